"""Training views: chat rendering, length budgets, padding and packing accounts.

Token counts are an estimate (words and single punctuation marks), not a
model tokenizer: the reference tokenizers need model files, and the estimate
is what a data job can compute everywhere, consistently.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glean.functions.text import PY_WHITESPACE, col_of, regex_class

# A token: a run of letters/digits/underscore, or one other non-space character.
TOKEN = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_" + regex_class(PY_WHITESPACE)[1:-1] + "]"
BUDGETS = (1024, 2048, 4096)

CHATML_START, CHATML_END = "<|im_start|>", "<|im_end|>"


def token_count(text) -> Column:
    return F.regexp_count(F.coalesce(col_of(text), F.lit("")), F.lit(TOKEN))


def chat_segment(role, text) -> Column:
    """One chatml turn: start marker + role, newline, content, end marker, newline."""
    return F.concat(F.lit(CHATML_START), col_of(role), F.lit("\n"), F.coalesce(col_of(text), F.lit("")),
                    F.lit(CHATML_END + "\n"))


def render_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """One row per conversation: its turns rendered in turn order.

    The conversation is the unit of output (one training text), so its turns are
    gathered per key; the turns are pre-rendered first, so only the small
    (turn, segment) pairs move through the aggregation.
    """
    seg = df.select(conv, F.struct(F.col(turn).alias("t"), chat_segment(F.col(role), F.col(text)).alias("s")).alias("x"))
    return (seg.groupBy(conv)
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]), "").alias("text"),
                    F.count(F.lit(1)).alias("n_turns")))


#: A token with the white space before it: these pieces, joined, are the text up to a token's end.
PIECE = regex_class(PY_WHITESPACE) + "*(?:" + TOKEN + ")"


def first_tokens(text, n: int) -> Column:
    """The text up to the end of its ``n``-th token; the whole text if it has no more than ``n``."""
    c = F.coalesce(col_of(text), F.lit(""))
    cut = F.array_join(F.slice(F.regexp_extract_all(c, F.lit(PIECE), 0), 1, n), "")
    return F.when(token_count(c) > n, cut).otherwise(c)


def length_budget(df: DataFrame, text: str = "text", budgets=BUDGETS, keep: bool = False) -> DataFrame:
    """Token estimate (``n_tokens``) and, per budget, whether the text is truncated and how many tokens stay
    (``kept_<b>``; labels are the same tokens). ``keep`` adds the cut text itself (``text_<b>``)."""
    out = df.withColumn("n_tokens", token_count(F.col(text)))
    for b in budgets:
        out = out.withColumn(f"truncated_{b}", F.col("n_tokens") > b).withColumn(f"kept_{b}", F.least(F.col("n_tokens"), F.lit(b)))
        if keep:
            out = out.withColumn(f"text_{b}", first_tokens(F.col(text), b))
    return out


def default_shards(df: DataFrame) -> int:
    """One shard per shuffle partition: the cluster's own sizing of a task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def padding_account(df: DataFrame, length: str, key: str, n_shards: int | None = None, batch_size: int = 4,
                    multiple: int = 8) -> DataFrame:
    """Pad-to-longest batches, rounded up to ``multiple``: per batch the padded
    and real token counts. Batches are formed within hash shards of ``key``
    (``n_shards`` sized to the data; by default one per shuffle partition), so
    no window holds more than a shard."""
    n_shards = n_shards or default_shards(df)
    w = Window.partitionBy("shard").orderBy(key)
    b = (df.withColumn("shard", F.pmod(F.col(key), F.lit(n_shards)))
           .withColumn("batch", F.floor((F.row_number().over(w) - 1) / batch_size)))
    g = b.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n_seqs"), F.max(length).alias("max_len"),
                                         F.sum(length).alias("real_tokens"))
    padded = (F.ceil(F.col("max_len") / multiple) * multiple).cast("long")
    return (g.withColumn("padded_len", padded)
             .withColumn("padded_tokens", F.col("padded_len") * F.col("n_seqs"))
             .withColumn("pad_tokens", F.col("padded_tokens") - F.col("real_tokens")))


PACK_SCHEMA = "shard long, key long, length long, pack_id long"


def _next_fit(budget: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        lengths = pdf["length"].clip(upper=budget).to_numpy()
        ids, cur, fill = [], 0, 0
        for n in lengths:
            if fill and fill + n > budget:
                cur, fill = cur + 1, 0
            fill += n
            ids.append(cur)
        return pd.DataFrame({"shard": pdf["shard"].to_numpy(), "key": pdf["key"].to_numpy(),
                             "length": pdf["length"].to_numpy(), "pack_id": ids})
    return pack


def pack_sequences(df: DataFrame, length: str, key: str, budget: int = 4096, n_shards: int | None = None) -> DataFrame:
    """Next-fit packing into sequences of at most ``budget`` tokens (a longer
    sequence is truncated to the budget and fills a pack alone).

    Packing is sequential within a shard, so each hash shard of ``key`` is
    packed by ``applyInPandas``; ``n_shards`` bounds the rows a task holds
    (by default one shard per shuffle partition).
    """
    n_shards = n_shards or default_shards(df)
    s = df.select(F.pmod(F.col(key), F.lit(n_shards)).cast("long").alias("shard"),
                  F.col(key).cast("long").alias("key"), F.col(length).cast("long").alias("length"))
    return s.groupBy("shard").applyInPandas(_next_fit(budget), PACK_SCHEMA)


def pack_stats(packed: DataFrame, budget: int = 4096) -> DataFrame:
    return (packed.withColumn("kept", F.least(F.col("length"), F.lit(budget)))
                  .groupBy("shard", "pack_id").agg(F.count(F.lit(1)).alias("n_seqs"), F.sum("kept").alias("fill")))
