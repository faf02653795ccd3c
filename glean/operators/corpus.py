"""Corpus assembly: union of sources, first-wins dedup, augmentation, order, split.

Randomness in the original (template choice, shuffle, split) is replaced by
stable hashes of content, so a rerun (or a retried task) gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.text import col_of
from glean.operators.dedup import dedup_first, dedup_late
from glean.session import cut_lineage, save_table

HASH_BUCKETS = 1_000_000


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Bag union of the branches (each carries its ``src_rank``)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def dedup_corpus(df: DataFrame, key: str = "output_key",
                 order=("src_rank", "src_path", "src_pos")) -> DataFrame:
    """One seen-set across all sources: the first row by source, file, position wins.
    Rows with their texts take the late way; rows without, one aggregate."""
    return (dedup_late if "output" in df.columns else dedup_first)(df, key, list(order))


def augment(df: DataFrame, rewrites=R.AUGMENT_REWRITES, col: str = "instruction") -> DataFrame:
    """Keep each row and add one variant per rewrite that changes the text
    (case-sensitive, all occurrences). ``aug_pos`` is 0 for the original."""
    variants = [F.struct(F.lit(0).alias("aug_pos"), F.col(col).alias("text"))]
    for i, (old, new) in enumerate(rewrites, start=1):
        variants.append(F.struct(F.lit(i).alias("aug_pos"), F.replace(F.col(col), F.lit(old), F.lit(new)).alias("text")))
    kept = F.filter(F.array(*variants), lambda v: (v["aug_pos"] == 0) | (v["text"] != F.col(col)))
    others = [c for c in df.columns if c != col]
    return (df.select(*others, F.explode(kept).alias("_v"))
              .select(*others, F.col("_v.text").alias(col), F.col("_v.aug_pos").alias("aug_pos")))


def hash_bucket(key, seed: str = "", buckets: int = HASH_BUCKETS) -> Column:
    """Uniform bucket in [0, buckets) from md5(seed || key) (first 15 hex digits)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed), col_of(key).cast("string"))), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def seeded_order(df: DataFrame, key: str = "output_key", seed: str = "glean") -> DataFrame:
    """A reproducible shuffle: sort by a seeded hash (a distributed range sort)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), 1, 15), 16, 10).cast("bigint")
    return df.withColumn("shuffle_key", h).orderBy("shuffle_key", key)


def split_corpus(df: DataFrame, val_ratio: float = R.VAL_RATIO, group: str = "output_key",
                 seed: str = "split", exact: bool = False) -> DataFrame:
    """Train/validation split by group: a row is validation when its group's hash is
    small enough. All rows of a group (an output and its augmented variants) land on
    one side, so nothing leaks; no global sort or single-task window is needed.

    By default the bound is ``val_ratio`` of the hash range: the share holds in
    expectation. With ``exact`` it is the hash of the ``int(n * val_ratio)``-th
    smallest of the n groups (``kth_smallest``): exactly so many groups validate.
    """
    if not exact:
        threshold = int(round(val_ratio * HASH_BUCKETS))
        return df.withColumn("split", F.when(hash_bucket(F.col(group), seed) < threshold, "val").otherwise("train"))
    df = save_table(df, "split")   # read for the groups and again for the rows: the sources are worked through once
    groups = cut_lineage(df.select(F.col(group).alias("k")).distinct().withColumn("h", hash_60(F.col("k"), seed)))
    last = kth_smallest(groups, int(groups.count() * val_ratio))
    if last is None:
        return df.withColumn("split", F.lit("train"))
    h, k = hash_60(F.col(group), seed), F.col(group).cast("string")
    inside = (h < last[0]) | ((h == last[0]) & (F.coalesce(k, F.lit("")) <= (last[1] or "")))
    return df.withColumn("split", F.when(inside, "val").otherwise("train"))


def hash_60(key, seed: str) -> Column:
    """60 bits of md5(seed || key); a null key hashes as an empty one."""
    text = F.concat(F.lit(seed), F.coalesce(col_of(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def kth_smallest(values: DataFrame, k: int, bits: int = 60, digit: int = 15, few: int = 4096):
    """(h, k) of the ``k``-th smallest row of ``values`` (h: long below 2**bits, k: its key, breaking ties); None if k is 0.

    Distributed selection: each pass counts the rows by the next ``digit`` bits of h among those that share the
    bits found so far (at most 2**digit counts come back) and goes on in the bucket that holds the k-th.
    """
    if k <= 0:
        return None
    left, at, shift = values, k, bits
    while shift > 0:
        shift = max(0, shift - digit)
        by = F.shiftright(F.col("h"), shift)
        counts = sorted((r["b"], r["n"]) for r in left.groupBy(by.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        for b, n in counts:
            if at <= n:
                break
            at -= n
        else:
            raise ValueError(f"fewer than {k} rows")
        left = left.filter(by == b)
        if n <= few:
            break
    row = left.orderBy("h", F.coalesce(F.col("k").cast("string"), F.lit(""))).limit(at).orderBy(F.desc("h"), F.desc(F.coalesce(F.col("k").cast("string"), F.lit("")))).first()
    return row["h"], row["k"]


def leakage(split_df: DataFrame, group: str = "output_key") -> DataFrame:
    """Groups present on both sides (must be empty)."""
    return (split_df.groupBy(group).agg(F.countDistinct("split").alias("sides"))
                    .filter(F.col("sides") > 1))


def format_prompt_col(instruction, input_, output) -> Column:
    """The instruction prompt: Instruction, optional Input (only when non-empty), Response."""
    i = F.coalesce(col_of(instruction), F.lit(""))
    x = F.coalesce(col_of(input_), F.lit(""))
    o = F.coalesce(col_of(output), F.lit(""))
    with_input = F.concat(F.lit("### Instruction:\n"), i, F.lit("\n\n### Input:\n"), x, F.lit("\n\n### Response:\n"), o)
    without = F.concat(F.lit("### Instruction:\n"), i, F.lit("\n\n### Response:\n"), o)
    return F.when(F.length(x) > 0, with_input).otherwise(without)


def format_prompt(df: DataFrame, out: str = "text") -> DataFrame:
    return df.withColumn(out, format_prompt_col(F.col("instruction"), F.col("input"), F.col("output")))
