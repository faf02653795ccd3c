"""First-wins deduplication without a per-key window, for narrow rows and for rows with text.

A ``row_number()`` window partitioned by the key would put every copy of a hot
key (say a boilerplate file that is a third of the corpus) into one task and
sort it there. Instead we aggregate: ``min_by(row, order)`` per key. Spark runs
it as partial aggregation before the shuffle, so each map task forwards at most
one row per key and the hot key costs one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions.text import col_of, py_strip
from glean.session import cut_lineage, save_table

#: Bits of the sketch of repeated keys (16 MB, broadcast): a bound, whatever the number of keys.
SKETCH_BITS = 1 << 27


def output_key(c) -> Column:
    """md5 hex of the lower-cased, stripped text (the corpus dedup key)."""
    return F.md5(F.lower(py_strip(col_of(c))))


def dedup_first(df: DataFrame, key, order: list) -> DataFrame:
    """Keep the first row per ``key`` (a column name or a list of them) by
    ``order`` (columns; unique per row within a key)."""
    cols = df.columns
    order_col = F.struct(*[col_of(o) for o in order]) if len(order) > 1 else col_of(order[0])
    keys = [key] if isinstance(key, str) else list(key)
    winners = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order_col).alias("_first"))
    return winners.select("_first.*")


def repeated_keys(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """keys and _first (the smallest order) of the keys that occur more than once; narrow, partially aggregated."""
    seen = rows.groupBy(*keys).agg(F.min(F.struct(*[col_of(o) for o in order])).alias("_first"), F.count(F.lit(1)).alias("_n"))
    return seen.filter(F.col("_n") > 1).drop("_n")


def maybe_repeated(rows: DataFrame, repeated: DataFrame, keys: list[str], bits: int = SKETCH_BITS) -> DataFrame:
    """``rows`` with _maybe: false only where the key certainly isn't one of ``repeated``.

    The sketch is a bitmap over hashes of the repeated keys, in pieces of 32,768 bits; pieces
    merge by OR, so it is built by partial aggregation. It has no false negatives, and a false
    positive only takes the longer way.
    """
    def bit(*ks):
        return F.pmod(F.xxhash64(*ks), F.lit(bits)) + 1

    sketch = (repeated.select(bit(*keys).alias("_h")).groupBy(F.expr("bitmap_bucket_number(_h)").alias("_bucket"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_h))").alias("_bits")))
    at = rows.withColumn("_h", bit(*keys)).withColumn("_of", F.expr("bitmap_bucket_number(_h)"))
    out = at.join(F.broadcast(sketch), F.col("_of") == F.col("_bucket"), "left")
    byte = F.expr("cast(conv(hex(substring(_bits, cast(bitmap_bit_position(_h) div 8 + 1 as int), 1)), 16, 10) as bigint)")
    found = F.col("_bits").isNotNull() & (F.getbit(byte, F.expr("cast(bitmap_bit_position(_h) % 8 as int)")) == 1)
    return out.withColumn("_maybe", found).drop("_h", "_of", "_bucket", "_bits")


def dedup_late(df: DataFrame, key, order: list, bits: int = SKETCH_BITS) -> DataFrame:
    """``dedup_first`` for rows that carry text: winners are found on (key, order) alone.

    Rows are written once to the shared folder. Keys that occur once - nearly all - are told
    by a sketch of the repeated ones and leave without aggregate or exchange; only rows whose
    key may be repeated are joined with the winners. Rows equal in key and order count as one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols, plain = df.columns, [o for o in order if isinstance(o, str)]
    if len(plain) != len(order):
        raise ValueError("order takes column names")
    rows = save_table(df, "dedup")
    repeated = cut_lineage(repeated_keys(rows.select(*dict.fromkeys([*keys, *plain])), keys, plain))
    marked = maybe_repeated(rows, repeated, keys, bits)
    names = [f"_k{i}" for i in range(len(keys))]
    winners = repeated.toDF(*names, "_first")
    same = F.col("_k0").eqNullSafe(F.col(keys[0]))
    for n, k in zip(names[1:], keys[1:]):
        same = same & F.col(n).eqNullSafe(F.col(k))
    copies = marked.filter("_maybe").join(winners, same, "left")
    copies = copies.filter(F.col("_first").isNull() | (F.struct(*plain) == F.col("_first"))).select(*cols).dropDuplicates(keys)
    return marked.filter(~F.col("_maybe")).select(*cols).unionByName(copies)


def anti_dedup(new: DataFrame, existing: DataFrame, key: str = "output_key") -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing`` (batch-to-batch dedup)."""
    return new.join(existing.select(key).distinct(), on=key, how="left_anti")
