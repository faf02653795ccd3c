"""Mixing sources to target weights.

Sizes (words) are summed per source; targets share ``BUDGET`` times all words by
weight, none above ``MOST`` times its source's size, the excess shared anew by weight
until none is above. The repetition rate of a source is target / size; a document is
taken floor(rate) times plus one copy with probability equal to the fraction, decided
by a hash of its id and the seed, so reruns agree and no order matters.

Edge cases: a null source is a source (the last one); null and empty texts have size
0 and take 0 words; a source without words has target 0; repeated rows (the same
doc_id) take the same decision; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glean.llm.common import WORD_RE, save, table
from glean.llm.registry import query

BUDGET_NUM, BUDGET_DEN = 3, 2
MOST = 2
WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def size_of(text="text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_RE)), F.lit(0)).cast("long")


def unit(doc_id="doc_id") -> Column:
    """A uniform number in [0, 1) from the document's id: the first 52 bits of its md5."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def ranked(sources: DataFrame) -> DataFrame:
    """rank (0, 1, ...) of each row by code point, null last: local ranks of range partitions plus their offsets."""
    s = save(sources.withColumn("last", F.col("source").isNull()).orderBy("last", "source")
             .withColumn("part", F.spark_partition_id()), "sources")
    first = s.groupBy("part").agg(F.count("*").alias("n"))
    first = first.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a partition
    local = F.row_number().over(Window.partitionBy("part").orderBy("last", "source"))
    return s.join(first, "part").select("source", "source_size", (F.col("before") + local - 1).alias("rank"))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of each source; ``sizes`` has (source, source_size)."""
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int")).cast("long")
    s = save(ranked(sizes).withColumn("weight", weight), "weights")
    budget = F.sum("source_size") * BUDGET_NUM
    first = s.agg(F.coalesce(budget, F.lit(0)).alias("t"), F.coalesce(F.sum("weight"), F.lit(1)).alias("w")).first()
    total = first["t"]  # BUDGET_DEN times the words to share
    # Shares are (weight * num) / (den * free weight): exact integers until the one division.
    num, den, capped, n_capped = total, first["w"], F.lit(False), 0
    while True:
        over = F.col("weight").cast("decimal(38,0)") * F.lit(str(num)).cast("decimal(38,0)") > F.col("source_size").cast("decimal(38,0)") * F.lit(str(MOST * BUDGET_DEN * den)).cast("decimal(38,0)")
        row = s.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("source_size"))).alias("size"), F.sum(F.when(~over, F.col("weight"))).alias("free")).first()
        capped = over
        if row["n"] == n_capped or not row["free"]:
            break
        n_capped, num, den = row["n"], total - MOST * BUDGET_DEN * (row["size"] or 0), row["free"]
    share = F.col("weight").cast("double") * F.lit(float(num)) / F.lit(float(BUDGET_DEN * den))
    return s.select("source", "source_size", F.when(capped, (MOST * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def copies() -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return F.floor(rate) + F.when(unit() < rate - F.floor(rate), 1).otherwise(0)


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every row of docs."""
    sized = save(docs.select("doc_id", "source", size_of().alias("size")), "sizes")
    t = save(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    t = t.withColumnRenamed("source", "of")
    out = sized.join(t, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", copies())
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """docs with each row repeated as often as the mix takes it (rows taken 0 times go)."""
    columns = docs.columns
    plain = docs.toDF(*[c if c in ("doc_id", "text", "source") else f"c{i}" for i, c in enumerate(columns)])
    sizes = plain.select("source", size_of().alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    t = save(targets(sizes), "targets").withColumnRenamed("source", "_of")
    out = plain.join(t, F.col("source").eqNullSafe(F.col("_of"))).withColumn("_n", copies().cast("int"))
    return (out.filter("_n > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
            .select(*plain.columns).toDF(*columns))


_ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
c AS (SELECT *, COALESCE(SUM(source_size) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_size,
        SUM(weight) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
        SUM(source_size) OVER () * 3 AS t3,
        row_number() OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST) AS k FROM w),
f AS (SELECT *, CAST(weight AS HUGEINT) * (t3 - 4 * before_size) <= CAST(source_size AS HUGEINT) * 4 * free AS fits FROM c),
m AS (SELECT arg_min(CAST(t3 - 4 * before_size AS DOUBLE), k) AS num, arg_min(CAST(2 * free AS DOUBLE), k) AS den, MIN(k) AS k0 FROM f WHERE fits),
t AS (SELECT source, source_size, CASE WHEN k < COALESCE(k0, 1000000000) THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(weight AS DOUBLE) * num / den END AS target FROM f, m),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        CAST(CAST('0x' || substr(md5('mix-1:' || COALESCE(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r
"""


@query("op8_mixing", _ORACLE)
def op8_mixing(spark, sf_dir):
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
