"""Summary statistics: counts by key, tag frequency, volume check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *cols: str, total: bool = False, name: str = "n") -> DataFrame:
    """Row count per key. ``total=True`` adds a grand-total row through
    ``rollup`` (key columns null on that row, ``is_total`` true)."""
    if not total:
        return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    return (df.rollup(*cols).agg(F.count(F.lit(1)).alias(name), F.grouping_id().alias("_gid"))
              .withColumn("is_total", F.col("_gid") > 0).drop("_gid"))


def tag_counts(df: DataFrame, tags: str = "tags") -> DataFrame:
    return df.select(F.explode(F.col(tags)).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def top_tags(df: DataFrame, tags: str = "tags", k: int = 10) -> DataFrame:
    """The k most frequent tags. The limit is the feature (a top-k report);
    Spark plans it as TakeOrderedAndProject over the aggregated counts.
    Ties break by tag name."""
    return tag_counts(df, tags).orderBy(F.desc("n"), F.asc("tag")).limit(k)


def volume_check(df: DataFrame, minimum: int = 1000) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_examples")).withColumn(
        "low_volume", F.col("n_examples") < F.lit(minimum))
