"""Driver tables (one parquet file each) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

# Per-table key used to spread rows over tasks (deterministic hash partitioning).
SPREAD_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id", "part": "p_partkey",
               "events": "event_id", "supplier": "s_suppkey", "labels": "doc_id", "orders": "o_orderkey",
               "lineitem": "l_orderkey", "benchmark": "item_id", "embeddings": "vec_id"}


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give CPU-heavy text work at least one task per core.

    A scan yields one task per file split; a single-row-group file is one task.
    On a cluster reading many files this is a no-op; when the scan has fewer
    partitions than the cluster's parallelism we hash-partition on the row key
    (deterministic on retry, unlike round-robin).
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001 - a session without the RDD API: leave the scan as it is
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name), SPREAD_KEYS.get(name))
