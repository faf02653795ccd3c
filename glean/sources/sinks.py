"""Sinks: JSON Lines and records (non-ASCII kept literal), snapshot stamping, empty guard.

A result is computed once: it goes to a sibling folder while its metrics are observed,
and takes its place by a rename. An empty result leaves nothing, and what was there stays;
readers never see a half-written folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def run_id(run_ts: str) -> str:
    """Snapshot stamp ``%Y%m%d_%H%M%S`` from an ISO timestamp passed in by the caller."""
    from datetime import datetime

    return datetime.fromisoformat(run_ts).strftime("%Y%m%d_%H%M%S")


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_once(df: DataFrame, path: str, fmt: str = "json", partition_by=(), run_ts: str | None = None,
               **metrics: Column) -> dict:
    """Write ``df`` in one pass; returns its number of rows (``n``) and ``metrics``, observed on the way.

    ``path`` is replaced; with ``run_ts`` only its folder ``run_id=<stamp>/`` is (one snapshot per run).
    """
    spark, stamp = df.sparkSession, f"/run_id={run_id(run_ts)}" if run_ts is not None else ""
    seen, path = Observation(), path.rstrip("/")
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in metrics.items()])
    if stamp:
        df, partition_by = df.withColumn("run_id", F.lit(run_id(run_ts))), ["run_id", *partition_by]
    staging = f"{path}.writing-{uuid.uuid4().hex}"
    fs, staged = _file_system(spark, staging)
    try:
        df.write.option("ignoreNullFields", "false").partitionBy(*partition_by).format(fmt).save(staging)
        got = seen.get
        if got["n"]:
            (_, source), (_, place) = _file_system(spark, staging + stamp), _file_system(spark, path + stamp)
            fs.mkdirs(place.getParent())
            fs.delete(place, True)
            if not fs.rename(source, place):
                raise OSError(f"cannot move {staging} to {path}{stamp}")
    finally:
        fs.delete(staged, True)
    return got


def write_jsonl(df: DataFrame, path: str, run_ts: str | None = None, columns=None, partition_by=None) -> bool:
    """Write rows as JSON Lines; nulls are written as ``null`` rather than dropped.

    With ``run_ts`` the rows go to ``run_id=<stamp>/``; ``partition_by`` adds further partition
    folders. An empty result writes nothing and returns False.
    """
    return write_once(df.select(*(columns or df.columns)), path, partition_by=partition_by or (), run_ts=run_ts)["n"] > 0


def write_projects(records: DataFrame, path: str, run_ts: str | None = None) -> dict:
    """Project records (``operators.records``) as JSON Lines, one line per project and chunk; returns what was counted."""
    return write_once(records, path, run_ts=run_ts, actions=F.sum(F.size("actions")), libraries=F.sum(F.size("function_libraries")),
                      projects=F.sum(F.when(F.col("chunk") == 0, 1).otherwise(0)))
