"""SparkSession helpers.

Library code never creates a session: operators take DataFrames. These helpers
are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins and
# coalesces/splits shuffle partitions from runtime statistics.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "glean", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. Master, memory and partitions are the cluster's
    (spark-submit, spark-defaults) unless the caller names them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def get_local_session(app: str, shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session on this machine's cores (bench and tools)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    return get_session(app, f"local[{cpus}]", shuffle_partitions or int(cpus), {"spark.driver.memory": "16g", **(extra or {})})


def cut_lineage(df):
    """``df`` written to the shared checkpoint folder and read back from it, so that steps
    which read it several times neither repeat what is below nor carry it in their plans."""
    if ensure_checkpoint_dir(df.sparkSession) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return df.checkpoint()


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the cluster's checkpoint folder, setting a scratch one only if unset
    and only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    we never replace it, and never invent a machine-local one there (None is
    returned). Local runs (tests) get a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        return None
    path = tempfile.mkdtemp(prefix="glean-ckpt-")
    sc.setCheckpointDir(path)
    return path


def save_table(df, name: str):
    """``df`` written once as Parquet to the shared checkpoint folder and read back: unlike a
    checkpoint, what follows reads only the columns it needs."""
    import uuid

    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = f"{folder.rstrip('/')}/glean-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
