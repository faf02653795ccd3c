"""Incremental landing-zone ingest with first-wins dedup (Structured Streaming).

New stamped JSON Lines files of code samples arrive in a landing folder. Each
micro-batch is turned into corpus rows (clean, validate, key, first-wins dedup
inside the batch) and appended unless its key is already in the sink.

State is the sink itself, a parquet table in shared storage partitioned by
``batch_id``: the anti-join reads only earlier batches (partition pruning),
and a replayed batch overwrites its own partition, so a retry after a lost
executor or driver is idempotent. The stream's checkpoint folder records the
files already consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from glean.operators.dedup import anti_dedup
from glean.plans.branches import code_branch
from glean.sources.jsonl import CODE_SAMPLE_SCHEMA, CORRUPT, path_exists, with_corrupt


def corpus_keys_before(spark: SparkSession, sink: str, batch_id: int) -> DataFrame | None:
    if not path_exists(spark, sink):
        return None
    existing = spark.read.parquet(sink)
    return existing.filter(F.col("batch_id") < batch_id).select("output_key")


def process_batch(sink: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = (batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
                .withColumn("src_pos", F.monotonically_increasing_id()))
        corpus = code_branch(rows)
        seen = corpus_keys_before(spark, sink, batch_id)
        if seen is not None:
            corpus = anti_dedup(corpus, seen)
        (corpus.withColumn("batch_id", F.lit(batch_id))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id").parquet(sink))
    return run


def start_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the ingest stream; with ``available_now`` it drains what is there and stops."""
    reader = (spark.readStream.schema(with_corrupt(CODE_SAMPLE_SCHEMA))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", "*.jsonl"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing).withColumn("src_path", F.col("_metadata.file_path"))
    writer = stream.writeStream.foreachBatch(process_batch(sink)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


# --- state-store variant ----------------------------------------------------------------
#
# The sink-as-state ingest above anti-joins each micro-batch against every key
# written so far, so its per-trigger work grows with the corpus. This variant
# keeps the seen-set in Spark's state store instead (RocksDB, one boolean per
# key): per trigger it touches only the keys of that batch. A key seen in an
# earlier batch emits nothing until its state expires, ``ttl_ms`` after it was
# last seen: the store then stops growing (None keeps keys for ever). Within a
# batch the first row per key by (file, block offset, content) wins: a streaming
# file source exposes no line position, so rows of one file block tie-break by
# content (the foreachBatch variant keeps exact line order). The checkpoint holds
# the state, so a replayed batch starts from the state before it.

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
FIRST = ["src_path", "src_pos", "output", "instruction"]


def first_row(frames):
    """The first row by FIRST over frames that come one by one; at most one row is held besides the frame in hand."""
    import pandas as pd

    best = None
    for f in frames:
        f = f if best is None else pd.concat([best, f], ignore_index=True)
        for c in FIRST:  # narrows to the smallest, without sorting the frame
            f = f[f[c] == f[c].min()] if f[c].notna().any() else f
        best = f.head(1)
    return best


class FirstUnseen(StatefulProcessor):
    """Emits a key's first row unless its state says that it was seen."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        known = self.seen.exists()
        self.seen.update((True,))
        if known:
            for _ in rows:  # passed by, not held
                pass
            return
        best = first_row(rows)
        if best is not None:
            yield best

    def close(self) -> None:
        pass


def start_ingest_stateful(spark: SparkSession, landing: str, sink: str, checkpoint: str, available_now: bool = True,
                          max_files_per_trigger: int | None = None, ttl_ms: int | None = None):
    """Incremental ingest with the seen-set in the state store; appends parquet to ``sink``."""
    reader = (spark.readStream.schema(with_corrupt(CODE_SAMPLE_SCHEMA))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", "*.jsonl"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = (reader.json(landing).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            .withColumn("src_path", F.col("_metadata.file_path"))
            .withColumn("src_pos", F.col("_metadata.file_block_start")))
    corpus = code_branch(rows, dedup=False)
    out = corpus.groupBy("output_key").transformWithStateInPandas(
        statefulProcessor=FirstUnseen(ttl_ms), outputStructType=corpus.schema, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
    writer = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    if available_now:  # with a time to live a drained query would wait for expiries: one batch takes what is there
        writer = writer.trigger(once=True) if ttl_ms else writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime="30 seconds")
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)  # the processor needs it; the query keeps it from its start
    try:
        return writer.start()
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
