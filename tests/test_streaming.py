"""X-1: incremental ingest over two arrivals equals the batch result (as a key set)."""

import json
import os

from pyspark.sql import functions as F

from glean.plans.branches import code_branch
from glean.sources.jsonl import read_code_samples
from glean.streaming.ingest import start_ingest

BODY = "Dim x\nSet b = Browser(\"B\")\nIf x Then\n  b.Click\nEnd If\n"


def sample(i, dup_of=None):
    code = BODY + f"' variant {dup_of if dup_of is not None else i}\n"
    return json.dumps({"source": "github", "code": code, "language": "vbscript", "description": f"d{i}"})


def test_two_arrivals_equal_batch(spark, tmp):
    landing, sink, ckpt = f"{tmp}/landing", f"{tmp}/sink", f"{tmp}/ckpt"
    os.makedirs(f"{landing}/github")
    with open(f"{landing}/github/a_1.jsonl", "w") as f:
        f.write("\n".join(sample(i) for i in range(5)) + "\n")
    q = start_ingest(spark, f"{landing}/github", sink, ckpt)
    q.awaitTermination(120)
    first = {r[0] for r in spark.read.parquet(sink).select("output_key").collect()}
    assert len(first) == 5
    with open(f"{landing}/github/a_2.jsonl", "w") as f:
        f.write("\n".join([sample(10, dup_of=1), sample(11), "{bad"]) + "\n")
    q = start_ingest(spark, f"{landing}/github", sink, ckpt)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    keys = [r[0] for r in out.select("output_key").collect()]
    assert len(keys) == len(set(keys)) == 6
    batch = code_branch(read_code_samples(spark, tmp + "/landing"))
    assert set(keys) == {r[0] for r in batch.select("output_key").collect()}
    assert out.select(F.max("batch_id")).first()[0] >= 1


def test_replayed_batch_is_idempotent(spark, tmp):
    """A micro-batch retried after a failure (same batch id) rewrites its own
    partition and reads only earlier batches' keys: the sink does not change."""
    from glean.sources.jsonl import CODE_SAMPLE_SCHEMA, with_corrupt
    from glean.streaming.ingest import process_batch

    sink = f"{tmp}/sink"
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.jsonl", "w") as f:
        f.write("\n".join(sample(i) for i in range(4)) + "\n")
    batch0 = (spark.read.schema(with_corrupt(CODE_SAMPLE_SCHEMA)).json(f"{tmp}/in")
              .withColumn("src_path", F.lit("a.jsonl")))
    run = process_batch(sink)
    run(batch0, 0)
    first = sorted(r[0] for r in spark.read.parquet(sink).select("output_key").collect())
    run(batch0, 0)                      # replay of batch 0
    assert sorted(r[0] for r in spark.read.parquet(sink).select("output_key").collect()) == first
    run(batch0, 1)                      # the same rows arriving later add nothing
    assert sorted(r[0] for r in spark.read.parquet(sink).select("output_key").collect()) == first


def test_state_store_variant_equals_batch(spark, tmp):
    from glean.streaming.ingest import start_ingest_stateful
    landing, sink, ckpt = f"{tmp}/landing", f"{tmp}/sink", f"{tmp}/ckpt"
    os.makedirs(f"{landing}/github")
    with open(f"{landing}/github/a_1.jsonl", "w") as f:
        f.write("\n".join([sample(0), sample(1), sample(2), sample(9, dup_of=1)]) + "\n")
    start_ingest_stateful(spark, f"{landing}/github", sink, ckpt).awaitTermination(180)
    first = spark.read.parquet(sink)
    assert first.count() == 3
    assert first.filter(F.col("output").contains("variant 1")).count() == 1
    with open(f"{landing}/github/a_2.jsonl", "w") as f:
        f.write("\n".join([sample(10, dup_of=2), sample(11)]) + "\n")
    start_ingest_stateful(spark, f"{landing}/github", sink, ckpt).awaitTermination(180)
    out = spark.read.parquet(sink)
    keys = [r[0] for r in out.select("output_key").collect()]
    assert len(keys) == len(set(keys)) == 4
    batch = code_branch(read_code_samples(spark, tmp + "/landing"))
    assert set(keys) == {r[0] for r in batch.select("output_key").collect()}


def test_first_row_of_frames_that_come_one_by_one():
    """A hot key's batch passes in pieces; at most a piece and one row are held."""
    import random

    import pandas as pd

    from glean.streaming.ingest import FIRST, first_row

    rnd = random.Random(1)
    rows = [(f"p{rnd.randrange(3)}", rnd.randrange(4), f"o{rnd.randrange(3)}", f"i{k}") for k in range(500)]
    pieces = (pd.DataFrame(rows[k:k + 7], columns=FIRST) for k in range(0, 500, 7))
    got = first_row(pieces)
    assert len(got) == 1 and tuple(got.iloc[0]) == min(rows)
    assert first_row(iter([])) is None


def test_state_expires(spark, tmp):
    """With a time to live, a key seen long ago is new again, and the store doesn't keep it; a key seen just now is not."""
    import time

    from glean.streaming.ingest import start_ingest_stateful
    landing, sink, ckpt = f"{tmp}/landing", f"{tmp}/sink", f"{tmp}/ckpt"
    os.makedirs(landing)

    def arrive(name, *samples, ttl):
        with open(f"{landing}/{name}.jsonl", "w") as f:
            f.write("\n".join(samples) + "\n")
        q = start_ingest_stateful(spark, landing, sink, ckpt, ttl_ms=ttl)
        q.awaitTermination(180)
        return q.lastProgress["stateOperators"][0]["numRowsTotal"]

    ttl = 15_000
    assert arrive("a", sample(0), sample(1), ttl=ttl) >= 2
    arrive("b", sample(0), ttl=ttl)  # again, at once: known
    assert spark.read.parquet(sink).count() == 2
    time.sleep(ttl / 1000 + 1)
    arrive("c", sample(1), sample(2), ttl=ttl)  # sample 1 has expired
    out = spark.read.parquet(sink)
    assert out.count() == 4 and out.filter(F.col("output").contains("variant 1")).count() == 2
    time.sleep(ttl / 1000 + 1)
    kept = [arrive(f"d{k}", sample(50 + k), ttl=ttl) for k in range(2)]
    assert max(kept) <= 4  # what expired is gone: the store holds the last arrivals only
