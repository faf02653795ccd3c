"""op5 on a line that most texts repeat: one key holds nearly all runs, and no task may get them all."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glean.llm import suffix_dedup
from tests.llm.test_operators import prose

LINE = prose(1, 25) + "\n"


def texts():
    return [(k, prose(100 + k, 20) + LINE * (8 + k % 5) + prose(200 + k, 30 + k % 3 * 40)) for k in range(50)] + [(None, LINE * 9), (3, LINE * 9), (90, None)]


def brute_force(rows):
    all_ = [(t or "").encode() for _, t in rows]
    count = collections.Counter(b[s:s + 400] for b in all_ for s in range(len(b) - 399))
    want = collections.Counter()
    for (i, _), b in zip(rows, all_):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 399):
            if count[b[s:s + 400]] > 1:
                gone[s:s + 400] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        want[i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()] += 1
    return want


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 0])  # sorted in blocks, and counted one by one
def test_common_key_is_dealt(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "COMMON", 10, raising=False)
    shares, passed = {}, collections.Counter()
    save = suffix_dedup.save

    def watched(df, name):
        passed[name] += 1
        if name == "runs":
            held = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            shares[name] = max(held) / sum(held)
            top = df.groupBy("key").count().agg(F.max("count")).first()[0]
            assert top > 0.5 * sum(held) and top > 100
        return save(df, name)

    monkeypatch.setattr(suffix_dedup, "save", watched)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = suffix_dedup.remove_repeats(spark.createDataFrame(texts(), "doc_id long, text string").coalesce(3)).drop("kept").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert collections.Counter(tuple(r) for r in got) == brute_force(texts())
    assert shares["runs"] < 0.4
    assert passed["windows"] == 1  # windows are hashed once, not for the count and again for the marks


def crowd():
    """One passage in very many surroundings, two of them common at its one end and one at the other, quoted from many starts."""
    passage = prose(7, 60)[:300]
    left, right, rare = prose(8, 60), prose(9, 60), prose(11, 60)
    rows = [prose(300 + k, 25) + passage + prose(600 + k, 25) for k in range(40)]  # shorter than 400 bytes: stays
    rows += [prose(900 + k, 25) + left[-50 - k % 7:] + passage + right[:100 + k % 5] + prose(1200 + k, 25) for k in range(40)]
    rows += [prose(1500 + k, 25) + rare[-150 + k:] + passage + right[:150 - 2 * k] + prose(1800 + k, 25) for k in range(40)]
    return [(k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 30, 3, 0])
def test_crowded_key_is_halved(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "COMMON", 10)
    made, save = {}, suffix_dedup.save

    def watched(df, name):
        df = save(df, name)
        made.setdefault(name, []).append(df.count())
        return df

    monkeypatch.setattr(suffix_dedup, "save", watched)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(crowd(), "doc_id long, text string")).drop("kept").collect()
    want = brute_force(crowd())
    assert collections.Counter(tuple(r) for r in got) == want
    assert sum(n_removed > 0 for _, _, n_removed, _, _ in want) > 60
    contexts = made["context-bytes"][0]
    assert contexts > 100
    assert made["windows"][0] < 8 * contexts  # not a row for each window of each context
    if 0 < hot < contexts:
        assert made["halves"] and all(n <= 2 * contexts for n in made["halves"])
        assert sum(made["halves"]) < 12 * contexts
