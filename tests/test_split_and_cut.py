"""The exact split by distributed selection, and texts cut at token ends."""

import hashlib
import random
import re

import pytest
from conftest import one
from pyspark.sql import functions as F

from glean.operators import corpus as C
from glean.operators import training_views as TV


def h60(key, seed="split"):
    return int(hashlib.md5((seed + (key or "")).encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("n, ratio", [(0, 0.5), (3, 0.05), (1000, 0.05), (1000, 0.333), (50, 1.0)])
def test_exact_split(spark, n, ratio):
    df = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("output_key"), F.explode(F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))).alias("aug"))
    got = C.split_corpus(df, ratio, exact=True).collect()
    val = {r["output_key"] for r in got if r["split"] == "val"}
    want = sorted({r["output_key"] for r in got}, key=lambda k: (h60(k), k))[:int(n * ratio)]
    assert val == set(want) and not val & {r["output_key"] for r in got if r["split"] == "train"} and len(got) == df.count()


def test_a_null_group_counts_as_one(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",)], "output_key string")
    got = [r["split"] for r in C.split_corpus(df, 0.67, exact=True).collect()]
    assert got.count("val") in (2, 3) and len(got) == 4


@pytest.mark.parametrize("bits, digit, few", [(60, 15, 4096), (60, 15, 1), (12, 5, 1), (12, 12, 0), (4, 2, 0)])
def test_kth_smallest(spark, bits, digit, few):
    """Also where many rows share a hash: then the key decides."""
    rnd = random.Random(bits)
    rows = sorted((rnd.randrange(1 << bits), f"k{i:03d}") for i in range(300))
    df = spark.createDataFrame(rows, "h long, k string").repartition(3)
    for k in (1, 2, 137, 299, 300):
        assert C.kth_smallest(df, k, bits, digit, few) == rows[k - 1]
    assert C.kth_smallest(df, 0) is None
    with pytest.raises(ValueError):
        C.kth_smallest(df, 301, bits, digit, few)


TEXTS = ["", "a", "a b  c", " lead, then more! \n", "naïve café  日本語 x_y 12", "...", "a　b\x0bc\x1cd", "tail   "]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100])
def test_texts_are_cut_at_token_ends(spark, n):
    token = re.compile(r"(?:[^\W_]|_)+|[^\w\s]")
    for t in TEXTS:
        ends = [m.end() for m in token.finditer(t)]
        assert one(spark, TV.first_tokens(F.col("x"), n), t) == (t[:ends[n - 1]] if len(ends) > n else t)


def test_kept_counts(spark):
    df = spark.createDataFrame([("a b c d e",), (None,)], "text string")
    got = [r.asDict() for r in TV.length_budget(df, budgets=(3, 9), keep=True).collect()]
    assert got == [{"text": "a b c d e", "n_tokens": 5, "truncated_3": True, "kept_3": 3, "text_3": "a b c", "truncated_9": False, "kept_9": 5, "text_9": "a b c d e"},
                   {"text": None, "n_tokens": 0, "truncated_3": False, "kept_3": 0, "text_3": "", "truncated_9": False, "kept_9": 0, "text_9": ""}]
    cut = TV.length_budget(df, budgets=(3,), keep=True)
    again = TV.length_budget(cut.select(F.col("text_3").alias("text")), budgets=(3,))
    assert [r["n_tokens"] for r in again.collect()] == [r["kept_3"] for r in cut.collect()]


def test_the_exact_split_works_its_sources_through_once(spark):
    df = spark.range(40).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("output_key"))
    got = C.split_corpus(df, 0.25, exact=True)
    assert "Range" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.filter("split = 'val'").count() == 10
