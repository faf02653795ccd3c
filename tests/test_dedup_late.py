"""Late first-wins dedup: the same rows as the plain one, and text that stays out of aggregates and exchanges."""

import collections

import pytest
from pyspark.sql import functions as F

from glean.operators.dedup import dedup_first, dedup_late, maybe_repeated, repeated_keys


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.concat(F.lit("pair"), (F.col("id") % 210).cast("string"))).when(
        F.col("id") == 5, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(3000).repartition(7).select(key.alias("output_key"), (F.col("id") % 2).cast("int").alias("src_rank"), F.lit("p").alias("src_path"),
                                                   F.col("id").alias("src_pos"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("output"))


ORDER = ["src_rank", "src_path", "src_pos"]


@pytest.mark.parametrize("bits", [1 << 27, 1 << 16, 32])
def test_same_rows_as_the_plain_way(rows, bits):
    plain = collections.Counter(map(tuple, dedup_first(rows, "output_key", ORDER).collect()))
    late = collections.Counter(map(tuple, dedup_late(rows, "output_key", ORDER, bits).collect()))
    assert late == plain and len(plain) < 2000


def test_two_key_columns_and_equal_orders(spark):
    df = spark.createDataFrame([("a", None, 1, "x"), ("a", None, 1, "x"), ("a", 2, 1, "y"), (None, None, 3, "z"), (None, None, 2, "w")],
                               "k string, j int, pos int, output string")
    got = sorted(map(tuple, dedup_late(df, ["k", "j"], ["pos"]).collect()), key=str)
    assert got == [("a", 2, 1, "y"), ("a", None, 1, "x"), (None, None, 2, "w")]
    assert dedup_late(df.limit(0), "k", ["pos"]).count() == 0


def test_sketch_has_no_false_negatives_and_few_false_positives(rows):
    repeated = repeated_keys(rows, ["output_key"], ORDER)
    keys = {r["output_key"] for r in repeated.collect()}
    marked = maybe_repeated(rows, repeated, ["output_key"], 1 << 20).select("output_key", "_maybe").collect()
    assert all(r["_maybe"] for r in marked if r["output_key"] in keys)
    assert sum(r["_maybe"] for r in marked if r["output_key"] not in keys) < 5


@pytest.fixture()
def no_broadcast(spark):
    """Winners are joined as on a large corpus; the sketch is still broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def below_the_join(plan: str) -> list[str]:
    lines = plan.split("\n")
    return lines[next(k for k, x in enumerate(lines) if "SortMergeJoin" in x):]


def test_text_meets_no_aggregate_before_the_join(rows, no_broadcast):
    plan = dedup_late(rows, "output_key", ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("BroadcastHashJoin", 1)[0]  # rows told apart by the sketch never move
    assert not [x for x in below_the_join(plan) if "Aggregate" in x and "output#" in x]


def test_only_possible_copies_cross_the_network(rows, no_broadcast):
    from tests.test_skew import shuffle_records

    out = dedup_late(rows, "output_key", ORDER)
    assert len(out.collect()) > 1500
    sizes = [r["count"] for r in rows.groupBy("output_key").count().collect()]
    copies, groups = sum(n for n in sizes if n > 1), sum(n > 1 for n in sizes)
    assert 0 < shuffle_records(out, "output_key") <= copies + 2 * groups + 5  # rows that have copies, and a winner a group (joined, then counted once)


@pytest.mark.parametrize("name", ["code_branch", "inst_branch", "qa_branch", "corpus_build"])
def test_registered_queries_never_aggregate_text(spark, name, no_broadcast):
    from conftest import SF001
    from glean.plans.registry import QUERIES, load_all

    load_all()
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in below_the_join(plan) if "Aggregate" in x and "output#" in x]
