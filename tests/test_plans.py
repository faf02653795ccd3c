"""Plan checks on every registered query: no row-at-a-time Python UDF, no
Cartesian product, no nested-loop join; scans prune columns."""

import pytest

from conftest import SF001
from glean.plans.registry import QUERIES, load_all

load_all()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    df = QUERIES["script_kinds"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "p_name" not in plan.split("ReadSchema")[1].split("\n")[0] if "ReadSchema" in plan else True


def windows_fed_by_single_partition(plan: str):
    """Window operators whose input exchange is SinglePartition (a global window)."""
    lines = plan.split("\n")
    bad = []
    for i, line in enumerate(lines):
        if "Window [" not in line or "WindowGroupLimit" in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        for below in lines[i + 1:]:
            d = len(below) - len(below.lstrip(" :+-"))
            if d <= depth:
                break
            if "Exchange" in below:
                if "SinglePartition" in below:
                    bad.append(line.strip()[:120])
                break
    return bad


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_global_window(spark, name):
    assert windows_fed_by_single_partition(plan_of(QUERIES[name](spark, SF001))) == []


def test_detector_flags_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(100).withColumn("rn", F.row_number().over(Window.orderBy("id")))
    assert windows_fed_by_single_partition(plan_of(df)) != []


def test_question_walk_plan_is_linear_in_categories(spark):
    """Six categories cost about six times the plan of one, not a power of two, and nothing stays cached."""
    from glean.operators.select import select_qa
    q = spark.range(60).selectExpr("id as question_id", "id % 7 as score", "1 as answer_count", "'t' as title",
                                   "'b' as body", "cast(null as string) as link",
                                   "array(concat('t', id % 6), concat('t', (id + 1) % 6)) as tags")
    a = spark.range(60).selectExpr("id as question_id", "1L as answer_pos", "2 as score", "false as is_accepted", "'x' as body")

    def plan(n):
        out = select_qa(q, a, {f"c{i}": [f"t{i}"] for i in range(n)}, max_questions=5)
        return len(out._jdf.queryExecution().executedPlan().toString())

    assert plan(6) < 6 * plan(1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_repository_walk_has_no_python_group(spark):
    from glean.operators.select import collect_repositories
    h = spark.createDataFrame([(0, "a", 9, "Java"), (1, "a", 9, "Java")], "query_id int, repo_name string, stars int, language string")
    out = collect_repositories(h, [0, 1], 30)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in out.select("query_id", "repo_name").collect()] == [(0, "a")]


def test_uncapped_walks_keep_everything(spark):
    from glean.operators.select import collect_repositories, select_qa
    h = spark.range(100).selectExpr("cast(id % 2 as int) as query_id", "concat('r', id) as repo_name", "9 as stars", "'Java' as language")
    assert collect_repositories(h, [0, 1], None).count() == 100
    q = spark.range(40).selectExpr("id as question_id", "1 as score", "1 as answer_count", "array('t') as tags")
    a = spark.range(40).selectExpr("id as question_id", "1L as answer_pos", "2 as score", "false as is_accepted", "'x' as body")
    assert select_qa(q, a, {"c": ["t"], "d": ["t"]}, max_questions=None).groupBy("category").count().collect() == [("c", 40)]


def test_walk_skips_what_an_earlier_category_reached(spark):
    """Category c stops at its second accepted question; the one it met and did not accept is skipped by d too."""
    from glean.operators.select import select_qa
    q = spark.createDataFrame([(1, 9), (2, 8), (3, 7), (4, 6)], "question_id long, score int") \
        .selectExpr("*", "1 as answer_count", "array('t') as tags")
    a = spark.createDataFrame([(1, 1, 2), (2, 1, 0), (3, 1, 2), (4, 1, 2)], "question_id long, answer_pos long, score int") \
        .selectExpr("*", "false as is_accepted", "'x' as body")
    out = select_qa(q, a, {"c": ["t"], "d": ["t"]}, max_questions=2).select("category", "question_id").collect()
    assert sorted(map(tuple, out)) == [("c", 1), ("c", 3), ("d", 4)]
