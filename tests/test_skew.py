"""Skew: one output key holds a third of all rows. First-wins dedup must stay
correct and the hot key must cross the shuffle at most once per map task
(partial aggregation), which the executed plan's shuffle metrics show."""

from pyspark.sql import functions as F

from glean.operators.dedup import dedup_first


def shuffle_records(df, partitioned_on: str):
    """Records written by the executed plan's shuffle exchanges that hash on ``partitioned_on``."""
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and f"hashpartitioning({partitioned_on}" in node.outputPartitioning().toString():
            m = node.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                total += m.get().value()
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def test_hot_key_dedup(spark):
    n, parts = 30000, 8
    df = (spark.range(n).repartition(parts)
          .select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("output_key"),
                  F.col("id").alias("src_pos"), F.lit("x" * 200).alias("output")))
    out = dedup_first(df, "output_key", ["src_pos"])
    rows = out.collect()
    assert len(rows) == 1 + (n - n // 3)
    assert [r["src_pos"] for r in rows if r["output_key"] == "hot"] == [0]
    # every cold key is one row; the hot key (10,000 rows) crosses at most once per map task
    written = shuffle_records(out, "output_key")
    assert (n - n // 3) < written <= (n - n // 3) + parts


def test_hot_tag_listing_limited_before_shuffle(spark):
    from glean.operators.select import category_rules, tag_listing
    n, parts, per_tag = 30000, 8, 500
    q = (spark.range(n).repartition(parts)
         .select(F.col("id").alias("question_id"), (F.col("id") % 97).alias("score"), F.lit(1).alias("answer_count"),
                 F.when(F.col("id") % 3 == 0, F.array(F.lit("vbscript"))).otherwise(F.array(F.lit("selenium"))).alias("tags")))
    listed = tag_listing(q, category_rules(spark), per_tag)
    rows = listed.collect()
    assert len(rows) == 2 * per_tag
    assert 0 < shuffle_records(listed, "category") <= 2 * per_tag * parts     # not 30,000
