"""Properties: dedup, augmentation, split, packing, anti-join."""

import random

from pyspark.sql import functions as F

from glean.operators import corpus as C
from glean.operators import training_views as TV
from glean.operators.dedup import anti_dedup, dedup_first


def rows(spark, n=300, seed=1):
    rnd = random.Random(seed)
    data = [(i % 3, f"f{i % 7}", i, f"k{rnd.randrange(40)}", rnd.choice(["Write code", "Read it", "Write Write"]))
            for i in range(n)]
    return spark.createDataFrame(data, "src_rank int, src_path string, src_pos long, output_key string, instruction string")


def test_dedup_first_wins_idempotent_order_free(spark):
    df = rows(spark)
    once = dedup_first(df, "output_key", ["src_rank", "src_path", "src_pos"])
    got = sorted(tuple(r) for r in once.collect())
    brute = {}
    for r in sorted(df.collect(), key=lambda r: (r["src_rank"], r["src_path"], r["src_pos"])):
        brute.setdefault(r["output_key"], tuple(r))
    assert got == sorted(brute.values())
    twice = dedup_first(once, "output_key", ["src_rank", "src_path", "src_pos"])
    assert sorted(tuple(r) for r in twice.collect()) == got
    shuffled = dedup_first(df.repartition(7), "output_key", ["src_rank", "src_path", "src_pos"])
    assert sorted(tuple(r) for r in shuffled.collect()) == got


def test_augment_count(spark):
    df = rows(spark)
    n_write = df.filter(F.col("instruction").contains("Write")).count()
    aug = C.augment(df)
    assert aug.count() == df.count() + n_write
    assert aug.filter("aug_pos = 1 and instruction like '%Write%'").count() == 0


def test_split_disjoint_complete_no_leak(spark):
    df = C.augment(rows(spark))
    s = C.split_corpus(df, 0.3)
    assert s.count() == df.count()
    assert C.leakage(s).count() == 0
    assert set(r[0] for r in s.select("split").distinct().collect()) == {"train", "val"}


def test_packing_matches_next_fit_and_budget(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([10, 500, 2000, 3000, 5000])) for i in range(200)]
    df = spark.createDataFrame(data, "conv_id long, n long")
    packed = TV.pack_sequences(df, "n", "conv_id", budget=4096, n_shards=4)
    got = {r["key"]: (r["shard"], r["pack_id"]) for r in packed.collect()}
    for shard in range(4):
        fill, pack = 0, 0
        for key, n in sorted((k, n) for k, n in data if k % 4 == shard):
            n = min(n, 4096)
            if fill and fill + n > 4096:
                pack, fill = pack + 1, 0
            fill += n
            assert got[key] == (shard, pack)
    stats = TV.pack_stats(packed, 4096).collect()
    assert max(r["fill"] for r in stats) <= 4096


def test_anti_self_is_empty(spark):
    df = rows(spark)
    assert anti_dedup(df, df).count() == 0


def test_prompt_sections(spark):
    df = spark.createDataFrame([("i", "", "o"), ("i", "x", "o")], "instruction string, input string, output string")
    got = [r["text"] for r in C.format_prompt(df).collect()]
    assert got == ["### Instruction:\ni\n\n### Response:\no", "### Instruction:\ni\n\n### Input:\nx\n\n### Response:\no"]


def test_min_length_drops_short_blocks(spark):
    from glean.plans.branches import qa_branch
    df = spark.createDataFrame(
        [("Title?", "q", ["short block here, 24 ch", "x" * 60], ["python"], "p", 1),
         ("Other", "q", ["tiny but over twenty chars"], ["vbscript"], "p", 2)],
        "title string, question string, code_blocks array<string>, tags array<string>, src_path string, src_pos long")
    out = qa_branch(df).collect()
    assert [r["output"] for r in out] == ["x" * 60]
    assert out[0]["instruction"] == "Title?" and out[0]["language"] == "selenium_python"


def test_second_collection_skips_taken_repos(spark):
    from glean.operators.select import collect_repositories, select_files
    hits = spark.createDataFrame(
        [(0, "a", 50, "Python"), (0, "b", 40, "Python"), (0, "a", 45, "Python"), (1, "c", 30, "Python"),
         (1, "a", 60, "Python"), (1, "d", 3, "Python"), (1, "e", 20, "Java")],
        "query_id int, repo_name string, stars int, language string")
    first = collect_repositories(hits, [0, 1], max_repos=2)                 # cap 2 per query
    assert sorted((r["query_id"], r["repo_name"]) for r in first.collect()) == [(0, "a"), (0, "b"), (1, "c"), (1, "e")]
    second = collect_repositories(hits, [0, 1], max_repos=2, language="Python", already=first)
    assert second.count() == 0                                               # everything left was taken or has < 5 stars
    files = spark.createDataFrame([("x/t.py", "import selenium"), ("x/u.py", "print(1)"), ("x/v.js", "webdriver")],
                                  "file_path string, code string")
    kept = select_files(files, "python", must_contain_selenium=True).collect()
    assert [r["file_path"] for r in kept] == ["x/t.py"]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rules_read_a_text_folded_once(spark):
    from glean.operators.label import task_of
    df = spark.createDataFrame([("SCREEN\u017fHOT of it", None), ("Click\u0131ng the Button", ""), ("plain", "a Te\u017ft"), ("plain", "a Function"), (None, "x")], "c string, d string")
    got = df.select(task_of(F.col("c"), F.col("d")).alias("task"))
    assert [r["task"] for r in got.collect()] == ["take a screenshot", "click a button", "automate a task", "create a reusable function", "automate a task"]
    assert plan_of(got).count("lower(") == 1 and plan_of(got).count("translate(") == 1


def test_code_blocks_of_a_pair_are_found_once(spark):
    from glean.functions.html import code_blocks
    from glean.plans.branches import qa_branch
    body = "<pre>if a &lt; b then &hellip; call something long enough to be kept</pre><code>a second block of some length</code>"
    pairs = spark.createDataFrame([("t", "q", body, ["java"], 1), ("t", "q", "<p>no code</p>", None, 2), ("t", "q", None, None, 3)], "title string, question string, body string, tags array<string>, src_pos long")
    out = qa_branch(pairs.select("title", "question", "tags", "src_pos", F.lit("p").alias("src_path"), code_blocks(F.col("body")).alias("code_blocks")), dedup=False)
    assert [r["output"] for r in out.collect()] == ["if a < b then \u2026 call something long enough to be kept"]
    assert plan_of(out).count("ArrowEvalPython") == 1 and plan_of(out).count("regexp_extract_all") <= 2
