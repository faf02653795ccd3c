"""Every operator on empty input, null fields and a single row (no errors, sensible results)."""

from pyspark.sql import functions as F

from glean.functions.html import code_blocks, html_to_text
from glean.operators import corpus as C
from glean.operators import projects as P
from glean.operators import select as S
from glean.operators import training_views as TV
from glean.operators.clean import clean_code_col
from glean.operators.dedup import dedup_first
from glean.plans.branches import code_branch, instruction_branch, qa_branch

CODE = "code string, language string, description string, src_path string, src_pos long"
QA = "title string, question string, code_blocks array<string>, tags array<string>, src_path string, src_pos long"
INST = "instruction string, input string, output string, src_path string, src_pos long"


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_branches_empty_and_nulls(spark):
    for fn, schema in [(code_branch, CODE), (qa_branch, QA), (instruction_branch, INST)]:
        assert fn(empty(spark, schema)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, "p", 1)], CODE)
    assert code_branch(nulls).count() == 0                       # empty code fails validation
    assert qa_branch(spark.createDataFrame([(None, None, None, None, "p", 1)], QA)).count() == 0
    assert instruction_branch(spark.createDataFrame([(None, None, None, "p", 1)], INST)).count() == 0


def test_corpus_ops_empty(spark):
    rows = empty(spark, "output_key string, instruction string, src_rank int, src_path string, src_pos long")
    out = C.split_corpus(C.augment(C.dedup_corpus(rows)))
    assert out.count() == 0
    assert dedup_first(rows, "output_key", ["src_pos"]).count() == 0


def test_selection_empty(spark):
    q = empty(spark, "question_id long, title string, body string, score long, answer_count long, tags array<string>, link string")
    a = empty(spark, "question_id long, answer_pos long, score long, is_accepted boolean, body string")
    assert S.qa_pairs(S.select_qa(q, a), q).count() == 0
    hits = empty(spark, "query_id int, repo_name string, stars int, language string")
    assert S.collect_repositories(hits, [0, 1], 30).count() == 0


def test_projects_empty(spark):
    files = empty(spark, "file_id long, path string, code string")
    markers = empty(spark, "path string")
    assert P.extract_projects(files, markers).count() == 0


def test_training_views_empty(spark):
    conv = empty(spark, "conv_id long, turn long, role string, text string")
    chats = TV.render_chat(conv)
    assert chats.count() == 0
    t = TV.length_budget(chats)
    assert TV.pack_sequences(t, "n_tokens", "conv_id", n_shards=4).count() == 0
    assert TV.padding_account(t, "n_tokens", "conv_id", n_shards=4).count() == 0


def test_kernels_on_null_and_one_row(spark):
    df = spark.createDataFrame([(None,), ("<p>x</p>",)], "h string")
    got = df.select(html_to_text("h").alias("t"), code_blocks("h").alias("b"), clean_code_col("h").alias("c")).collect()
    assert got[0]["t"] == "" and got[0]["b"] == [] and got[0]["c"] is None
    assert got[1]["t"] == "x"
