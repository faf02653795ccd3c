"""Non-vacuity: on the sf0.01 fixture every predicate keeps some rows and drops others.

Two paths the fixture cannot reach are covered by unit tests instead
(tests/test_corpus.py): the Q&A minimum length (every fixture block is long
enough) and a second repository collection (the fixture has 20 repositories,
all taken by the first walk at the reference's default cap). Likewise every
fixture project has a script, so the empty-project drop is exercised by the
project-scan test (tests/test_scripts.py)."""

import pytest

from glean.plans.registry import QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.01"

FLAGS = [("code_length_check", "length_ok"), ("code_vbscript_check", "keywords_ok"),
         ("code_selenium_check", "keywords_ok"), ("code_file_ext", "ext_ok"),
         ("code_selenium_content", "content_ok"), ("qa_filter_questions", "passes"), ("qa_has_code", "has_code"),
         ("inst_required_fields", "keep"), ("script_non_blank", "non_blank"),
         ("script_min_size", "long_enough")]


@pytest.mark.parametrize("name,col", FLAGS)
def test_both_outcomes(spark, name, col):
    values = {r[0] for r in QUERIES[name](spark, SF).select(col).distinct().collect()}
    assert values == {True, False}, (name, values)


def test_statuses_and_sides(spark):
    st = {r[0] for r in QUERIES["json_corrupt_lines"](spark, SF).select("status").distinct().collect()}
    assert st == {"ok", "malformed", "blank"}
    sides = {r[0] for r in QUERIES["corpus_split"](spark, SF).select("split").collect()}
    assert sides == {"train", "val"}
    labels = {r[0] for r in QUERIES["code_task_label"](spark, SF).select("task").distinct().collect()}
    assert len(labels) == 35          # all 32 rules and the 3 fallbacks fire
