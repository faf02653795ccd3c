"""Trap A (whitespace), B (line terminators), C (case), I (rule order): parity with Python."""

from pyspark.sql import functions as F

from conftest import one
from glean.functions import rules as R
from glean.functions import text as T
from glean.operators.clean import clean_code_col
from glean.operators.label import task_of

HARD = ["  a\x0b", "　x　", "a \n\n \n\nb", "\x1c\x1dz\x85", "line  \t\nnext  ", "", "\n\n\n\n",
        "\xa0 mid \n"]


def test_whitespace_set_is_pythons():
    assert all(c.isspace() for c in T.PY_WHITESPACE)
    assert "　" in T.PY_WHITESPACE and "\x0b" in T.PY_WHITESPACE and "​" not in T.PY_WHITESPACE


def test_strip_matches_python(spark):
    for s in HARD:
        assert one(spark, T.py_strip(F.col("x")), s) == s.strip(), repr(s)


def test_rstrip_lines_matches_python(spark):
    for s in HARD:
        want = "\n".join(line.rstrip() for line in s.split("\n"))
        assert one(spark, T.rstrip_lines(F.col("x")), s) == want, repr(s)


CLEAN_CASES = [
    ("a\n\n\n\nb", "a\n\nb"),
    # whitespace-only lines are stripped after the collapse: the run survives
    ("x  \n \n \n y", "x\n\n\n y"),
    ("' Copyright 2020\ncode", "code"),
    ("#COPYRIGHT\n  # copyright not at col 0\nend", "# copyright not at col 0\nend"),
    # CR belongs to the line in Python; rstrip removes it before the comment rule
    ("'copyright\r\nx", "x"),
    # dotless i matches i under Python's IGNORECASE
    ("' copyrıght\nkeep", "keep"),
    ("keep ' copyright mid-line", "keep ' copyright mid-line"),
    ("", ""),
]


def test_clean_code_cases(spark):
    for s, want in CLEAN_CASES:
        assert one(spark, clean_code_col(F.col("x")), s) == want, repr(s)


LABEL_CASES = [
    ("click\nbutton", "automate a task"),              # '.' does not cross \n
    ("click\rbutton", "click a button"),               # Python '.' crosses \r
    ("click button", "click a button"),           # and U+2028
    ("the database", "handle multiple windows"),       # rule 14 'tab' shadows rule 24
    ("DataTable", "handle multiple windows"),
    ("ſql", "interact with database"),            # long s ~ s
    ("logın", "handle user login"),               # dotless i ~ i
    ("my unit test", "automate testing"),
    ("a function", "create a reusable function"),
    ("nothing here", "automate a task"),
    ("please sign-in", "handle user login"),
]


def test_task_labels(spark):
    for s, want in LABEL_CASES:
        assert one(spark, task_of(F.col("x"), F.lit("")), s) == want, repr(s)


def test_required_literals():
    assert R.required_literals("click.*button") == [["click", "button"]]
    assert R.required_literals("sign.?in|login") == [["sign", "in"], ["login"]]
    assert R.required_literals("a[bc]") is None


def test_templates_and_purpose(spark):
    from glean.operators.label import instruction_of

    got = one(spark, instruction_of(F.lit("click a button"), F.lit("nope"), F.col("x")), "00000000ffff")
    assert got == R.INSTRUCTION_TEMPLATES["vbscript"][0].replace("{task}", "click a button")
    assert one(spark, R.purpose_of(F.col("x")), "DoLogin") == "handle user login"
    assert one(spark, R.purpose_of(F.col("x")), "Zed9") == "perform Zed9 operation"
    assert one(spark, R.purpose_of(F.col("x")), "SetLogout") == "handle user logout"   # 'login' not in it; logout first
