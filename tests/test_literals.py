"""Small inputs with the exact text they must give, white space included."""

import time

import pytest
from conftest import one
from pyspark.sql import functions as F

from glean.functions import html as H
from glean.operators import clean as C

PRIVATE = "    a z  "


@pytest.mark.parametrize("html, text", [
    ("<p>plain</p>", "plain"),
    ("<p>a &amp; b</p>", "a & b"),
    ("<p>x</p><!-- gone --><p>y</p>", "x\ny"),
    ("<p>x</p>\n<p>y</p>", "x\n\ny"),
    ("<p>x</p>\n\n\n<p> y </p>", "x\n\n y"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<p>a</p><pre>x\n\n\n\ny</pre>b", "a\n\n```\nx\n\ny\n```\n\nb"),
    ("see <code>x = 1</code> there", "see \n\n```\nx = 1\n```\n\n there"),
    ("<pre>never ends <b>bold</b>", "```\nnever ends bold\n```"),
    ("a <script>var t = '<p>';</script> b", "a \n b"),
    ("a < b and c <d", "a < b and c <d"),
    ("a <!-- no end", "a <!-- no end"),
    ("a <!-- no end > b", "a \n b"),
    ("a <script> b", "a \n b"),
    (f"<p>{PRIVATE}</p><pre>{PRIVATE}</pre>", f"{PRIVATE}\n\n```\n{PRIVATE}\n```"),
    ("<p>x</p>", "\nx\n"),
    ("&#xE000;<b>&#xE001;</b>", "\n"),
    (None, ""), ("", ""),
])
def test_html_to_text(spark, html, text):
    assert one(spark, H.html_to_text(F.col("x")), html) == text


def test_code_blocks_keep_private_characters(spark):
    block = f"{PRIVATE} and twenty one more characters"
    assert one(spark, H.code_blocks(F.col("x")), f"<code>{block}</code><pre>{block} <i>x</i></pre>") == [block, f"{block} x"]


@pytest.mark.parametrize("piece", ["<a ", "<!-- x ", "<script> ", "<style>a ", "<pre>x ", "</p", "<! ", "<? ", "<"])
def test_a_megabyte_of_what_never_ends(spark, piece):
    html = piece * (1_000_000 // len(piece))
    began = time.time()
    got = one(spark, H.html_to_text(F.col("x")), html)
    assert time.time() - began < 20 and isinstance(got, str)
    ended = one(spark, H.html_to_text(F.col("x")), html + " --></script></style> last")
    assert time.time() - began < 40 and (ended.endswith("last") or ended.endswith("```"))


@pytest.mark.parametrize("code, cleaned", [
    ("a\r\nb", "a\nb"),
    ("a\n\n\n\n\nb", "a\n\nb"),
    ("x   \ny\t\n", "x\ny"),
    ("a\n \n \nb", "a\n\n\nb"),  # blank lines with spaces are emptied after the collapse: three newlines stay
    ("' Copyright me\nx", "x"),
    ("a\n# COPYRIGHT\nb", "a\n\nb"),
    ("　a ", "a"),
])
def test_clean_code(spark, code, cleaned):
    assert one(spark, C.clean_code_col(F.col("x")), code) == cleaned
