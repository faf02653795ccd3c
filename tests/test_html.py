"""Trap E (HTML): text nodes, ignorable content, nested blocks, double decoding."""

from pyspark.sql import functions as F

from conftest import one
from glean.functions.html import code_blocks, html_to_text, unescape

LONG = 'print("hello world, long enough")'


def test_nested_pre_code_gives_two_blocks(spark):
    html = f"<pre><code>{LONG}</code></pre><code>x</code>"
    assert one(spark, code_blocks(F.col("x")), html) == [LONG, LONG]


def test_blocks_skip_comments_and_decode(spark):
    html = "<code>a &lt; b <!-- no --> and c &gt; d done</code>"
    assert one(spark, code_blocks(F.col("x")), html) == ["a < b  and c > d done"]


def test_text_nodes_joined_by_newline(spark):
    assert one(spark, html_to_text(F.col("x")), "<p>a</p>\n<p>b</p>") == "a\n\nb"
    assert one(spark, html_to_text(F.col("x")), "foo<!-- c -->bar") == "foo\nbar"


def test_script_with_closing_tag_inside(spark):
    assert one(spark, html_to_text(F.col("x")), '<script>var t="</p>";</script><p>x</p>') == "x"


def test_double_decoding(spark):
    assert one(spark, html_to_text(F.col("x")), "<p>&amp;lt;b&amp;gt;</p>") == "<b>"


def test_rare_entities_use_full_decoder(spark):
    assert one(spark, unescape(F.col("x")), "caf&eacute; &#233; &#x41; AT&amp;T &amp") == "café é A AT&T &"


def test_code_block_fenced_in_place(spark):
    html = "<p>a</p><pre><code>x = 1</code></pre><p>b</p>"
    assert one(spark, html_to_text(F.col("x")), html) == "a\n\n```\nx = 1\n```\n\nb"


def test_empty_and_null(spark):
    assert one(spark, html_to_text(F.col("x")), "") == ""
    assert one(spark, code_blocks(F.col("x")), None) == []
