"""HTML to text and code blocks, as Column expressions.

Semantics follow Python's ``html.parser`` tree as a soup library exposes it:

* text nodes are the maximal runs of characters between tags; comments,
  doctype/declarations, processing instructions and ``script``/``style``
  contents are not text, but they do separate text nodes;
* ``get_text()`` of an element concatenates its text nodes; ``get_text('\\n')``
  of the document joins them with newlines;
* the parser decodes character references in text once (``html.unescape``).

Every pass is linear. A tag, comment, script or style that never ends would be searched to
the end of the text from each place where it could begin, so such beginnings (those after
the last possible end) are marked before the searches and restored after. The characters
used as marks may occur in pages: they are escaped first, and come back as they were.

No HTML library is needed: tags are matched with regular expressions, text is
assembled with split/transform/join, and entity decoding runs JVM-side for the
common entities. Only rows that still hold another reference are sent to
Python's ``html.unescape`` through an Arrow-batched pandas UDF (the column it
receives is null for every other row).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from glean.functions.text import col_of, collapse_newlines, let, py_strip

# HTML5 named/numeric references decoded without Python ("&amp;" last, so a
# single pass never decodes its own output).
FAST_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
                 ("&#x27;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "\u00b7"), ("&copy;", "\u00a9"),
                 ("&amp;", "&")]
_FAST_NAMES = "|".join(k[1:-1] for k, _ in FAST_ENTITIES)
# Any other reference (or a legacy one without ';') needs the full decoder.
SLOW_REFERENCE = "&(?!(?:%s);)[#A-Za-z]" % _FAST_NAMES

TAG = r"</?[A-Za-z][^>]*>"
SEP = "\ue000"          # stands for "a node boundary" while text is assembled
OPEN, CLOSE = "\ue001", "\ue002"   # delimit an outermost code block
ESCAPE, LATER, NEVER = "\ue003", "\ue004", "\ue005"   # escapes a mark; "<" of a comment, script or style without end; "<" of a tag without end
MARKS = SEP + OPEN + CLOSE + LATER + NEVER
IGNORABLE = (r"(?s)<!--.*?-->|(?is)<(script|style)\b[^>]*>.*?</\1\s*>|[<%s]![^>]*>|<\?[^>]*>" % LATER)
BLOCK = r"(?is)<(pre|code)\b[^>]*>(.*?)(?:</\1\s*>|\z)"
BLOCK_STARTS = r"(?is)(?=<(pre|code)\b[^>]*>(.*?)(?:</\1\s*>|\z))"


@pandas_udf(StringType())
def _unescape_series(s: pd.Series) -> pd.Series:
    import html

    return s.map(lambda x: None if x is None else html.unescape(x))


@pandas_udf(ArrayType(StringType()))
def _unescape_arrays(s: pd.Series) -> pd.Series:
    import html

    return s.map(lambda xs: None if xs is None else [None if x is None else html.unescape(x) for x in xs])


def fast_unescape(c) -> Column:
    c = col_of(c)
    for k, v in FAST_ENTITIES:
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def unescape(c) -> Column:
    """``html.unescape``: JVM replace chain, Python only for rare references."""
    c = col_of(c)
    slow = _unescape_series(F.when(c.rlike(SLOW_REFERENCE), c))
    return F.coalesce(slow, fast_unescape(c))


@pandas_udf(StringType())
def _unescape_twice_series(s: pd.Series) -> pd.Series:
    import html

    return s.map(lambda x: None if x is None else html.unescape(html.unescape(x)))


def unescape_twice(c) -> Column:
    """``html.unescape(html.unescape(s))`` with one Python pass at most: rows
    whose text (or once-decoded text) holds a rare reference go to Python."""
    c = col_of(c)
    once = fast_unescape(c)
    needs = c.rlike(SLOW_REFERENCE) | once.rlike(SLOW_REFERENCE)
    return F.coalesce(_unescape_twice_series(F.when(needs, c)), fast_unescape(once))


def unescape_all(arr) -> Column:
    """``[html.unescape(x) for x in arr]`` with the same fast/slow split."""
    def ways(xs):
        slow = F.coalesce(F.exists(xs, lambda x: x.rlike(SLOW_REFERENCE)), F.lit(False))
        return F.struct(F.when(slow, xs).alias("slow"), F.when(~slow, F.transform(xs, fast_unescape)).alias("fast"))

    both = let(col_of(arr), ways)
    return F.coalesce(_unescape_arrays(both["slow"]), both["fast"])


def escape_marks(c) -> Column:
    """The text without mark characters: each becomes ESCAPE and a letter, as does ESCAPE itself."""
    def escaped(x):
        out = F.replace(x, F.lit(ESCAPE), F.lit(ESCAPE + "z"))
        for k, m in enumerate(MARKS):
            out = F.replace(out, F.lit(m), F.lit(ESCAPE + chr(97 + k)))
        return out
    return let(col_of(c), lambda x: F.when(x.rlike("[%s%s]" % (ESCAPE, MARKS)), escaped(x)).otherwise(x))


def restore_marks(c) -> Column:
    def restored(x):
        for k, m in enumerate(MARKS):
            x = F.replace(x, F.lit(ESCAPE + chr(97 + k)), F.lit(m))
        return F.replace(x, F.lit(ESCAPE + "z"), F.lit(ESCAPE))
    return let(col_of(c), lambda x: F.when(F.contains(x, F.lit(ESCAPE)), restored(x)).otherwise(x))


def _after_last(c: Column, end: str, begin: str, mark: str, fold: str = "") -> Column:
    """``c`` with ``mark`` for each ``begin`` (a "<") that comes after the last ``end``, whatever the case of the letters in ``fold``."""
    # One step finds the cut, the next uses it: a body that names the variable of another would keep Python UDFs from being planned.
    def cut(folded):
        return lambda x: F.struct(x.alias("s"), (F.length(x) - F.length(F.substring_index(folded(x), end, -1))).alias("n"))

    def marked(y):
        tail = F.substring(y["s"], y["n"] + 1, F.length(y["s"]))
        return F.concat(F.substring(y["s"], F.lit(1), y["n"]), F.regexp_replace(tail, begin, mark))

    if not fold:
        return let(c, lambda x: F.when(F.substring_index(x, end, -1).rlike(begin), let(let(x, cut(lambda v: v)), marked)).otherwise(x))
    # Mostly the end as written is behind every beginning; only else is the text folded.
    return let(c, lambda x: F.when(F.substring_index(x, end, -1).rlike(begin), let(let(x, cut(lambda v: F.translate(v, fold.upper(), fold))), marked)).otherwise(x))


def mark_unended(c) -> Column:
    """Beginnings that have no end after them are marked, so that no search for the end is made there."""
    def when_open(x):  # the last "<" has no ">" after it
        tail = F.substring_index(x, ">", -1)
        return F.when(x.rlike(r"<[^<>]*\z"), F.concat(F.substring(x, F.lit(1), F.length(x) - F.length(tail)), F.replace(tail, F.lit("<"), F.lit(NEVER)))).otherwise(x)

    c = let(col_of(c), when_open)
    c = _after_last(c, "-->", "<(?=!--)", LATER)
    for name in ("script", "style"):
        c = _after_last(c, "</" + name, r"(?i)<(?=%s\b)" % name, LATER, "".join(sorted(set(name))))
    return c


def drop_ignorable(html, replacement: str = "") -> Column:
    """Without comments, declarations, instructions, scripts and styles; the "<" of tags without end stay marked (NEVER)."""
    return F.replace(F.regexp_replace(mark_unended(html), IGNORABLE, replacement), F.lit(LATER), F.lit("<"))


def restore_all(c) -> Column:
    """Marked "<" and escaped characters as they were."""
    return restore_marks(F.replace(col_of(c), F.lit(NEVER), F.lit("<")))


def code_blocks(html, min_len: int = 21) -> Column:
    """Text of every ``pre`` and ``code`` element in document order (a ``code``
    inside a ``pre`` gives a second entry), stripped, kept if at least
    ``min_len`` characters long. An element that doesn't end runs to the end of
    the text, so unended elements within each other give as much text as they hold."""
    clean = drop_ignorable(escape_marks(F.coalesce(col_of(html), F.lit(""))))
    inner = F.regexp_extract_all(clean, F.lit(BLOCK_STARTS), 2)
    texts = unescape_all(F.transform(inner, lambda x: restore_all(F.regexp_replace(x, TAG, ""))))
    return F.filter(F.transform(texts, py_strip), lambda x: F.length(x) >= min_len)


def _outside(o: Column) -> Column:
    return F.regexp_replace(o, "(?:%s|%s)+" % (TAG, SEP), SEP)


def _block(i: Column) -> Column:
    body = F.regexp_replace(i, "%s|%s" % (TAG, SEP), "")
    return F.concat(F.lit(SEP + "\n```\n"), body, F.lit("\n```\n" + SEP))


def html_to_text(html) -> Column:
    """Document text with code blocks fenced in place.

    Outermost ``pre``/``code`` elements become "\\n```\\n<text>\\n```\\n" nodes;
    all text nodes are joined by newlines; references are decoded twice (once by
    the parser, once more afterwards); 3+ newlines become 2; the ends are
    stripped.
    """
    h = drop_ignorable(escape_marks(F.coalesce(col_of(html), F.lit(""))), SEP)
    marked = F.regexp_replace(h, BLOCK, OPEN + "$2" + CLOSE)

    def rendered(pieces):
        rest = F.transform(F.slice(pieces, 2, 1 << 30), lambda p: F.concat(
            _block(F.substring_index(p, CLOSE, 1)),
            _outside(F.regexp_extract(p, "(?s)^[^%s]*%s(.*)$" % (CLOSE, CLOSE), 1))))
        return F.concat(_outside(F.element_at(pieces, 1)), F.array_join(rest, ""))

    text = F.regexp_replace(let(F.split(marked, OPEN, -1), rendered), SEP + "+", SEP)
    text = F.replace(F.trim(text, F.lit(SEP)), F.lit(SEP), F.lit("\n"))
    text = unescape_twice(restore_all(text))
    return py_strip(collapse_newlines(text))


# --- DataFrame-level forms ---------------------------------------------------------


def html_code_blocks(df, html: str = "body", min_len: int = 21, out: str = "code_blocks"):
    return df.withColumn(out, code_blocks(F.col(html), min_len))


def html_text(df, html: str = "body", out: str = "text"):
    return df.withColumn(out, html_to_text(F.col(html)))
