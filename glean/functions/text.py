"""Text kernel: Python string semantics as Spark Column expressions.

Three mismatches between Python, Java (Spark) and RE2 (DuckDB) matter here:

* Whitespace. Python's ``strip`` removes every character for which
  ``str.isspace()`` is true; Spark's one-argument ``trim`` removes only U+0020.
  We pass the explicit character set to ``trim(col, chars)``.
* Line terminators. Java's ``.``, ``^`` and ``$`` also break at ``\\r``,
  U+0085, U+2028/9; Python breaks at ``\\n`` only. Patterns get ``(?d)``
  (UNIX_LINES).
* Case. Java ``(?i)`` is ASCII-only; Python ignores case over Unicode, so
  patterns that need it get ``(?iu)``.

Every helper returns a Column and stays inside whole-stage codegen
(``trim``/``regexp_replace``/``rlike``), except where noted.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule: the whitespace set is whatever the running Python calls whitespace.
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
PY_WHITESPACE_NO_NL = PY_WHITESPACE.replace("\n", "")


def regex_class(chars: str) -> str:
    """A Java/RE2 character class holding exactly ``chars`` (\\x{..} escapes)."""
    return "[" + "".join("\\x{%x}" % ord(c) for c in chars) + "]"


WS_CLASS = regex_class(PY_WHITESPACE)
WS_NO_NL_CLASS = regex_class(PY_WHITESPACE_NO_NL)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def py_strip(c) -> Column:
    """``str.strip()``: trim the Unicode whitespace set from both ends."""
    return F.trim(col_of(c), F.lit(PY_WHITESPACE))


def py_rstrip(c) -> Column:
    """``str.rstrip()``."""
    return F.rtrim(col_of(c), F.lit(PY_WHITESPACE))


def rstrip_lines(c) -> Column:
    """``'\\n'.join(line.rstrip() for line in s.split('\\n'))``.

    Split, right-trim each line with the explicit whitespace set, join: linear
    in the text and faster than a look-around regex over a 26-way class.
    """
    lines = F.split(col_of(c), "\n", -1)
    return F.array_join(F.transform(lines, lambda x: F.rtrim(x, F.lit(PY_WHITESPACE_NO_NL))), "\n")


def collapse_newlines(c) -> Column:
    """``re.sub(r'\\n{3,}', '\\n\\n', s)``."""
    return F.regexp_replace(col_of(c), "\\n{3,}", "\n\n")


def blank_marked_lines(c, marker: str, word: str) -> Column:
    """Blank every line that starts with ``marker`` and contains ``word``
    (case-insensitive, Python MULTILINE semantics); the newline is kept. Texts
    without such a line start are left without a regex scan."""
    import re

    pattern = "(?imdu)^" + re.escape(marker) + ".*" + re.escape(word) + ".*$"
    return let(col_of(c), lambda x: F.when(F.startswith(x, F.lit(marker)) | F.contains(x, F.lit("\n" + marker)),
                                           F.regexp_replace(x, pattern, "")).otherwise(x))


def py_search(c, pattern: str, ignore_case: bool = False) -> Column:
    """``re.search(pattern, s)`` with Python's line and case semantics."""
    flags = "(?iud)" if ignore_case else "(?d)"
    return col_of(c).rlike(flags + pattern)


def contains_any(c, needles) -> Column:
    """``any(n in s for n in needles)`` — plain substring tests, no regex."""
    c = col_of(c)
    cond = None
    for n in needles:
        t = F.contains(c, F.lit(n))
        cond = t if cond is None else (cond | t)
    return cond if cond is not None else F.lit(False)


def stable_bucket(key, n: int) -> Column:
    """Deterministic pick in ``[0, n)`` from a hex md5 key: the first 8 hex
    digits as an integer, modulo n. Stands in for unseeded ``random.choice``."""
    return F.pmod(F.conv(F.substring(col_of(key), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def with_computed(df, **cols):
    """Add columns that are computed once per row.

    A later ``filter`` on a plain ``withColumn`` alias is pushed below the
    projection with the alias replaced by its expression, so an expensive
    regex chain used by several predicates runs once per reference. Producing
    the columns through ``inline(array(struct(...)))`` (a Generate node) keeps
    them as real attributes: predicates above it read the stored value.
    """
    packed = F.struct(*[col_of(v).alias(k) for k, v in cols.items()])
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(packed)))
