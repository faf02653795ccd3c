"""Code cleaning (order matters, and the result is not idempotent)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions.text import (blank_marked_lines, col_of, collapse_newlines, py_strip,
                                  rstrip_lines)


def clean_code_col(c) -> Column:
    """(a) 3+ newlines -> 2, (b) strip each line's right end, (c) blank lines that
    start with ``'`` and mention "copyright", (d) same for ``#``, (e) strip.

    Because (a) runs before (b)-(d), whitespace-only lines and blanked comment
    lines leave newline runs that are *not* collapsed again.
    """
    c = collapse_newlines(col_of(c))
    c = rstrip_lines(c)
    c = blank_marked_lines(c, "'", "copyright")
    c = blank_marked_lines(c, "#", "copyright")
    return py_strip(c)


def clean_code(df: DataFrame, col: str = "code", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, clean_code_col(F.col(col)))
