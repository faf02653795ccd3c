"""Row predicates: code validation, required fields, minimum lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.text import col_of, contains_any, let, py_strip


def length_ok(code, lo: int = R.MIN_CODE_CHARS, hi: int | None = R.MAX_CODE_CHARS) -> Column:
    n = F.length(col_of(code))
    return (n >= lo) & (n <= hi) if hi is not None else (n >= lo)


def keywords_ok(code, language, vb_keywords=R.VBSCRIPT_KEYWORDS,
                selenium_markers=R.SELENIUM_MARKERS) -> Column:
    """VBScript: lower-cased code holds a keyword. Selenium languages: code holds
    a marker, case-sensitively. Other languages pass."""
    code, language = col_of(code), col_of(language)
    return (F.when(language == "vbscript", let(F.lower(code), lambda x: contains_any(x, vb_keywords)))
             .when(F.startswith(language, F.lit("selenium")), contains_any(code, selenium_markers))
             .otherwise(F.lit(True)))


def code_is_valid(code, language, lo: int = R.MIN_CODE_CHARS, hi: int = R.MAX_CODE_CHARS) -> Column:
    return length_ok(code, lo, hi) & keywords_ok(code, language)


def validate_code(df: DataFrame, code: str = "code", language: str = "language",
                  lo: int = R.MIN_CODE_CHARS, hi: int = R.MAX_CODE_CHARS) -> DataFrame:
    return df.filter(code_is_valid(F.col(code), F.col(language), lo, hi))


def require_non_empty(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose string columns are non-null and non-empty, or whose
    array columns hold at least one element."""
    cond = F.lit(True)
    for c in cols:
        dt = df.schema[c].dataType.typeName()
        cond = cond & ((F.size(F.col(c)) > 0) if dt == "array" else (F.coalesce(F.length(c), F.lit(0)) > 0))
    return df.filter(cond)


def require_non_blank(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose text is whitespace only (``not s.strip()``)."""
    return df.filter(F.length(py_strip(F.col(col))) > 0)


def min_length(df: DataFrame, col: str, n: int, strict: bool = False) -> DataFrame:
    length = F.length(F.col(col))
    return df.filter(length > n if strict else length >= n)
