"""Labelling: task detection, instruction wording, purposes, tag languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.text import col_of, let, stable_bucket


def task_of(code, description) -> Column:
    """The rules name the text dozens of times: it is joined, lower-cased and folded once per row."""
    combined = F.lower(F.concat(col_of(code), F.lit(" "), F.coalesce(col_of(description), F.lit(""))))
    both = let(combined, lambda t: F.struct(t.alias("text"), R.caseless(t).alias("folded")))
    return let(both, lambda x: R.task_label(x["text"], folded=x["folded"]))


def label_task(df: DataFrame, code: str = "code", description: str = "description",
               out: str = "task") -> DataFrame:
    return df.withColumn(out, task_of(F.col(code), F.col(description)))


def instruction_of(task, language, key, templates=R.INSTRUCTION_TEMPLATES) -> Column:
    """Template chosen by a stable bucket of ``key`` (md5 hex), ``{task}`` filled."""
    arr = R.templates_for(col_of(language), templates)
    key = col_of(key)
    idx = F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), F.size(arr))
    return F.replace(F.element_at(arr, (idx + 1).cast("int")), F.lit("{task}"), col_of(task))


def make_instruction(df: DataFrame, task: str = "task", language: str = "language",
                     key: str = "output_key", out: str = "instruction") -> DataFrame:
    return df.withColumn(out, instruction_of(F.col(task), F.col(language), F.col(key)))


def language_from_tags(df: DataFrame, tags: str = "tags", out: str = "language") -> DataFrame:
    return df.withColumn(out, R.language_from_tag_array(F.col(tags)))


def infer_purpose(df: DataFrame, name: str = "name", out: str = "purpose") -> DataFrame:
    return df.withColumn(out, R.purpose_of(F.col(name)))


def title_instruction(title) -> Column:
    """Keep a title ending in '?', else "How to " + lower(title)."""
    title = F.coalesce(col_of(title), F.lit(""))
    return F.when(F.endswith(title, F.lit("?")), title).otherwise(F.concat(F.lit("How to "), F.lower(title)))


def qa_to_instruction(df: DataFrame, title: str = "title", question: str = "question",
                      max_input: int = 500) -> DataFrame:
    return (df.withColumn("instruction", title_instruction(F.col(title)))
              .withColumn("input", F.substring(F.coalesce(F.col(question), F.lit("")), 1, max_input)))


__all__ = ["task_of", "label_task", "instruction_of", "make_instruction", "language_from_tags",
           "infer_purpose", "title_instruction", "qa_to_instruction", "stable_bucket"]
