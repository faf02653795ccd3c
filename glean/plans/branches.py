"""Branch compositions: each raw source becomes canonical corpus rows.

Canonical corpus columns: ``source, language, instruction, input, output,
output_key, src_rank, src_path, src_pos``. The last three make the implicit
first-seen order explicit (source rank, then file, then position), which is
what first-wins dedup orders by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.text import with_computed
from glean.operators.clean import clean_code_col
from glean.operators.dedup import dedup_late, output_key
from glean.operators.label import instruction_of, task_of, title_instruction
from glean.operators.validate import code_is_valid

CORPUS_COLUMNS = ["source", "language", "instruction", "input", "output", "output_key",
                  "src_rank", "src_path", "src_pos"]
ORDER = ["src_rank", "src_path", "src_pos"]

# Source ranks: the order in which the sources are read (first wins on ties).
RANK_CODE, RANK_QA, RANK_INSTRUCTIONS = 0, 1, 2


def apply_code_defaults(df: DataFrame) -> DataFrame:
    """Missing-field defaults: code "", language "vbscript", description ""."""
    return (df.withColumn("code", F.coalesce(F.col("code"), F.lit("")))
              .withColumn("language", F.coalesce(F.col("language"), F.lit("vbscript")))
              .withColumn("description", F.coalesce(F.col("description"), F.lit(""))))


def code_branch(samples: DataFrame, dedup: bool = True) -> DataFrame:
    """Code samples -> corpus rows: defaults, clean, validate, dedup, label, instruction.

    ``samples`` needs code, language, description, src_path, src_pos.
    """
    df = (with_computed(apply_code_defaults(samples), output=clean_code_col(F.col("code")))
          .filter(code_is_valid(F.col("output"), F.col("language")))
          .withColumn("output_key", output_key(F.col("output")))
          .withColumn("src_rank", F.lit(RANK_CODE))
          .select("output", "output_key", "language", "description", *ORDER))   # raw code stays behind
    if dedup:
        df = dedup_late(df, "output_key", ORDER)
    df = (df.withColumn("task", task_of(F.col("output"), F.col("description")))
            .withColumn("instruction", instruction_of(F.col("task"), F.col("language"), F.col("output_key")))
            .withColumn("input", F.lit(""))
            .withColumn("source", F.lit("github")))
    return df.select(*CORPUS_COLUMNS)


def longest_first(blocks) -> F.Column:
    """First of the longest strings in an array (``max(blocks, key=len)``)."""
    indexed = F.transform(blocks, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("neg_pos"), x.alias("v")))
    return F.array_max(indexed)["v"]


def longest_block(df: DataFrame, blocks: str = "code_blocks", out: str = "longest") -> DataFrame:
    return df.withColumn(out, longest_first(F.col(blocks)))


def qa_branch(pairs: DataFrame, dedup: bool = True) -> DataFrame:
    """Q&A pairs -> corpus rows: longest code block, clean, min length, title instruction.

    ``pairs`` needs title, question, code_blocks, tags, src_path, src_pos.
    """
    # stored, so that the filter is not pushed below it and finds the blocks a second time
    df = (with_computed(pairs, code_blocks=F.coalesce(F.col("code_blocks"), F.array().cast("array<string>")))
               .filter(F.size("code_blocks") > 0)
               .transform(lambda d: with_computed(d, output=clean_code_col(longest_first(F.col("code_blocks")))))
               .filter(F.length("output") >= R.MIN_CODE_CHARS)
               .withColumn("output_key", output_key(F.col("output")))
               .withColumn("src_rank", F.lit(RANK_QA))
               .select("output", "output_key", "title", "question", "tags", *ORDER))
    if dedup:
        df = dedup_late(df, "output_key", ORDER)
    df = (df.withColumn("language", R.language_from_tag_array(F.coalesce(F.col("tags"), F.array().cast("array<string>"))))
            .withColumn("instruction", title_instruction(F.col("title")))
            .withColumn("input", F.substring(F.coalesce(F.col("question"), F.lit("")), 1, 500))
            .withColumn("source", F.lit("stackoverflow")))
    return df.select(*CORPUS_COLUMNS)


def instruction_branch(samples: DataFrame, dedup: bool = True) -> DataFrame:
    """Ready-made instruction rows -> corpus rows: required fields, clean output, min length.

    ``samples`` needs instruction, input, output, src_path, src_pos.
    """
    df = (samples.withColumn("instruction", F.coalesce(F.col("instruction"), F.lit("")))
                 .withColumn("input", F.coalesce(F.col("input"), F.lit("")))
                 .withColumn("output", F.coalesce(F.col("output"), F.lit("")))
                 .filter((F.length("instruction") > 0) & (F.length("output") > 0))
                 .transform(lambda d: with_computed(d, output=clean_code_col(F.col("output"))))
                 .filter(F.length("output") >= R.MIN_CODE_CHARS)
                 .withColumn("output_key", output_key(F.col("output")))
                 .withColumn("src_rank", F.lit(RANK_INSTRUCTIONS))
                 .select("instruction", "input", "output", "output_key", *ORDER))
    if dedup:
        df = dedup_late(df, "output_key", ORDER)
    df = (df.withColumn("language", F.lit("vbscript"))
            .withColumn("source", F.lit("your_scripts")))
    return df.select(*CORPUS_COLUMNS)
