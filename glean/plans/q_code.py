"""Queries over code samples and repository hits."""

from __future__ import annotations

from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.text import with_computed
from glean.operators import select as S
from glean.operators.clean import clean_code_col
from glean.operators.dedup import dedup_first, output_key
from glean.operators.label import instruction_of, task_of
from glean.operators.stats import count_by
from glean.operators.validate import keywords_ok, length_ok
from glean.plans import duck as D
from glean.plans.branches import code_branch
from glean.plans.registry import query
from glean.plans.views import duck_with, view

CLEAN = D.clean_code("code")


def code_view(spark, sf_dir):
    """code_samples with the corpus order columns (path, position)."""
    return (view(spark, sf_dir, "code_samples")
            .withColumn("src_path", F.lit("code_samples"))
            .withColumn("src_pos", F.col("doc_id")))


@query("code_clean", "O-14", duck_with("code_samples") + f"select doc_id, {CLEAN} as code_clean from code_samples")
def q_code_clean(spark, sf_dir):
    return code_view(spark, sf_dir).select("doc_id", clean_code_col(F.col("code")).alias("code_clean"))


@query("code_length_check", "O-15", duck_with("code_samples") + f"""
select doc_id, length(c) as n_chars, {D.length_ok('c')} as length_ok
from (select doc_id, {CLEAN} as c from code_samples)""")
def q_code_length_check(spark, sf_dir):
    c = clean_code_col(F.col("code"))
    return code_view(spark, sf_dir).select("doc_id", c.alias("c")).select(
        "doc_id", F.length("c").alias("n_chars"), length_ok(F.col("c")).alias("length_ok"))


@query("code_vbscript_check", "O-16", duck_with("code_samples") + f"""
select doc_id, {D.keywords_ok('c', 'language')} as keywords_ok
from (select doc_id, language, {CLEAN} as c from code_samples) where language = 'vbscript'""")
def q_code_vbscript_check(spark, sf_dir):
    df = code_view(spark, sf_dir).filter(F.col("language") == "vbscript")
    return df.select("doc_id", keywords_ok(clean_code_col(F.col("code")), F.col("language")).alias("keywords_ok"))


@query("code_selenium_check", "O-17", duck_with("code_samples") + f"""
select doc_id, language, {D.keywords_ok('c', 'language')} as keywords_ok
from (select doc_id, language, {CLEAN} as c from code_samples) where language <> 'vbscript'""")
def q_code_selenium_check(spark, sf_dir):
    df = code_view(spark, sf_dir).filter(F.col("language") != "vbscript")
    return df.select("doc_id", "language",
                     keywords_ok(clean_code_col(F.col("code")), F.col("language")).alias("keywords_ok"))


@query("code_task_label", "O-30", duck_with("code_samples") + f"""
select doc_id, {D.task_of(CLEAN, 'description')} as task from code_samples""")
def q_code_task_label(spark, sf_dir):
    df = code_view(spark, sf_dir)
    return df.select("doc_id", task_of(clean_code_col(F.col("code")), F.col("description")).alias("task"))


@query("code_instruction", "O-31", duck_with("code_samples") + f"""
select doc_id, language, {D.instruction_of(D.task_of('c', 'description'), 'language', D.output_key('c'))} as instruction
from (select doc_id, language, description, {CLEAN} as c from code_samples)""")
def q_code_instruction(spark, sf_dir):
    df = code_view(spark, sf_dir).withColumn("c", clean_code_col(F.col("code")))
    return df.select("doc_id", "language", instruction_of(
        task_of(F.col("c"), F.col("description")), F.col("language"), output_key(F.col("c"))).alias("instruction"))


_VALID = f"{D.length_ok('c')} and {D.keywords_ok('c', 'language')}"


@query("code_dedup", "O-42", duck_with("code_samples") + f"""
select min(doc_id) as doc_id, k as output_key from (
  select doc_id, {D.output_key('c')} as k from (select doc_id, language, {CLEAN} as c from code_samples)
  where {_VALID}) group by k""")
def q_code_dedup(spark, sf_dir):
    df = (with_computed(code_view(spark, sf_dir), c=clean_code_col(F.col("code")))
          .filter(length_ok(F.col("c")) & keywords_ok(F.col("c"), F.col("language")))
          .select("doc_id", output_key(F.col("c")).alias("output_key")))
    return dedup_first(df, "output_key", ["doc_id"])


@query("code_branch", "O-81", duck_with("code_samples") + f"""
, valid as (
  select doc_id, language, description, c, {D.output_key('c')} as k
  from (select doc_id, language, description, {CLEAN} as c from code_samples) where {_VALID}),
firsts as (select * from valid qualify row_number() over (partition by k order by doc_id) = 1)
select doc_id, language,
  {D.instruction_of(D.task_of('c', 'description'), 'language', 'k')} as instruction,
  '' as input, c as output, k as output_key
from firsts""")
def q_code_branch(spark, sf_dir):
    df = code_branch(code_view(spark, sf_dir))
    return df.select(F.col("src_pos").alias("doc_id"), "language", "instruction", "input", "output", "output_key")


@query("code_count_by_language", "O-51", duck_with("code_samples") + """
select language, count(*) as n from code_samples group by language""")
def q_code_count_by_language(spark, sf_dir):
    return count_by(code_view(spark, sf_dir), "language")


def _ext_duck(path: str, language: str) -> str:
    parts = []
    for lang, exts in R.FILE_EXTENSIONS.items():
        cond = " or ".join(f"ends_with(lower({path}), {D.lit(e)})" for e in exts)
        parts.append(f"when {D.lang_family(language)} = {D.lit(lang)} then ({cond})")
    return "(case " + " ".join(parts) + " else false end)"


@query("code_file_ext", "O-21", duck_with("repo_files") + f"""
select doc_id, file_path, {_ext_duck('file_path', 'language')} as ext_ok from repo_files""")
def q_code_file_ext(spark, sf_dir):
    df = view(spark, sf_dir, "repo_files")
    return df.select("doc_id", "file_path", S.extension_ok(F.col("file_path"), S.lang_family(F.col("language"))).alias("ext_ok"))


@query("code_file_size", "O-22", duck_with("repo_files") + """
select doc_id, strlen(code) as n_bytes, strlen(code) < 100000 as size_ok from repo_files""")
def q_code_file_size(spark, sf_dir):
    df = view(spark, sf_dir, "repo_files")
    return df.select("doc_id", F.octet_length("code").alias("n_bytes"), S.size_ok(F.col("code")).alias("size_ok"))


@query("code_selenium_content", "O-23", duck_with("repo_files") + f"""
select doc_id, {D.contains_any('lower(code)', R.SELENIUM_CONTENT_MARKERS)} as content_ok
from repo_files where starts_with(language, 'selenium')""")
def q_code_selenium_content(spark, sf_dir):
    df = view(spark, sf_dir, "repo_files").filter(F.startswith(F.col("language"), F.lit("selenium")))
    return df.select("doc_id", S.selenium_content_ok(F.col("code")).alias("content_ok"))
