"""Queries over repository search hits and their files."""

from __future__ import annotations

from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.operators import select as S
from glean.operators.dedup import dedup_first
from glean.plans import duck as D
from glean.plans.q_code import code_view
from glean.plans.registry import query
from glean.plans.views import duck_with, view

QUERY_IDS = [0, 1, 2, 3, 4]          # the search queries, in order
GROUPS = {"uft": [0, 1, 2], "general": [3, 4]}   # two query lists walked as one
MAX_REPOS = 30                       # per collection, as the full collection runs it
CAP = MAX_REPOS // len(QUERY_IDS) + 1


def hits(spark, sf_dir):
    return view(spark, sf_dir, "repo_hits")


# code_selection: each collection has its own queries, and few repositories are taken from each, so that
# all four find some among the fixture's 20.
COLLECTION_QUERIES = {"vbscript": [0, 1], "selenium_python": [1, 2], "selenium_java": [2, 3],
                      "selenium_javascript": [3, 4]}
COLLECTION_REPOS = 4


def d_collect(prefix: str, language: str | None, prev: str | None, query_ids=QUERY_IDS, cap=CAP) -> str:
    """CTEs walking ``query_ids``; ``{prefix}_all`` holds the collected repositories."""
    lang = f" and language = {D.lit(language)}" if language else ""
    parts, seen = [], prev
    out = f""",
{prefix}c as (select * from repo_hits where stars >= 5{lang}
  qualify row_number() over (partition by query_id, repo_name order by stars desc) = 1)"""
    for q in query_ids:
        excl = f" and repo_name not in (select repo_name from {seen})" if seen else ""
        out += f""",
{prefix}{q} as (select * from {prefix}c where query_id = {q}{excl} order by stars desc, repo_name limit {cap}),
{prefix}seen{q} as ({f'select repo_name from {seen} union all ' if seen else ''}select repo_name from {prefix}{q})"""
        seen = f"{prefix}seen{q}"
        parts.append(f"select * from {prefix}{q}")
    return out + f",\n{prefix}_all as ({' union all '.join(parts)})"


def _ext(path: str, family: str) -> str:
    return "(" + " or ".join(f"ends_with(lower({path}), {D.lit(e)})" for e in R.FILE_EXTENSIONS[family]) + ")"


@query("repo_filter", "O-24", duck_with("repo_hits") + """
select query_id, repo_name, stars, language from repo_hits where stars >= 5""")
def q_repo_filter(spark, sf_dir):
    return S.filter_repos(hits(spark, sf_dir), min_stars=5).select("query_id", "repo_name", "stars", "language")


@query("repo_dedup", "O-44", duck_with("repo_hits") + """
select repo_name, query_id, stars from repo_hits where stars >= 5
qualify row_number() over (partition by repo_name order by query_id, stars desc) = 1""")
def q_repo_dedup(spark, sf_dir):
    f = S.filter_repos(hits(spark, sf_dir), min_stars=5).withColumn("neg_stars", -F.col("stars"))
    return dedup_first(f, "repo_name", ["query_id", "neg_stars"]).select("repo_name", "query_id", "stars")


@query("repo_query_cap", "O-50", duck_with("repo_hits") + d_collect("v", None, None) + """
select query_id, repo_name, stars from v_all""")
def q_repo_cap(spark, sf_dir):
    return S.collect_repositories(hits(spark, sf_dir), QUERY_IDS, MAX_REPOS).select("query_id", "repo_name", "stars")


@query("repo_query_union", "O-60", duck_with("repo_hits") + f"""
select case when query_id in ({', '.join(map(str, GROUPS['uft']))}) then 'uft' else 'general' end as query_group,
  query_id, repo_name, stars from repo_hits
where query_id in ({', '.join(map(str, GROUPS['uft']))}) or query_id in ({', '.join(map(str, GROUPS['general']))})""")
def q_repo_union(spark, sf_dir):
    h = hits(spark, sf_dir)
    parts = [h.filter(F.col("query_id").isin(ids)).withColumn("query_group", F.lit(g)) for g, ids in GROUPS.items()]
    return S.union_rules(*parts).select("query_group", "query_id", "repo_name", "stars")


@query("repo_attach_files", "O-40", duck_with("repo_hits", "code_samples") + d_collect("v", None, None) + """
select r.query_id, r.repo_name, r.stars, c.doc_id from v_all r join code_samples c on c.repo_name = r.repo_name""")
def q_attach(spark, sf_dir):
    repos = S.collect_repositories(hits(spark, sf_dir), QUERY_IDS, MAX_REPOS)
    files = code_view(spark, sf_dir).select("repo_name", "doc_id")
    bound = len(QUERY_IDS) * CAP
    return S.attach_repo(files, repos.select("query_id", "repo_name", "stars"), max_repos=bound).select(
        "query_id", "repo_name", "stars", "doc_id")


def d_code_selection() -> str:
    ctes, selects, prev = "", [], None
    for i, (label, language, family, selenium) in enumerate(S.COLLECTIONS):
        ids, p = COLLECTION_QUERIES[label], f"x{i}_"
        ctes += d_collect(p, language, prev, ids, COLLECTION_REPOS // len(ids) + 1)
        ctes += f",\n{p}taken as ({f'select * from {prev} union all ' if prev else ''}select repo_name from {p}_all)"
        prev = f"{p}taken"
        selects.append(f"""select {D.lit(label)} as collection, r.query_id, r.repo_name, r.stars, r.description, r.url, c.doc_id, c.file_path
from {p}_all r join repo_files c on c.repo_name = r.repo_name
where {_ext('c.file_path', family)} and strlen(c.code) < {R.MAX_FILE_BYTES}"""
                       + (f" and {D.contains_any('lower(c.code)', R.SELENIUM_CONTENT_MARKERS)}" if selenium else ""))
    return ctes + "\n" + "\nunion all\n".join(selects)


@query("code_selection", "O-85", duck_with("repo_hits", "repo_files") + d_code_selection())
def q_code_selection(spark, sf_dir):
    files = view(spark, sf_dir, "repo_files").select("repo_name", "doc_id", "file_path", "code")
    out = S.select_code(hits(spark, sf_dir), files, COLLECTION_QUERIES, COLLECTION_REPOS)
    return out.select(F.col("language").alias("collection"), "query_id", "repo_name", "stars", "description", "url",
                      "doc_id", "file_path")
