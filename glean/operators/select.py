"""Selection of repositories, files, questions and answers as relational jobs.

The scrapers behind these rules walked search results one request at a
time; here the search results are tables, and each rule is a filter, a
first-wins dedup, a per-group cap, or an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.text import col_of, contains_any
from glean.session import cut_lineage


# Largest row count we broadcast on the strength of a static bound (rule lists,
# caps); beyond it the join is left to the planner (sort-merge, or AQE's
# runtime broadcast when the side turns out small).
BROADCAST_ROW_BOUND = 1_000_000


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when its row count is bounded by ``max_rows``
    (known from parameters, not data) and that bound is small enough."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROW_BOUND else df


# --- files ---------------------------------------------------------------

def lang_family(language) -> Column:
    """'selenium_python' -> 'python'; other names unchanged."""
    return F.regexp_replace(col_of(language), "^selenium_", "")


def extension_ok(path, family, extensions=R.FILE_EXTENSIONS) -> Column:
    """Case-insensitive suffix test against the family's extension list."""
    path, family = F.lower(col_of(path)), col_of(family)
    chain = None
    for fam, exts in extensions.items():
        cond = F.lit(False)
        for e in exts:
            cond = cond | F.endswith(path, F.lit(e))
        chain = F.when(family == fam, cond) if chain is None else chain.when(family == fam, cond)
    return chain.otherwise(F.lit(False))


def size_ok(content, max_bytes: int = R.MAX_FILE_BYTES) -> Column:
    return F.octet_length(col_of(content)) < max_bytes


def selenium_content_ok(content) -> Column:
    return contains_any(F.lower(col_of(content)), R.SELENIUM_CONTENT_MARKERS)


def select_files(files: DataFrame, family: str, path: str = "file_path", content: str = "code",
                 max_bytes: int = R.MAX_FILE_BYTES, must_contain_selenium: bool = False) -> DataFrame:
    """Extension, size and (optionally) content predicates on repository files."""
    cond = extension_ok(F.col(path), F.lit(family)) & size_ok(F.col(content), max_bytes)
    if must_contain_selenium:
        cond = cond & selenium_content_ok(F.col(content))
    return files.filter(cond)


# --- repositories ----------------------------------------------------------

def filter_repos(repos: DataFrame, min_stars: int = 5, language: str | None = None) -> DataFrame:
    cond = F.col("stars") >= min_stars
    if language is not None:
        cond = cond & (F.col("language") == language)
    return repos.filter(cond)


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """Global top-n by ``order``: a TakeOrderedAndProject of at most n rows."""
    return df.orderBy(*order).limit(n)


def cap_per_group(df: DataFrame, group, order: list, n: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each group by ``order``.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most n rows per group: a hot group
    never reaches one task whole.
    """
    w = Window.partitionBy(group).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def walk_stops(cand: DataFrame, positions: list[str], cap: int | None, ok: Column | None = None) -> list:
    """Where each of several lists, walked in order, stops.

    ``cand`` has one row per item and, per list, a column with the item's place in it (null: not
    listed). A walk skips items that an earlier walk reached and stops at its ``cap``-th item that
    is ``ok``; its stop is that item's place (None: the list ended first). An item was reached by
    an earlier walk if its place there is not past that walk's stop, so a stop per list says it all:
    a step is one aggregate over ``cand``, and its plan doesn't hold the earlier steps.
    """
    stops = []
    for i, p in enumerate(positions):
        if cap is None:
            stops.append(None)
            continue
        free = cand.filter(F.col(p).isNotNull() & ~_reached(positions[:i], stops))
        first = top_n(free if ok is None else free.filter(ok), cap, [F.asc(p)])
        row = first.agg(F.count(F.lit(1)).alias("n"), F.max(p).alias("stop")).first()
        stops.append(row["stop"] if row["n"] >= cap else None)
    return stops


def _reached_by(position: str, stop) -> Column:
    return F.col(position).isNotNull() if stop is None else F.coalesce(F.col(position) <= stop, F.lit(False))


def _reached(positions: list[str], stops: list) -> Column:
    out = F.lit(False)
    for p, stop in zip(positions, stops):
        out = out | _reached_by(p, stop)
    return out


def first_walk(positions: list[str], stops: list) -> Column:
    """Index of the first walk that reached the item (null: none did)."""
    return F.coalesce(*[F.when(_reached_by(p, stop), F.lit(i)) for i, (p, stop) in enumerate(zip(positions, stops))])


def collect_repositories(hits: DataFrame, query_ids: list, max_repos: int | None, min_stars: int = 5,
                         language: str | None = None, already: DataFrame | None = None) -> DataFrame:
    """Walk the search queries in order. Per query: hits with enough stars (and
    the language), stars descending, skipping repositories collected by an
    earlier query (they do not count), at most ``max_repos // n + 1`` new ones
    (``max_repos`` None: all).

    A query can only take repositories from the first ``cap * len(query_ids)``
    of its list (earlier queries hold at most ``cap * (q - 1)``), so each list
    is cut to that depth first (a per-group top-n, limited before the shuffle).
    """
    from glean.operators.dedup import dedup_first

    cap = None if max_repos is None else max_repos // len(query_ids) + 1
    cand = filter_repos(hits, min_stars, language).filter(F.col("query_id").isin(query_ids))
    # a result list names a repository once (its best-starred entry)
    cand = dedup_first(cand.withColumn("_neg_stars", -F.col("stars")), ["query_id", "repo_name"],
                       ["_neg_stars"]).drop("_neg_stars")
    if already is not None:
        cand = cand.join(already.select("repo_name"), "repo_name", "left_anti")
    cols = cand.columns
    if cap is None:
        first = F.array_position(F.array(*[F.lit(q) for q in query_ids]), F.col("query_id"))
        return dedup_first(cand.withColumn("_walk", first), "repo_name", ["_walk"]).select(*cols)
    listed = cut_lineage(cap_per_group(cand, "query_id", [F.desc("stars"), F.asc("repo_name")],
                                       cap * len(query_ids), rank_col="_rank"))
    places = [f"_place{i}" for i in range(len(query_ids))]
    wide = listed.groupBy("repo_name").agg(*[F.min(F.when(F.col("query_id") == q, F.col("_rank"))).alias(p)
                                             for p, q in zip(places, query_ids)])
    walk = first_walk(places, walk_stops(wide, places, cap))
    query_of = F.element_at(F.array(*[F.lit(q) for q in query_ids]), walk + 1)
    taken = wide.filter(walk.isNotNull()).select("repo_name", query_of.alias("query_id"))
    return listed.join(taken, ["repo_name", "query_id"], "left_semi").select(*cols)


def attach_repo(files: DataFrame, repos: DataFrame, on: str = "repo_name",
                max_repos: int | None = None) -> DataFrame:
    """Copy repository fields (stars, description, query) onto each file row.

    A collected repository set is bounded by the caps (``max_repos`` rows);
    with that bound given and small, it is broadcast.
    """
    side = broadcast_if_bounded(repos, max_repos) if max_repos is not None else repos
    return files.join(side, on=on, how="inner")


# --- questions and answers ---------------------------------------------------

def question_ok(min_score: int = 0, min_answers: int = 1) -> Column:
    return (F.col("score") >= min_score) & (F.coalesce(F.col("answer_count"), F.lit(0)) >= min_answers)


def filter_questions(questions: DataFrame, min_score: int = 0, min_answers: int = 1) -> DataFrame:
    return questions.filter(question_ok(min_score, min_answers))


def best_answer_order() -> Column:
    """Order that makes the chosen answer the minimum: the first accepted answer
    in list order; otherwise the highest score, earliest on ties."""
    acc = F.coalesce(F.col("is_accepted"), F.lit(False))
    return F.struct((~acc).alias("not_accepted"),
                    F.when(acc, F.col("answer_pos")).otherwise(F.lit(0)).alias("acc_pos"),
                    (-F.coalesce(F.col("score"), F.lit(0))).alias("neg_score"),
                    F.col("answer_pos").alias("pos"))


def best_answer(answers: DataFrame, key: str = "question_id") -> DataFrame:
    """One answer per question via ``min_by`` (partial aggregation; a question
    with a huge answer list never lands in one task whole)."""
    cols = [c for c in answers.columns]
    return (answers.groupBy(key)
            .agg(F.min_by(F.struct(*[F.col(c) for c in cols if c != key]), best_answer_order()).alias("_b"))
            .select(key, "_b.*"))


def filter_answers(pairs: DataFrame, min_answer_score: int = 1) -> DataFrame:
    """Applied after choosing: a low-scored chosen answer drops the question."""
    return pairs.filter((F.coalesce(F.col("answer_score"), F.lit(0)) >= min_answer_score)
                        & (F.coalesce(F.length("answer_body"), F.lit(0)) > 0))


def category_rules(spark, category_tags=R.QA_CATEGORY_TAGS) -> DataFrame:
    """The tag search plan as a small table: (category, cat_rank, tag, tag_rank)."""
    rows = [(c, ci, t, ti) for ci, (c, tags) in enumerate(category_tags.items()) for ti, t in enumerate(tags)]
    return spark.createDataFrame(rows, "category string, cat_rank int, tag string, tag_rank int")


POS_SCALE = 1_000_000_000   # cat_pos = tag_rank * POS_SCALE + rank within the tag listing


def tag_listing(questions: DataFrame, rules: DataFrame, per_tag: int = 500) -> DataFrame:
    """Questions listed per searched tag, votes descending (ties by id), at most
    ``per_tag`` per tag (5 pages of 100). One row per (category, tag, question)."""
    pairs = (questions.select("question_id", "score", "answer_count",
                              F.explode(F.array_distinct(F.col("tags"))).alias("tag"))
             .join(rules, "tag"))   # the planner sees the rule table's size
    listed = cap_per_group(pairs, ["category", "tag"], [F.desc("score"), F.asc("question_id")], per_tag,
                           rank_col="rank")
    return listed.withColumn("cat_pos", F.col("tag_rank").cast("long") * POS_SCALE + F.col("rank"))


def first_per_category(listing: DataFrame) -> DataFrame:
    """A question met again under a later tag of the same search is skipped."""
    from glean.operators.dedup import dedup_first

    return dedup_first(listing, ["category", "question_id"], ["cat_pos"])


def select_qa(questions: DataFrame, answers: DataFrame, category_tags=R.QA_CATEGORY_TAGS,
              max_questions: int | None = 300, per_tag: int = 500, min_score: int = 0, min_answers: int = 1,
              min_answer_score: int = 1) -> DataFrame:
    """Question/answer selection, one category after another.

    Per category: the tag listings (``tag_listing``), first occurrence per
    question, the question predicate, the best answer, the answer predicate,
    then the first ``max_questions`` accepted pairs in listing order. A
    question is *seen* (and skipped by later categories) if the walk reached
    it: every yielded question up to the one that filled the cap, accepted or
    not (``walk_stops``). ``max_questions`` None: no cap. Returns
    one row per selected pair with the chosen answer's fields; bodies join in
    only after the choice.
    """
    rules = category_rules(questions.sparkSession, category_tags)
    listing = tag_listing(questions, rules, per_tag)
    places = [f"_place{i}" for i in range(len(category_tags))]
    # a question met again under a later tag of the same category counts once, at its first place
    wide = (filter_questions(listing, min_score, min_answers).groupBy("question_id")
            .agg(*[F.min(F.when(F.col("cat_rank") == i, F.col("cat_pos"))).alias(p) for i, p in enumerate(places)]))
    best = best_answer(answers.select("question_id", "answer_pos", "score", "is_accepted",
                                      (F.coalesce(F.length("body"), F.lit(0)) > 0).alias("has_body")))
    best = best.select("question_id", "answer_pos", F.col("score").alias("answer_score"), "is_accepted",
                       ((F.col("score") >= min_answer_score) & F.col("has_body")).alias("ok"))
    cand = wide.join(best, "question_id", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    if max_questions is not None:
        cand = cut_lineage(cand)
    walk = first_walk(places, walk_stops(cand, places, max_questions, F.col("ok")))
    chosen = (cand.filter(F.col("ok")).withColumn("cat_rank", walk).filter(F.col("cat_rank").isNotNull())
              .withColumn("cat_pos", F.element_at(F.array(*places), F.col("cat_rank") + 1))
              .withColumn("category", F.element_at(F.array(*[F.lit(c) for c in category_tags]), F.col("cat_rank") + 1)))
    bodies = answers.select("question_id", "answer_pos", F.col("body").alias("answer_body"))
    return chosen.join(bodies, ["question_id", "answer_pos"]).select(
        "category", "cat_rank", "cat_pos", "question_id", "answer_pos", "answer_score", "is_accepted", "answer_body")


def pair_columns() -> list[Column]:
    """QA pair fields (title, question text, answer text, code blocks, tags, url)
    of a question joined to its chosen answer."""
    from glean.functions.html import code_blocks, html_to_text, unescape

    title = unescape(F.coalesce(F.col("title"), F.lit("")))
    text = html_to_text(F.col("body"))
    return [F.col("question_id"), F.col("answer_pos"), F.col("tags"), F.col("score"), F.col("answer_score"),
            title.alias("title"),
            F.when(F.length(text) > 0, text).otherwise(title).alias("question"),
            html_to_text(F.col("answer_body")).alias("answer"),
            code_blocks(F.col("answer_body")).alias("code_blocks"),
            F.coalesce(F.col("link"), F.concat(F.lit("https://stackoverflow.com/q/"),
                                               F.col("question_id").cast("string"))).alias("url")]


def qa_pairs(selected: DataFrame, questions: DataFrame) -> DataFrame:
    """Selected pairs -> QAPair rows. The planner picks the join: ``selected``
    carries answer texts, so its row bound says little about its bytes."""
    q = questions.join(selected, "question_id")
    return q.select(
        "category", *pair_columns(),
        F.lit("qa_selection").alias("src_path"),
        (F.col("cat_rank").cast("long") * (POS_SCALE * 1000) + F.col("cat_pos")).alias("src_pos"))


def answered_pairs(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Every question that has an answer, with its best one, as QAPair rows in
    question order: no cap and no category. What a corpus build reads."""
    best = best_answer(answers.select("question_id", "answer_pos", "score", "is_accepted"))
    bodies = answers.select("question_id", "answer_pos", F.col("body").alias("answer_body"))
    pairs = best.withColumnRenamed("score", "answer_score").join(bodies, ["question_id", "answer_pos"])
    return questions.join(pairs, "question_id").select(
        *pair_columns(), F.lit("qa_pairs").alias("src_path"), F.col("question_id").alias("src_pos"))


def join_answers(questions: DataFrame, answers: DataFrame, key: str = "question_id") -> DataFrame:
    """Questions with each of their answers (inner equi-join; the planner picks
    sort-merge or, for a small side, broadcast)."""
    a = answers.select(*[F.col(c).alias(f"answer_{c}") if c not in (key,) and not c.startswith("answer_") else F.col(c)
                         for c in answers.columns])
    return questions.join(a, key)


def union_rules(*rule_tables: DataFrame) -> DataFrame:
    """Rule lists walked as one (e.g. two groups of search queries)."""
    out = rule_tables[0]
    for t in rule_tables[1:]:
        out = out.unionByName(t)
    return out


#: Collections in order: label, hit language (None: any), file family, files must mention Selenium.
COLLECTIONS = (("vbscript", None, "vbscript", False),
               ("selenium_python", "Python", "python", True),
               ("selenium_java", "Java", "java", True),
               ("selenium_javascript", "JavaScript", "javascript", True))


def select_code(hits: DataFrame, files: DataFrame, query_ids, max_repos: int | None = 30,
                collections=COLLECTIONS) -> DataFrame:
    """Repository code selection, one collection after another (repositories
    collected earlier are skipped): walk the queries, keep files by extension,
    size and (Selenium collections) content, copy repository fields (description
    and url too, where the hits have them) onto files. ``query_ids`` is one list
    of queries or a dict of them by collection label; ``files`` needs repo_name,
    file_path, code."""
    lists = query_ids if isinstance(query_ids, dict) else {c[0]: query_ids for c in collections}
    fields = [c for c in ("query_id", "repo_name", "stars", "description", "url") if c in hits.columns]
    taken, out = None, None
    for label, language, family, selenium in collections:
        ids = lists[label]
        repos = cut_lineage(collect_repositories(hits, ids, max_repos, language=language, already=taken))
        kept = select_files(files, family, must_contain_selenium=selenium).drop("description", "url")
        bound = None if max_repos is None else len(ids) * (max_repos // len(ids) + 1)
        rows = attach_repo(kept, repos.select(*fields), max_repos=bound).withColumn("language", F.lit(label))
        taken = repos.select("repo_name") if taken is None else taken.unionByName(repos.select("repo_name"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
