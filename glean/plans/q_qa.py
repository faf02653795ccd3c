"""Queries over questions, answers and web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.html import code_blocks, html_to_text, unescape
from glean.functions.text import with_computed
from glean.operators import select as S
from glean.operators.clean import clean_code_col
from glean.operators.label import title_instruction
from glean.operators.stats import tag_counts, top_tags
from glean.plans import duck as D
from glean.plans.branches import longest_first, qa_branch
from glean.plans.registry import query
from glean.plans.tables import spread_table
from glean.plans.views import duck_with, view

MAX_QUESTIONS = 300     # per category, as the full collection runs it
SMALL_CAP = 25          # the cap operator exercised where it bites on the fixture


def questions_view(spark, sf_dir):
    return view(spark, sf_dir, "questions").withColumn("tags", F.split(F.col("tags_csv"), ",", -1))


def answers_view(spark, sf_dir):
    return view(spark, sf_dir, "answers")


# --- DuckDB building blocks ----------------------------------------------------

def _rules_values() -> str:
    rows = [f"({D.lit(c)}, {ci}, {D.lit(t)}, {ti})"
            for ci, (c, tags) in enumerate(R.QA_CATEGORY_TAGS.items()) for ti, t in enumerate(tags)]
    return "(values " + ", ".join(rows) + ") as r(category, cat_rank, tag, tag_rank)"


D_Q = duck_with("questions", "answers") + ", q as (select *, string_split(tags_csv, ',') as tags from questions)\n"

D_BEST = """best as (select question_id, answer_pos, score as answer_score, is_accepted, body as answer_body from answers
  qualify row_number() over (partition by question_id order by not coalesce(is_accepted, false),
    case when coalesce(is_accepted, false) then answer_pos else 0 end, -coalesce(score, 0), answer_pos) = 1)"""


def _listing_ctes(per_tag: int = 500) -> str:
    return f""", listing as (
  select r.category, r.cat_rank, r.tag, r.tag_rank, q.question_id, q.score, q.answer_count,
    row_number() over (partition by r.category, r.tag order by q.score desc, q.question_id) as rank
  from (select question_id, score, answer_count, unnest(list_distinct(tags)) as tag from q) q join {_rules_values()} on q.tag = r.tag
  qualify rank <= {per_tag}),
listed as (select *, tag_rank::bigint * {S.POS_SCALE} + rank as cat_pos from listing),
firsts as (select * from listed qualify row_number() over (partition by category, question_id order by cat_pos) = 1)
"""


def _selection_ctes(max_questions: int) -> str:
    s = _listing_ctes() + f""", yielded as (select * from firsts where score >= 0 and answer_count >= 1),
{D_BEST},
cand as (select y.*, b.answer_pos, b.answer_score, b.is_accepted, b.answer_body,
  (b.answer_pos is not null and b.answer_score >= 1 and coalesce(length(b.answer_body), 0) > 0) as ok
  from yielded y left join best b using (question_id))"""
    parts = []
    for ci, c in enumerate(R.QA_CATEGORY_TAGS):
        prev = f" and question_id not in (select question_id from seen{ci - 1})" if ci else ""
        s += f""",
c{ci} as (select * from cand where category = {D.lit(c)}{prev}),
acc{ci} as (select * from c{ci} where ok order by cat_pos limit {max_questions}),
stop{ci} as (select case when count(*) >= {max_questions} then max(cat_pos) end as stop from acc{ci}),
seen{ci} as ({f'select question_id from seen{ci - 1} union all ' if ci else ''}select question_id from c{ci}, stop{ci} where stop is null or cat_pos <= stop)"""
        parts.append(f"select category, cat_rank, cat_pos, question_id, answer_pos, answer_score, is_accepted, answer_body from acc{ci}")
    return s + ",\nselected as (" + " union all ".join(parts) + ")\n"


def _pairs_cte(selected: str = "selected", columns: str = "s.category, s.cat_rank, s.cat_pos, ") -> str:
    title = D.unescape("coalesce(q.title, '')")
    return f""", pairs0 as (select {columns}q.question_id, s.answer_pos, q.tags, q.score, s.answer_score,
    {title} as title, {D.html_to_text('q.body')} as qtext, {D.html_to_text('s.answer_body')} as answer,
    {D.code_blocks_from(D.mark_blocks('s.answer_body'))} as code_blocks,
    coalesce(q.link, 'https://stackoverflow.com/q/' || cast(q.question_id as varchar)) as url
  from q join {selected} s using (question_id)),
pairs as (select *, case when length(qtext) > 0 then qtext else title end as question from pairs0)
"""


def _pairs_spark(spark, sf_dir, max_questions=MAX_QUESTIONS):
    qv = questions_view(spark, sf_dir)
    sel = S.select_qa(qv, answers_view(spark, sf_dir), max_questions=max_questions)
    return S.qa_pairs(sel, qv)


def answered_ctes() -> str:
    """CTE ``pairs`` of every answered question (what corpus queries read), on top of D_Q."""
    return ", " + D_BEST + _pairs_cte("best", "")


def answered(spark, sf_dir):
    return S.answered_pairs(questions_view(spark, sf_dir), answers_view(spark, sf_dir))


# --- queries -------------------------------------------------------------------

@query("qa_listing_cap", "O-57", D_Q + _listing_ctes() + "select category, tag, question_id, rank from listed")
def q_listing(spark, sf_dir):
    rules = S.category_rules(spark)
    return S.tag_listing(questions_view(spark, sf_dir), rules).select("category", "tag", "question_id", "rank")


@query("qa_question_dedup", "O-43", D_Q + _listing_ctes() + "select category, question_id, cat_pos from firsts")
def q_question_dedup(spark, sf_dir):
    rules = S.category_rules(spark)
    firsts = S.first_per_category(S.tag_listing(questions_view(spark, sf_dir), rules))
    return firsts.select("category", "question_id", "cat_pos")


@query("qa_filter_questions", "O-25", D_Q + "select question_id, score >= 0 and answer_count >= 1 as passes from q")
def q_filter_questions(spark, sf_dir):
    qv = questions_view(spark, sf_dir)
    return qv.select("question_id", F.coalesce(S.question_ok(), F.lit(False)).alias("passes"))


@query("qa_join_answers", "O-39", D_Q + """select q.question_id, a.answer_pos, q.score, a.score as answer_score
from q join answers a on a.question_id = q.question_id""")
def q_join_answers(spark, sf_dir):
    a = answers_view(spark, sf_dir).select("question_id", "answer_pos", "score")
    return S.join_answers(questions_view(spark, sf_dir).select("question_id", "score"), a)


@query("qa_best_answer", "O-41", D_Q + ", " + D_BEST + "\nselect question_id, answer_pos, answer_score, is_accepted from best")
def q_best_answer(spark, sf_dir):
    b = S.best_answer(answers_view(spark, sf_dir))
    return b.select("question_id", "answer_pos", F.col("score").alias("answer_score"), "is_accepted")


@query("qa_filter_answers", "O-26", D_Q + ", " + D_BEST + """
select question_id, answer_pos from best where answer_score >= 1 and coalesce(length(answer_body), 0) > 0""")
def q_filter_answers(spark, sf_dir):
    b = S.best_answer(answers_view(spark, sf_dir)).select(
        "question_id", "answer_pos", F.col("score").alias("answer_score"), F.col("body").alias("answer_body"))
    return S.filter_answers(b).select("question_id", "answer_pos")


@query("qa_cap_per_category", "O-50", D_Q + _selection_ctes(SMALL_CAP) +
       "select category, question_id, cat_pos from selected")
def q_cap_per_category(spark, sf_dir):
    sel = S.select_qa(questions_view(spark, sf_dir), answers_view(spark, sf_dir), max_questions=SMALL_CAP)
    return sel.select("category", "question_id", "cat_pos")


_PAIR_COLS = """category, question_id, answer_pos, answer_score, title, question, answer, url,
  array_to_string(tags, ',') as tags, len(code_blocks) as n_blocks, array_to_string(code_blocks, chr(30)) as blocks"""


@query("qa_selection", "O-84", D_Q + _selection_ctes(MAX_QUESTIONS) + _pairs_cte() + f"select {_PAIR_COLS} from pairs")
def q_selection(spark, sf_dir):
    p = _pairs_spark(spark, sf_dir)
    return p.select("category", "question_id", "answer_pos", "answer_score", "title", "question", "answer", "url",
                    F.array_join("tags", ",").alias("tags"), F.size("code_blocks").alias("n_blocks"),
                    F.array_join("code_blocks", "\u001e").alias("blocks"))


def qa_branch_ctes() -> str:
    """CTEs ``kept`` (Q&A corpus rows before dedup) on top of ``pairs``."""
    return f"""
, withcode as (select *, list_reduce(list_transform(code_blocks, lambda x, i: {{'n': length(x), 'neg': -i, 'v': x}}),
    lambda a, b: case when (b.n > a.n) or (b.n = a.n and b.neg > a.neg) then b else a end).v as longest
  from pairs where len(code_blocks) > 0),
cleaned as (select *, {D.clean_code('longest')} as output from withcode),
kept as (select *, {D.output_key('output')} as output_key from cleaned where length(output) >= 50)
"""


@query("qa_branch", "O-82", D_Q + answered_ctes() + qa_branch_ctes() + f"""
, firsts2 as (select * from kept qualify row_number() over (partition by output_key order by question_id) = 1)
select question_id, {D.title_instruction('title')} as instruction, substr(question, 1, 500) as input, output, output_key,
  {D.language_from_tags('tags')} as language
from firsts2""")
def q_qa_branch(spark, sf_dir):
    out = qa_branch(answered(spark, sf_dir))       # src_pos is the question's id
    return out.select(F.col("src_pos").alias("question_id"), "instruction", "input", "output", "output_key", "language")


@query("qa_code_blocks", "O-70", duck_with("answers") + f"""
select question_id, answer_pos, b.i as block_pos, b.v as block
from (select question_id, answer_pos, {D.code_blocks_from(D.mark_blocks('body'))} as bl from answers),
  unnest(list_transform(bl, lambda v, i: {{'i': i - 1, 'v': v}})) as t(b)""")
def q_code_blocks(spark, sf_dir):
    a = answers_view(spark, sf_dir).select("question_id", "answer_pos", code_blocks(F.col("body")).alias("bl"))
    return a.select("question_id", "answer_pos", F.posexplode("bl").alias("block_pos", "block"))


_D_LONGEST = """list_reduce(list_transform(bl, lambda x, i: {'n': length(x), 'neg': -i, 'v': x}),
    lambda a, b: case when (b.n > a.n) or (b.n = a.n and b.neg > a.neg) then b else a end).v"""


@query("qa_longest_block", "O-72", duck_with("answers") + f"""
select question_id, answer_pos, {_D_LONGEST} as longest
from (select question_id, answer_pos, {D.code_blocks_from(D.mark_blocks('body'))} as bl from answers) where len(bl) > 0""")
def q_longest_block(spark, sf_dir):
    a = answers_view(spark, sf_dir).select("question_id", "answer_pos", code_blocks(F.col("body")).alias("bl"))
    return a.filter(F.size("bl") > 0).select("question_id", "answer_pos", longest_first(F.col("bl")).alias("longest"))


@query("qa_has_code", "O-18", duck_with("answers") + f"""
select question_id, answer_pos, len({D.code_blocks_from(D.mark_blocks('body'))}) > 0 as has_code from answers""")
def q_has_code(spark, sf_dir):
    a = answers_view(spark, sf_dir)
    return a.select("question_id", "answer_pos", (F.size(code_blocks(F.col("body"))) > 0).alias("has_code"))


@query("qa_min_length", "O-19", duck_with("answers") + f"""
select question_id, answer_pos, length(c) as n_chars, length(c) >= 50 as keep from (
  select question_id, answer_pos, {D.clean_code(_D_LONGEST)} as c
  from (select question_id, answer_pos, {D.code_blocks_from(D.mark_blocks('body'))} as bl from answers) where len(bl) > 0)""")
def q_min_length(spark, sf_dir):
    a = answers_view(spark, sf_dir).select("question_id", "answer_pos", code_blocks(F.col("body")).alias("bl"))
    a = with_computed(a.filter(F.size("bl") > 0), c=clean_code_col(longest_first(F.col("bl"))))
    return a.select("question_id", "answer_pos", F.length("c").alias("n_chars"),
                    (F.length("c") >= R.MIN_CODE_CHARS).alias("keep"))


@query("qa_tag_language", "O-32", D_Q + f"select question_id, {D.language_from_tags('tags')} as language from q")
def q_tag_language(spark, sf_dir):
    return questions_view(spark, sf_dir).select("question_id", R.language_from_tag_array(F.col("tags")).alias("language"))


@query("qa_title_instruction", "O-33", D_Q + f"""
select question_id, {D.title_instruction(D.unescape("coalesce(title, '')"))} as instruction from q""")
def q_title_instruction(spark, sf_dir):
    qv = questions_view(spark, sf_dir)
    return qv.select("question_id", title_instruction(unescape(F.col("title"))).alias("instruction"))


@query("qa_question_text", "O-35", D_Q + f"""
select question_id, case when length(t) > 0 then t else {D.unescape("coalesce(title, '')")} end as question
from (select question_id, title, {D.html_to_text('body')} as t from q)""")
def q_question_text(spark, sf_dir):
    qv = with_computed(questions_view(spark, sf_dir), t=html_to_text(F.col("body")))
    title = unescape(F.coalesce(F.col("title"), F.lit("")))
    return qv.select("question_id", F.when(F.length("t") > 0, F.col("t")).otherwise(title).alias("question"))


@query("qa_input_truncate", "O-34", D_Q + f"""
select question_id, substr(case when length(t) > 0 then t else {D.unescape("coalesce(title, '')")} end, 1, 500) as input
from (select question_id, title, {D.html_to_text('body')} as t from q)""")
def q_input_truncate(spark, sf_dir):
    qv = with_computed(questions_view(spark, sf_dir), t=html_to_text(F.col("body")))
    title = unescape(F.coalesce(F.col("title"), F.lit("")))
    text = F.when(F.length("t") > 0, F.col("t")).otherwise(title)
    return qv.select("question_id", F.substring(text, 1, 500).alias("input"))


@query("qa_link_default", "O-36", D_Q + """
select question_id, coalesce(link, 'https://stackoverflow.com/q/' || cast(question_id as varchar)) as url from q""")
def q_link_default(spark, sf_dir):
    qv = questions_view(spark, sf_dir)
    return qv.select("question_id", F.coalesce(F.col("link"), F.concat(
        F.lit("https://stackoverflow.com/q/"), F.col("question_id").cast("string"))).alias("url"))


@query("qa_tag_counts", "O-53", D_Q + _selection_ctes(MAX_QUESTIONS) + """
select tag, count(*) as n from (select unnest(q.tags) as tag from q join selected s using (question_id)) group by tag""")
def q_tag_counts(spark, sf_dir):
    qv = questions_view(spark, sf_dir)
    sel = S.select_qa(qv, answers_view(spark, sf_dir), max_questions=MAX_QUESTIONS)
    bound = MAX_QUESTIONS * len(R.QA_CATEGORY_TAGS)
    return tag_counts(qv.join(S.broadcast_if_bounded(sel.select("question_id"), bound), "question_id"))


@query("qa_top_tags", "O-54", D_Q + _selection_ctes(MAX_QUESTIONS) + """
select tag, count(*) as n from (select unnest(q.tags) as tag from q join selected s using (question_id))
group by tag order by n desc, tag limit 10""")
def q_top_tags(spark, sf_dir):
    qv = questions_view(spark, sf_dir)
    sel = S.select_qa(qv, answers_view(spark, sf_dir), max_questions=MAX_QUESTIONS)
    bound = MAX_QUESTIONS * len(R.QA_CATEGORY_TAGS)
    return top_tags(qv.join(S.broadcast_if_bounded(sel.select("question_id"), bound), "question_id"))


@query("html_to_text", "O-71", f"select page_id, {D.html_to_text('html')} as text from pages")
def q_html_to_text(spark, sf_dir):
    pages = spread_table(spark, sf_dir, "pages")
    return pages.select("page_id", html_to_text(F.col("html")).alias("text"))


@query("html_answer_text", "O-71", duck_with("answers") + f"""
select question_id, answer_pos, {D.html_to_text('body')} as text from answers""")
def q_html_answer_text(spark, sf_dir):
    a = answers_view(spark, sf_dir)
    return a.select("question_id", "answer_pos", html_to_text(F.col("body")).alias("text"))


@query("qa_json_roundtrip", "O-02", D_Q + """
, j as (select question_id, to_json({'source': 'stackoverflow', 'question_id': question_id, 'title': title, 'tags': tags,
    'code_blocks': [body], 'score': score}) as line from q)
select question_id, json_extract_string(line, '$.title') as title,
  array_to_string(cast(json_extract(line, '$.tags') as varchar[]), ',') as tags,
  len(cast(json_extract(line, '$.code_blocks') as varchar[])) as n_blocks, cast(json_extract_string(line, '$.score') as bigint) as score
from j""")
def q_qa_json(spark, sf_dir):
    """QAPair-shaped JSON lines (arrays included) parsed with the source schema."""
    from glean.sources.jsonl import QA_PAIR_SCHEMA, typed
    qv = questions_view(spark, sf_dir)
    line = F.to_json(F.struct(F.lit("stackoverflow").alias("source"), "question_id", "title", "tags",
                              F.array("body").alias("code_blocks"), "score"))
    p = typed(qv.select(F.from_json(line, QA_PAIR_SCHEMA).alias("r")).select("r.*"))
    return p.select("question_id", "title", F.array_join("tags", ",").alias("tags"),
                    F.size("code_blocks").alias("n_blocks"), "score")
