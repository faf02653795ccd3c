"""Queries over instruction rows, the assembled corpus, conversations and raw JSON lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.operators import corpus as C
from glean.operators import training_views as TV
from glean.operators.dedup import anti_dedup
from glean.operators.records import with_chunks
from glean.operators.stats import count_by, volume_check
from glean.plans import duck as D
from glean.plans.branches import code_branch, instruction_branch, qa_branch
from glean.plans.q_code import CLEAN, code_view
from glean.plans.q_qa import answered, answered_ctes, qa_branch_ctes
from glean.plans.registry import query
from glean.plans.tables import spread_table
from glean.plans.views import duck_with, view

VAL_THRESHOLD = int(round(R.VAL_RATIO * C.HASH_BUCKETS))


def inst_view(spark, sf_dir):
    return (view(spark, sf_dir, "instruction_samples")
            .withColumn("src_path", F.lit("instruction_samples"))
            .withColumn("src_pos", F.col("conv_id") * 1000 + F.col("turn")))


def d_bucket(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5({D.lit(seed)} || {key}), 1, 15))::bigint % {C.HASH_BUCKETS})"


D_INST = f""", inst0 as (select conv_id, turn, coalesce(instruction, '') as instruction, coalesce(input, '') as input,
    coalesce(output, '') as output from instruction_samples),
inst1 as (select *, {D.clean_code('output')} as c from inst0 where length(instruction) > 0 and length(output) > 0),
inst_rows as (select 2::bigint as src_rank, conv_id * 1000 + turn as src_pos, 'your_scripts' as source, 'vbscript' as language,
    instruction, input, c as output, {D.output_key('c')} as output_key from inst1 where length(c) >= 50)
"""

_VALID = f"{D.length_ok('c')} and {D.keywords_ok('c', 'language')}"

D_CODE_ROWS = f""", cvalid as (select doc_id, language, description, c, {D.output_key('c')} as k
  from (select doc_id, language, description, {CLEAN} as c from code_samples) where {_VALID}),
code_rows as (select 0::bigint as src_rank, doc_id as src_pos, 'github' as source, language,
  {D.instruction_of(D.task_of('c', 'description'), 'language', 'k')} as instruction, '' as input, c as output, k as output_key
  from cvalid)
"""

D_QA_ROWS = f""", qa_rows as (select 1::bigint as src_rank, question_id as src_pos, 'stackoverflow' as source,
  {D.language_from_tags('tags')} as language, {D.title_instruction('title')} as instruction, substr(question, 1, 500) as input,
  output, output_key from kept)
"""

D_CORPUS = (duck_with("code_samples", "questions", "answers", "instruction_samples")
            + ", q as (select *, string_split(tags_csv, ',') as tags from questions)\n"
            + answered_ctes() + qa_branch_ctes() + D_CODE_ROWS + D_QA_ROWS + D_INST + f"""
, allrows as (select * from code_rows union all select * from qa_rows union all select * from inst_rows),
deduped as (select * from allrows qualify row_number() over (partition by output_key order by src_rank, src_pos) = 1),
augmented as (select *, 0::bigint as aug_pos from deduped
  union all select src_rank, src_pos, source, language, replace(instruction, 'Write', 'Create'), input, output, output_key, 1::bigint
  from deduped where replace(instruction, 'Write', 'Create') <> instruction),
corpus as (select *, case when {d_bucket('output_key', 'split')} < {VAL_THRESHOLD} then 'val' else 'train' end as split from augmented)
""")


def corpus_rows(spark, sf_dir):
    """The three branches without dedup (each with src_rank/src_path/src_pos)."""
    code = code_branch(code_view(spark, sf_dir), dedup=False)
    qa = qa_branch(answered(spark, sf_dir), dedup=False)
    inst = instruction_branch(inst_view(spark, sf_dir), dedup=False)
    return C.union_sources(code, qa, inst)


def build_corpus(spark, sf_dir):
    """Union -> cross-source first-wins dedup -> augment -> group split."""
    return C.split_corpus(C.augment(C.dedup_corpus(corpus_rows(spark, sf_dir))))


# --- instruction rows --------------------------------------------------------------------

@query("inst_required_fields", "O-20", duck_with("instruction_samples") + """
select conv_id, turn, coalesce(instruction, '') <> '' and coalesce(output, '') <> '' as keep from instruction_samples""")
def q_required(spark, sf_dir):
    v = view(spark, sf_dir, "instruction_samples")
    keep = (F.coalesce(F.col("instruction"), F.lit("")) != "") & (F.coalesce(F.col("output"), F.lit("")) != "")
    return v.select("conv_id", "turn", keep.alias("keep"))


@query("inst_branch", "O-83", duck_with("instruction_samples") + D_INST + """
select src_pos, instruction, input, output, output_key from inst_rows
qualify row_number() over (partition by output_key order by src_pos) = 1""")
def q_inst_branch(spark, sf_dir):
    return instruction_branch(inst_view(spark, sf_dir)).select("src_pos", "instruction", "input", "output", "output_key")


@query("inst_augment", "O-74", duck_with("instruction_samples") + D_INST + """
, d as (select * from inst_rows qualify row_number() over (partition by output_key order by src_pos) = 1)
select src_pos, 0::bigint as aug_pos, instruction from d
union all select src_pos, 1::bigint, replace(instruction, 'Write', 'Create') from d where replace(instruction, 'Write', 'Create') <> instruction""")
def q_inst_augment(spark, sf_dir):
    return C.augment(instruction_branch(inst_view(spark, sf_dir))).select("src_pos", "aug_pos", "instruction")


@query("inst_prompt", "O-78", duck_with("instruction_samples") + D_INST + """
, d as (select * from inst_rows qualify row_number() over (partition by output_key order by src_pos) = 1)
select src_pos, case when length(input) > 0
  then '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Input:' || chr(10) || input || chr(10) || chr(10) || '### Response:' || chr(10) || output
  else '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Response:' || chr(10) || output end as text
from d""")
def q_inst_prompt(spark, sf_dir):
    return C.format_prompt(instruction_branch(inst_view(spark, sf_dir))).select("src_pos", "text")


# --- corpus ---------------------------------------------------------------------------------

@query("corpus_union", "O-59", D_CORPUS + "select source, src_rank, src_pos, output_key from allrows")
def q_union(spark, sf_dir):
    return corpus_rows(spark, sf_dir).select("source", "src_rank", "src_pos", "output_key")


@query("corpus_build", "O-80", D_CORPUS + """
select source, src_pos, aug_pos, instruction, input, output, output_key, split from corpus""")
def q_build(spark, sf_dir):
    return build_corpus(spark, sf_dir).select("source", "src_pos", "aug_pos", "instruction", "input", "output",
                                              "output_key", "split")


def narrow_corpus(spark, sf_dir):
    """The deduplicated corpus without its texts: what counts, order and split need."""
    return C.dedup_corpus(corpus_rows(spark, sf_dir).select("source", "instruction", "output_key", "src_rank", "src_path", "src_pos"))


@query("corpus_split", "O-77", D_CORPUS + """
select split, count(*) as n_rows, count(distinct output_key) as n_groups from corpus group by split""")
def q_split(spark, sf_dir):
    s = C.split_corpus(C.augment(narrow_corpus(spark, sf_dir)))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("output_key").alias("n_groups"))


@query("corpus_split_exact", "O-77", D_CORPUS + f"""
, g as (select output_key, count(*) as n_rows, ('0x' || substr(md5('split' || output_key), 1, 15))::bigint as h from augmented group by output_key),
r as (select *, row_number() over (order by h, output_key) as k, count(*) over () as n from g)
select output_key, n_rows, case when k <= floor(n * {R.VAL_RATIO}) then 'val' else 'train' end as split from r""")
def q_split_exact(spark, sf_dir):
    """Every output, its rows and its side: exactly int(n * ratio) of the n outputs validate."""
    s = C.split_corpus(C.augment(narrow_corpus(spark, sf_dir)), exact=True)
    return s.groupBy("output_key").agg(F.count(F.lit(1)).alias("n_rows"), F.max("split").alias("split"))


@query("corpus_source_counts", "O-55", D_CORPUS + """
select case when grouping(source) = 1 then '(all)' else source end as source_label, count(*) as n,
  grouping(source) = 1 as is_total
from deduped group by rollup(source)""")
def q_source_counts(spark, sf_dir):
    c = count_by(narrow_corpus(spark, sf_dir), "source", total=True)
    return c.select(F.when(F.col("is_total"), F.lit("(all)")).otherwise(F.col("source")).alias("source_label"),
                    "n", "is_total")


@query("corpus_volume_check", "O-56", D_CORPUS + f"""
select count(*) as n_examples, count(*) < {R.LOW_VOLUME} as low_volume from augmented""")
def q_volume(spark, sf_dir):
    return volume_check(C.augment(narrow_corpus(spark, sf_dir)), R.LOW_VOLUME)


@query("corpus_seeded_order", "O-58", D_CORPUS + """
, s as (select output_key, ('0x' || substr(md5('glean' || output_key), 1, 15))::bigint as shuffle_key from deduped)
select *, row_number() over (order by shuffle_key, output_key) - 1 as pos from s""")
def q_seeded_order(spark, sf_dir):
    """The shuffled order, each row with its place in it (a prefix sum of ones over the range sort)."""
    s = C.seeded_order(narrow_corpus(spark, sf_dir)).select("output_key", "shuffle_key", F.lit(1).cast("long").alias("one"), F.lit("").alias("all"))
    return with_chunks(s, "one", ["shuffle_key", "output_key"], 1, "all").select("output_key", "shuffle_key", F.col("chunk").alias("pos"))


@query("batch_anti_dedup", "X-2", D_CORPUS + """
, qa_first as (select * from qa_rows qualify row_number() over (partition by output_key order by src_pos) = 1)
select src_pos, output_key from qa_first where output_key not in (select output_key from inst_rows)""")
def q_anti(spark, sf_dir):
    new = qa_branch(answered(spark, sf_dir))
    existing = instruction_branch(inst_view(spark, sf_dir), dedup=False)
    return anti_dedup(new, existing).select("src_pos", "output_key")


# --- conversations: training views -------------------------------------------------------------

D_CHATS = f""", chats as (select conv_id, string_agg('{TV.CHATML_START}' || role || chr(10) || coalesce(text, '') || '{TV.CHATML_END}' || chr(10), '' order by turn) as text,
  count(*) as n_turns from conversations group by conv_id),
tok as (select conv_id, n_turns, len(regexp_extract_all(text, {D.lit(TV.TOKEN)})) as n_tokens from chats)
"""
WC = "with dummy as (select 1)"


def chats(spark, sf_dir):
    return TV.render_chat(spread_table(spark, sf_dir, "conversations"))


@query("chat_render", "O-79", WC + D_CHATS + "select conv_id, text, n_turns from chats")
def q_chat(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", "text", "n_turns")


@query("length_budget", "O-61", WC + D_CHATS + """
select conv_id, n_tokens, n_tokens > 1024 as truncated_1024, n_tokens > 2048 as truncated_2048, n_tokens > 4096 as truncated_4096,
  least(n_tokens, 1024) as kept_1024, least(n_tokens, 2048) as kept_2048, least(n_tokens, 4096) as kept_4096 from tok""")
def q_length_budget(spark, sf_dir):
    return TV.length_budget(chats(spark, sf_dir)).select("conv_id", "n_tokens", *[f"{c}_{b}" for c in ("truncated", "kept") for b in TV.BUDGETS])


#: Budgets of the query that returns cut texts: below the trainers' own, so that texts of every table are cut.
SHORT_BUDGETS = (32, 128, 1024)


@query("truncated_texts", "O-61", WC + D_CHATS + ", c as (select conv_id, text, n_tokens, unnest([" + ", ".join(map(str, SHORT_BUDGETS)) + f"""]) as budget from chats join tok using (conv_id))
select conv_id, budget::bigint as budget, least(n_tokens, budget) as n_kept, case when n_tokens > budget
  then array_to_string(list_slice(regexp_extract_all(text, {D.lit(TV.PIECE)}), 1, budget), '') else text end as text from c""")
def q_truncated(spark, sf_dir):
    """Chat texts cut at the end of their n-th token, per budget."""
    t = TV.length_budget(chats(spark, sf_dir), budgets=SHORT_BUDGETS, keep=True)
    per = F.array(*[F.struct(F.lit(b).cast("long").alias("budget"), F.col(f"kept_{b}").alias("n_kept"), F.col(f"text_{b}").alias("text")) for b in SHORT_BUDGETS])
    return t.select("conv_id", F.inline(per))


@query("padding_account", "O-62", WC + D_CHATS + """
, seqs as (select conv_id, least(n_tokens, 1024) as len from tok),
b as (select len, conv_id % 64 as shard, (row_number() over (partition by conv_id % 64 order by conv_id) - 1) // 4 as batch from seqs),
g as (select shard, batch, count(*) as n_seqs, max(len) as max_len, sum(len)::bigint as real_tokens from b group by shard, batch)
select shard, batch, n_seqs, max_len, real_tokens, (ceil(max_len / 8) * 8)::bigint as padded_len,
  (ceil(max_len / 8) * 8)::bigint * n_seqs as padded_tokens, (ceil(max_len / 8) * 8)::bigint * n_seqs - real_tokens as pad_tokens from g""")
def q_padding(spark, sf_dir):
    t = TV.length_budget(chats(spark, sf_dir), budgets=())
    seqs = t.select("conv_id", F.least(F.col("n_tokens"), F.lit(1024)).cast("long").alias("len"))
    return TV.padding_account(seqs, "len", "conv_id", n_shards=64, batch_size=4).select(
        "shard", "batch", "n_seqs", "max_len", "real_tokens", "padded_len", "padded_tokens", "pad_tokens")


@query("sequence_packing", "O-63")
def q_packing(spark, sf_dir):
    t = TV.length_budget(chats(spark, sf_dir), budgets=())
    return TV.pack_sequences(t, "n_tokens", "conv_id", budget=4096, n_shards=64)


@query("pack_fill", "O-63")
def q_pack_fill(spark, sf_dir):
    t = TV.length_budget(chats(spark, sf_dir), budgets=())
    return TV.pack_stats(TV.pack_sequences(t, "n_tokens", "conv_id", budget=4096, n_shards=64))


# --- raw JSON lines ----------------------------------------------------------------------------

@query("json_corrupt_lines", "O-05", duck_with("raw_events") + f"""
select event_id, case when {D.strip('line')} = '' then 'blank' when json_valid(line) and starts_with(ltrim(line), '{{') then 'ok'
  else 'malformed' end as status from raw_events""")
def q_corrupt(spark, sf_dir):
    from glean.sources.jsonl import line_status
    return view(spark, sf_dir, "raw_events").select("event_id", line_status(F.col("line")).alias("status"))


@query("code_json_defaults", "O-06", duck_with("code_samples") + f"""
, j as (select doc_id, to_json({{'code': case when doc_id % 11 = 0 then null else code end,
    'language': case when doc_id % 7 = 0 then null else language end,
    'description': case when doc_id % 4 = 0 then null else description end}}) as line from code_samples)
select doc_id, length(coalesce(json_extract_string(line, '$.code'), '')) as code_chars,
  coalesce(json_extract_string(line, '$.language'), 'vbscript') as language,
  coalesce(json_extract_string(line, '$.description'), '') as description from j""")
def q_defaults(spark, sf_dir):
    from glean.plans.branches import apply_code_defaults
    from glean.sources.jsonl import CODE_SAMPLE_SCHEMA
    v = code_view(spark, sf_dir)
    line = F.to_json(F.struct(
        F.when(F.col("doc_id") % 11 != 0, F.col("code")).alias("code"),
        F.when(F.col("doc_id") % 7 != 0, F.col("language")).alias("language"),
        F.when(F.col("doc_id") % 4 != 0, F.col("description")).alias("description")))
    parsed = v.select("doc_id", F.from_json(line, CODE_SAMPLE_SCHEMA).alias("s")).select("doc_id", "s.*")
    d = apply_code_defaults(parsed)
    return d.select("doc_id", F.length("code").alias("code_chars"), "language", "description")


@query("code_json_roundtrip", "O-01", duck_with("code_samples") + """
, j as (select doc_id, to_json({'source': source, 'repo_name': repo_name, 'file_path': file_path, 'language': language,
    'code': code, 'stars': stars}) as line from code_samples)
select doc_id, json_extract_string(line, '$.source') as source, json_extract_string(line, '$.repo_name') as repo_name,
  json_extract_string(line, '$.file_path') as file_path, json_extract_string(line, '$.language') as language,
  json_extract_string(line, '$.code') = code as code_equal, cast(json_extract(line, '$.stars') as bigint) as stars
from j join code_samples using (doc_id)""")
def q_roundtrip(spark, sf_dir):
    from glean.sources.jsonl import CODE_SAMPLE_SCHEMA
    v = code_view(spark, sf_dir)
    line = F.to_json(F.struct("source", "repo_name", "file_path", "language", "code", "stars"))
    p = v.select("doc_id", "code", F.from_json(line, CODE_SAMPLE_SCHEMA).alias("s"))
    return p.select("doc_id", "s.source", "s.repo_name", "s.file_path", "s.language",
                    (F.col("s.code") == F.col("code")).alias("code_equal"), F.col("s.stars").cast("int").alias("stars"))



@query("inst_json_roundtrip", "O-03", duck_with("instruction_samples") + """
, j as (select conv_id, turn, to_json({'instruction': instruction, 'input': input, 'output': output, 'source': 'uft_project',
    'category': 'function', 'metadata': {'project': 'p' || cast(conv_id as varchar)}}) as line from instruction_samples)
select conv_id, turn, json_extract_string(line, '$.instruction') as instruction, json_extract_string(line, '$.input') as input,
  length(json_extract_string(line, '$.output')) as output_chars, json_extract_string(line, '$.metadata.project') as project
from j""")
def q_inst_json(spark, sf_dir):
    """TrainingSample-shaped JSON lines (with a metadata map) parsed with the source schema."""
    from glean.sources.jsonl import TRAINING_SAMPLE_SCHEMA
    v = view(spark, sf_dir, "instruction_samples")
    line = F.to_json(F.struct("instruction", "input", "output", F.lit("uft_project").alias("source"),
                              F.lit("function").alias("category"),
                              F.create_map(F.lit("project"), F.concat(F.lit("p"), F.col("conv_id").cast("string"))).alias("metadata")))
    p = v.select("conv_id", "turn", F.from_json(line, TRAINING_SAMPLE_SCHEMA).alias("r"))
    return p.select("conv_id", "turn", "r.instruction", "r.input", F.length("r.output").alias("output_chars"),
                    F.col("r.metadata").getItem("project").alias("project"))


@query("prompt_length_budget", "O-61", duck_with("instruction_samples") + D_INST + f"""
, d as (select * from inst_rows qualify row_number() over (partition by output_key order by src_pos) = 1),
p as (select src_pos, case when length(input) > 0
  then '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Input:' || chr(10) || input || chr(10) || chr(10) || '### Response:' || chr(10) || output
  else '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Response:' || chr(10) || output end as text from d),
t as (select src_pos, len(regexp_extract_all(text, {D.lit(TV.TOKEN)})) as n_tokens from p)
select src_pos, n_tokens, n_tokens > 1024 as truncated_1024, n_tokens > 2048 as truncated_2048,
  n_tokens > 4096 as truncated_4096, least(n_tokens, 1024) as kept_1024, least(n_tokens, 2048) as kept_2048, least(n_tokens, 4096) as kept_4096 from t""")
def q_prompt_length(spark, sf_dir):
    """The trainers' view: instruction prompts measured against the 1024/2048/4096 budgets."""
    prompts = C.format_prompt(instruction_branch(inst_view(spark, sf_dir)))
    return TV.length_budget(prompts).select("src_pos", "n_tokens", *[f"{c}_{b}" for c in ("truncated", "kept") for b in TV.BUDGETS])
