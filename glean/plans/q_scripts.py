"""Queries over script files, project markers and object-repository entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.operators import projects as P
from glean.operators import records as RC
from glean.operators import scripts as SC
from glean.operators.stats import count_by
from glean.plans import duck as D
from glean.plans.registry import query
from glean.plans.tables import spread_table
from glean.plans.views import duck_with, view
from glean.session import save_table

# --- DuckDB twins of the script kernels -------------------------------------------

FN = R.FUNCTION_PATTERN
OBJ = R.OBJECT_PATTERN


def d_name(path):
    return f"regexp_extract({path}, '[^/]*$')"


def d_parent_name(path):
    return f"regexp_extract({path}, '([^/]*)/[^/]*$', 1)"


def d_parent_dir(path):
    return f"regexp_extract({path}, '^(.*)/[^/]*$', 1)"


def d_stem(path):
    return f"regexp_replace({d_name(path)}, '^(.+)\\.[^.]*$', '\\1')"


def d_kind(path):
    n = d_name(path)
    return (f"(case when ends_with({n}, '.mts') then 'action' when ends_with({n}, '.qfl') or ends_with({n}, '.vbs') "
            f"then 'library' when ends_with({n}, '.tsr') then 'object_repository' "
            f"when regexp_matches({n}, '\\.xls[^/]*$') then 'data_table' when ends_with({n}, '.tsp') "
            f"then 'project_marker' else 'other' end)")


def d_ancestors(path):
    parts = f"string_split({path}, '/')"
    return f"list_transform(range(2, len({parts})), lambda i: array_to_string(list_slice({parts}, 1, i), '/'))"


def d_functions(code):
    return (f"list_transform(regexp_extract_all(coalesce({code}, ''), {D.lit('(?is)' + FN)}, 0), lambda m: "
            f"{{'name': regexp_extract(m, {D.lit('(?is)' + FN)}, 1), "
            f"'parameters': {D.strip(f'regexp_extract(m, {D.lit(chr(40) + chr(63) + chr(105) + chr(115) + chr(41) + FN)}, 2)')}, "
            f"'body': {D.strip(f'regexp_extract(m, {D.lit(chr(40) + chr(63) + chr(105) + chr(115) + chr(41) + FN)}, 3)')}, "
            f"'full_code': m}})")


def d_object_refs(code):
    p = D.lit("(?i)" + OBJ)
    return (f"list_sort(list_distinct(list_transform(regexp_extract_all(coalesce({code}, ''), {p}, 0), "
            f"lambda m: regexp_extract(m, {p}, 1) || '(\"' || regexp_extract(m, {p}, 2) || '\")')))")


def d_group_refs(code, pattern):
    return f"list_sort(list_distinct(regexp_extract_all(coalesce({code}, ''), {D.lit('(?i)' + pattern)}, 1)))"


D_COMP = f""", comp as (select s.file_id, s.path, s.code, {d_kind('s.path')} as kind,
  {d_parent_name('s.path')} as action_name, {d_stem('s.path')} as library_name,
  length({D.strip("coalesce(s.code, '')")}) > 0 as non_blank,
  {d_functions('s.code')} as functions, {d_object_refs('s.code')} as object_refs from scripts s),
roots as (select distinct {d_parent_dir('path')} as project from project_markers
  union select distinct {d_parent_dir(d_parent_dir('path'))} from scripts where {d_name('path')} = 'Script.mts'),
member as (select a.project, a.file_id from (select file_id, unnest({d_ancestors('path')}) as project from scripts) a
  join roots using (project)),
pc as (select m.project, c.* from member m join comp c using (file_id)),
stats as (select project,
  count(*) filter (where kind = 'action' and non_blank) as n_actions,
  count(*) filter (where kind = 'library' and non_blank) as n_libraries,
  coalesce(sum(case when kind in ('action', 'library') and non_blank then len(functions) else 0 end), 0)::bigint as n_functions,
  count(*) filter (where kind = 'data_table') as n_data_tables
  from pc group by project),
valid as (select * from stats where n_actions + n_libraries > 0),
vpc as (select * from pc where project in (select project from valid))
"""

D_SAMPLES = D_COMP + f""", vpc2 as (select *, regexp_extract(project, '[^/]*$') as project_name from vpc),
samples as (
  select project, project_name, file_id, -1 as fn_pos, 'full_action' as category, 'uft_project' as source,
    'Write a UFT VBScript action that performs automation tasks' as instruction,
    'Action name: ' || action_name || '. Objects used: ' || array_to_string(list_slice(object_refs, 1, {R.OBJECTS_IN_INPUT}), ', ') as input,
    code as output, 'project' as meta_group, project_name as meta_group_name, 'action' as meta_item_key, action_name as meta_item
  from vpc2 where kind = 'action' and non_blank and length(code) > {R.ACTION_MIN_CHARS}
  union all
  select project, project_name, file_id, f.i - 1, 'function', 'uft_project',
    'Write a VBScript function to ' || {D.purpose_of('f.fn.name')},
    'Function name: ' || f.fn.name || ', Parameters: ' || f.fn.parameters, f.fn.full_code,
    'project', project_name, 'function', f.fn.name
  from (select *, unnest(list_transform(functions, lambda x, i: {{'i': i, 'fn': x}})) as f from vpc2 where kind = 'action' and non_blank)
  where length(f.fn.full_code) > {R.FUNCTION_MIN_CHARS}
  union all
  select project, project_name, file_id, f.i - 1, 'library_function', 'uft_library',
    'Write a reusable VBScript function to ' || {D.purpose_of('f.fn.name')},
    'Function: ' || f.fn.name || '(' || f.fn.parameters || ')', f.fn.full_code,
    'library', library_name, 'function', f.fn.name
  from (select *, unnest(list_transform(functions, lambda x, i: {{'i': i, 'fn': x}})) as f from vpc2 where kind = 'library' and non_blank)
  where length(f.fn.full_code) > {R.FUNCTION_MIN_CHARS})
"""

W = duck_with("scripts", "project_markers")
WS_ = duck_with("scripts")


def scripts_view(spark, sf_dir):
    return view(spark, sf_dir, "scripts")


def markers_view(spark, sf_dir):
    return view(spark, sf_dir, "project_markers")


def components(spark, sf_dir):
    files = scripts_view(spark, sf_dir)
    markers = markers_view(spark, sf_dir)
    roots = P.marker_roots(markers).unionByName(P.script_mts_roots(files)).distinct()
    return P.assign_projects(files, roots).join(SC.extract_components(files), "file_id")


# --- per-file operators ---------------------------------------------------------------

@query("script_kinds", "O-07", WS_ + f"select file_id, path, {d_kind('path')} as kind from scripts")
def q_kinds(spark, sf_dir):
    return scripts_view(spark, sf_dir).select("file_id", "path", SC.script_kind(F.col("path")).alias("kind"))


@query("script_names", "O-38", WS_ + f"""
select file_id, {d_parent_name('path')} as action_name, {d_stem('path')} as library_name from scripts""")
def q_names(spark, sf_dir):
    return scripts_view(spark, sf_dir).select("file_id", SC.parent_name(F.col("path")).alias("action_name"),
                                              SC.file_stem(F.col("path")).alias("library_name"))


@query("script_non_blank", "O-28", WS_ + f"""
select file_id, length({D.strip("coalesce(code, '')")}) > 0 as non_blank from scripts""")
def q_non_blank(spark, sf_dir):
    from glean.functions.text import py_strip
    return scripts_view(spark, sf_dir).select(
        "file_id", (F.length(py_strip(F.coalesce(F.col("code"), F.lit("")))) > 0).alias("non_blank"))


_FN_ROWS = f"""select file_id, f.i - 1 as fn_pos, f.fn.name as name, f.fn.parameters as parameters, f.fn.body as body,
  f.fn.full_code as full_code
from (select file_id, unnest(list_transform({d_functions('code')}, lambda x, i: {{'i': i, 'fn': x}})) as f from scripts)"""


def _fn_rows(spark, sf_dir):
    s = scripts_view(spark, sf_dir).select("file_id", F.posexplode(SC.functions_of(F.col("code"))).alias("fn_pos", "fn"))
    return s.select("file_id", "fn_pos", "fn.name", "fn.parameters", "fn.body", "fn.full_code")


@query("script_functions", "O-65", WS_ + _FN_ROWS)
def q_functions(spark, sf_dir):
    return _fn_rows(spark, sf_dir)


@query("script_function_purpose", "O-37", WS_ + f"select file_id, fn_pos, name, {D.purpose_of('name')} as purpose from ({_FN_ROWS})")
def q_purpose(spark, sf_dir):
    return _fn_rows(spark, sf_dir).select("file_id", "fn_pos", "name", R.purpose_of(F.col("name")).alias("purpose"))


@query("script_min_size", "O-27", WS_ + f"""
select file_id, fn_pos, length(full_code) as n_chars, length(full_code) > {R.FUNCTION_MIN_CHARS} as long_enough from ({_FN_ROWS})""")
def q_min_size(spark, sf_dir):
    f = _fn_rows(spark, sf_dir)
    return f.select("file_id", "fn_pos", F.length("full_code").alias("n_chars"),
                    (F.length("full_code") > R.FUNCTION_MIN_CHARS).alias("long_enough"))


@query("script_object_refs", "O-66", WS_ + f"select file_id, unnest({d_object_refs('code')}) as ref from scripts")
def q_object_refs(spark, sf_dir):
    return scripts_view(spark, sf_dir).select("file_id", F.explode(SC.object_refs_of(F.col("code"))).alias("ref"))


@query("script_datatable_refs", "O-67", WS_ + f"select file_id, unnest({d_group_refs('code', R.DATATABLE_PATTERN)}) as ref from scripts")
def q_datatable_refs(spark, sf_dir):
    return scripts_view(spark, sf_dir).select("file_id", F.explode(SC.datatable_refs_of(F.col("code"))).alias("ref"))


@query("script_checkpoints", "O-68", WS_ + f"select file_id, unnest({d_group_refs('code', R.CHECKPOINT_PATTERN)}) as ref from scripts")
def q_checkpoints(spark, sf_dir):
    return scripts_view(spark, sf_dir).select("file_id", F.explode(SC.checkpoints_of(F.col("code"))).alias("ref"))


_REP = D.lit("(?i)" + R.REPORTER_PATTERN)


@query("script_report_events", "O-69", WS_ + f"""
select file_id, e.i - 1 as ev_pos, regexp_extract(e.m, {_REP}, 1) as status, regexp_extract(e.m, {_REP}, 2) as step,
  regexp_extract(e.m, {_REP}, 3) as detail
from (select file_id, unnest(list_transform(regexp_extract_all(coalesce(code, ''), {_REP}, 0), lambda m, i: {{'i': i, 'm': m}})) as e from scripts)""")
def q_report_events(spark, sf_dir):
    s = scripts_view(spark, sf_dir).select("file_id", F.posexplode(SC.report_events_of(F.col("code"))).alias("ev_pos", "ev"))
    return s.select("file_id", "ev_pos", "ev.status", "ev.step", "ev.detail")


@query("library_function_count", "O-49", WS_ + f"""
select file_id, {d_stem('path')} as library_name, len({d_functions('code')}) as function_count
from scripts where {d_kind('path')} = 'library' and length({D.strip("coalesce(code, '')")}) > 0""")
def q_function_count(spark, sf_dir):
    c = SC.extract_components(scripts_view(spark, sf_dir))
    c = c.filter((F.col("kind") == "library") & F.col("non_blank"))
    return c.select("file_id", "library_name", F.size("functions").alias("function_count"))


# --- projects ---------------------------------------------------------------------------

@query("project_membership", "O-45", W + D_COMP + "select project, file_id from member")
def q_membership(spark, sf_dir):
    files = scripts_view(spark, sf_dir)
    roots = P.marker_roots(markers_view(spark, sf_dir)).unionByName(P.script_mts_roots(files)).distinct()
    return P.assign_projects(files, roots).select("project", "file_id")


@query("project_standalone", "O-46", W + D_COMP + f"""
select distinct {d_parent_dir(d_parent_dir('path'))} as project from scripts where {d_name('path')} = 'Script.mts'
  and {d_parent_dir(d_parent_dir('path'))} not in (
    select {d_parent_dir('path')} from project_markers where {d_parent_dir('path')} in (select project from valid))""")
def q_standalone(spark, sf_dir):
    files, markers = scripts_view(spark, sf_dir), markers_view(spark, sf_dir)
    valid = P.project_stats(components(spark, sf_dir)).filter("valid")
    return P.standalone_projects(files, markers, valid)


@query("project_assembly", "O-47", W + D_COMP + "select project, n_actions, n_libraries, n_functions, n_data_tables from valid")
def q_assembly(spark, sf_dir):
    stats = P.project_stats(components(spark, sf_dir)).filter("valid")
    return stats.select("project", "n_actions", "n_libraries", "n_functions", "n_data_tables")


_SAMPLE_COLS = ("project, file_id, fn_pos, category, source, instruction, input, output, meta_group, "
                "meta_group_name, meta_item_key, meta_item")


@query("project_samples", "O-73", W + D_SAMPLES + f"select {_SAMPLE_COLS} from samples")
def q_samples(spark, sf_dir):
    files, markers = scripts_view(spark, sf_dir), markers_view(spark, sf_dir)
    return P.extract_projects(files, markers).select(*[c.strip() for c in _SAMPLE_COLS.split(",")])


@query("project_category_counts", "O-52", W + D_SAMPLES + "select category, count(*) as n from samples group by category")
def q_category_counts(spark, sf_dir):
    files, markers = scripts_view(spark, sf_dir), markers_view(spark, sf_dir)
    return count_by(P.extract_projects(files, markers), "category")


@query("project_extraction", "O-86", W + D_SAMPLES + """
select project_name, category, source, instruction, input, output, meta_group, meta_group_name, meta_item_key, meta_item,
  count(*) as n_copies from samples group by all""")
def q_extraction(spark, sf_dir):
    """Training-sample file contents: one row per distinct sample with the number of
    projects that produced it (nested projects produce a file's samples twice)."""
    files, markers = scripts_view(spark, sf_dir), markers_view(spark, sf_dir)
    s = P.extract_projects(files, markers)
    keys = ["project_name", "category", "source", "instruction", "input", "output", "meta_group",
            "meta_group_name", "meta_item_key", "meta_item"]
    return s.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_copies"))


# --- object repositories -------------------------------------------------------------------

WO = duck_with("object_entries")


@query("object_merge", "O-48", WO + """
select project, entry_name, entry_type, file_order from object_entries
qualify row_number() over (partition by project, entry_name order by file_order desc) = 1""")
def q_object_merge(spark, sf_dir):
    e = view(spark, sf_dir, "object_entries").select("project", "entry_name", "entry_type", "file_order",
                                                       F.lit(0).alias("pos"))
    return SC.merge_objects(e).select("project", "entry_name", "entry_type", "file_order")


@query("object_binary_strings", "O-76", WO + f"""
select project, file_order, r.i - 1 as pos, r.s as entry_name from (
  select project, file_order, unnest(list_transform(regexp_extract_all(raw_text, '[\\x20-\\x7e]{{4,}}', 0), lambda s, i: {{'i': i, 's': s}})) as r
  from object_entries) where {D.contains_any('lower(r.s)', R.OBJECT_STRING_KEYWORDS)}""")
def q_object_binary(spark, sf_dir):
    e = view(spark, sf_dir, "object_entries")
    return SC.object_entries_binary(e).select("project", "file_order", "pos", "entry_name")


#: Bytes put before a text so that the ladder goes on: valid in cp1252 only, and in ISO-8859-1 only, with what they decode to.
CP1252_BYTES, LATIN1_BYTES = "80938594999f", "81808d9d"
CP1252_TEXT, LATIN1_TEXT = bytes.fromhex(CP1252_BYTES).decode("cp1252"), bytes.fromhex(LATIN1_BYTES).decode("latin-1")

_D_PLAIN = "regexp_replace(text, '[^\\x{00}-\\x{7f}\\x{a0}-\\x{ff}]', '?', 'g')"


@query("decode_roundtrip", "O-08", f"""with d as (select doc_id, case doc_id % 4 when 0 then 'utf-8' when 1 then 'utf-16' when 2 then 'cp1252' else 'iso-8859-1' end as encoding,
  case when doc_id % 4 < 2 then text when doc_id % 4 = 2 then {D.chars(CP1252_TEXT)} || {_D_PLAIN} else {D.chars(LATIN1_TEXT)} || {_D_PLAIN} end as t from documents)
select doc_id, encoding, length(u) as n_chars, md5(u) as text_md5 from (select doc_id, encoding, regexp_replace(t, '\r\n?', chr(10), 'g') as u from d)""")
def q_decode_roundtrip(spark, sf_dir):
    """Documents encoded as UTF-8, UTF-16 (with BOM), cp1252 with bytes 80-9F, or bytes that only ISO-8859-1 has,
    then decoded by the ladder: the encoding found and the text, to be compared with the original."""
    d = spread_table(spark, sf_dir, "documents")
    plain = F.encode(F.regexp_replace("text", "[^\\x{0}-\\x{7f}\\x{a0}-\\x{ff}]", "?"), "ISO-8859-1")
    kind = F.col("doc_id") % 4
    enc = (F.when(kind == 0, F.encode("text", "UTF-8")).when(kind == 1, F.encode("text", "UTF-16"))
             .when(kind == 2, F.concat(F.unhex(F.lit(CP1252_BYTES)), plain)).otherwise(F.concat(F.unhex(F.lit(LATIN1_BYTES)), plain)))
    d = d.select("doc_id", enc.alias("content"))
    decoded = SC.decode_text(F.col("content"))
    return d.select("doc_id", SC.decoded_encoding(F.col("content")).alias("encoding"), F.length(decoded).alias("n_chars"), F.md5(decoded).alias("text_md5"))


# --- XML object repositories: one repository document per part row --------------------------

XML_DOC = """'<?xml version="1.0"?><ObjectRepository><Browser Name="B' || cast(p_size as {t}) || '" micclass="Browser">'
  || '<!-- <Gone Name="comment"/> --><Page Name="' || p_name || '" title="' || p_type || '"><![CDATA[<Gone Name="cdata"/>]]><WebEdit Name="' || p_brand || '" html_tag="INPUT" '
  || 'note="a &amp; b &#65;&#x42;"/></Page></Browser></ObjectRepository>'"""

D_XML_TAG = r"""<([A-Za-z_][\w.:-]*)((?:\s+[\w.:-]+\s*=\s*(?:"[^"]*"|'[^']*'))*)\s*/?>"""
D_XML_NAME = r"""\sName\s*=\s*(?:"([^"]*)"|'([^']*)')"""
D_XML_ATTR = r"""([\w.:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)')"""


def _d_xml(e):
    for k, v in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]:
        e = f"replace({e}, {D.lit(k)}, {D.lit(v)})"
    return f"replace(replace({e}, '&#65;', 'A'), '&#x42;', 'B')"


def _d_tags(e):
    """Start tags outside comments and CDATA sections."""
    return f"regexp_extract_all(regexp_replace({e}, {D.lit(r'(?s)<!--.*?-->|<!.CDATA.*?]]>')}, '', 'g'), {D.lit(D_XML_TAG)}, 0)"


@query("object_xml_entries", "O-75", f"""with docs as (select '/w/proj' || cast(p_partkey % 40 as varchar) as project, p_partkey as file_order,
    {XML_DOC.format(t='varchar')} as text from part),
tags as (select project, file_order, t.i - 1 as pos, t.s as tag_text from docs,
    unnest(list_transform({_d_tags('text')}, lambda s, i: {{'i': i, 's': s}})) as x(t)),
entries as (select project, file_order, pos, regexp_extract(tag_text, {D.lit(D_XML_TAG)}, 1) as entry_type,
    len(regexp_extract_all(tag_text, {D.lit(D_XML_ATTR)}, 0)) as n_props,
    array_to_string(list_transform(regexp_extract_all(tag_text, {D.lit(D_XML_ATTR)}, 0), lambda a: regexp_extract(a, {D.lit(D_XML_ATTR)}, 1) || '='
      || {_d_xml(f"regexp_extract(a, {D.lit(D_XML_ATTR)}, 2)")}), ';') as properties,
    {_d_xml(f"regexp_extract(tag_text, {D.lit(D_XML_NAME)}, 1) || regexp_extract(tag_text, {D.lit(D_XML_NAME)}, 2)")} as entry_name
  from tags where regexp_matches(tag_text, {D.lit(D_XML_NAME)}))
select project, entry_name, entry_type, file_order, n_props, properties from entries
qualify row_number() over (partition by project, entry_name order by file_order desc, pos desc) = 1""")
def q_object_xml(spark, sf_dir):
    part = spread_table(spark, sf_dir, "part")
    docs = part.select(F.concat(F.lit("/w/proj"), (F.col("p_partkey") % 40).cast("string")).alias("project"),
                       F.col("p_partkey").alias("file_order"),
                       F.expr(XML_DOC.format(t="string")).alias("text"))
    entries = SC.object_entries_xml(docs)
    merged = SC.merge_objects(entries)
    return merged.select("project", "entry_name", "entry_type", "file_order", F.size("properties").alias("n_props"),
                         F.array_join(F.transform("properties", lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";").alias("properties"))


@query("project_drop_empty", "O-29", W + D_COMP + "select project, n_actions + n_libraries > 0 as kept from stats")
def q_drop_empty(spark, sf_dir):
    stats = P.project_stats(components(spark, sf_dir))
    return stats.select("project", F.col("valid").alias("kept"))


# --- project records ------------------------------------------------------------------------

#: Chunks of records in the query: small, so that projects of the test tables have several.
RECORD_BYTES = 8 << 10

D_RECORDS = duck_with("scripts", "project_markers", "object_entries") + D_COMP + f""", parts as (
  select project, case when kind = 'action' then case when {d_name('path')} = 'Script.mts' then 0 else 1 end
      when kind = 'library' then case when ends_with(path, '.qfl') then 2 else 3 end else 5 end as rank,
    path as key, strlen(path) + strlen(coalesce(code, '')) as size, kind as section, path as file, code, functions, object_refs,
    case kind when 'action' then action_name when 'library' then library_name end as name
  from vpc where (kind in ('action', 'library') and non_blank) or kind = 'data_table'
  union all
  select project, 4, entry_name, strlen(entry_name) + strlen(entry_type), 'object', null, entry_type, null, null, entry_name
  from (select * from object_entries where project in (select project from valid)
    qualify row_number() over (partition by project, entry_name order by file_order desc) = 1)),
chunked as (select *, (sum(size) over (partition by project order by rank, key rows between unbounded preceding and current row) - size) // {RECORD_BYTES} as chunk from parts)
select project, chunk::bigint as chunk, section, row_number() over (partition by project, chunk, section order by rank, key) - 1 as pos, name, file,
  case when section <> 'data_table' then md5(code) end as code_md5,
  case when section in ('action', 'library') then array_to_string(list_transform(functions, lambda f: f.name || '(' || f.parameters || ')'), ';') end as functions,
  case when section = 'action' then array_to_string(object_refs, ';') end as refs
from chunked"""


@query("project_records", "O-10", D_RECORDS)
def q_records(spark, sf_dir):
    """The components of the nested project records, read back out of their chunks."""
    comp = SC.extract_components(scripts_view(spark, sf_dir))
    members = RC.valid_members(comp, markers_view(spark, sf_dir))
    entries = view(spark, sf_dir, "object_entries").select("project", "entry_name", "entry_type", "file_order", F.lit(0).alias("pos"), F.lit(False).alias("raw"))
    records = RC.project_records(comp, members, SC.merge_objects(entries), chunk_bytes=RECORD_BYTES)
    return RC.record_components(save_table(records, "records"))
