"""Fixture views: raw-input-shaped relations derived from the driver tables.

The driver tables hold prose, pages and conversations, not code. These views
reshape them into the inputs the corpus operators consume (code samples,
repository hits, questions, answers, instruction rows, script files, project
markers, object-repository entries, JSON lines) so that every operator has
rows to keep and rows to drop. Each view is one SQL text rendered for Spark
(``spark.sql`` with DataFrame arguments) and for DuckDB (the oracle).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from glean.plans.tables import spread_table

_PHRASES = ("(values (0,'click the button'), (1,'enter some text'), (2,'select from dropdown'), "
            "(3,'verify the element'), (4,'wait for element'), (5,'login now'), (6,'sign out'), "
            "(7,'table row'), (8,'screenshot'), (9,'file upload'), (10,'download it'), (11,'navigate'), "
            "(12,'iframe'), (13,'window'), (14,'alert'), (15,'drag and drop'), (16,'scroll'), "
            "(17,'hover'), (18,'right click'), (19,'double-click'), (20,'keyboard'), (21,'cookie'), "
            "(22,'excel'), (23,'sql'), (24,'api'), (25,'json'), (26,'xml'), (27,'regex'), "
            "(28,'error handling'), (29,'log it'), (30,'parallel'), (31,'data driven'), "
            "(32,'unit test'), (33,'my function'), (34,'')) as p(k, phrase)")

VIEWS = {
    # CodeSample-shaped rows; choices key on n_chars so exact copies stay copies.
    "code_samples": """
select d.doc_id, 'github' as source, d.source as repo_name,
  d.source || '/f' || cast(d.doc_id as string) || case d.n_chars % 5 when 0 then '.vbs' when 1 then '.PY' when 2 then '.java' when 3 then '.ts' else '.md' end as file_path,
  case d.n_chars % 5 when 0 then 'vbscript' when 1 then 'selenium_python' when 2 then 'selenium_java' when 3 then 'selenium_javascript' else 'other' end as language,
  case when d.n_chars % 3 = 0 then chr(39) || ' Copyright (c) ' || d.source || chr(10)
       when d.n_chars % 3 = 1 then '# copyright ' || d.source || chr(10) else '' end
   || case when d.n_chars % 4 = 0 then '' else 'driver ' end || p.phrase || '  ' || chr(10) || chr(10) || chr(10) || chr(10) || d.text || chr(9) || chr(10) as code,
  d.lang as description, coalesce(l.quality, 0) as stars
from {documents} d
join __PHRASES__ on d.n_chars % 35 = p.k
left join {labels} l on l.doc_id = d.doc_id
""".replace("__PHRASES__", _PHRASES),
    # Repository search hits: one repository found by several queries.
    "repo_hits": """
select cast(s_nationkey % 5 as bigint) as query_id, 'src' || cast(s_suppkey % 20 as string) as repo_name,
  s_suppkey % 37 as stars,
  case s_suppkey % 3 when 0 then 'Python' when 1 then 'Java' else 'JavaScript' end as language,
  s_name || ' automation' as description, 'https://git.example.com/src' || cast(s_suppkey % 20 as string) as url
from {supplier}
""",
    # Raw questions, one per user turn; tags_csv splits with split(tags_csv, ',').
    "questions": """
select conv_id * 1000000 + turn as question_id,
  'Q &amp; A ' || text || case when conv_id % 3 = 0 then '?' else '' end as title,
  case when conv_id % 9 = 0 then '' else '<p>' || text || '</p>' end as body,
  conv_id % 4 - 1 as score, conv_id % 3 as answer_count,
  case conv_id % 5 when 0 then 'vbscript,qtp' when 1 then 'python,selenium' when 2 then 'java' when 3 then 'javascript' else 'webdriver' end as tags_csv,
  case when conv_id % 6 = 0 then null else 'https://q.example.com/' || cast(conv_id as string) end as link
from {conversations} where role = 'user'
""",
    # Raw answers, each of the user turn before it: nested and tiny code blocks (whole texts), a comment, a
    # double-encoded entity, empty bodies.
    "answers": """
select conv_id * 1000000 + user_turn as question_id, turn as answer_pos, (length(text) % 6) - 1 as score,
  (length(text) + turn) % 5 = 0 as is_accepted,
  case when length(text) % 11 = 0 then ''
       else '<p>' || text || ' &amp;amp; more</p><!-- c --><pre><code>' || text || '</code></pre><code>x</code><code>' || text || '</code>' end as body
from (select *, max(case when role = 'user' then turn end) over (partition by conv_id order by turn) as user_turn
      from {conversations})
where role = 'assistant' and user_turn is not null
""",
    # Ready-made instruction rows with empty instructions and the word "Write".
    "instruction_samples": """
select u.conv_id, u.turn,
  case when length(u.text) % 7 = 0 then '' when length(u.text) % 2 = 0 then 'Write ' || u.text else u.text end as instruction,
  case when length(a.text) % 3 = 0 then '' else u.text end as input,
  a.text as output
from {conversations} u join {conversations} a on a.conv_id = u.conv_id and a.turn = u.turn + 1
where u.role = 'user' and a.role = 'assistant'
""",
    # Script files: actions, extra actions, libraries, data sheets, blank files.
    "scripts": """
select p_partkey as file_id,
  '/w/proj' || cast(p_partkey % 40 as string) || '/' || case when p_partkey % 8 < 4 then 'sub/' else '' end || 'Action' || cast(p_partkey as string) || '/'
   || case p_partkey % 7 when 0 then 'extra.mts' when 1 then 'lib.qfl' when 2 then 'util.vbs' when 3 then 'data.xlsx' else 'Script.mts' end as path,
  case when p_partkey % 13 = 0 then '  ' || chr(10) else
  'Public Function ' || case p_size % 6 when 0 then 'DoLogin' when 1 then 'VerifyRow' when 2 then 'GetCell' when 3 then 'CloseApp' when 4 then 'Zed' else 'SaveLog' end || cast(p_size as string) || '(a, b)' || chr(10)
   || '  Browser("B' || cast(p_size as string) || '").Page("' || p_name || '").WebEdit("' || p_type || '").Set DataTable("' || p_brand || '", dtGlobalSheet)' || chr(10)
   || '  Browser("B' || cast(p_size as string) || '").Check(Checkpoint("' || p_name || '"))' || chr(10)
   || '  Reporter.ReportEvent micPass, "' || p_name || '", "ok"' || chr(10) || 'End Function' || chr(10)
   || case when p_size % 2 = 0 then 'Sub S' || cast(p_size as string) || '()' || chr(10) || 'End Sub' || chr(10) else '' end end as code
from {part}
""",
    # Project marker files; some projects nest another, some scripts have none.
    "project_markers": """
select distinct '/w/proj' || cast(p_partkey % 40 as string) || '/Test.tsp' as path from {part} where p_partkey % 40 < 30
union
select distinct '/w/proj' || cast(p_partkey % 40 as string) || '/sub/Inner.tsp' as path from {part} where p_partkey % 8 < 2
""",
    # Object-repository entries: one key in many files (last wins), printable runs.
    "object_entries": """
select '/w/proj' || cast(p_partkey % 40 as string) as project, p_partkey as file_order, p_name || ' Button' as entry_name, p_type as entry_type,
  p_name || ' Button' || chr(1) || 'ab' || chr(2) || p_type || chr(3) || 'EditBox' || cast(p_size as string) as raw_text
from {part}
""",
    # Repository files: code samples where every sixth file imports Selenium,
    # so the file-content predicate has files to keep as well as to drop.
    "repo_files": """
select doc_id, repo_name, file_path, language,
  case when doc_id % 6 = 0 then 'from selenium import webdriver' || chr(10) else '' end || code as code
from {code_samples}
""",
    # JSON lines with malformed and blank ones.
    "raw_events": """
select event_id, event_type, case when event_id % 17 = 0 then substr(props, 1, 4) when event_id % 29 = 0 then '' else props end as line
from {events}
""",
}


def _tables_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a Spark DataFrame over the parquet tables in ``sf_dir``
    (a view may read another view)."""
    sql = VIEWS[name]
    args = {t: view(spark, sf_dir, t) if t in VIEWS else spread_table(spark, sf_dir, t) for t in _tables_in(sql)}
    return spark.sql(sql, **args)


def duck_view(name: str) -> str:
    """The same view as DuckDB SQL over the pre-registered table views."""
    sql = VIEWS[name]
    sql = re.sub(r"\{(\w+)\}", r"\1", sql)
    return sql.replace(" as string)", " as varchar)")


def duck_with(*names: str) -> str:
    """``WITH`` clause defining the named views (and the views they read) for a
    DuckDB oracle query."""
    order: list[str] = []

    def add(n):
        for dep in _tables_in(VIEWS[n]):
            if dep in VIEWS:
                add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "with " + ",\n".join(f"{n} as ({duck_view(n)})" for n in order) + "\n"
