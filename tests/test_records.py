"""Project records: chunks against plain prefix sums, a hot project, the job's files."""

import collections
import json
import os

from pyspark.sql import functions as F

from glean.operators import records as RC
from glean.operators import scripts as SC
from glean.plans.jobs import extract_projects_job


def files_frame(spark, rows):
    return SC.extract_components(spark.createDataFrame([(k, p, c) for k, (p, c) in enumerate(rows)], "file_id long, path string, code string"))


FN = "Function F{0}(a)\n  Browser(\"B\").Page(\"P\").Check 1\nEnd Function\n"
ROWS = [("/r/p/A2/Script.mts", FN.format(2)), ("/r/p/A1/Script.mts", FN.format(1)), ("/r/p/A1/more.mts", "x = DataTable(\"c\")"), ("/r/p/lib.vbs", FN.format(3)),
        ("/r/p/lib.qfl", "y"), ("/r/p/blank.vbs", " \n"), ("/r/p/t.xlsx", None), ("/r/p/in/Q/Script.mts", "z"), ("/r/none/notes.txt", "n"), ("/r/empty/t.xls", None)]


def test_records(spark):
    comp = files_frame(spark, ROWS)
    markers = spark.createDataFrame([("/r/p/T.tsp",), ("/r/empty/T.tsp",)], "path string")
    objects = spark.createDataFrame([("/r/p", "Save", "Button", [("Name", "Save")], False), ("/r/other", "No", "x", None, True)],
                                    "project string, entry_name string, entry_type string, properties array<struct<key:string,value:string>>, raw boolean")
    members = RC.valid_members(comp, markers)
    got = {(r["path"], r["chunk"]): r.asDict(recursive=True) for r in RC.project_records(comp, members, objects, "2024-01-02T00:00:00").collect()}
    assert set(got) == {("/r/p", 0), ("/r/p/in", 0)}  # the grandparent of a Script.mts is a project too
    p = got["/r/p", 0]
    assert [a["script_path"] for a in p["actions"]] == ["/r/p/A1/Script.mts", "/r/p/A2/Script.mts", "/r/p/in/Q/Script.mts", "/r/p/A1/more.mts"]
    assert (p["name"], p["collected_at"], p["recovery_scenarios"], p["data_tables"]) == ("p", "2024-01-02T00:00:00", [], ["/r/p/t.xlsx"])
    assert p["actions"][0]["functions"][0]["name"] == "F1" and p["actions"][0]["object_references"] == ['Browser("B")', 'Page("P")']
    assert p["actions"][3]["parameters"] == ["c"] and p["actions"][3]["name"] == "A1"
    assert [(x["name"], x["path"], x["function_count"]) for x in p["function_libraries"]] == [("lib", "/r/p/lib.qfl", 0), ("lib", "/r/p/lib.vbs", 1)]
    assert p["object_repository"] == [{"name": "Save", "type": "Button", "properties": [{"key": "Name", "value": "Save"}], "raw": False}]


def test_no_projects(spark):
    comp = files_frame(spark, ROWS).limit(0)
    markers = spark.createDataFrame([], "path string")
    assert RC.project_records(comp, RC.valid_members(comp, markers)).count() == 0


def test_a_hot_project_is_cut_into_bounded_chunks(spark):
    """100,000 actions of one project: every chunk within its bytes, no task with more than its share, all components back."""
    n, limit = 100_000, 1 << 18
    code = F.concat(F.lit("x = "), F.repeat(F.lit("y"), (F.col("id") % 90).cast("int")))
    files = spark.range(n, numPartitions=8).select(
        F.col("id").alias("file_id"), F.concat(F.lit("/r/"), F.when(F.col("id") % 50 == 0, "small").otherwise("big"), F.lit("/A"), F.lpad(F.col("id").cast("string"), 6, "0"),
                                              F.lit("/Script.mts")).alias("path"), code.alias("code"))
    comp = files.select("*", F.lit("action").alias("kind"), F.lit(True).alias("non_blank"), F.lit("A").alias("action_name"), F.lit("l").alias("library_name"),
                        F.array().cast(RC._FN).alias("functions"), F.array().cast("array<string>").alias("object_refs"), F.array().cast("array<string>").alias("datatable_refs"))
    members = RC.valid_members(comp, spark.createDataFrame([], "path string"))
    got = RC.project_records(comp, members, chunk_bytes=limit)
    size = F.aggregate("actions", F.lit(0), lambda s, a: s + F.octet_length(a["code"]) + F.octet_length(a["script_path"]))
    rows = got.select("path", "chunk", size.alias("bytes"), F.size("actions").alias("n"), F.col("actions")[0]["script_path"].alias("first")).collect()
    assert sum(r["n"] for r in rows) == n and max(r["bytes"] for r in rows) < limit + 200
    # Plain prefix sums give the same first action for each chunk.
    start, want = collections.Counter(), {}
    for i in range(n):
        p = "/r/small" if i % 50 == 0 else "/r/big"
        path = f"{p}/A{i:06d}/Script.mts"
        want.setdefault((p, start[p] // limit), path)
        start[p] += len(path) + 4 + i % 90
    assert {(r["path"], r["chunk"]): r["first"] for r in rows} == want and len(want) > 20


def test_job_writes_records_with_objects(spark, tmp):
    def write(path, text):
        os.makedirs(os.path.dirname(f"{tmp}/scan/{path}"), exist_ok=True)
        with open(f"{tmp}/scan/{path}", "w") as f:
            f.write(text)

    write("p/T.tsp", "")  # an empty marker
    write("p/A1/Script.mts", FN.format(1))
    write("p/A1/ObjectRepository.tsr", '<?xml version="1.0"?><R><Browser Name="B1" title="a &amp; b"><Edit Name="E" w="3"/></Browser></R>')
    write("p/lib.qfl", FN.format(2))
    seen = extract_projects_job(spark, f"{tmp}/scan", f"{tmp}/out", run_ts="2024-01-02T03:04:05")
    assert seen["samples_by_category"] == {"function": 1, "library_function": 1}
    lines = [json.loads(x) for d, _, fs in os.walk(f"{tmp}/out/projects/run_id=20240102_030405") for f in fs if f.endswith(".json") for x in open(f"{d}/{f}")]
    (record,) = [x for x in lines if x["name"] == "p"]
    assert [a["name"] for a in record["actions"]] == ["A1"] and record["function_libraries"][0]["function_count"] == 1
    assert {o["name"]: {p["key"]: p["value"] for p in o["properties"]} for o in record["object_repository"]} == {
        "B1": {"Name": "B1", "title": "a & b"}, "E": {"Name": "E", "w": "3"}}


def test_a_folder_above_every_file_is_not_sorted(spark):
    """Files meet the project folders by a hash of the folders; each file of a hot folder once."""
    rows = [(f"/r/hot/A{k}/Script.mts", FN.format(k)) for k in range(300)] + [("/r/cold/notes.txt", "n")]
    comp = files_frame(spark, rows)
    members = RC.valid_members(comp, spark.createDataFrame([("/r/hot/T.tsp",), ("/r/cold/T.tsp",)], "path string"))
    assert sorted((r["project"], r["file_id"]) for r in members.collect()) == [("/r/hot", k) for k in range(300)]
    roots = spark.createDataFrame([("/r",), ("/r/hot",)], "project string")
    for joined in (members, RC.assign_projects(comp, roots)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort" not in plan
