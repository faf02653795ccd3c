"""Trap H (function pattern), D (decoding), object and DataTable references, project scan."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import one
from glean.functions import rules as R
from glean.operators import scripts as SC


def fn(spark, code):
    return [r.asDict() for r in one(spark, SC.functions_of(F.col("x")), code)]


def test_call_after_unconsumed_end_sub(spark):
    got = fn(spark, "Sub B\n  x = 1\nEnd Sub\nFoo(1)\nEnd Sub")
    assert got == [{"name": "Foo", "parameters": "1", "body": "", "full_code": "Sub\nFoo(1)\nEnd Sub"}]


def test_function_closed_by_end_sub_and_case(spark):
    got = fn(spark, "Function F(a)\n y\nEnd Sub\nPUBLIC FUNCTION g( x )\nEND FUNCTION")
    assert [(g["name"], g["parameters"], g["body"]) for g in got] == [("F", "a", "y"), ("g", "x", "")]


def test_no_parameter_list_is_not_a_function(spark):
    assert fn(spark, "Sub Main\n x\nEnd Sub") == []


def test_object_and_datatable_refs(spark):
    code = 'Browser("b").Page("p").WebEdit("e").Set 1\nbrowser("b")\nBrowser( "b" )'
    assert one(spark, SC.object_refs_of(F.col("x")), code) == ['Browser("b")', 'Page("p")', 'WebEdit("e")', 'browser("b")']
    code = 'DataTable("col1", dtGlobalSheet) DataTable.Value("col2") datatable("col1") DataTable("c3", "Sheet1")'
    assert one(spark, SC.datatable_refs_of(F.col("x")), code) == ["c3", "col1", "col2"]
    assert one(spark, SC.checkpoints_of(F.col("x")), 'B.Check(Checkpoint("cp1"))') == ["cp1"]


def test_paths(spark):
    assert one(spark, SC.file_stem(F.col("x")), "/a/b/lib.tar.qfl") == "lib.tar"
    assert one(spark, SC.file_stem(F.col("x")), "/a/.hidden") == ".hidden"
    assert one(spark, SC.ancestors(F.col("x")), "/w/p/Action1/Script.mts") == ["/w", "/w/p", "/w/p/Action1"]
    assert one(spark, SC.script_kind(F.col("x")), "/a/data.xlsx") == "data_table"
    assert one(spark, SC.script_kind(F.col("x")), "/a/SCRIPT.MTS") == "other"


def write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_decode_ladder_and_project_scan(spark, tmp):
    from glean.operators.projects import extract_projects
    from glean.sources.files import marker_files, scan_project_files

    body = "Public Function DoLogin(user, pass)\r\n  Browser(\"B\").Page(\"P\").WebEdit(\"u\").Set user\r\nEnd Function\r\n"
    write(f"{tmp}/proj/Test.tsp", b"")
    pad = "' a comment line that makes the action longer than one hundred characters\n"
    write(f"{tmp}/proj/Action1/Script.mts", (body + pad).encode("utf-8"))
    write(f"{tmp}/proj/lib.qfl", body.encode("utf-16"))                       # BOM
    write(f"{tmp}/proj/quotes.vbs", "' “quoted”\n".encode("cp1252") + body.encode("cp1252"))
    write(f"{tmp}/proj/odd.vbs", b"\x81 raw " + body.encode("latin-1"))        # 0x81 undefined in cp1252
    write(f"{tmp}/proj/empty.mts", b"")
    write(f"{tmp}/proj/data.xlsx", b"PK")
    write(f"{tmp}/loose/Action9/Script.mts", body.encode("utf-8"))             # standalone project
    write(f"{tmp}/emptyproj/Test.tsp", b"marker")                              # no scripts: dropped
    write(f"{tmp}/emptyproj/sheet.xls", b"data")
    files = scan_project_files(spark, tmp)
    got = {os.path.relpath(r["path"], tmp): r["code"] for r in files.collect()}
    norm = body.replace("\r\n", "\n")
    assert got["proj/Action1/Script.mts"] == norm + pad
    assert got["proj/lib.qfl"] == norm
    assert got["proj/quotes.vbs"] == "' “quoted”\n" + norm
    assert got["proj/odd.vbs"] == "\x81 raw " + norm
    assert "proj/empty.mts" not in got          # zero-length files yield no row (blank: nothing to extract)
    assert got["proj/data.xlsx"] is None
    markers = marker_files(spark, tmp)
    assert markers.count() == 2
    samples = extract_projects(files.filter(F.col("kind") != "project_marker"), markers)
    rows = samples.collect()
    assert {r["project_name"] for r in rows} == {"proj", "loose"}
    from glean.operators.projects import projects
    kept = {r["project"].rsplit("/", 1)[-1] for r in projects(files, markers).collect()}
    assert kept == {"proj", "loose"}                                           # emptyproj has no action or library
    cats = sorted(r["category"] for r in rows if r["project_name"] == "proj")
    assert cats == ["full_action", "function", "library_function", "library_function", "library_function"]


def test_strict_function_pattern(spark):
    code = "Sub B\n  x = 1\nEnd Sub\nFoo(1)\nEnd Sub\nFunction Real(a)\n y\nEnd Function"
    loose = [f["name"] for f in one(spark, SC.functions_of(F.col("x")), code)]
    strict = [f["name"] for f in one(spark, SC.functions_of(F.col("x"), strict=True), code)]
    assert loose == ["Foo", "Real"] and strict == ["Real"]


def test_dataframe_forms(spark):
    df = spark.createDataFrame([(1, "/p/Action1/Script.mts", 'Function F(a)\n Browser("b").Sync\nEnd Function\n'
                                 'Reporter.ReportEvent micPass, "s", "d"')], "id int, path string, code string")
    assert [r["name"] for r in SC.extract_functions(df).collect()] == ["F"]
    assert SC.extract_object_refs(df).first()["object_refs"] == ['Browser("b")']
    assert [tuple(r[c] for c in ("status", "step", "detail")) for r in SC.extract_events(df).collect()] == [("micPass", "s", "d")]
    assert SC.name_from_path(df, kind="action").first()["name"] == "Action1"
    assert SC.name_from_path(df, kind="library").first()["name"] == "Script"


def test_object_repository_files(spark, tmp):
    from glean.sources.files import scan_object_repositories
    write(f"{tmp}/p/Test.tsp", b"m")
    write(f"{tmp}/p/a.tsr", b'<?xml version="1.0"?><Repo><Browser Name="Shop" micclass="Browser">'
                            b'<Page Name="Cart"/><WebButton Name="Buy &amp; go"/></Browser></Repo>')
    write(f"{tmp}/p/b.tsr", b"\x00\x01WebButton Buy &amp; go\x00\x02xx\x03PageCart\x00LoginPage\x00zzzz")
    write(f"{tmp}/p/c.tsr", b'<Repo><WinEdit Name="broken"></Repo>')         # malformed XML: read as binary
    projects = spark.createDataFrame([(f"{tmp}/p",)], "project string")
    got = {r["entry_name"]: (r["entry_type"], r["raw"]) for r in scan_object_repositories(spark, tmp, projects).collect()}
    assert got["Shop"] == ("Browser", False)
    assert got["Buy & go"] == ("WebButton", False)
    assert got["LoginPage"] == ("extracted", True)          # binary run mentioning "page"
    assert got["WebButton Buy &amp; go"] == ("extracted", True)
    assert "zzzz" not in got
    assert got['<Repo><WinEdit Name="broken"></Repo>'] == ("extracted", True)   # the whole printable run ("edit")
    assert "broken" not in got


def test_functions_equal_the_plain_pattern(spark):
    """The guarded search against one over the whole text, on random mixtures of its parts."""
    rnd = random.Random(5)
    parts = ["Function ", "Sub ", "Public Sub ", "private  Function\n", "a", "Foo", "(", ")", "(x, y)", "End Sub", "End\n Function", "End If", "\n", " ", "\ue005", "\ue003a", "'c'", "EndSub"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 60))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, code string")
    strict = FUNCTION_STRICT_PY
    hits = 0
    for r in df.select("i", "code", SC.functions_of(F.col("code")).alias("f"), SC.functions_of(F.col("code"), strict=True).alias("s")).collect():
        want = [(m.group(1), m.group(2).strip(), m.group(3).strip(), m.group(0)) for m in re.finditer(R.FUNCTION_PATTERN, r["code"], re.I | re.S)]
        assert [tuple(x) for x in r["f"]] == want
        assert [x["full_code"] for x in r["s"]] == [m.group(0) for m in re.finditer(strict, r["code"], re.I | re.S)]
        hits += len(want)
    assert hits > 200


FUNCTION_STRICT_PY = r"(?<![\w])(?<!End\s)(?<!End\s\s)" + R.FUNCTION_PATTERN.replace(r"End\s+(?:Function|Sub)", r"(?<![\w])End\s+(?:Function|Sub)(?![\w])")


@pytest.mark.parametrize("piece, end, n", [("Sub a(b)\n", "", 0), ("Sub a(", "", 0), ("Sub a(", " End Sub", 0), ("Sub a(x) ", " End Sub", 1), ("Sub ", "a() End Sub", 1),
                                           ("Sub a(x) End If ", "", 0), ("Function f(a) x End Function ", "", 34482), ("Sub a( End Sub ", " ) Sub b( ", 0)])
def test_a_megabyte_of_openers(spark, piece, end, n):
    code = piece * (1_000_000 // len(piece)) + end
    began = time.time()
    got = spark.createDataFrame([(code,)], "x string").select(F.size(SC.functions_of(F.col("x")))).first()[0]
    assert got == n and time.time() - began < 30


def test_xml_repositories_by_a_parser(spark):
    """Comments, CDATA, references, quotes, encodings, namespaces, duplicates: as a tree of the standard library has them."""
    import xml.etree.ElementTree as ET

    good = ['<R Name="r"><a Name="x" t="1 &lt; 2 &#65;&#x42;"/><!-- <b Name="no"/> --><![CDATA[<c Name="no"/>]]></R>',
            "<R><a Name='it&apos;s \"q\"' w = 'x>y'/><b\n Name='multi\nline'/></R>",
            '<R xmlns="urn:u" xmlns:p="urn:p"><p:a Name="n" p:k="v"/></R>', "<R/>",
            '<?xml version="1.0"?><!DOCTYPE R [<!ENTITY e "entity">]><R><a Name="&e;"/><a Name="same"/><b Name="same" z="2"/></R>']
    bad = ["<R><a Name='x'></R>", "<R Name='x' Name='y'/>", "plain", "", "<R Name='&nope;'/>", "<R Name='x'/>junk"]
    docs = [x.encode("utf-8") for x in good + bad] + ['<?xml version="1.0" encoding="UTF-16"?><R><a Name="é"/></R>'.encode("utf-16"),
                                                      '<?xml version="1.0" encoding="ISO-8859-1"?><R><a Name="é"/></R>'.encode("latin-1"), b"\x00\x01Button"]
    df = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(docs)], "file_order int, content binary")
    got = {}
    for r in SC.parse_repositories(df, "content", ("file_order",)).collect():
        got.setdefault(r["file_order"], []).append((r["pos"], r["entry_name"], r["entry_type"], None if r["raw"] else [tuple(p) for p in r["properties"]]))
    for i, d in enumerate(docs):
        try:
            named = [e for e in ET.fromstring(d).iter() if "Name" in e.attrib]
            want = [(k, e.attrib["Name"], e.tag, list(e.attrib.items())) for k, e in enumerate(named)]
        except ET.ParseError:
            want = [(-1, None, None, None)]
        assert sorted(got.get(i, []), key=lambda x: x[0]) == want
    assert sum(v[0][0] == -1 for v in got.values()) == 7


def test_object_attributes_reach_the_merge(spark, tmp):
    from glean.sources.files import scan_object_repositories
    write(f"{tmp}/p/a.tsr", b'<R><a Name="x" v="old"/><a Name="y" v="1 &amp; 2"/></R>')
    write(f"{tmp}/p/b.tsr", b'<R><b Name="x" v="new"/></R>')
    projects = spark.createDataFrame([(f"{tmp}/p",), (f"{tmp}/none",)], "project string")
    got = {r["entry_name"]: (r["entry_type"], [tuple(p) for p in r["properties"]]) for r in scan_object_repositories(spark, tmp, projects).collect()}
    assert got == {"x": ("b", [("Name", "x"), ("v", "new")]), "y": ("a", [("Name", "y"), ("v", "1 & 2")])}


def test_markers_are_listed_on_executors(spark, tmp):
    from glean.sources.files import _hadoop_markers, list_tree, marker_files
    want = set()
    for k in range(40):
        folder = f"{tmp}/r/" + "/".join(f"d {(k >> j) & 1}" for j in range(k % 6))
        os.makedirs(folder, exist_ok=True)
        write(f"{folder}/m{k}.tsp", b"" if k % 2 else b"x")  # half of them empty
        write(f"{folder}/ü {k}.txt", b"")
        want.add(os.path.normpath(f"{folder}/m{k}.tsp"))
    os.makedirs(f"{tmp}/r/nothing/here")
    for root in (f"{tmp}/r", f"file://{tmp}/r/"):
        got = [r["path"] for r in marker_files(spark, root).collect()]
        assert len(got) == 40 and {os.path.normpath(p) for p in got} == want
    assert {r["path"] for r in _hadoop_markers(spark, f"{tmp}/r", ".tsp").collect()} == want
    assert list_tree(spark, f"{tmp}/r").count() == 80
    with pytest.raises(RuntimeError):
        list_tree(spark, f"{tmp}/r", most_levels=2)


def test_decode_utf8_ignore(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xff\xfe caf\xc3\xa9 \xe2\x82"),)], "b binary")
    got = df.select(SC.decode_utf8_ignore(F.col("b"))).first()[0]
    assert got == b"ok \xff\xfe caf\xc3\xa9 \xe2\x82".decode("utf-8", errors="ignore")
