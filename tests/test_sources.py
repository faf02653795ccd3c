"""Trap G (JSON), missing folders, sinks."""

import json
import os

from pyspark.sql import functions as F

from glean.sources import jsonl as J
from glean.sources.sinks import run_id, write_jsonl


def test_jsonl_defaults_corrupt_and_types(spark, tmp):
    os.makedirs(f"{tmp}/raw/github")
    lines = [
        json.dumps({"code": "Dim x\nSet y = Browser(\"b\")" + " " * 60, "language": "vbscript", "description": "d",
                    "stars": 7}),
        json.dumps({"code": "only code, keys missing"}),
        json.dumps({"code": "null description", "description": None}),
        json.dumps({"code": "wrong stars", "stars": "oops"}),
        "",
        '{"code": "trunc',
    ]
    with open(f"{tmp}/raw/github/a.jsonl", "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = J.read_jsonl(spark, f"{tmp}/raw/github", J.CODE_SAMPLE_SCHEMA)
    assert J.quarantine(raw).count() == 1
    df = J.read_code_samples(spark, f"{tmp}/raw")
    rows = {r["code"]: r for r in df.collect()}
    assert len(rows) == 4
    assert rows["wrong stars"]["stars"] is None
    assert rows[json.loads(lines[0])["code"]]["stars"] == 7
    from glean.plans.branches import apply_code_defaults
    d = {r["code"]: r for r in apply_code_defaults(df).collect()}
    assert d["only code, keys missing"]["language"] == "vbscript"
    assert d["null description"]["description"] == ""
    # positions follow line order within the file
    pos = [r["src_pos"] for r in df.orderBy("src_pos").collect()]
    assert pos == sorted(pos) and len(set(pos)) == 4


def test_missing_folder_is_typed_empty(spark, tmp):
    df = J.read_code_samples(spark, f"{tmp}/nothing")
    assert df.count() == 0
    assert "code" in df.columns and "src_pos" in df.columns


def test_instruction_glob(spark, tmp):
    os.makedirs(f"{tmp}/raw/your_scripts")
    with open(f"{tmp}/raw/your_scripts/uft_training_samples_1.jsonl", "w") as f:
        f.write(json.dumps({"instruction": "i", "input": "", "output": "o", "metadata": {"project": "p"}}) + "\n")
    with open(f"{tmp}/raw/your_scripts/projects.jsonl", "w") as f:
        f.write(json.dumps({"instruction": "skip", "output": "o"}) + "\n")
    df = J.read_instruction_samples(spark, f"{tmp}/raw")
    assert [r["instruction"] for r in df.collect()] == ["i"]


def test_sink_roundtrip_and_guards(spark, tmp):
    df = spark.createDataFrame([("Écris", "", "sortie ü")], "instruction string, input string, output string")
    assert write_jsonl(df, f"{tmp}/out", run_ts="2024-05-06T07:08:09")
    back = spark.read.json(f"{tmp}/out")
    assert back.first()["run_id"] == "20240506_070809" == run_id("2024-05-06T07:08:09")
    text = open([os.path.join(dp, f) for dp, _, fs in os.walk(f"{tmp}/out") for f in fs if f.endswith(".json")][0],
                encoding="utf-8").read()
    assert "Écris" in text and '"input":""' in text
    assert not write_jsonl(df.filter(F.lit(False)), f"{tmp}/empty")
    assert not os.path.exists(f"{tmp}/empty")
    corpus = J.read_corpus(spark, f"{tmp}/out", f"{tmp}/no_val")
    assert corpus.count() == 1


def test_line_status(spark):
    df = spark.createDataFrame([("{\"k\": 1}",), ("{\"k\"",), ("",), ("  ",), ("42",)], "line string")
    got = [r[0] for r in df.select(J.line_status(F.col("line"))).collect()]
    assert got == ["ok", "malformed", "blank", "blank", "malformed"]


def test_an_empty_result_keeps_what_was_there(spark, tmp):
    df = spark.createDataFrame([("a",)], "output string")
    assert write_jsonl(df, f"{tmp}/out") and not write_jsonl(df.limit(0), f"{tmp}/out")
    assert [r["output"] for r in spark.read.json(f"{tmp}/out").collect()] == ["a"]
    assert write_jsonl(df.withColumn("output", F.lit("b")), f"{tmp}/out")
    assert [r["output"] for r in spark.read.json(f"{tmp}/out").collect()] == ["b"]
    assert os.listdir(tmp) == ["out"]


def test_writing_computes_the_result_once(spark, tmp):
    """Rows, metrics and the empty guard come from one pass over the input."""
    from glean.sources.sinks import write_once

    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).mapInPandas(look, "id long")
    got = write_once(df, f"{tmp}/out", even=F.count_if(F.col("id") % 2 == 0))
    assert got == {"n": 1000, "even": 500} and seen.value == 1000
