"""End to end on files: project scan -> training samples -> corpus build, as the
reference's batch flow runs them (scrape/scan, then process)."""

import json
import os

from glean.__main__ import main as cli
from glean.plans.jobs import build_corpus_job, extract_projects_job
from glean.sources.jsonl import read_corpus


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


VB = ("Dim ie\nSet ie = Browser(\"Login\")\nIf ie.Exist Then\n  ie.WebEdit(\"user\").Set \"me\"\n"
      "  ie.WebButton(\"Sign in\").Click\nEnd If\n")
PROJ = ("Public Function DoLogin(user, pass)\n  Browser(\"B\").Page(\"P\").WebEdit(\"u\").Set user\n"
        "  Browser(\"B\").Page(\"P\").WebButton(\"Go\").Click\nEnd Function\n")


def test_scan_then_build(spark, tmp):
    write(f"{tmp}/scan/projA/Test.tsp", "marker")
    write(f"{tmp}/scan/projA/Action1/Script.mts", PROJ + "' padding to pass one hundred characters in the action\n")
    seen = extract_projects_job(spark, f"{tmp}/scan", f"{tmp}/raw/your_scripts", run_ts="2024-01-02T03:04:05")
    assert seen == {"written": 2, "samples_by_category": {"full_action": 1, "function": 1}}
    samples = spark.read.json(f"{tmp}/raw/your_scripts/uft_training_samples")
    assert {r["category"] for r in samples.collect()} == {"full_action", "function"}
    write(f"{tmp}/raw/github/github_samples_1.jsonl", "\n".join([
        json.dumps({"code": VB, "language": "vbscript", "description": "login page"}),
        json.dumps({"code": VB + "\n\n\n", "language": "vbscript", "description": "same code again"}),
        json.dumps({"code": "x = 1", "language": "vbscript"}),
        "{broken"]) + "\n")
    write(f"{tmp}/raw/stackoverflow/qa_1.jsonl", json.dumps({
        "title": "Write a loop?", "question": "how", "tags": ["vbscript"],
        "code_blocks": ["short", VB.replace("Dim ie", "Dim browser")]}) + "\n")
    counts = build_corpus_job(spark, f"{tmp}/raw", f"{tmp}/out")
    # github: 1 kept (copy and short one dropped); Q&A: 1; project samples: 2 -> 4 rows, plus augmentation
    assert counts["training_data"] == counts["train"] + counts["val"]
    assert counts["low_volume"] is True          # fewer than 1000 examples
    rows = spark.read.json(counts["paths"]["training_data"]).collect()
    outputs = {r["output"] for r in rows}
    assert len(outputs) == 4
    assert any(r["instruction"].startswith("Create") for r in rows) or not any(
        "Write" in r["instruction"] for r in rows)
    corpus = read_corpus(spark, counts["paths"]["train"], counts["paths"]["val"])
    assert corpus.count() == counts["training_data"]


def test_cli_build(spark, tmp, capsys):
    write(f"{tmp}/raw/github/a.jsonl", json.dumps({"code": VB, "language": "vbscript"}) + "\n")
    cli(["build", "--raw-dir", f"{tmp}/raw", "--output-dir", f"{tmp}/out"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["training_data"] >= 1


def test_snapshots_of_two_runs_stay(spark, tmp):
    write(f"{tmp}/scan/projA/Test.tsp", "marker")
    write(f"{tmp}/scan/projA/Action1/Script.mts", PROJ + "' padding to pass one hundred characters in the action\n")
    for ts in ("2024-01-02T03:04:05", "2024-02-03T04:05:06"):
        assert extract_projects_job(spark, f"{tmp}/scan", f"{tmp}/raw/your_scripts", run_ts=ts)["written"]
    runs = {r["run_id"] for r in spark.read.json(f"{tmp}/raw/your_scripts/uft_training_samples").collect()}
    assert runs == {"20240102_030405", "20240203_040506"}


def test_session_keeps_the_clusters_settings(spark):
    from glean.session import get_session

    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    again = get_session("other")
    assert (again.sparkContext.master, again.conf.get("spark.sql.shuffle.partitions")) == before
