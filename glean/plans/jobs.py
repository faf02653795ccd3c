"""File-to-file jobs: the corpus build and the project scan, end to end.

``build_corpus_job`` reads the three raw JSON Lines sources under ``raw_dir``
(``github/*.jsonl``, ``stackoverflow/*.jsonl``, ``your_scripts/*training*.jsonl``),
runs the three branches, the cross-source first-wins dedup, augmentation and
the group split, and writes ``training_data/`` as JSON Lines in one pass,
partitioned by split (``split=train``, ``split=val``). ``extract_projects_job`` scans a folder tree for
project files and writes the training samples (JSON Lines, with metadata) and
the nested project records. Counts are observed while writing; no output is read back. ``run_ts`` is passed in (never ``now()``),
so reruns of a run write the same snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glean.operators import corpus as C
from glean.operators import projects as P
from glean.operators import records as RC
from glean.operators.scripts import extract_components
from glean.plans.branches import code_branch, instruction_branch, qa_branch
from glean.session import cut_lineage, save_table
from glean.sources import jsonl as J
from glean.sources.files import marker_files, scan_object_repositories, scan_project_files
from glean.sources.sinks import write_once, write_projects

EXAMPLE_COLUMNS = ["instruction", "input", "output"]
CATEGORIES = ("full_action", "function", "library_function")


def corpus_from_raw(spark: SparkSession, raw_dir: str, val_ratio: float = C.R.VAL_RATIO) -> DataFrame:
    code = code_branch(J.read_code_samples(spark, raw_dir), dedup=False)
    qa = qa_branch(J.read_qa(spark, raw_dir), dedup=False)
    inst = instruction_branch(J.read_instruction_samples(spark, raw_dir), dedup=False)
    deduped = C.dedup_corpus(C.union_sources(code, qa, inst))
    return C.split_corpus(C.augment(deduped), val_ratio, exact=True)


def build_corpus_job(spark: SparkSession, raw_dir: str, out_dir: str, val_ratio: float = C.R.VAL_RATIO) -> dict:
    """Write the corpus once, partitioned by split: ``training_data/`` holds every
    row, ``training_data/split=train`` and ``.../split=val`` are the two sides (int(n * val_ratio) of the n outputs validate).
    Returns paths and counts, observed while writing."""
    corpus = corpus_from_raw(spark, raw_dir, val_ratio)
    out = f"{out_dir.rstrip('/')}/training_data"
    val = F.count_if(F.col("split") == "val")
    seen = write_once(corpus.select(*EXAMPLE_COLUMNS, "split"), out, partition_by=["split"], val=val)
    counts = {"training_data": seen["n"], "train": seen["n"] - seen["val"], "val": seen["val"],
              "paths": {"training_data": out, "train": f"{out}/split=train", "val": f"{out}/split=val"}}
    if seen["n"]:
        counts["low_volume"] = seen["n"] < C.R.LOW_VOLUME
    return counts


def extract_projects_job(spark: SparkSession, scan_dir: str, out_dir: str, run_ts: str | None = None) -> dict:
    """Project files under ``scan_dir`` -> ``uft_training_samples`` (JSON Lines in the
    instruction-sample shape, read back by the corpus build) and ``projects`` (nested
    records). Files are read and extracted once. Returns the samples written and, by category, their counts."""
    files = scan_project_files(spark, scan_dir).filter(~F.col("kind").isin("project_marker", "object_repository"))
    comp = save_table(extract_components(files.drop("content", "length")), "components")
    members = cut_lineage(RC.valid_members(comp, marker_files(spark, scan_dir)))
    samples = comp.select("file_id", P.file_samples(comp).alias("samples")).filter(F.size("samples") > 0)
    samples = P.sample_metadata(P.generate_samples(members.join(samples, "file_id")))
    rows = samples.select("instruction", "input", "output", "source", "category", "metadata")
    out = out_dir.rstrip("/")
    by = {c: F.count_if(F.col("category") == c) for c in CATEGORIES}
    seen = write_once(rows, f"{out}/uft_training_samples", run_ts=run_ts, **by)
    objects = scan_object_repositories(spark, scan_dir, members.select("project").distinct())
    write_projects(RC.project_records(comp, members, objects, run_ts), f"{out}/projects", run_ts=run_ts)
    return {"written": seen["n"], "samples_by_category": {c: seen[c] for c in CATEGORIES if seen[c]}}
