"""JSON Lines sources.

* Schemas are given, never inferred. Fields whose type the producer may get
  wrong (counts, ids) are read as strings and cast with ``try_cast``: a wrong
  type must not turn a whole line into a corrupt record.
* PERMISSIVE mode keeps malformed lines in ``_corrupt_record``; ``clean`` and
  ``quarantine`` split them (blank lines are skipped by the reader itself).
* A missing source folder contributes a typed empty DataFrame.
* ``src_path``/``src_pos`` record where a row came from: the file, and a
  position that increases with the line order inside the file (rows of one
  file split are read in order by one task; splits are numbered in order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from glean.functions.text import col_of, py_strip

CORRUPT = "_corrupt_record"


def _s(*names: str) -> list:
    return [StructField(n, StringType()) for n in names]


CODE_SAMPLE_SCHEMA = StructType(_s("source", "repo_name", "file_path", "language", "code", "description", "url",
                                   "stars", "collected_at"))
QA_PAIR_SCHEMA = StructType(_s("source", "question_id", "title", "question", "answer")
                            + [StructField("code_blocks", ArrayType(StringType())),
                               StructField("tags", ArrayType(StringType()))]
                            + _s("score", "answer_score", "url", "collected_at"))
TRAINING_SAMPLE_SCHEMA = StructType(_s("instruction", "input", "output", "source", "category")
                                    + [StructField("metadata", MapType(StringType(), StringType()))])
EXAMPLE_SCHEMA = StructType(_s("instruction", "input", "output"))

INT_FIELDS = {"stars": "int", "question_id": "long", "score": "int", "answer_score": "int"}


def with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists (a glob pattern: when it matches something)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if any(ch in path for ch in "*?[{"):
        found = fs.globStatus(hpath)
        return found is not None and len(found) > 0
    return fs.exists(hpath)


def read_jsonl(spark: SparkSession, path: str, schema: StructType, glob: str | None = None,
               src_rank: int = 0) -> DataFrame:
    """All matching ``*.jsonl`` files under ``path`` (rows incl. corrupt ones).

    Lines are read as text and parsed with ``from_json`` in PERMISSIVE mode:
    the same parser as the JSON source, but the corrupt-record column is an
    ordinary column (the JSON source refuses queries that reference only it,
    such as a count of the clean rows). Blank lines are skipped.
    """
    full = with_corrupt(schema)
    pattern = f"{path.rstrip('/')}/{glob or '*.jsonl'}"      # top-level files only, like a folder glob
    if not path_exists(spark, path) or not path_exists(spark, pattern):
        empty = spark.createDataFrame([], full)
        return empty.select("*", F.lit(src_rank).alias("src_rank"), F.lit("").alias("src_path"),
                            F.lit(0).cast("long").alias("src_pos"))
    return parse_lines(spark.read.text(pattern), schema, src_rank)


def parse_lines(lines: DataFrame, schema: StructType, src_rank: int = 0) -> DataFrame:
    """Text lines (``value``) -> typed rows plus ``_corrupt_record``, positions."""
    full = with_corrupt(schema)
    lines = lines.select("value", F.col("_metadata.file_path").alias("src_path"),
                         F.monotonically_increasing_id().alias("src_pos"))
    lines = lines.filter(F.length(py_strip(F.col("value"))) > 0)
    parsed = lines.select("*", F.from_json("value", full, {"mode": "PERMISSIVE",
                                                          "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull() | ~F.startswith(F.ltrim("value"), F.lit("{"))
    fields = [F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]
    return parsed.select(*fields, F.when(bad, F.col("value")).alias(CORRUPT), F.lit(src_rank).alias("src_rank"),
                         "src_path", "src_pos")


def typed(df: DataFrame) -> DataFrame:
    """Cast the string-read numeric fields (a bad value becomes null, not an error)."""
    for name, t in INT_FIELDS.items():
        if name in df.columns:
            df = df.withColumn(name, F.expr(f"try_cast(`{name}` as {t})"))
    return df


def clean(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, "src_path", "src_pos")


def read_code_samples(spark: SparkSession, raw_dir: str) -> DataFrame:
    return typed(clean(read_jsonl(spark, f"{raw_dir.rstrip('/')}/github", CODE_SAMPLE_SCHEMA, src_rank=0)))


def read_qa(spark: SparkSession, raw_dir: str) -> DataFrame:
    return typed(clean(read_jsonl(spark, f"{raw_dir.rstrip('/')}/stackoverflow", QA_PAIR_SCHEMA, src_rank=1)))


def read_instruction_samples(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Hand-placed ``*training*.jsonl`` files and what the project scan wrote (all snapshots, or an unstamped run)."""
    folder = f"{raw_dir.rstrip('/')}/your_scripts"
    rows = read_jsonl(spark, folder, TRAINING_SAMPLE_SCHEMA, glob="*training*.jsonl", src_rank=2)
    for glob in ("*.json", "run_id=*/*.json"):
        rows = rows.unionByName(read_jsonl(spark, f"{folder}/uft_training_samples", TRAINING_SAMPLE_SCHEMA, glob=glob, src_rank=2))
    return clean(rows)


def read_corpus(spark: SparkSession, train: str, val: str | None = None) -> DataFrame:
    """Corpus rows for training (a file or a written folder, snapshot
    partitions included); the validation path is optional."""
    def one(p, split):
        rows = parse_lines(spark.read.text(p), EXAMPLE_SCHEMA)
        return clean(rows).select(*EXAMPLE_SCHEMA.fieldNames()).withColumn("split", F.lit(split))
    df = one(train, "train")
    if val is not None and path_exists(spark, val):
        df = df.unionByName(one(val, "val"))
    return df


def line_status(line) -> Column:
    """'blank', 'malformed' or 'ok' for one JSON line (an object is required)."""
    line = col_of(line)
    parsed = F.from_json(line, "_probe string, _corrupt_record string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    bad = parsed.isNull() | parsed[CORRUPT].isNotNull() | ~F.startswith(F.ltrim(line), F.lit("{"))
    return (F.when(F.length(py_strip(F.coalesce(line, F.lit("")))) == 0, "blank")
             .when(bad, "malformed").otherwise("ok"))
