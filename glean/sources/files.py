"""File trees: project folders read with the ``binaryFile`` source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glean.operators.scripts import decode_text, merge_objects, object_entries_binary, parse_repositories, script_kind
from glean.session import save_table

# File names a project scan looks at (glob semantics, case-sensitive).
PROJECT_FILE_PATTERN = r"(\.mts|\.qfl|\.vbs|\.tsr|\.tsp|\.xls[^/]*)$"


def scan_project_files(spark: SparkSession, root: str) -> DataFrame:
    """Every project-relevant file below ``root``: id, path, kind, text, bytes.

    Listing is recursive; the name filter runs on the ``path`` column, which
    the binary source evaluates before reading contents.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .filter(F.col("path").rlike(PROJECT_FILE_PATTERN)))
    path = F.regexp_replace(F.col("path"), "^file:", "")
    return files.select(
        F.xxhash64(F.col("path")).alias("file_id"), path.alias("path"), script_kind(path).alias("kind"),
        F.when(script_kind(path).isin("action", "library"), decode_text(F.col("content"))).alias("code"),
        F.col("content"), F.col("length"))


def _lister(root: str):
    """The entries of each folder of the frames (paths within ``root``'s file system): path, folder (true or false)."""
    def run(frames):
        import pandas as pd
        from pyarrow import fs

        where, _ = fs.FileSystem.from_uri(root)
        for frame in frames:
            for folder in frame["path"]:
                entries = where.get_file_info(fs.FileSelector(folder))
                for k in range(0, len(entries), 4096):
                    part = entries[k:k + 4096]
                    yield pd.DataFrame({"path": [e.path for e in part], "folder": [e.type == fs.FileType.Directory for e in part]})

    return run


def list_tree(spark: SparkSession, root: str, most_levels: int = 200) -> DataFrame:
    """Paths of all files below ``root``, zero-length ones included, listed on the executors and
    written as Spark writes them (local paths without a scheme).

    A frontier walk: the folders of one level are a table, listed in parallel, and give the files and
    the folders of the next. The driver sees no path. ``root`` is a URI that Arrow's file systems open.
    """
    from pyarrow import fs

    root = root.rstrip("/") or "/"
    _, base = fs.FileSystem.from_uri(root)
    frontier = spark.createDataFrame([(base,)], "path string")
    found = None
    for _ in range(most_levels):
        level = save_table(frontier.mapInPandas(_lister(root), "path string, folder boolean"), "listing")
        files = level.filter("not folder").select("path")
        found = files if found is None else found.unionByName(files)
        frontier = level.filter("folder").select("path")
        if frontier.isEmpty():
            full = F.concat(F.lit(root), F.substring("path", F.lit(len(base) + 1), F.length("path")))
            return found.select(F.regexp_replace(full, "^file:(//)?", "").alias("path"))
        frontier = frontier.repartition(spark.sparkContext.defaultParallelism, "path")
    raise RuntimeError(f"folders below {root} are more than {most_levels} levels deep")


def marker_files(spark: SparkSession, root: str, suffix: str = ".tsp") -> DataFrame:
    """Project marker paths under ``root``.

    Markers may be empty files, which Spark's file sources skip (they yield no row for a
    zero-length file), so the tree is listed (``list_tree``). Where Arrow doesn't know the
    file system, Hadoop's listing on the driver stands in.
    """
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(root)
    except (ValueError, OSError, NotImplementedError):
        return _hadoop_markers(spark, root, suffix)
    return list_tree(spark, root).filter(F.col("path").endswith(suffix))


def _hadoop_markers(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    hroot = jvm.org.apache.hadoop.fs.Path(root)
    it = hroot.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(hroot, True)
    paths = []
    while it.hasNext():
        p = it.next().getPath().toString()
        if p.endswith(suffix):
            paths.append((p.removeprefix("file:"),))
    return spark.createDataFrame(paths, "path string")


def scan_object_repositories(spark: SparkSession, root: str, projects: DataFrame) -> DataFrame:
    """Object repositories (``*.tsr``) of each project, merged (last file wins).

    A file that an XML parser accepts is read as XML: elements with a ``Name``, with all their attributes.
    Any other file, malformed XML included, is read as binary: printable runs naming an object.
    ``projects`` holds project folders; a file belongs to every project folder above it. Each file is parsed once.
    """
    from glean.operators.projects import assign_projects

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .filter(F.col("path").endswith(".tsr")))
    files = files.select(F.regexp_replace("path", "^file:", "").alias("path"), F.xxhash64("path").alias("file_id"), "content")
    entries = save_table(parse_repositories(files, "content", ("file_id", "path")), "entries")
    raw = files.join(entries.filter("pos = -1").select("file_id"), "file_id", "left_semi")
    raw = raw.select("file_id", "path", F.decode(F.col("content"), "ISO-8859-1").alias("raw_text"))
    binary = object_entries_binary(raw, "raw_text", ("file_id", "path"))
    both = entries.filter("pos >= 0").unionByName(binary.withColumn("properties", F.lit(None).cast(entries.schema["properties"].dataType)))
    owned = assign_projects(files.select("file_id", "path"), projects)
    return merge_objects(both.join(owned, "file_id").drop("file_id"), order=("path", "pos"))
