"""Project records: each project's actions, libraries, objects and data tables, nested.

A project can be larger than any task, so a record is a *chunk* of a project: its
components in a fixed order (actions named Script.mts, other actions, libraries by
kind, objects, data tables; each by path or name), cut where the running size
passes a multiple of ``CHUNK_BYTES``. A chunk holds at most that plus its last component.

The running size is a prefix sum without a one-task window: narrow rows (no text) are
dealt out by range, summed within each range partition, and the sums of the partitions
before are added, a row per project and partition. Texts join afterwards, by chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glean.operators.projects import assign_projects, marker_roots, script_mts_roots
from glean.operators.scripts import file_name
from glean.session import cut_lineage, save_table

CHUNK_BYTES = 64 << 20

_FN = "array<struct<name:string,parameters:string,body:string,full_code:string>>"
_ACTION = f"struct<name:string,script_path:string,code:string,functions:{_FN},object_references:array<string>,parameters:array<string>>"
_LIBRARY = f"struct<name:string,path:string,code:string,functions:{_FN},function_count:int>"
_OBJECT = "struct<name:string,type:string,properties:array<struct<key:string,value:string>>,raw:boolean>"


def valid_members(files: DataFrame, markers: DataFrame) -> DataFrame:
    """(project, file_id) of every project with an action or a library; ``files`` needs
    file_id, path, kind and non_blank only, and is read for those columns alone."""
    light = files.select("file_id", "path", "kind", "non_blank")
    roots = marker_roots(markers).unionByName(script_mts_roots(light)).distinct()
    member = save_table(assign_projects(light, roots).join(light.drop("path"), "file_id"), "members")
    scripts = F.col("kind").isin("action", "library") & F.col("non_blank")
    valid = member.groupBy("project").agg(F.count_if(scripts).alias("n")).filter("n > 0").select("project")
    return member.join(valid.hint("shuffle_hash"), "project", "left_semi").select("project", "file_id")


def with_chunks(rows: DataFrame, size: str, order: list[str], chunk_bytes: int = CHUNK_BYTES, group: str = "project") -> DataFrame:
    """``rows`` with the number of the chunk in which each row begins, by running ``size`` in ``order`` within ``group``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(parts, group, *order).withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_g", "_p", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(sums, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
    start = F.col("_before") + F.sum(size).over(inside) - F.col(size)
    return out.withColumn("chunk", F.floor(start / F.lit(chunk_bytes)).cast("long")).drop("_part", "_p", "_g", "_before")


def project_records(components: DataFrame, members: DataFrame, objects: DataFrame | None = None,
                    collected_at: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per project and chunk: name, path, chunk, actions, function_libraries,
    object_repository, data_tables, recovery_scenarios (always empty) and collected_at.

    ``components`` are extracted files (``extract_components``), ``members`` the files of
    valid projects, ``objects`` merged repository entries (project, entry_name,
    entry_type, properties, raw). A file of nested projects is in the records of each.
    """
    name = file_name(F.col("path"))
    rank = (F.when(F.col("kind") == "action", F.when(name == "Script.mts", 0).otherwise(1))
             .when(F.col("kind") == "library", F.when(F.endswith(name, F.lit(".qfl")), 2).otherwise(3))
             .when(F.col("kind") == "data_table", 5))
    kept = components.filter((F.col("kind").isin("action", "library") & F.col("non_blank")) | (F.col("kind") == "data_table"))
    files = kept.select("file_id", rank.alias("rank"), F.col("path").alias("key"),
                        (F.octet_length("path") + F.octet_length(F.coalesce(F.col("code"), F.lit("")))).cast("long").alias("size"))
    narrow = members.join(files, "file_id").withColumn("object", F.lit(None).cast(_OBJECT))
    if objects is not None:
        of_valid = objects.join(members.select("project").distinct().hint("shuffle_hash"), "project", "left_semi")
        props = F.col("properties") if "properties" in objects.columns else F.lit(None)
        entry = F.struct(F.col("entry_name").alias("name"), F.col("entry_type").alias("type"), props.alias("properties"), F.col("raw")).cast(_OBJECT)
        of_valid = of_valid.select(F.lit(None).cast("long").alias("file_id"), "project", F.lit(4).alias("rank"), F.col("entry_name").alias("key"),
                                   (F.octet_length("entry_name") + F.octet_length("entry_type")).cast("long").alias("size"), entry.alias("object"))
        narrow = narrow.unionByName(of_valid)
    placed = with_chunks(narrow, "size", ["rank", "key"], chunk_bytes)

    action = F.struct(F.col("action_name").alias("name"), F.col("path").alias("script_path"), F.col("code"), F.col("functions"),
                      F.col("object_refs").alias("object_references"), F.col("datatable_refs").alias("parameters")).cast(_ACTION)
    library = F.struct(F.col("library_name").alias("name"), F.col("path"), F.col("code"), F.col("functions"),
                       F.size("functions").alias("function_count")).cast(_LIBRARY)
    texts = kept.select(F.col("file_id").alias("_f"), F.when(F.col("kind") == "action", action).alias("action"),
                        F.when(F.col("kind") == "library", library).alias("library"))
    full = placed.join(texts, F.col("file_id") == F.col("_f"), "left")
    x = F.array_sort(F.collect_list(F.struct("rank", "key", "action", "library", "object")))
    records = full.groupBy("project", "chunk").agg(x.alias("x"))

    def section(low, high, field):
        return F.transform(F.filter("x", lambda c: (c["rank"] >= low) & (c["rank"] <= high)), lambda c: c[field])

    return records.select(
        F.element_at(F.split("project", "/", -1), -1).alias("name"), F.col("project").alias("path"), "chunk",
        section(0, 1, "action").alias("actions"), section(2, 3, "library").alias("function_libraries"),
        section(4, 4, "object").alias("object_repository"), section(5, 5, "key").alias("data_tables"),
        F.array().cast("array<string>").alias("recovery_scenarios"), F.lit(collected_at).cast("string").alias("collected_at"))


def record_components(records: DataFrame) -> DataFrame:
    """The components of records, one row each, as they stand in their chunk."""
    fns = lambda c: F.array_join(F.transform(c["functions"], lambda f: F.concat(f["name"], F.lit("("), f["parameters"], F.lit(")"))), ";")
    none, base = F.lit(None).cast("string"), ["path", "chunk"]

    def rows(array, section, name, path, code, functions, refs):
        c = F.col("c")
        out = records.select(*base, F.posexplode(array).alias("pos", "c"))
        return out.select(F.col("path").alias("project"), "chunk", F.lit(section).alias("section"), "pos", name(c).alias("name"), path(c).alias("file"),
                          F.md5(code(c)).alias("code_md5"), functions(c).alias("functions"), refs(c).alias("refs"))

    return (rows("actions", "action", lambda c: c["name"], lambda c: c["script_path"], lambda c: c["code"], fns, lambda c: F.array_join(c["object_references"], ";"))
            .unionByName(rows("function_libraries", "library", lambda c: c["name"], lambda c: c["path"], lambda c: c["code"], fns, lambda c: none))
            .unionByName(rows("object_repository", "object", lambda c: c["name"], lambda c: none, lambda c: c["type"], lambda c: none, lambda c: none))
            .unionByName(rows("data_tables", "data_table", lambda c: none, lambda c: c, lambda c: none, lambda c: none, lambda c: none)))
