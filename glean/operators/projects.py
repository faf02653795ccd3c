"""Projects: membership, statistics and training samples.

A project is a folder: one holding a ``*.tsp`` marker, or the grandparent of a
``Script.mts`` (a standalone action folder). It owns every file below it, so
nested projects both own a file. Membership is an equi-join of each file's
ancestor folders (a handful per file) with the project folders, never a
nested-loop ``startswith`` join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.operators.scripts import ancestors, file_name, grandparent_dir, parent_dir

SAMPLE_COLUMNS = ["project", "project_name", "file_id", "fn_pos", "category", "source", "instruction",
                  "input", "output", "meta_group", "meta_group_name", "meta_item_key", "meta_item"]


def sample_metadata(df: DataFrame) -> DataFrame:
    """The sample's metadata as a map ({project|library: name, action|function: name})."""
    return df.withColumn("metadata", F.create_map(F.col("meta_group"), F.col("meta_group_name"),
                                                  F.col("meta_item_key"), F.col("meta_item")))


def marker_roots(markers: DataFrame, path: str = "path") -> DataFrame:
    return markers.select(parent_dir(F.col(path)).alias("project")).distinct()


def script_mts_roots(files: DataFrame, path: str = "path") -> DataFrame:
    return (files.filter(file_name(F.col(path)) == "Script.mts")
                 .select(grandparent_dir(F.col(path)).alias("project")).distinct())


def assign_projects(files: DataFrame, roots: DataFrame, path: str = "path", key: str = "file_id") -> DataFrame:
    """(project, file) pairs: a file belongs to every project folder above it.

    A folder near the root is above every file: the distinct ``roots`` are hashed, so that no
    task sorts the rows of such a folder.
    """
    anc = files.select(key, F.explode(ancestors(F.col(path))).alias("project"))
    return anc.join(roots.hint("shuffle_hash"), "project")


def project_stats(components: DataFrame) -> DataFrame:
    """Per project: non-blank actions and libraries, their functions, data
    tables; ``valid`` when it has an action or a library. Partial aggregation."""
    action = (F.col("kind") == "action") & F.col("non_blank")
    library = (F.col("kind") == "library") & F.col("non_blank")
    return (components.groupBy("project").agg(
        F.count_if(action).alias("n_actions"),
        F.count_if(library).alias("n_libraries"),
        F.sum(F.when(action | library, F.size("functions")).otherwise(0)).alias("n_functions"),
        F.count_if(F.col("kind") == "data_table").alias("n_data_tables"))
        .withColumn("valid", (F.col("n_actions") + F.col("n_libraries")) > 0))


def projects(files: DataFrame, markers: DataFrame) -> DataFrame:
    """Valid project folders (marker folders and standalone action folders)."""
    from glean.operators.scripts import extract_components

    roots = marker_roots(markers).unionByName(script_mts_roots(files)).distinct()
    comp = assign_projects(files, roots).join(extract_components(files), "file_id")
    return project_stats(comp).filter("valid")


def standalone_projects(files: DataFrame, markers: DataFrame, valid: DataFrame) -> DataFrame:
    """Grandparents of ``Script.mts`` that are not already a (valid) marker project."""
    marked = marker_roots(markers).join(valid.select("project"), "project", "left_semi")
    return script_mts_roots(files).join(marked, "project", "left_anti")


def _sample(category, source, fn_pos, instruction, input_, output, group, group_name, item_key, item):
    return F.struct(F.lit(category).alias("category"), F.lit(source).alias("source"),
                    fn_pos.cast("int").alias("fn_pos"), instruction.alias("instruction"), input_.alias("input"),
                    output.alias("output"), F.lit(group).alias("meta_group"), group_name.alias("meta_group_name"),
                    F.lit(item_key).alias("meta_item_key"), item.alias("meta_item"))


def file_samples(components: DataFrame) -> Column:
    """Every training sample a file yields, as one array (computed in a single
    projection next to the extraction, so the regex work runs once per file).

    full_action: the action code when longer than 100 characters; function:
    each action function longer than 50; library_function: each library
    function longer than 50. Object references listed are the first five.
    ``meta_group_name`` of action samples is filled with the project name later.
    """
    action = (F.col("kind") == "action") & F.col("non_blank")
    library = (F.col("kind") == "library") & F.col("non_blank")
    long_fns = F.filter(F.transform("functions", lambda f, i: F.struct(f.alias("f"), i.alias("i"))),
                        lambda x: F.length(x["f"]["full_code"]) > R.FUNCTION_MIN_CHARS)
    full = _sample("full_action", "uft_project", F.lit(-1),
                   F.lit("Write a UFT VBScript action that performs automation tasks"),
                   F.concat(F.lit("Action name: "), F.col("action_name"), F.lit(". Objects used: "),
                            F.array_join(F.slice("object_refs", 1, R.OBJECTS_IN_INPUT), ", ")),
                   F.col("code"), "project", F.lit(None).cast("string"), "action", F.col("action_name"))
    fn_samples = F.transform(long_fns, lambda x: _sample(
        "function", "uft_project", x["i"], F.concat(F.lit("Write a VBScript function to "), R.purpose_of(x["f"]["name"])),
        F.concat(F.lit("Function name: "), x["f"]["name"], F.lit(", Parameters: "), x["f"]["parameters"]),
        x["f"]["full_code"], "project", F.lit(None).cast("string"), "function", x["f"]["name"]))
    lib_samples = F.transform(long_fns, lambda x: _sample(
        "library_function", "uft_library", x["i"],
        F.concat(F.lit("Write a reusable VBScript function to "), R.purpose_of(x["f"]["name"])),
        F.concat(F.lit("Function: "), x["f"]["name"], F.lit("("), x["f"]["parameters"], F.lit(")")),
        x["f"]["full_code"], "library", F.col("library_name"), "function", x["f"]["name"]))
    empty = F.array().cast(full_type())
    return (F.when(action, F.concat(F.when(F.length("code") > R.ACTION_MIN_CHARS, F.array(full)).otherwise(empty),
                                    fn_samples))
             .when(library, lib_samples).otherwise(empty))


def full_type() -> str:
    return ("array<struct<category:string,source:string,fn_pos:int,instruction:string,input:string,output:string,"
            "meta_group:string,meta_group_name:string,meta_item_key:string,meta_item:string>>")


def per_file(files: DataFrame) -> DataFrame:
    """File-level facts for project statistics plus the file's samples."""
    from glean.operators.scripts import extract_components

    comp = extract_components(files)
    return comp.select("file_id", "kind", "non_blank", F.size("functions").alias("n_functions"),
                       file_samples(comp).alias("samples"))


def project_file_stats(pm: DataFrame) -> DataFrame:
    action = (F.col("kind") == "action") & F.col("non_blank")
    library = (F.col("kind") == "library") & F.col("non_blank")
    return (pm.groupBy("project").agg(
        F.count_if(action).alias("n_actions"),
        F.count_if(library).alias("n_libraries"),
        F.sum(F.when(action | library, F.col("n_functions")).otherwise(0)).alias("n_functions"),
        F.count_if(F.col("kind") == "data_table").alias("n_data_tables"))
        .withColumn("valid", (F.col("n_actions") + F.col("n_libraries")) > 0))


def generate_samples(pm: DataFrame) -> DataFrame:
    """(project, file) rows with a ``samples`` array -> one row per sample."""
    out = pm.select("project", "file_id", F.explode("samples").alias("s")).select("project", "file_id", "s.*")
    name = F.element_at(F.split("project", "/", -1), -1)
    return (out.withColumn("project_name", name)
               .withColumn("meta_group_name", F.coalesce(F.col("meta_group_name"), F.col("project_name")))
               .select(*SAMPLE_COLUMNS))


def extract_projects(files: DataFrame, markers: DataFrame) -> DataFrame:
    """Files + markers -> training samples of every valid project.

    Validity needs only each file's kind and blank flag (no regex), so it is
    computed from a light projection; the extraction (functions, references,
    samples) runs once per file and is joined to the valid memberships.
    """
    from glean.functions.text import py_strip
    from glean.operators.scripts import script_kind

    roots = marker_roots(markers).unionByName(script_mts_roots(files)).distinct()
    member = assign_projects(files, roots)
    light = files.select("file_id", script_kind(F.col("path")).alias("kind"),
                         (F.length(py_strip(F.coalesce(F.col("code"), F.lit("")))) > 0).alias("non_blank"))
    scripts = (F.col("kind").isin("action", "library")) & F.col("non_blank")
    valid = (member.join(light, "file_id").groupBy("project").agg(F.count_if(scripts).alias("n_scripts"))
                   .filter(F.col("n_scripts") > 0).select("project"))
    kept = member.join(valid.hint("shuffle_hash"), "project", "left_semi")
    return generate_samples(kept.join(per_file(files).select("file_id", "samples"), "file_id"))


def assemble_projects(components: DataFrame) -> DataFrame:
    """Per project: actions, libraries, functions, data tables (aggregates;
    a project is never gathered into one row or task)."""
    return project_stats(components)


def drop_empty_projects(stats: DataFrame) -> DataFrame:
    """Keep projects with at least one action or library."""
    return stats.filter(F.col("valid"))
