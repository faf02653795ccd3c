"""Script files: kinds, names, decoding, and component extraction.

Extraction uses ``regexp_extract_all`` for the full matches and re-applies
the pattern to each match to read its groups (a match re-matched from its own
start yields the same groups), so every component is a Column expression.
Java needs ``(?U)`` for Python's Unicode ``\\w``/``\\s`` and ``(?s)``/``(?i)``
where Python used DOTALL/IGNORECASE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.functions import rules as R
from glean.functions.html import NEVER, escape_marks, let, restore_marks
from glean.functions.text import col_of, py_strip

FUNCTION_RE = "(?isU)" + R.FUNCTION_PATTERN
# strict=True: the keyword must start a word and the closing End must be a word
# ("Foo(1)" after an unconsumed "End Sub" is then not a function named Foo).
FUNCTION_STRICT_RE = "(?isU)(?<![\\w])(?<!End\\s)(?<!End\\s\\s)" + R.FUNCTION_PATTERN.replace(
    "End\\s+(?:Function|Sub)", "(?<![\\w])End\\s+(?:Function|Sub)(?![\\w])")
OBJECT_RE = "(?iU)" + R.OBJECT_PATTERN
DATATABLE_RE = "(?iU)" + R.DATATABLE_PATTERN
CHECKPOINT_RE = "(?iU)" + R.CHECKPOINT_PATTERN
REPORTER_RE = "(?iU)" + R.REPORTER_PATTERN

# --- paths -------------------------------------------------------------------


def file_name(path) -> Column:
    return F.element_at(F.split(col_of(path), "/", -1), -1)


def parent_name(path) -> Column:
    """Name of the folder holding the file (an action's name)."""
    return F.element_at(F.split(col_of(path), "/", -1), -2)


def parent_dir(path) -> Column:
    return F.regexp_extract(col_of(path), "^(.*)/[^/]*$", 1)


def grandparent_dir(path) -> Column:
    return parent_dir(parent_dir(path))


def file_stem(path) -> Column:
    """``Path.stem``: the name without its last suffix (a leading dot is not a suffix)."""
    return F.regexp_replace(file_name(path), "(?<=.)\\.[^.]*$", "")


def script_kind(path) -> Column:
    """File kind by name, as the project scan's glob patterns see it
    (case-sensitive): action (``*.mts``), library (``*.qfl``, ``*.vbs``),
    object repository (``*.tsr``), data table (``*.xls*``), project marker
    (``*.tsp``), other."""
    name = file_name(path)
    return (F.when(F.endswith(name, F.lit(".mts")), "action")
             .when(F.endswith(name, F.lit(".qfl")) | F.endswith(name, F.lit(".vbs")), "library")
             .when(F.endswith(name, F.lit(".tsr")), "object_repository")
             .when(name.rlike("\\.xls[^/]*$"), "data_table")
             .when(F.endswith(name, F.lit(".tsp")), "project_marker")
             .otherwise("other"))


def ancestors(path) -> Column:
    """Every folder above the file, outermost first ('/a/b/c.x' -> ['/a', '/a/b'])."""
    parts = F.split(col_of(path), "/", -1)
    return F.transform(F.sequence(F.lit(2), F.size(parts) - 1),
                       lambda i: F.array_join(F.slice(parts, 1, i), "/"))


# --- decoding ----------------------------------------------------------------

# cp1252 differs from ISO-8859-1 only in 0x80-0x9F (public code page table).
_C1 = "".join(chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
_CP1252 = bytes(range(0x80, 0xA0)).decode("cp1252", errors="ignore")


def decode_text(content) -> Column:
    """Bytes -> text trying UTF-8, UTF-16 (BOM required), cp1252, ISO-8859-1,
    then universal newlines (CRLF and CR become LF), as a text-mode read does."""
    b = col_of(content)
    as_latin1 = F.decode(b, "ISO-8859-1")
    bom16 = F.substring(F.hex(b), 1, 4).isin("FFFE", "FEFF") & (F.octet_length(b) % 2 == 0)
    text = (F.when(F.is_valid_utf8(b.cast("string")), F.decode(b, "UTF-8"))
             .when(bom16, F.decode(b, "UTF-16"))
             .when(~as_latin1.rlike("[\\x{81}\\x{8d}\\x{8f}\\x{90}\\x{9d}]"), F.translate(as_latin1, _C1, _CP1252))
             .otherwise(as_latin1))
    return F.regexp_replace(text, "\\r\\n?", "\n")


def decode_utf8_ignore(content) -> Column:
    """``bytes.decode('utf-8', errors='ignore')``: invalid sequences are dropped
    (``make_valid_utf8`` marks them with U+FFFD, which is then removed; a
    genuine U+FFFD in the input is dropped too)."""
    return F.regexp_replace(F.make_valid_utf8(col_of(content).cast("string")), "\\x{fffd}", "")


def decoded_encoding(content) -> Column:
    b = col_of(content)
    as_latin1 = F.decode(b, "ISO-8859-1")
    bom16 = F.substring(F.hex(b), 1, 4).isin("FFFE", "FEFF") & (F.octet_length(b) % 2 == 0)
    return (F.when(F.is_valid_utf8(b.cast("string")), "utf-8").when(bom16, "utf-16")
             .when(~as_latin1.rlike("[\\x{81}\\x{8d}\\x{8f}\\x{90}\\x{9d}]"), "cp1252")
             .otherwise("iso-8859-1"))


# --- extraction ----------------------------------------------------------------


_END = "End\\s+(?:Function|Sub)"
_STRICT_END = "(?<![\\w])End\\s+(?:Function|Sub)(?![\\w])"
_OPENER = "(?isU)(?:Function|Sub)\\s+\\w+\\s*\\("


def function_texts(code, strict: bool = False) -> Column:
    """The text of every Function/Sub block, in order; linear.

    A block needs a ``)`` and an End behind its ``(``. Nothing behind the last End is searched, and a ``(``
    behind the last ``)`` that an End follows can't open a block, so it is marked where one seems to begin there:
    every search that is made finds its end, and goes on behind it. Marks are escaped and restored as in pages.
    """
    pat, end = (FUNCTION_STRICT_RE, _STRICT_END) if strict else (FUNCTION_RE, _END)
    # s: up to the last End; n: its length up to the last ")" before that End. Each step names only its own variable.
    ended = let(F.coalesce(col_of(code), F.lit("")), lambda x: F.struct(F.regexp_extract(x, "(?isU)^.*" + end, 0).alias("s"), F.regexp_extract(x, "(?isU)^(.*)" + end, 1).alias("before")))
    cut = let(ended, lambda y: F.struct(y["s"].alias("s"), F.when(F.contains(y["before"], F.lit(")")), F.length(y["before"]) - F.length(
        F.substring_index(y["before"], ")", -1))).otherwise(0).alias("n")))

    def searched(z):
        tail = F.substring(z["s"], z["n"] + 1, F.length(z["s"]))
        marked = F.concat(escape_marks(F.substring(z["s"], F.lit(1), z["n"])), F.replace(escape_marks(tail), F.lit("("), F.lit(NEVER)))
        plain = F.regexp_extract_all(z["s"], F.lit(pat), 0)
        careful = F.transform(F.regexp_extract_all(marked, F.lit(pat), 0), lambda m: restore_marks(F.replace(m, F.lit(NEVER), F.lit("("))))
        return F.when(z["n"] == 0, F.array().cast("array<string>")).when(tail.rlike(_OPENER), careful).otherwise(plain)

    return let(cut, searched)


def functions_of(code, strict: bool = False) -> Column:
    """array<struct<name, parameters, body, full_code>> of Function/Sub blocks."""
    pat = FUNCTION_STRICT_RE if strict else FUNCTION_RE
    return F.transform(function_texts(code, strict), lambda m: F.struct(
        F.regexp_extract(m, pat, 1).alias("name"),
        py_strip(F.regexp_extract(m, pat, 2)).alias("parameters"),
        py_strip(F.regexp_extract(m, pat, 3)).alias("body"),
        m.alias("full_code")))


def object_refs_of(code) -> Column:
    """Distinct ``Type("name")`` references (type as written), sorted."""
    matches = F.regexp_extract_all(F.coalesce(col_of(code), F.lit("")), F.lit(OBJECT_RE), 0)
    refs = F.transform(matches, lambda m: F.concat(F.regexp_extract(m, OBJECT_RE, 1), F.lit('("'),
                                                    F.regexp_extract(m, OBJECT_RE, 2), F.lit('")')))
    return F.array_sort(F.array_distinct(refs))


def group_refs_of(code, pattern: str) -> Column:
    """Distinct first-group values of ``pattern`` (DataTable columns, checkpoints), sorted."""
    return F.array_sort(F.array_distinct(
        F.regexp_extract_all(F.coalesce(col_of(code), F.lit("")), F.lit(pattern), 1)))


def datatable_refs_of(code) -> Column:
    return group_refs_of(code, DATATABLE_RE)


def checkpoints_of(code) -> Column:
    return group_refs_of(code, CHECKPOINT_RE)


def report_events_of(code) -> Column:
    """array<struct<status, step, detail>> of Reporter.ReportEvent calls, in order."""
    matches = F.regexp_extract_all(F.coalesce(col_of(code), F.lit("")), F.lit(REPORTER_RE), 0)
    return F.transform(matches, lambda m: F.struct(
        F.regexp_extract(m, REPORTER_RE, 1).alias("status"),
        F.regexp_extract(m, REPORTER_RE, 2).alias("step"),
        F.regexp_extract(m, REPORTER_RE, 3).alias("detail")))


def extract_components(files: DataFrame, code: str = "code", path: str = "path") -> DataFrame:
    """Per file: kind, names, blank flag, functions, object and DataTable refs."""
    derived = {"kind", "is_script_mts", "action_name", "library_name", "non_blank", "functions",
               "object_refs", "datatable_refs"}
    return files.select(
        *[c for c in files.columns if c not in derived],
        script_kind(F.col(path)).alias("kind"),
        (file_name(F.col(path)) == "Script.mts").alias("is_script_mts"),
        parent_name(F.col(path)).alias("action_name"),
        file_stem(F.col(path)).alias("library_name"),
        (F.length(py_strip(F.coalesce(F.col(code), F.lit("")))) > 0).alias("non_blank"),
        functions_of(F.col(code)).alias("functions"),
        object_refs_of(F.col(code)).alias("object_refs"),
        datatable_refs_of(F.col(code)).alias("datatable_refs"))


# --- DataFrame-level forms ---------------------------------------------------------


def name_from_path(df: DataFrame, path: str = "path", kind: str = "action", out: str = "name") -> DataFrame:
    """Action name = parent folder; library name = file stem; project name = folder name."""
    c = F.col(path)
    expr = {"action": parent_name(c), "library": file_stem(c), "project": file_name(c)}[kind]
    return df.withColumn(out, expr)


def extract_functions(df: DataFrame, col: str = "code", strict: bool = False) -> DataFrame:
    """One row per Function/Sub block (fn_pos, name, parameters, body, full_code)."""
    keep = [c for c in df.columns if c != col]
    out = df.select(*keep, F.posexplode(functions_of(F.col(col), strict)).alias("fn_pos", "fn"))
    return out.select(*keep, "fn_pos", "fn.*")


def extract_object_refs(df: DataFrame, col: str = "code", out: str = "object_refs") -> DataFrame:
    return df.withColumn(out, object_refs_of(F.col(col)))


def extract_refs(df: DataFrame, col: str = "code", pattern: str = DATATABLE_RE, out: str = "refs") -> DataFrame:
    """Distinct first-group values of ``pattern`` (DataTable columns by default; pass
    ``CHECKPOINT_RE`` for checkpoints)."""
    return df.withColumn(out, group_refs_of(F.col(col), pattern))


def extract_events(df: DataFrame, col: str = "code") -> DataFrame:
    """One row per Reporter.ReportEvent call (ev_pos, status, step, detail)."""
    keep = [c for c in df.columns if c != col]
    out = df.select(*keep, F.posexplode(report_events_of(F.col(col))).alias("ev_pos", "ev"))
    return out.select(*keep, "ev_pos", "ev.*")


# --- object repositories -----------------------------------------------------------

PRINTABLE_RUN = "[\\x{20}-\\x{7e}]{4,}"


def printable_strings(text) -> Column:
    """Runs of at least 4 printable ASCII characters (bytes read as ISO-8859-1)."""
    return F.regexp_extract_all(col_of(text), F.lit(PRINTABLE_RUN), 0)


def object_entries_binary(df: DataFrame, text: str = "raw_text", keep=("project", "file_order")) -> DataFrame:
    """Binary repository: each printable run mentioning an object word is an
    entry named by the run itself (type "extracted", raw)."""
    words = R.OBJECT_STRING_KEYWORDS
    runs = df.select(*keep, F.posexplode(printable_strings(F.col(text))).alias("pos", "entry_name"))
    low = F.lower(F.col("entry_name"))
    cond = None
    for w in words:
        t = F.instr(low, w) > 0
        cond = t if cond is None else (cond | t)
    return runs.filter(cond).withColumn("entry_type", F.lit("extracted")).withColumn("raw", F.lit(True))


_ENTRY = "pos int, entry_name string, entry_type string, properties array<struct<key: string, value: string>>, raw boolean"


def xml_elements(document: bytes | str) -> list[tuple[str, list[tuple[str, str]]]] | None:
    """(tag, attributes) of every element with a ``Name``, in document order; None if it isn't well-formed XML.

    Names in a namespace are written ``{uri}name``. Events stream through the parser: no tree is held.
    """
    from xml.parsers import expat

    found: list[tuple[str, list[tuple[str, str]]]] = []

    def full(name):
        return "{" + name if "}" in name else name

    def start(tag, attributes):
        pairs = [(full(attributes[i]), attributes[i + 1]) for i in range(0, len(attributes), 2)]
        if any(k == "Name" for k, _ in pairs):
            found.append((full(tag), pairs))

    parser = expat.ParserCreate(namespace_separator="}")
    parser.ordered_attributes = True
    parser.StartElementHandler = start
    try:
        parser.Parse(document, True)
    except (expat.ExpatError, ValueError, LookupError):
        return None
    return found


def parse_repositories(df: DataFrame, document: str, keep=("project", "file_order")) -> DataFrame:
    """``keep``, then a row per named element of a well-formed document (attributes in order, references
    and CDATA resolved); a document that isn't XML gives one row with ``pos`` -1. One parse per document."""
    import pyarrow as pa

    names = [*keep, "pos", "entry_name", "entry_type", "properties", "raw"]
    pair = pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                found = xml_elements(one.column(len(keep))[0].as_py() or "")
                rows = [(-1, None, None, None, True)] if found is None else [
                    (k, dict(p)["Name"], tag, [{"key": a, "value": v} for a, v in p], False) for k, (tag, p) in enumerate(found)]
                for at in range(0, len(rows), 4096):
                    part = list(zip(*rows[at:at + 4096]))
                    same = pa.array([0] * len(part[0]))
                    yield pa.RecordBatch.from_arrays(
                        [one.column(k).take(same) for k in range(len(keep))]
                        + [pa.array(c, t) for c, t in zip(part, (pa.int32(), pa.string(), pa.string(), pair, pa.bool_()))], names)

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", " + _ENTRY
    return df.select(*keep, document).mapInArrow(run, schema)


def object_entries_xml(df: DataFrame, text: str = "text", keep=("project", "file_order")) -> DataFrame:
    """XML repository: every element carrying a ``Name`` attribute becomes an entry (name, tag, all
    attributes as key/value pairs, by a real parser). Documents that aren't well-formed give none."""
    return parse_repositories(df, text, keep).filter(F.col("pos") >= 0)


def merge_objects(entries: DataFrame, project: str = "project", name: str = "entry_name",
                  order=("file_order", "pos")) -> DataFrame:
    """Per (project, entry name) the entry from the last file wins (``max_by``,
    partial aggregation: a much-repeated name never lands in one task whole)."""
    value_cols = [c for c in entries.columns if c not in (project, name)]
    return (entries.groupBy(project, name)
            .agg(F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.struct(*[F.col(o) for o in order])).alias("_w"))
            .select(project, name, "_w.*"))
