"""Secret scans with multipart credential linking.

Strong spans (assignments, access ids, long hex strings) are reported always. Weak
candidates - user names, bare high-variety tokens, endpoints - are reported only
when complementary parts co-occur: an interval join places parts in scopes
(paragraphs: what lies between blank lines), and all parts of a scope are linked,
however far apart.

* a user name needs a secret in its scope;
* a bare token needs an identifier or an endpoint in its scope;
* an endpoint needs an identifier and a secret in its scope.

Parts of each role are counted by scope: no pairs are made, however many parts a
scope has. A bare token has letters and digits of all three classes (digits, upper and
lower case), or of two with at least ``VARIETY`` different characters.

Edge cases: null and empty texts have no spans; a repeated (doc_id, text) row gets
the same result each time; a null doc_id is a value like any other.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glean.llm.common import save, table, with_columns_of
from glean.llm.registry import query

VARIETY = 10
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_USER = re.compile(r"""\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?[ \t]*[:=][ \t]*["']?([A-Za-z0-9@._+-]{3,})""", re.I | re.A)
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_URL = re.compile(r"""\b(?:(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|jdbc:[a-z]+)://[^\s"'<>]{3,}|(?:host|endpoint|server)["']?[ \t]*[:=][ \t]*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::\d+)?)""", re.I | re.A)
_BLANK = re.compile(r"\n[ \t\r]*\n")
#: Kinds in the order in which spans with equal starts are listed; strong ones first.
KINDS = ("assign", "access", "hex", "user", "key", "endpoint")
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "user": "id", "key": "secret", "endpoint": "endpoint"}


def strong_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end) of the spans that are always reported, in order."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def weak_spans(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that only count next to complementary parts; those that touch a strong span are left out."""
    out = [(m.start(), 3, m.end()) for m in _USER.finditer(text)] if ":" in text or "=" in text else []
    if "://" in text or "." in text and (":" in text or "=" in text):
        out += [(m.start(), 5, m.end()) for m in _URL.finditer(text)]
    if any(len(w) >= 20 for w in text.split()):
        for m in _TOKEN.finditer(text):
            w = set(m.group())
            classes = any("0" <= c <= "9" for c in w) + any("A" <= c <= "Z" for c in w) + any("a" <= c <= "z" for c in w)
            if classes == 3 or (classes == 2 and sum(c.isalnum() for c in w) >= VARIETY):
                out.append((m.start(), 4, m.end()))
    if not out:
        return out
    # Candidates come by start. Of the strong spans that start before a candidate's end, and of those taken
    # before it, the greatest end tells whether any touches it.
    starts, ends, top = [s for s, _, _ in strong], [], 0
    for _, _, e in strong:
        top = max(top, e)
        ends.append(top)
    free, last = [], 0
    for s, k, e in sorted(out):
        before = bisect.bisect_left(starts, e)
        if s < last or (before and s < ends[before - 1]):
            continue
        free.append((s, k, e))
        last = e
    return free


def spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_PARTS = "array<struct<start: int, kind: int, end: int, scope: int>>"
_FOUND = f"doc_id bigint, rid string, n_assign bigint, n_access bigint, n_hex bigint, base string, parts {_PARTS}"


def _scan(batches):
    types = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())]))
    for b in batches:
        for at in range(0, b.num_rows, 512):
            ids, rid, counts, base, parts = b.column("doc_id").slice(at, 512), [], ([], [], []), [], []
            for text in b.column("text").slice(at, 512).to_pylist():
                text = text or ""
                strong = strong_spans(text)
                weak = weak_spans(text, strong)
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in strong))
                base.append(spell(strong))
                if not weak:
                    rid.append(None)
                    parts.append(None)
                    continue
                rid.append(hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest())
                cuts = [m.start() for m in _BLANK.finditer(text)]
                parts.append([{"start": s, "kind": k, "end": e, "scope": bisect.bisect_right(cuts, s)} for s, k, e in sorted(strong + weak)])
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(rid, pa.string()), *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(parts, types)],
                ["doc_id", "rid", "n_assign", "n_access", "n_hex", "base", "parts"])


def linked(parts: DataFrame) -> DataFrame:
    """Interval join within scopes: of the exploded ``parts`` (doc_id, rid, scope, start, kind, end), the ones to report."""
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind") + 1)
    scope = Window.partitionBy("doc_id", "rid", "scope")
    p = parts.withColumn("role", role)
    for r in ("id", "secret", "endpoint"):
        mine = F.col("role") == r
        p = p.withColumn(f"near_{r}", F.count_if(mine).over(scope) > mine.cast("int"))
    complete = (F.when(F.col("role") == "id", F.col("near_secret"))
                .when(F.col("role") == "secret", F.col("near_id") | F.col("near_endpoint"))
                .otherwise(F.col("near_id") & F.col("near_secret")))
    return p.filter((F.col("kind") < 3) | complete)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, rid (md5 of the text; null if the row has no weak candidates), counts, base, spans for every row."""
    found = save(with_columns_of(docs, ["doc_id", "text"]).mapInArrow(_scan, _FOUND), "secrets")
    plain = found.filter("rid is null").drop("parts").withColumn("spans", F.col("base"))
    weak = found.filter("rid is not null")
    exploded = (weak.groupBy("doc_id", "rid").agg(F.first("parts").alias("parts"))
                .select("doc_id", "rid", F.explode("parts").alias("p")).select("doc_id", "rid", "p.*"))
    spans = (linked(exploded).groupBy("doc_id", "rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("x"))
             .select(F.col("doc_id").alias("d"), F.col("rid").alias("r"), F.array_join(F.transform("x", lambda x: F.concat_ws(
                 ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1), x["start"], x["end"])), ",").alias("spans")))
    joined = weak.drop("parts").join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r")), "left")
    return plain.unionByName(joined.select(*[c for c in plain.columns if c != "spans"], F.coalesce("spans", F.lit("")).alias("spans")))


def mask(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with every reported span of ``text`` replaced by ``mark``; other columns and rows as they are."""
    columns = docs.columns
    weak = (scan(docs).filter("rid is not null and spans <> base")
            .select(F.col("doc_id").alias("_d"), F.col("rid").alias("_r"), F.col("spans").alias("_spans")).distinct())
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(columns)])
    names = plain.columns
    joined = plain.join(weak, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.md5(F.col("text").cast("binary")) == F.col("_r")), "left")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, texts = b.slice(at, 512), []
                for text, spans in zip(part.column("text").to_pylist(), part.column("_spans").to_pylist()):
                    if text:
                        cut = [(int(s), int(e)) for _, s, e in (x.rsplit(":", 2) for x in spans.split(","))] if spans else [(s, e) for s, _, e in strong_spans(text)]
                        out, last = [], 0
                        for s, e in sorted(cut):
                            if s >= last:
                                out += [text[last:s], mark]
                            last = max(last, e)
                        text = "".join(out) + text[last:]
                    texts.append(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, part.column(k).type) if k == "text" else part.column(k) for k in names], names)

    return joined.select(*names, "_spans").mapInArrow(run, plain.schema).toDF(*columns)


@query("op3_secret_linking")
def op3_secret_linking(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")
