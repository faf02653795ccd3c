"""Source divergence audit through minimal acyclic transducers.

Terms are maximal runs of letters (ASCII letters and all non-ASCII characters), A-Z
lower-cased. Each language keeps the terms of at least ``MIN_DOCS`` of its documents.

1. Document frequencies are counted by task and summed by (lang, term).
2. The kept terms, sorted by Spark in ranges, become minimal acyclic transducers of at
   most ``CHUNK`` consecutive terms of a language each (incremental construction from
   sorted input: the finished suffix of the previous term is merged with equal states).
   An edge's output is the number of terms before it, so that the outputs along a term
   add up to its rank; with the terms of the chunks before, that is its lexicographic
   ordinal in the language.
3. All texts stream through the transducers, which recount each (lang, source) by
   ordinal. Transducers are broadcast in rounds of at most ``ROUND_BYTES`` (one round
   unless the kept vocabulary is larger); a round reads all texts.
4. Smoothed shares are exact integers (decimals in Spark). Sources of a language are
   compared in blocks of ``BLOCK`` ordinals, and the block sums are added up. Ranks break ties by ordinal.

Edge cases: null text, lang and source are ''; texts without a term give their group
no counts, but the group exists; a language without kept terms has no `term` rows, and
its pairs have the value 0 and stay in item order; repeated rows count again; an empty table gives an
empty result; equal values rank by the UTF-8 bytes of the item; extra columns are not read; a very long text is
counted in pieces of ``PIECE`` bytes, cut between terms.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glean.llm.common import rows_of, save, table
from glean.llm.registry import query

MIN_DOCS = 30
SCALE, PRIOR, TOP = 1_000_000_000, 5, 50
#: Terms of one transducer; bytes of transducers broadcast at once; ordinals compared at once.
CHUNK, ROUND_BYTES, BLOCK = 1 << 16, 64 << 20, 1024
#: Distinct (group, term) counts that a task holds before it sends them on; bytes of text split at once.
HELD, PIECE = 1 << 19, 1 << 20

#: Bytes to terms: A-Z lower-cased, other ASCII but letters to spaces, the rest as it is.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None):
    """Lists of the text's terms (bytes), a piece of the text at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(data):
        end = len(data) if at + PIECE >= len(data) else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


# ---------------------------------------------------------------- vocabulary


def _document_frequencies(batches):
    """(lang, term, n): documents of this task that hold the term, in bounded parts."""
    held: dict[str, Counter] = {}

    def flush():
        for lang in list(held):
            counts = held.pop(lang)
            n = len(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))), pa.array(counts.keys(), pa.binary(), size=n).cast(pa.string()),
                                              pa.array(np.fromiter(counts.values(), np.int64, n))], ["lang", "term", "n"])

    for b in batches:
        for lang, text in rows_of(b, "lang", "text"):
            held.setdefault(lang, Counter()).update(set().union(*terms(text)))
            if sum(map(len, held.values())) > HELD:
                yield from flush()
    yield from flush()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term: the vocabulary of each language."""
    found = texts(docs).select("lang", "text").mapInArrow(_document_frequencies, "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("lang", "term")


class Transducer:
    """A minimal acyclic transducer from terms (bytes) to their ranks.

    Edges of state s are ``first[s]:first[s + 1]`` of ``label``, ``target`` and ``before``
    (the terms that come before those of this edge); state 0 is where terms begin.
    """

    def __init__(self, first, label, target, before, final):
        self.first, self.label, self.target, self.before, self.final = first, label, target, before, final

    @classmethod
    def build(cls, sorted_terms: list[bytes]) -> Transducer:
        register: dict[tuple, int] = {}
        edges: list[tuple] = []  # of finished states: ((label, target), ...)
        finals: list[bool] = []
        sizes: list[int] = []  # terms that a finished state accepts
        path: list[list] = [[False, []]]  # unfinished states along the last term: [final, edges]
        last = b""

        def finish(depth):
            while len(path) > depth + 1:
                final, out = path.pop()
                key = (final, tuple(out))
                state = register.get(key)
                if state is None:
                    state = register[key] = len(edges)
                    edges.append(key[1])
                    finals.append(final)
                    sizes.append(final + sum(sizes[t] for _, t in out))
                path[-1][1].append((last[len(path) - 1], state))

        for term in sorted_terms:
            shared = 0
            while shared < min(len(term), len(last)) and term[shared] == last[shared]:
                shared += 1
            finish(shared)
            path.extend([False, []] for _ in range(len(term) - shared))
            path[-1][0] = True
            last = term
        finish(0)
        edges.append(tuple(path[0][1]))
        finals.append(path[0][0])
        flip = len(edges) - 1  # the start, finished last, becomes state 0
        label, target, before, first = bytearray(), [], [], [0]
        for state in range(flip, -1, -1):
            count = int(finals[state])
            for c, t in edges[state]:
                label.append(c)
                target.append(flip - t)
                before.append(count)
                count += sizes[t]
            first.append(len(target))
        return cls(np.array(first, np.int32), bytes(label), np.array(target, np.int32), np.array(before, np.int32), np.array(finals[::-1], np.uint8))

    def rank(self, term: bytes) -> int:
        """The term's rank, -1 if it isn't one of the transducer's."""
        first, label, target, before = self.first, self.label, self.target, self.before
        state = rank = 0
        for c in term:
            e = label.find(c, first[state], first[state + 1])
            if e < 0:
                return -1
            rank += before[e]
            state = target[e]
        return int(rank) if self.final[state] else -1

    def terms(self):
        """All terms in order."""
        stack = [(0, b"")]
        while stack:
            state, term = stack.pop()
            if self.final[state]:
                yield term
            for e in range(int(self.first[state + 1]) - 1, int(self.first[state]) - 1, -1):
                stack.append((int(self.target[e]), term + self.label[e:e + 1]))

    def to_bytes(self) -> bytes:
        head = np.array([len(self.final), len(self.label)], np.int32)
        return b"".join([head.tobytes(), self.first.tobytes(), self.target.tobytes(), self.before.tobytes(), self.final.tobytes(), self.label])

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        states, edges = np.frombuffer(data, np.int32, 2).tolist()
        at, parts = 8, []
        for n in (states + 1, edges, edges):
            parts.append(memoryview(data)[at:at + 4 * n].cast("i"))
            at += 4 * n
        return cls(parts[0], data[at + states:], parts[1], parts[2], memoryview(data)[at:at + states])


def _transducers(frames):
    """A row per transducer from terms sorted by (lang, term)."""
    lang, held = None, []

    def one():
        return {"lang": lang, "low": held[0], "n": len(held), "data": Transducer.build(held).to_bytes()}

    for frame in frames:
        for this, term in zip(frame["lang"], frame["term"]):
            if held and (this != lang or len(held) == CHUNK):
                yield pd.DataFrame([one()])
                held = []
            lang = this
            held.append(term.encode("utf-8", "surrogatepass"))
    if held:
        yield pd.DataFrame([one()])


def transducers(kept: DataFrame) -> DataFrame:
    """lang, low (first term), n (terms), data, base (terms of the language in earlier chunks); one row per chunk."""
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = save(kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
                  .mapInPandas(_transducers, "lang string, low binary, n long, data binary"), "transducers")
    base = chunks.select("lang", "low", (F.sum("n").over(Window.partitionBy("lang").orderBy("low")) - F.col("n")).alias("base"))
    return chunks.join(base, ["lang", "low"])


def _all_terms(frames):
    for frame in frames:
        for lang, base, data in zip(frame["lang"], frame["base"], frame["data"]):
            found = [t.decode("utf-8", "surrogatepass") for t in Transducer.from_bytes(bytes(data)).terms()]
            yield pd.DataFrame({"lang": lang, "ordinal": np.arange(base, base + len(found)), "term": found})


def vocabulary(chunks: DataFrame) -> DataFrame:
    """lang, ordinal, term: the terms read back from the transducers."""
    return chunks.select("lang", "base", "data").mapInPandas(_all_terms, "lang string, ordinal long, term string")


# ---------------------------------------------------------------- recounting


def _recounter(shared):
    """Counts by (lang, source, ordinal) of texts through the transducers of one round; ordinal -1 marks the group."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])

    def run(batches):
        machines: dict[str, list] = {}
        for lang, low, base, data in shared.value:
            machines.setdefault(lang, []).append((low, base, Transducer.from_bytes(data)))
        known: dict[str, dict[bytes, int]] = {}  # kept terms met so far
        held: dict[tuple[str, str], Counter] = {}

        def ordinal(lang, term):
            for low, base, machine in reversed(machines.get(lang, ())):
                if low <= term:
                    rank = machine.rank(term)
                    return -1 if rank < 0 else base + rank
            return -1

        def flush():
            for lang, source in list(held):
                counts = held.pop((lang, source))
                memo = known.setdefault(lang, {})
                if len(memo) > HELD:
                    memo.clear()
                ordinals = list(map(memo.get, counts))
                for i, term in enumerate(counts):
                    if ordinals[i] is None:
                        ordinals[i] = k = ordinal(lang, term)
                        if k >= 0:
                            memo[term] = k
                ordinals = np.array(ordinals, np.int64)
                kept = ordinals >= 0
                ordinals = np.append(ordinals[kept], -1)  # -1: the group itself
                numbers = np.append(np.fromiter(counts.values(), np.int64, len(counts))[kept], 0)
                same = pa.array(np.zeros(len(ordinals), np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(same), pa.array([source], pa.string()).take(same),
                                                  pa.array(ordinals), pa.array(numbers)], schema=schema)

        for b in batches:
            for lang, source, text in rows_of(b, "lang", "source", "text"):
                counts = held.setdefault((lang, source), Counter())
                for piece in terms(text):
                    counts.update(piece)
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return run


def recount(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """lang, source, ordinal, n: occurrences of each kept term in each group (ordinal -1: the group itself, n 0)."""
    spark = docs.sparkSession
    plan = chunks.select("lang", "low", F.length("data").alias("size")).orderBy("lang", "low").collect()  # a row per CHUNK terms
    rounds, size = [[]], 0
    for r in plan:
        if rounds[-1] and size + r["size"] > ROUND_BYTES:
            rounds.append([])
            size = 0
        rounds[-1].append((r["lang"], r["low"]))
        size += r["size"]
    parts = []
    for members in rounds:
        data = []
        if members:
            (l0, t0), (l1, t1) = members[0], members[-1]
            inside = ((F.col("lang") > l0) | ((F.col("lang") == l0) & (F.col("low") >= F.lit(bytes(t0))))) & (
                (F.col("lang") < l1) | ((F.col("lang") == l1) & (F.col("low") <= F.lit(bytes(t1)))))
            data = [(r["lang"], bytes(r["low"]), r["base"], bytes(r["data"]))  # at most ROUND_BYTES
                    for r in chunks.filter(inside).select("lang", "low", "base", "data").orderBy("lang", "low").collect()]
        shared = spark.sparkContext.broadcast(data)
        parts.append(texts(docs).mapInArrow(_recounter(shared), "lang string, source string, ordinal long, n long"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return save(found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "recounts")


# ---------------------------------------------------------------- shares and divergences


def share(n: str, total: str, size: str) -> str:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * size)) in exact decimals."""
    return (f"CAST(1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + {PRIOR} AS DECIMAL(20,0))) "
            f"DIV (CAST({total} AS DECIMAL(20,0)) + {PRIOR} * CAST({size} AS DECIMAL(18,0))) AS BIGINT)")


def _compare(key, frame):
    """Sums of |p - q| over a block of ordinals for all pairs of sources; ``frame`` has a row per source."""
    lang, block, width = key
    frame = frame.sort_values("source")
    p = np.repeat(frame["p0"].to_numpy(np.int64)[:, None], width, axis=1)
    for i, (at, values) in enumerate(zip(frame["at"], frame["ps"])):
        if at is not None and len(at):
            p[i, np.asarray(at, np.int64)] = np.asarray(values, np.int64)
    names = frame["source"].to_numpy()
    out = {"source": [], "item": [], "value": []}
    for i in range(len(names)):
        value = np.abs(p - p[i]).sum(axis=1)
        others = np.arange(len(names)) != i
        out["source"].append(np.repeat(names[i], others.sum()))
        out["item"].append(names[others])
        out["value"].append(value[others])
    cat = {c: np.concatenate(v) for c, v in out.items()}
    return pd.DataFrame({"lang": lang, **cat})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: divergence of each source of a language from
    every other one (`pair`) and the terms it has more of than the language (`term`)."""
    chunks = transducers(kept_terms(docs, min_docs))
    chunks = save(chunks, "chunks")
    counts = recount(docs, chunks)
    sizes = chunks.groupBy("lang").agg(F.sum("n").alias("size"))
    zero = F.coalesce("size", F.lit(0)).alias("size")
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(sizes, "lang", "left").select("lang", "source", "total", zero)
    p0 = F.expr(f"CASE WHEN size > 0 THEN {share('0L', 'total', 'size')} ELSE 0 END")
    groups = save(groups.withColumn("p0", p0), "groups")
    real = counts.filter("ordinal >= 0")
    own = real.join(groups, ["lang", "source"]).withColumn("p", F.expr(share("n", "total", "size")))
    own = save(own.select("lang", "source", "ordinal", "p"), "shares")

    blocks = sizes.select("lang", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / BLOCK))).alias("block"))
    blocks = blocks.select("lang", "block", F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK).alias("width"))
    packed = (own.withColumn("block", F.floor(F.col("ordinal") / BLOCK)).groupBy("lang", "source", "block")
              .agg(F.collect_list(F.struct((F.col("ordinal") % BLOCK).alias("at"), "p")).alias("x")))
    dense = (groups.select("lang", "source", "p0").join(blocks, "lang").join(packed, ["lang", "source", "block"], "left")
             .select("lang", "source", "block", "width", "p0", F.col("x.at").alias("at"), F.col("x.p").alias("ps")))
    sums = dense.groupBy("lang", "block", "width").applyInPandas(_compare, "lang string, source string, item string, value long")
    # Every pair of a language is there, also of one without kept terms.
    g = groups.select("lang", "source")
    empty = groups.filter("size = 0").select("lang", "source")
    empty = (empty.join(g.withColumnRenamed("source", "item"), "lang").filter("source <> item")
             .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    pairs = sums.unionByName(empty).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    by = Window.partitionBy("lang", "source")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(by.orderBy(F.desc("value"), "item")).alias("rank"))

    lang_total = real.groupBy("lang").agg(F.sum("n").alias("total"))
    whole = real.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(lang_total, "lang").join(sizes, "lang")
    whole = whole.select("lang", "ordinal", F.expr(share("n", "total", "size")).alias("q"))
    more = own.join(whole, ["lang", "ordinal"]).filter("p > q").withColumn("value", F.col("p") - F.col("q"))
    more = more.withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "ordinal"))).filter(F.col("rank") <= top)
    named = more.join(vocabulary(chunks), ["lang", "ordinal"])
    found = named.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(found)


_ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
             regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
v AS (SELECT lang, term FROM o GROUP BY lang, term HAVING COUNT(DISTINCT k) >= 30),
c AS (SELECT lang, source, term, COUNT(*) AS n FROM o JOIN v USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (SELECT g.lang, g.source, v.term, COALESCE(c.n, 0) AS n FROM g JOIN v ON g.lang = v.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (SUM(n) OVER (PARTITION BY lang, source) + 5 * COUNT(*) OVER (PARTITION BY lang, source)) AS p FROM f),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (SUM(n) OVER (PARTITION BY lang) + 5 * COUNT(*) OVER (PARTITION BY lang)) AS q
      FROM (SELECT lang, term, SUM(n) AS n FROM f GROUP BY lang, term)),
s AS (SELECT a.lang, a.source, b.source AS item, CAST(COALESCE(SUM(abs(a.p - b.p)), 0) AS BIGINT) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, b.source AS item, COALESCE(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
t AS (SELECT p.lang, p.source, p.term AS item, CAST(p.p - l.q AS BIGINT) AS value FROM p JOIN l USING (lang, term) WHERE p.n > 0 AND p.p > l.q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM t) WHERE rank <= 50
"""


@query("op13_term_divergence", _ORACLE)
def op13_term_divergence(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))
