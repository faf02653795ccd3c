"""Periodic runs of words, found in scale tiles.

A run is a maximal stretch of consecutive words with smallest period q and at least
``max(MIN_WORDS, 2 * q)`` words. For a period p, the words i with ``x[i] == x[i + p]``
form maximal intervals; a run of n words with period p is an interval of n - p.

1. Tiles. For each octave of periods [2^k, 2^(k+1)), boundaries lie every s words, s
   being no longer than the shortest interval of the octave, so each interval holds a
   boundary. The tile of boundary c is x[c - s : c + s + 2^(k+1)]. A boundary matters
   only if half a step of words on either side recurs p words on; rolling hashes drop
   the others (equal words hash alike, so none that matters is lost). Tiles of
   consecutive boundaries go out as rows of bounded size, with the words themselves as
   numbers, and are shuffled on their own: tiles of a long document lie in many tasks.
2. Each tile is solved by Z-functions of the words after and (reversed) before its boundary. They tell how
   far x and x shifted by p agree around the boundary, up to a step on either side: a fragment of an interval.
3. Fragments are shuffled by (document, period) and overlapping or touching ones
   stitched into whole intervals. Of intervals with the same ends the smallest period
   stays (by periodicity, a larger one is its multiple).

A word is dropped if a run contains it after the run's first q words: one period stays.

Edge cases: null and empty texts have no words and no runs; ties of the longest run go
to the smallest start, then period; repeated rows (also of one doc_id) are handled row
by row; null doc_ids stay; an empty table gives an empty result; extra columns are not
read. A text is tiled in one task (memory: some 60 bytes per byte of a text over ``BLOCK_BYTES``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glean.llm.common import blocks, rows_of, save, splitmix, table, word_hashes, words
from glean.llm.registry import query

MIN_WORDS = 12
#: Words (with overlaps) from which on consecutive boundaries of one octave are cut into rows.
ROW_WORDS = 1 << 14


def shortest(p: int) -> int:
    """The shortest interval of period p that makes a run."""
    return max(MIN_WORDS - p, p)


def step_of(octave: int) -> int:
    """Distance of boundaries: a power of two, at most the shortest interval of the octave."""
    low = min(shortest(p) for p in range(1 << octave, min(2 << octave, (1 << octave) + MIN_WORDS)))
    return 1 << (low.bit_length() - 1)


# ---------------------------------------------------------------- tiles


def _longer(grams: np.ndarray, by: int) -> np.ndarray:
    """Hashes of the words of each gram and of the gram ``by`` words on."""
    return splitmix(grams[:-by] * np.uint64(0x9E3779B97F4A7C15) + grams[by:]) if len(grams) > by else grams[:0]


def _grams(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each position on."""
    out, have = h, 1
    while have < width:
        take = min(have, width - have)
        out, have = _longer(out, take), have + take
    return out


def boundaries(h: np.ndarray, octave: int, grams: np.ndarray) -> np.ndarray:
    """Multiples of the step around which an interval of the octave may lie.

    ``h`` are hashes of words (salted by document); ``grams`` hash half a step of words from each position on.
    """
    n, s, low = len(h), step_of(octave), 1 << octave
    if octave < 3:  # every position, over the whole shortest interval
        found = []
        for p in range(low, 2 * low):
            width = shortest(p)
            g = _grams(h, width)
            at = np.flatnonzero(g[:-p] == g[p:]) if len(g) > p else np.zeros(0, np.int64)
            found += [first * s for first in (-(-at // s) + k for k in range(-(-width // s)))]
        c = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return c[c < n]
    half = s // 2  # here s == low: position c + p is in the next row of boundaries
    hits = np.zeros(-(-n // s), bool)
    for back in (0, half):  # half a step after the boundary, half a step before it
        g = grams[s - back:] if back else grams
        rows = len(g) // s
        if rows > 1:
            t = g[:rows * s].reshape(rows, s)
            same = (t[1:] == t[:-1, :1]).any(axis=1)
            hits[np.flatnonzero(same) + (1 if back else 0)] = True
        if rows and len(g) > rows * s:  # the last, partial row
            if (g[rows * s:] == g[(rows - 1) * s]).any():
                hits[rows - 1 + (1 if back else 0)] = True
    return np.flatnonzero(hits) * s


def tiles(h: np.ndarray, row: np.ndarray):
    """(octave, document, its boundaries) of a block: ``h`` hashes and ``row`` the document of each word."""
    longest = int(np.bincount(row).max(initial=0)) if len(row) else 0
    octave, grams = 0, None
    while 2 << octave <= longest:
        s = step_of(octave)
        if octave >= 3:
            grams = _grams(h, s // 2) if grams is None else _longer(grams, s // 4)
        c = boundaries(h, octave, grams)
        if len(c):
            # A boundary is looked at from the documents on both sides of it: tiles don't leave their document.
            of = row[c]
            before = row[np.maximum(c - 1, 0)]
            c, of = np.concatenate([c, c[before != of]]), np.concatenate([of, before[before != of]])
            order = np.lexsort((c, of))
            c, of = c[order], of[order]
            for part in np.split(np.arange(len(c)), np.flatnonzero(np.diff(of)) + 1):
                yield octave, int(of[part[0]]), c[part]
        octave += 1


_TILED = "key long, doc_id string, n long, text string, octave int, first long, count int, low long, words binary"


def _tiler(texts: bool):
    """Documents (n, text) and tile rows (octave .. words) of each batch; a document without tiles has its result as text."""
    names = ["key", "doc_id", "n", "text", "octave", "first", "count", "low", "words"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches):
        for b in batches:
            keys, ids = b.column("key").to_pylist(), b.column("doc_id").to_pylist()
            for i, j, buf, off in blocks(b.column("text")):
                starts, ends, row = words(buf, off)
                counts = np.bincount(row, minlength=j - i)
                begin = np.concatenate([[0], np.cumsum(counts)]).tolist()
                h = splitmix(word_hashes(buf, starts, ends) ^ (row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
                out, tiled = [], set()
                for octave, d, c in tiles(h, row):
                    tiled.add(d)
                    s, high = step_of(octave), 2 << octave
                    d0, d1 = begin[d], begin[d + 1]
                    most = max(1, (ROW_WORDS - s - high) // s)
                    cuts = np.flatnonzero(np.diff(c) != s) + 1
                    for run_ in np.split(c, cuts):
                        for k in range(0, len(run_), most):
                            part = run_[k:k + most]
                            low, top = max(d0, int(part[0]) - s), min(d1, int(part[-1]) + s + high)
                            number: dict[bytes, int] = {}
                            code = [number.setdefault(buf[a:e].tobytes(), len(number)) for a, e in zip(starts[low:top].tolist(), ends[low:top].tolist())]
                            out.append((keys[i + d], None, None, None, octave, int(part[0]) - d0, len(part), low - d0, np.array(code, np.int32).tobytes()))
                for d in range(j - i):
                    parts = buf[off[d]:off[d + 1]].tobytes().split()
                    whole = b" ".join(parts)
                    text = whole.decode() if texts or d in tiled else hashlib.sha256(whole).hexdigest()
                    out.append((keys[i + d], ids[i + d], len(parts), text, -2 if d in tiled else -1, None, None, None, None))
                for k in range(0, len(out), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k:k + 1024]), types)], names)

    return run


# ---------------------------------------------------------------- solving a tile


def _same(x: np.ndarray, i: int, j: int) -> int:
    """How many words agree from i and j (> i) on."""
    n, size, k = len(x), 16, 0
    while j + k < n:
        m = min(size, n - j - k)
        differ = x[i + k:i + k + m] != x[j + k:j + k + m]
        at = int(differ.argmax())
        if differ[at]:
            return k + at
        k += m
        size *= 4
    return k


def z_function(x: np.ndarray) -> dict[int, int]:
    """{i: the longest common prefix of x and x[i:]} for the i > 0 where it isn't 0. Linear; words unlike the first are skipped."""
    xs, n, z = x.tolist(), len(x), {}
    if n > 96:
        begins = (np.flatnonzero(x[1:] == x[0]) + 1).tolist()
    else:
        begins = [i for i in range(1, n) if xs[i] == xs[0]]
    left = right = 0
    for i in begins:
        k = 0
        if i < right:
            k = z[i - left]  # x[i - left] is x[0] too
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        few = min(n - i, k + 8)
        while k < few and xs[k] == xs[i + k]:
            k += 1
        if k == few < n - i:
            k += _same(x, k, i + k)
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def fragments(x: np.ndarray, low: int, first: int, count: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of intervals of ``x[i] == x[i + period]`` around ``count`` boundaries; x begins at word ``low``."""
    s, p0, p1 = step_of(octave), 1 << octave, 2 << octave
    n, bar = len(x), np.array([-1])
    open_: dict[int, list[int]] = {}
    out = []
    for c in range(first - low, first - low + count * s, s):
        after = z_function(x[c:c + s + p1])
        back, end = x[max(0, c - s):c][::-1], min(n, c + p1 - 1)
        before = z_function(np.concatenate([back, bar, x[max(0, c - s):end][::-1]])) if len(back) else {}
        past = len(back) + 1 + end - c  # the reversed words begin with word end - 1; the word before c + p is c + p - 1
        for q in {p for p in after if p0 <= p < p1} | {past - at for at in before if p0 <= past - at < p1}:
            f, r = min(after.get(q, 0), s), min(before.get(past - q, 0), s)
            if f == s or r == s or f + r >= shortest(q):
                last = open_.get(q)
                if last and c - r <= last[1]:
                    last[0], last[1] = min(last[0], c - r), max(last[1], c + f)
                else:
                    if last:
                        out.append((q, last[0] + low, last[1] + low))
                    open_[q] = [c - r, c + f]
    return out + [(q, a + low, e + low) for q, (a, e) in open_.items()]


def _solve(batches):
    for b in batches:
        for key, octave, first, count, low, data in rows_of(b, "key", "octave", "first", "count", "low", "words"):
            found = fragments(np.frombuffer(data, np.int32).astype(np.int64), low, first, count, octave)
            for k in range(0, len(found), 1 << 16):
                p, a, e = zip(*found[k:k + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(p), pa.int64()), *[pa.array(v, pa.int64()) for v in (p, a, e)]], ["key", "period", "low", "high"])


# ---------------------------------------------------------------- stitching


def stitch(found: DataFrame) -> DataFrame:
    """key, start, length, period of each run from fragments (key, period, low, high)."""
    order = Window.partitionBy("key", "period").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("low") <= F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = (found.withColumn("reach", reach).withColumn("island", island).groupBy("key", "period", "island")
             .agg(F.min("low").alias("start"), (F.max("high") - F.min("low")).alias("size")))
    whole = whole.filter(F.col("size") >= F.greatest(F.lit(MIN_WORDS) - F.col("period"), F.col("period")))
    return (whole.select("key", "start", (F.col("size") + F.col("period")).alias("length"), "period")
            .groupBy("key", "start", "length").agg(F.min("period").alias("period")))


def _collapser(texts: bool):
    def run(batches):
        names = ["doc_id", "n", "runs", "collapsed"]
        for b in batches:
            out = []
            for doc_id, n, text, runs in rows_of(b, "doc_id", "n", "text", "runs"):
                if runs:
                    parts = text.encode().split()
                    gone = np.zeros(n + 1, np.int32)
                    for r in runs:
                        gone[r["start"] + r["period"]] += 1
                        gone[r["start"] + r["length"]] -= 1
                    keep = np.cumsum(gone[:n]) == 0
                    text = b" ".join([parts[k] for k in np.flatnonzero(keep).tolist()]).decode()
                out.append((doc_id, n, runs or [], text if texts else hashlib.sha256(text.encode()).hexdigest()))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], b.schema.field("runs").type), pa.array(cols[3], pa.string())], names)

    return run


_RUNS = "array<struct<start: long, period: long, length: long>>"


def periodic_runs(docs: DataFrame, texts: bool = True) -> DataFrame:
    """doc_id, n (words), runs (by start, then period) and collapsed: the kept words joined by one space,
    or with ``texts=False`` their SHA-256, so that only texts with tiles are written and shuffled."""
    spark = docs.sparkSession
    read = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tiled = save(read.mapInArrow(_tiler(texts), _TILED), "tiles")
    rows = tiled.filter("octave >= 0").select("key", "octave", "first", "count", "low", "words")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.repartition(parts, "key", "octave", "first").mapInArrow(_solve, "key long, period long, low long, high long")
    runs = stitch(found).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).cast(_RUNS).alias("runs"))
    plain = tiled.filter("octave = -1").select("doc_id", "n", F.array().cast(_RUNS).alias("runs"), F.col("text").alias("collapsed"))
    some = tiled.filter("octave = -2").select("key", "doc_id", "n", "text").join(runs, "key", "left").select("doc_id", "n", "text", "runs")
    done = plain.unionByName(some.mapInArrow(_collapser(texts), f"doc_id string, n long, runs {_RUNS}, collapsed string"))
    return done.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


# ---------------------------------------------------------------- query


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, with every document whose id's CRC-32 divides by 10 rewritten so that its
    words repeat with a period from some word on (as the query's contract says)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    d = docs.select("doc_id", "text", F.when(h % 10 == 0, h).alias("h"))
    d = d.withColumn("w", F.explode(F.array(F.when(F.col("h").isNotNull(), w))))  # computed once
    n = F.size("w").cast("long")
    g = F.floor(F.col("h") / 10)
    a = g % n
    d = d.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, a))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int")
    d = d.withColumn("p", p)
    rest = (F.col("n") - F.col("a")).cast("int")
    cycle = F.slice("w", F.col("a").cast("int") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), again), " ")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def longest(runs: str = "runs") -> Column:
    """The run with the greatest length (ties: smallest start, then period); null without runs."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(looped(table(spark, sf_dir, "documents")), texts=False).withColumn("best", longest())
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    period = -F.col("best.small")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
        F.floor(F.col("best.length") * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
