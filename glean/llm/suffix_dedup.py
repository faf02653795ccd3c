"""Suffix-array dedup: remove every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Strings of LENGTH bytes ("windows") of all documents are compared, without a table of all of them:

1. A window's anchor is the position, among its first ``SPAN``, with the smallest hash
   of 8 bytes (the leftmost of equal ones). It depends on the window's bytes alone, so
   equal windows have their anchors at the same place. Windows with one anchor are
   consecutive: a run. Runs meet by the ``LENGTH - SPAN + 1`` bytes that follow the
   anchor in every window of theirs; most meet no other.
2. Runs with equal bytes are one context and all their windows repeat.
3. The other contexts that met are sorted in blocks by a suffix array (lyndon.py) over
   phrases: starts chosen by content, again by smallest hashes, spelled by fixed
   ``PHRASE`` bytes, so the order of phrase sequences is the order of their bytes.
   Longest common prefixes in bytes give, for any length, the classes of suffixes that
   agree so far; a window repeats if another one has the class of its first phrase
   start and the same bytes before it.
4. More than ``HOT`` contexts of one key (1 MB of text) would make a block too large. They
   are cut in two pieces, by how far before the anchor a window starts: the far half
   share more bytes before the anchor, the near half more bytes after it, and pieces meet
   again by all the bytes that their windows must share. Equal pieces repeat whole and
   one of them goes on; a piece alone in its group has nothing to repeat; groups of up to
   ``HOT`` pieces are sorted as above, larger ones are halved again, at most 8 times, until
   each holds one window.

Joins on keys, contexts and pieces deal the rows of a value with more than ``COMMON``
of them to several tasks (a line repeated all over has one key).

Anchors, contexts and pieces are told apart by 64-bit hashes within groups that
agree on another 64-bit hash. Equal texts, told apart from others by two hashes (96
bits), share their ranges. Repeated rows are copies of each other. Null and empty
texts have nothing to remove; texts shorter than LENGTH stay whole; a doc_id may be
null or repeated.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glean.llm.common import _BYTE, _powers, blocks, save, splitmix, table, text_buffer, with_columns_of
from glean.llm.lyndon import suffix_order
from glean.llm.registry import query

LENGTH, SPAN = 400, 192
KEY = LENGTH - SPAN + 1
PHRASE_SPAN = 64
PHRASE = PHRASE_SPAN + 8
HOT, BLOCK_CONTEXTS = 2000, 1000
COMMON = 2000
_LOW = np.uint64(0xFFFFFFFF)


def _eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as an integer (zeros follow the end)."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf),), "<u8", buffer=padded.data, strides=(1,))


def smallest(buf: np.ndarray, span: int, seed: int) -> np.ndarray:
    """For each position the one, among it and the following ``span - 1``, with the smallest hash of 8 bytes."""
    n = len(buf)
    h = _eights(buf) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h &= ~_LOW
    h |= np.arange(n, dtype=np.uint64)
    rows = -(-(n + span) // span)
    grid = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = h
    grid = grid.reshape(rows, span)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return (np.minimum(ahead[:n], behind[span - 1:span - 1 + n]) & _LOW).astype(np.int64)


class Hashes:
    """64-bit hashes of any stretch of a buffer."""

    def __init__(self, buf: np.ndarray, seed: int):
        self.up, self.down = _powers(len(buf) + 1)
        self.total = np.zeros(len(buf) + 1, np.uint64)
        letter = splitmix(_BYTE + np.uint64(seed)) | np.uint64(1)
        np.cumsum(letter[buf] * self.up[:len(buf)], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return splitmix((self.total[end] - self.total[start]) * self.down[start])


def runs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """row, anchor, first and last window start of each run (positions in the buffer)."""
    size = np.diff(off)
    long_ = np.flatnonzero(size >= LENGTH)
    if not len(long_):
        return (np.zeros(0, np.int64),) * 4
    count = size[long_] - LENGTH + 1
    row = np.repeat(long_, count)
    start = np.arange(count.sum()) + np.repeat(off[long_] - (np.cumsum(count) - count), count)
    anchor = smallest(buf, SPAN, 1)[start]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(row) != 0)]))
    last = np.concatenate([new[1:] - 1, [len(start) - 1]])
    return row[new], anchor[new], start[new], start[last]


_RUNS = "th bigint, tc bigint, key bigint, ctx bigint, anchor int, lo int, hi int"


def _runs_of(batches):
    seen: dict[int, int] = {}
    for b in batches:
        ths, tcs = b.column("th").to_numpy(zero_copy_only=False), b.column("tc").to_numpy(zero_copy_only=False)
        for i, j, buf, off in blocks(b.column("text")):
            row, anchor, lo, hi = runs(buf, off)
            # copies within a task: two of them say all that more would
            fresh = np.zeros(j - i, bool)
            for k, th in enumerate(ths[i:j].tolist()):
                n = seen.get(th, 0)
                fresh[k] = n < 2
                seen[th] = n + 1
            if len(seen) > 1 << 18:
                seen.clear()
            use = fresh[row]
            row, anchor, lo, hi = row[use], anchor[use], lo[use], hi[use]
            if not len(row):
                continue
            h = Hashes(buf, 1)
            key = h(anchor, anchor + KEY)
            ctx = splitmix(h(lo, hi + LENGTH) + splitmix(((anchor - lo) * 4096 + hi - lo).astype(np.uint64)))
            at = off[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ths[i:j][row], pa.int64()), pa.array(tcs[i:j][row], pa.int64()),
                 pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)),
                 *[pa.array((x - at).astype(np.int32)) for x in (anchor, lo, hi)]],
                ["th", "tc", "key", "ctx", "anchor", "lo", "hi"])


def phrases(buf: np.ndarray, off: np.ndarray) -> dict:
    """Suffix array over the phrase starts of the strings buf[off[k]:off[k + 1]].

    Returns positions (``pos``), ``rank`` (place in the order) and ``lcp`` (bytes in
    common with the one before in the order) of the starts, and for each position of
    the buffer the start it belongs to (``of``)."""
    n = len(buf)
    of = smallest(buf, PHRASE_SPAN, 2)
    # the smallest among the first positions must not be looked for beyond the string
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    valid = np.arange(n) + PHRASE <= off[owner + 1]
    pos = np.unique(of[valid])
    left = off[owner[pos] + 1] - pos
    wide = np.zeros((len(pos), PHRASE + 1), np.uint8)
    padded = np.concatenate([buf, np.zeros(PHRASE, np.uint8)])
    wide[:, :PHRASE] = padded[pos[:, None] + np.arange(PHRASE)]
    size = np.minimum(left, PHRASE)
    wide[:, :PHRASE][np.arange(PHRASE) >= size[:, None]] = 0
    wide[:, PHRASE] = size
    _, symbol = np.unique(np.ascontiguousarray(wide).view(f"S{PHRASE + 1}").ravel(), return_inverse=True)
    # one text: each string's symbols and an end mark (1), in the end 0
    string = owner[pos]
    shift = np.arange(len(pos)) + string  # a mark behind each string before
    total = len(pos) + len(off) - 1
    text = np.ones(total + 1, np.int64)
    text[shift] = symbol + 2
    text[-1] = 0
    where = np.zeros(total + 1, np.int64)
    ends = np.ones(total, bool)
    ends[shift] = False
    where[shift] = pos
    where[:total][ends] = off[1:]
    order = suffix_order(text)
    order = order[text[order] >= 2]
    # bytes in common with the one before
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(order), np.int64)
    step = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        same = (text[a[live] + step[live]] == text[b[live] + step[live]]) & (text[a[live] + step[live]] >= 2)
        live = live[same]
        step[live] += 1
    back = np.full(total + 1, -1)
    back[shift] = np.arange(len(pos))
    ta, tb = back[a + step], back[b + step]
    both = (ta >= 0) & (tb >= 0)
    common = np.zeros(len(a), np.int64)
    ra, rb = wide[ta[both], :PHRASE], wide[tb[both], :PHRASE]
    differ = ra != rb
    common[both] = np.where(differ.any(1), differ.argmax(1), PHRASE)
    common[both] = np.minimum(common[both], np.minimum(size[ta[both]], size[tb[both]]))
    lcp[1:] = where[a + step] - where[a] + common
    rank = np.empty(len(pos), np.int64)
    rank[back[order]] = np.arange(len(order))
    return {"pos": pos, "rank": rank, "lcp": lcp, "of": of}


def repeated_windows(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions where a window starts that starts at another position too; strings are at least LENGTH long."""
    p = phrases(buf, off)
    size = np.diff(off)
    count = size - LENGTH + 1
    start = np.arange(count.sum()) + np.repeat(off[:-1] - (np.cumsum(count) - count), count)
    first = p["of"][start]
    rank = p["rank"][np.searchsorted(p["pos"], first)]
    before = first - start
    need = LENGTH - before
    lcp = np.append(p["lcp"], 0)
    some = np.maximum(lcp[rank], lcp[rank + 1]) >= need
    start, first, rank, before = start[some], first[some], rank[some], before[some]
    h = Hashes(buf, 3)
    out = []
    by = np.argsort(before, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(before[by])) + 1, [len(by)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        w = by[a:b]
        cls = np.cumsum(p["lcp"] < LENGTH - before[w[0]])[rank[w]]
        lead = h(start[w], first[w])
        order = np.lexsort((lead, cls))
        same = (cls[order][1:] == cls[order][:-1]) & (lead[order][1:] == lead[order][:-1])
        again = np.zeros(len(w), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        out.append(start[w[again]])
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


_RANGES = "key bigint, ctx bigint, a int, b int"


def _ranges(key, ctx, string, start) -> pd.DataFrame:
    """Consecutive starts of each string as ranges."""
    if not len(start):
        return pd.DataFrame({"key": np.zeros(0, np.int64), "ctx": np.zeros(0, np.int64), "a": np.zeros(0, np.int32), "b": np.zeros(0, np.int32)})
    new = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(string) != 0)]))
    last = np.concatenate([new[1:] - 1, [len(start) - 1]])
    return pd.DataFrame({"key": key[string[new]], "ctx": ctx[string[new]], "a": start[new].astype(np.int32), "b": start[last].astype(np.int32)})


def sort_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of a block of contexts or pieces of them (key, ctx, shift, bytes), relative to the context."""
    pdf = pdf.sort_values(["key", "ctx", "shift"], kind="stable")
    buf, off = text_buffer(pa.array(pdf["bytes"], pa.binary()))
    buf, off = buf[off[0]:off[-1]], off - off[0]
    start = repeated_windows(buf, off)
    string = np.searchsorted(off, start, side="right") - 1
    return _ranges(pdf["key"].to_numpy(), pdf["ctx"].to_numpy(), string, start - off[string] + pdf["shift"].to_numpy()[string])


_PIECES = "key bigint, ctx bigint, grp bigint, piece bigint, shift int, before int, low int, high int, bytes binary"


def _halves(batches):
    """Each piece cut in two.

    A piece is ``bytes`` from ``shift`` of a context, its anchor is at ``before``, and its
    windows start ``low`` to ``high`` bytes before the anchor. So each of them has ``low``
    bytes before the anchor and ``SPAN - 1 - high`` after its KEY bytes: pieces of a group
    agree on these."""
    for b in batches:
        cols = {c: b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "ctx", "grp", "shift", "before", "low", "high")}
        for i, j, buf, off in blocks(b.column("bytes")):
            key, ctx, grp, shift, before, low, high = [v[i:j] for v in cols.values()]
            anchor = off[:-1] + before
            after = off[1:] - anchor - KEY
            mid = (low + high + 1) // 2
            h, h2, raw = Hashes(buf, 4), Hashes(buf, 5), buf.tobytes()
            for least, most in ((low, mid - 1), (mid, high)):
                use = np.flatnonzero((least <= most) & (before >= least) & (after >= SPAN - 1 - most))
                lo, hi, at = least[use], most[use], anchor[use]
                lead = np.minimum(before[use], hi)
                start, end = at - lead, at + KEY + np.minimum(after[use], SPAN - 1 - lo)
                group = splitmix(h(at - lo, at + KEY + SPAN - 1 - hi) + splitmix(grp[use].view(np.uint64) + (lo * 4096 + hi).astype(np.uint64)))
                piece = splitmix(h2(start, end) + splitmix(lead.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[use]), pa.array(ctx[use]), pa.array(group.view(np.int64)), pa.array(piece.view(np.int64)),
                     *[pa.array(x.astype(np.int32)) for x in (shift[use] + start - off[use], lead, lo, hi)],
                     pa.array([raw[x:y] for x, y in zip(start.tolist(), end.tolist())], pa.binary())],
                    ["key", "ctx", "grp", "piece", "shift", "before", "low", "high", "bytes"])


def _cut_contexts(batches):
    for b in batches:
        texts, wanted = b.column("text").cast(pa.large_binary()), b.column("wanted")
        for k in range(b.num_rows):
            text, rows = texts[k].as_py() or b"", wanted[k].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["key"] for r in rows], pa.int64()), pa.array([r["ctx"] for r in rows], pa.int64()),
                 pa.array([r["anchor"] - r["lo"] for r in rows], pa.int32()),
                 pa.array([text[r["lo"]:r["hi"] + LENGTH] for r in rows], pa.binary())], ["key", "ctx", "before", "bytes"])


def _removed(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            cols: list[list] = [[], [], [], [], []]
            for text, ranges in zip(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("ranges").to_pylist()):
                text = text or b""
                kept, last, spans, end = [], 0, 0, -1
                for r in sorted(ranges or [], key=lambda r: r["a"]):
                    a, e = r["a"], min(len(text), r["b"] + LENGTH)
                    if a > end:
                        kept.append(text[last:a])
                        spans += 1
                    end = max(end, e)
                    last = end
                kept = b"".join(kept) + text[last:]
                for c, v in zip(cols, (len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())], names)


def meet(rows: DataFrame, counts: DataFrame, on: list[str], deal: list[str]) -> DataFrame:
    """``rows`` joined with ``counts`` (a row per value of ``on``; ``n``: its number in ``rows``).

    A value with more than COMMON rows is dealt to several tasks by the hash of ``deal``;
    at most one row in COMMON can name such a value, so their list is broadcast."""
    n_parts = F.ceil(F.col("n") / COMMON)
    common = counts.filter(F.col("n") > COMMON).select(*[F.col(c).alias(f"common_{c}") for c in on], n_parts.alias("n_parts"))
    same = functools.reduce(lambda x, y: x & y, [F.col(c) == F.col(f"common_{c}") for c in on])
    part = F.coalesce(F.pmod(F.xxhash64(*deal), F.col("n_parts")), F.lit(0).cast("bigint"))
    dealt = rows.join(F.broadcast(common), same, "left").withColumn("part", part).select(*rows.columns, "part")
    spread = counts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), n_parts - 1))).drop("n")
    return dealt.join(spread, [*on, "part"]).drop("part")


def halved(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Crowded pieces cut in two: the ranges of those equal to another one, and one of each that has others in
    its group (``crowded``: more than HOT, and their windows still start at several distances)."""
    halves = save(pieces.mapInArrow(_halves, _PIECES), "halves")
    same = save(halves.groupBy("grp", "piece").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "ctx", "shift")).alias("at"), *[F.min(c).alias(c) for c in ("before", "low", "high", "bytes")]), "pieces")
    groups = save(same.groupBy("grp").agg(F.count("*").alias("n")).filter("n > 1").withColumn("many", F.col("n") > HOT), "groups")
    left = (meet(same.drop("n"), groups, ["grp"], ["piece"])
            .select("at.key", "at.ctx", "grp", "at.shift", "before", "low", "high", "bytes", (F.col("many") & (F.col("low") < F.col("high"))).alias("crowded")))
    last = (F.col("shift") + F.octet_length("bytes") - LENGTH).alias("b")
    whole = meet(halves.select("grp", "piece", "key", "ctx", F.col("shift").alias("a"), last), same.filter("n > 1").select("grp", "piece", "n"), ["grp", "piece"], ["key", "ctx"])
    return whole.select("key", "ctx", "a", "b"), save(left, "left")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """th, tc, ranges (first and last start, in bytes, of consecutive repeated windows) of the texts with any; ``docs`` has text, th, tc."""
    long_ = docs.select("text", "th", "tc").filter(F.octet_length("text") >= LENGTH)
    found = long_.mapInArrow(_runs_of, _RUNS)
    keys = found.groupBy("key").agg(F.count("*").alias("n"), (F.min("ctx") != F.max("ctx")).alias("mixed")).filter("n > 1")
    met = save(meet(found, save(keys, "keys"), ["key"], ["th", "tc", "lo"]), "runs")
    contexts = save(met.filter("mixed").groupBy("key", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("th", "tc", "lo", "hi", "anchor")).alias("at")), "contexts")
    wanted = contexts.groupBy("at.th", "at.tc").agg(F.collect_list(F.struct("key", "ctx", F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"), F.col("at.anchor").alias("anchor"))).alias("wanted"))
    cut = (long_.join(wanted, ["th", "tc"]).select("text", "wanted")
           .mapInArrow(_cut_contexts, "key bigint, ctx bigint, before int, bytes binary").groupBy("key", "ctx").agg(F.min("before").alias("before"), F.min("bytes").alias("bytes")))
    cut = save(cut, "context-bytes")
    hot = F.broadcast(cut.groupBy("key").agg(F.count("*").alias("n_ctx")).filter(F.col("n_ctx") > HOT).select("key"))
    pieces = cut.select("key", "ctx", F.col("key").alias("grp"), F.lit(0).alias("shift"), "before", F.lit(0).alias("low"), F.lit(SPAN - 1).alias("high"), "bytes")
    to_sort, crowded, found_ = pieces.join(hot, "key", "left_anti"), pieces.join(hot, "key", "left_semi"), []
    while not crowded.isEmpty():
        whole, left = halved(crowded)
        found_.append(whole)
        to_sort = to_sort.unionByName(left.filter("not crowded").drop("crowded"))
        crowded = left.filter("crowded").drop("crowded")
    n_blocks = max(1, -(-to_sort.count() // BLOCK_CONTEXTS))
    found_.append(to_sort.withColumn("block", F.pmod(F.xxhash64("grp"), F.lit(n_blocks)))
                  .select("block", "key", "ctx", "shift", "bytes").groupBy("block").applyInPandas(sort_block, _RANGES))
    windows = save(functools.reduce(DataFrame.unionByName, found_), "windows")
    parts = windows.groupBy("key", "ctx").agg(F.collect_list(F.struct("a", "b")).alias("parts"))
    marks = save(contexts.select("key", "ctx", "n").join(parts, ["key", "ctx"], "left").filter("n > 1 or parts is not null")
                 .withColumn("whole", F.col("n") > 1), "marks")
    all_ = F.array(F.struct(F.col("lo").alias("a"), F.col("hi").alias("b")))
    simple = met.filter("not mixed").select("th", "tc", all_.alias("r"))
    other = meet(met.filter("mixed"), marks, ["key", "ctx"], ["th", "tc", "lo"]).select(
        "th", "tc", F.when(F.col("whole"), all_).otherwise(
            F.transform("parts", lambda p: F.struct((p["a"] + F.col("lo")).alias("a"), (p["b"] + F.col("lo")).alias("b")))).alias("r"))
    # A range as one number: distinct numbers are found by hash, distinct structs by comparing all pairs.
    packed = F.transform("r", lambda x: F.shiftleft(x["a"].cast("long"), 32) + x["b"])
    distinct = F.array_distinct(F.flatten(F.collect_list("p")))
    back = F.transform(distinct, lambda y: F.struct(F.shiftright(y, 32).cast("int").alias("a"), y.bitwiseAND((1 << 32) - 1).cast("int").alias("b")))
    return simple.unionByName(other).select("th", "tc", packed.alias("p")).groupBy("th", "tc").agg(back.alias("ranges"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row."""
    docs = with_columns_of(docs, ["doc_id", "text"]).withColumn("th", F.xxhash64("text")).withColumn("tc", F.crc32(F.col("text").cast("binary")))
    joined = docs.join(repeated_ranges(docs), ["th", "tc"], "left")
    return joined.select("doc_id", "text", "ranges").mapInArrow(
        _removed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
