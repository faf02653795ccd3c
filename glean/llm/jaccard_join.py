"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct shingles of ``WORDS`` words; two sets link when
``100 * intersection >= PERCENT * union``. Exact prefix filtering over one total order
of shingles: frequent ones last (a bounded list of heavy shingles, found over all
documents), all others by hash. Linked sets share a shingle among their first
``n - ceil(PERCENT / 100 * n) + 1``, so index lists are kept for those only.

Two set relations save work:

* Block skipping. A list is cut into blocks of like set sizes; each block knows its
  sizes, its largest number of shingles behind the listed position, and its
  components. A set skips whole blocks whose sizes or positions rule out a link, and
  within a block sets whose positions do.
* Derived answers. Sets of one list are first compared with two hubs of the list only.
  A set that links with a hub has, as far as components go, the answer already
  computed for the hub: all sets linked with either are one component, and pairs
  within a component are never looked up again. A second round takes the set that
  shares most as the hub. Then the lists are read again for pairs of sets from
  different components. What two such sets have in common occurs in more than one
  component; counted by class of hash, those shingles bound the intersection (for
  sets in crowded lists only). Pairs whose bound allows a link are all verified, and so
  are pairs with a set whose shingles are not counted.

So no link between components is lost and no pairs within a group of copies are made.
Equal sets are one set (told apart by a 64-bit hash, as shingles are). Candidates are
verified on the whole texts.

Edge cases: null, empty and blank texts have an empty set and link with nothing; texts
with fewer words than WORDS have their whole word sequence as the one shingle; a null
doc_id links with nothing (component null); repeated rows are copies of each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glean.llm.common import blocks, components, save, splitmix, table, with_columns_of, word_hashes, words
from glean.llm.registry import query

WORDS, PERCENT = 5, 75
#: Bound of the list of heavy shingles (512 kB): it orders shingles, and drops none.
HEAVY = 1 << 16
#: Classes of shingles (by hash) in which shared ones are counted: an upper bound of an intersection.
CLASSES = 32
#: Postings in reach of a posting from which on its set's shared shingles are counted; no pair is left out for it.
CROWD = 64
_STEP = splitmix(np.arange(101, 101 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingles(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    starts, ends, row = words(buf, off)
    h = word_hashes(buf, starts, ends, lower=True)
    n = len(off) - 1
    per_row = np.bincount(row, minlength=n)
    at = np.concatenate([[0], np.cumsum(per_row)])
    mixed = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        mixed += h[k:k + len(mixed)] * _STEP[k]
    mixed = splitmix(mixed)
    windows = np.maximum(per_row - WORDS + 1, 0)
    for a, w in zip(at.tolist(), windows.tolist()):
        mixed[a:a + w].sort()
    of = row[:len(mixed)]
    fresh = np.ones(len(mixed), bool)
    fresh[1:] = (mixed[1:] != mixed[:-1]) | (of[1:] != of[:-1])
    fresh &= np.arange(len(mixed)) - at[of] < windows[of]
    flat = mixed[fresh]
    cut = np.concatenate([[0], np.cumsum(np.bincount(of[fresh], minlength=n))]).tolist()
    out = []
    for k in range(n):
        a, m = at[k], per_row[k]
        if m >= WORDS:
            out.append(flat[cut[k]:cut[k + 1]])
        elif m:
            whole = (h[a:a + m] * _STEP[:m]).sum(dtype=np.uint64) + np.uint64(m)
            out.append(splitmix(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each set, as signed integers."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(splitmix(flat ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    end = np.cumsum(sizes)
    return splitmix(total[end] - total[end - sizes] + sizes.astype(np.uint64)).view(np.int64)


def _sets_and_heavy(batches):
    """Rows of documents (doc_id, n, fp; doc true), then heavy shingles of this task (fp: the shingle, n: its count)."""
    seen: set[int] = set()
    tokens, counts, pending = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def merge():
        nonlocal tokens, counts, pending
        if pending:
            t = np.concatenate([tokens, *pending])
            if not len(t):  # only null, empty or blank texts so far, or a few short ones
                pending = []
                return
            c = np.concatenate([counts, np.ones(sum(map(len, pending)), np.int64)])
            order = np.argsort(t, kind="stable")
            t, c = t[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            tokens, counts, pending = t[first], np.add.reduceat(c, first), []
            if len(tokens) > 1 << 20:  # a summary: rare ones are forgotten
                keep = counts > 1
                tokens, counts = tokens[keep], counts[keep]

    low = np.uint64(int(0.45 * 2 ** 64))  # prefixes hold shingles of small hash
    size = 0
    for b in batches:
        for i, j, buf, off in blocks(b.column("text")):
            sets = shingles(buf, off)
            fps = fingerprints(sets).tolist()
            for s, fp in zip(sets, fps):
                if fp not in seen:
                    seen.add(fp)
                    part = s[:np.searchsorted(s, low)]
                    pending.append(part)
                    size += len(part)
            if size > 1 << 20:
                merge()
                size = 0
            if len(seen) > 1 << 18:
                seen.clear()
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(fps, pa.int64()), pa.array(np.ones(j - i, bool))], ["doc_id", "n", "fp", "doc"])
    merge()
    keep = np.argsort(-counts, kind="stable")[:HEAVY]
    keep = keep[counts[keep] > 2]
    yield pa.RecordBatch.from_arrays([pa.nulls(len(keep), pa.int64()), pa.array(counts[keep]), pa.array(tokens[keep].view(np.int64)),
                                      pa.array(np.zeros(len(keep), bool))], ["doc_id", "n", "fp", "doc"])


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _prefixes(heavy: np.ndarray, rank: np.ndarray, places: bool = True):
    """Postings (token, fp and, with ``places``, n and place in the set's order) of each distinct set;
    ``heavy`` ascending, ``rank`` rarest first."""
    near = np.zeros(1 << 20, bool)  # leading bits of heavy shingles: most others are told apart by them
    near[heavy >> np.uint64(44)] = True

    def hot_places(flat):
        out = np.zeros(len(flat), bool)
        if len(heavy):
            maybe = np.flatnonzero(near[flat >> np.uint64(44)])
            at = np.minimum(np.searchsorted(heavy, flat[maybe]), len(heavy) - 1)
            out[maybe[heavy[at] == flat[maybe]]] = True
        return out

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for i, j, buf, off in blocks(b.column("text")):
                toks, fps, ns = [], [], []
                sets = shingles(buf, off)
                hot_of = hot_places(np.concatenate(sets))
                end = 0
                for s, fp in zip(sets, fingerprints(sets).tolist()):
                    hot = hot_of[end:end + len(s)]
                    end += len(s)
                    if not len(s) or fp in seen:
                        continue
                    seen.add(fp)
                    p = prefix_length(len(s))
                    first = s[~hot][:p]
                    if len(first) < p:
                        late = s[hot]
                        late = late[np.argsort(rank[np.searchsorted(heavy, late)], kind="stable")]
                        first = np.concatenate([first, late[:p - len(first)]])
                    toks.append(first)
                    fps.append(fp)
                    ns.append(len(s))
                if len(seen) > 1 << 18:
                    seen.clear()
                if toks:
                    sizes = np.array([len(t) for t in toks])
                    columns = [pa.array(np.concatenate(toks).view(np.int64)), pa.array(np.repeat(np.array(fps, np.int64), sizes))]
                    if places:
                        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                        columns += [pa.array(np.repeat(np.array(ns, np.int32), sizes)), pa.array(place.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["token", "fp", "n", "place"][:len(columns)])

    return run


def _possible(n, i, m, j):
    """May sets of n and m shingles link whose first common one is at places i and j?"""
    need = F.ceil((n + m) * PERCENT / (100 + PERCENT) - 1e-9)
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (F.least(n - i, m - j) >= need)


def _linked_texts(batches):
    """Pairs (a, b, their texts) that link."""
    last, last_set = None, None
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            a_ids, b_ids = part.column("a").to_pylist(), part.column("b").to_pylist()
            b_sets = [s for _, _, buf, off in blocks(part.column("text_b")) for s in shingles(buf, off)]
            new = [k for k, a in enumerate(a_ids) if (a_ids[k - 1] if k else last) != a]
            a_sets = dict(zip(new, (s for _, _, buf, off in blocks(part.column("text_a").take(pa.array(new, pa.int64()))) for s in shingles(buf, off)))) if new else {}
            out = []
            for k, a in enumerate(a_ids):
                if k in a_sets:
                    last, last_set = a, a_sets[k]
                common = len(np.intersect1d(last_set, b_sets[k], assume_unique=True))
                if 100 * common >= PERCENT * (len(last_set) + len(b_sets[k]) - common):
                    out.append((a, b_ids[k]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (a, b) of sets that link; ``texts`` has fp, text."""
    tb = texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b"))
    ta = texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(tb, "b").join(ta, "a").select("a", "b", "text_a", "text_b").mapInArrow(_linked_texts, "a bigint, b bigint")


def _size_class(n):
    return F.floor(F.log(n) / F.log(F.lit(100.0 / PERCENT)) + 1e-9).cast("int")


def _own_shingles(batches):
    """(token, fp, comp) of every shingle of the texts."""
    for b in batches:
        for i, j, buf, off in blocks(b.column("text")):
            sets = shingles(buf, off)
            sizes = [len(s) for s in sets]
            fp, comp = (np.repeat(b.column(c).slice(i, j - i).to_numpy(zero_copy_only=False), sizes) for c in ("fp", "comp"))
            token = np.concatenate(sets).view(np.int64)
            for at in range(0, len(token), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 16)]) for x in (token, fp, comp)], ["token", "fp", "comp"])


def sharing(grams: DataFrame, sets: DataFrame) -> DataFrame:
    """Of sets (fp, n, comp) those that may link outside their component, with ``s`` and ``sig``.

    Sets of different components can have no other shingles in common than those that occur in more than
    one component: ``s`` of a set's shingles, ``sig`` of them by class of hash. A link takes PERCENT of n at least.
    """
    met = grams.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("token")
    kind = F.pmod(F.shiftright("token", 7), F.lit(CLASSES))
    counts = grams.join(met, "token").groupBy("fp").agg(
        F.count("*").cast("int").alias("s"), *[F.count_if(kind == c).cast("int").alias(f"k{c}") for c in range(CLASSES)])
    return counts.join(sets, "fp").filter(100 * F.col("s") >= PERCENT * F.col("n")).select(
        "fp", "n", "comp", "s", F.array(*[f"k{c}" for c in range(CLASSES)]).alias("sig"))


def _of_own_set(batches):
    """The rows (fp, text) whose text has that set."""
    for b in batches:
        for i, j, buf, off in blocks(b.column("text")):
            part = b.slice(i, j - i)
            own = fingerprints(shingles(buf, off)) == part.column("fp").to_numpy()
            yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(own)) for k in ("fp", "text")], ["fp", "text"])


def _may_share(n, s, sig, m, t, other):
    """Can sets of n and m shingles, s and t of them shared, have as many in common as a link takes?"""
    need = F.ceil((n + m) * PERCENT / (100 + PERCENT) - 1e-9)
    most = F.aggregate(F.zip_with(sig, other, lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    return (F.least(s, t) >= need) & (most >= need)


def _open_lists(index: DataFrame, found: DataFrame) -> DataFrame:
    """The lists that hold sets of more than one component of the links found, with component and size block."""
    comp = components(found).withColumnRenamed("node", "f")
    known = index.join(comp, F.col("fp") == F.col("f"), "left").select("token", "fp", "n", "place", F.coalesce("component", "fp").alias("comp"), _size_class(F.col("n")).alias("block"))
    open_ = known.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("token")
    return save(known.join(open_, "token"), "open-lists")


def _probes(known: DataFrame):
    """Postings that some block of their list may hold a partner for, the listed postings, and when two of them may link.

    Blocks are known in short: their sizes, places and components.
    """
    head = known.groupBy("token", "block").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.max(F.col("n") - F.col("place")).alias("behind"), F.count("*").alias("crowd"),
                                               F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    head = head.withColumn("of", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))).select(
        F.col("token").alias("t"), "of", F.col("block").alias("other"), "n0", "n1", "behind", "crowd", "c0", "c1")
    least_need = F.ceil((F.col("n") + F.greatest(F.col("n0"), F.ceil(F.col("n") * PERCENT / 100))) * PERCENT / (100 + PERCENT) - 1e-9)
    probe = known.join(head, (F.col("token") == F.col("t")) & (F.col("block") == F.col("of")) & ~((F.col("c0") == F.col("comp")) & (F.col("c1") == F.col("comp")))
                       & (100 * F.col("n1") >= PERCENT * F.col("n")) & (100 * F.col("n") >= PERCENT * F.col("n0"))
                       & (F.least(F.col("n") - F.col("place"), F.col("behind")) >= least_need))
    counts = "sig" in known.columns
    side = lambda x: [F.col("fp").alias(x), F.col("n").alias(f"n{x}"), F.col("place").alias(f"i{x}"), F.col("comp").alias(f"c{x}"),
                      *([F.col("s").alias(f"t{x}"), F.col("sig").alias(f"s{x}")] if counts else [])]
    match = ((F.col("token") == F.col("t")) & (F.col("other") == F.col("bk")) & (F.col("ca") != F.col("cb"))
             & _possible(F.col("na"), F.col("ia"), F.col("nb"), F.col("ib")))
    return probe.select("token", "other", "crowd", *side("a")), known.select(F.col("token").alias("t"), F.col("block").alias("bk"), *side("b")), match


def links(docs: DataFrame, sets: DataFrame, heavy: np.ndarray, rank: np.ndarray) -> DataFrame:
    """Enough verified links (a, b) between distinct sets to connect every component."""
    named = docs.filter("doc_id is not null").select("text")
    postings = named.mapInArrow(_prefixes(heavy, rank), "token bigint, fp bigint, n int, place int")
    # n and place travel as one number
    postings = postings.select("token", "fp", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("place")).alias("np"))
    lists = named.mapInArrow(_prefixes(heavy, rank, places=False), "token bigint, fp bigint").groupBy("token").agg(F.min("fp").alias("f0"), F.max("fp").alias("f1")).filter("f0 <> f1").select(F.col("token").alias("t"))
    index = postings.join(lists, F.col("token") == F.col("t")).drop("t").distinct()
    index = save(index.select("token", "fp", F.shiftright("np", 32).cast("int").alias("n"), F.col("np").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("place")), "index-lists")
    hub = F.struct("fp", "n", "place")
    hubs = index.groupBy("token").agg(F.min(hub).alias("lo"), F.max(hub).alias("hi"))
    reps = sets.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    used = index.select("fp").distinct().join(reps, "fp").withColumnRenamed("rep", "r")
    # a doc_id may come with several texts: a set gets one of its own
    texts = save(docs.join(used, F.col("doc_id") == F.col("r")).select("fp", "text").mapInArrow(_of_own_set, "fp bigint, text string").groupBy("fp").agg(F.min("text").alias("text"))
                 if sets.groupBy("doc_id").count().filter("count > 1").limit(1).count() else
                 docs.join(used, F.col("doc_id") == F.col("r")).select("fp", "text"), "set-texts")
    pair = lambda h: F.when((F.col("fp") != F.col(f"{h}.fp")) & _possible(F.col("n"), F.col("place"), F.col(f"{h}.n"), F.col(f"{h}.place")),
                            F.struct(F.least("fp", F.col(f"{h}.fp")).alias("a"), F.greatest("fp", F.col(f"{h}.fp")).alias("b")))
    tried = save(index.join(hubs, "token").select(F.explode(F.array(pair("lo"), pair("hi"))).alias("p")).filter("p is not null").select("p.a", "p.b").distinct(), "hub-pairs")
    first = save(verify(tried, texts), "hub-links")
    known = _open_lists(index, first)
    # sets in crowded lists; those that share too little with each other have no links left to find among them
    probe, listed, match = _probes(known)
    asking = probe.filter(F.col("crowd") > CROWD).join(listed, match, "left_semi").select(F.col("a").alias("fp")).distinct()
    asking = save(asking, "asking")
    nodes = save(known.select("fp", "n", "comp").distinct().join(asking, "fp"), "asking-sets")
    grams = save(texts.join(nodes, "fp").select("fp", "comp", "text").mapInArrow(_own_shingles, "token bigint, fp bigint, comp bigint"), "open-shingles")
    alive = save(sharing(grams, nodes), "sharing-sets")
    # second hub of each list: the set that shares most
    rich = known.select("token", "fp", "place").join(alive.select("fp", "n", "s", "sig"), "fp")
    best = rich.groupBy("token").agg(F.max(F.struct("s", "fp", "n", "place")).alias("hi"))
    best = best.join(alive.select(F.col("fp").alias("h"), F.col("sig").alias("hsig")), F.col("hi.fp") == F.col("h"))
    second = save(rich.join(best, "token").filter(_may_share(F.col("n"), F.col("s"), F.col("sig"), F.col("hi.n"), F.col("hi.s"), F.col("hsig"))).select(pair("hi").alias("p"))
                  .filter("p is not null").select("p.a", "p.b").distinct().join(tried, ["a", "b"], "left_anti"), "hub-pairs")
    first = first.unionByName(save(verify(second, texts), "hub-links"))
    tried = tried.unionByName(second)
    known = _open_lists(index, first)
    nodes = save(known.select("fp", "n", "comp").distinct().join(asking, "fp"), "asking-sets")
    alive = save(sharing(grams.drop("comp").join(nodes.select("fp", "comp"), "fp"), nodes), "sharing-sets")
    counts = nodes.select("fp").join(alive.select("fp", "s", "sig"), "fp", "left").select("fp", F.coalesce("s", F.lit(0)).alias("s"), "sig")
    known = save(known.join(counts, "fp", "left"), "open-lists")
    probe, listed, match = _probes(known)
    share = _may_share(F.col("na"), F.col("ta"), F.col("sa"), F.col("nb"), F.col("tb"), F.col("sb"))
    uncounted = F.col("ta").isNull() | F.col("tb").isNull()
    more = probe.join(listed, match & (F.col("a") < F.col("b")) & (uncounted | share)).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    return first.unionByName(verify(save(more, "cross-pairs"), texts))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp (its set), comp (its component's own key) and component_id of every row of docs."""
    docs = with_columns_of(docs, ["doc_id", "text"])
    found = save(docs.mapInArrow(_sets_and_heavy, "doc_id bigint, n bigint, fp bigint, doc boolean"), "shingle-sets")
    sets = found.filter("doc").select("doc_id", "n", "fp")
    usable = sets.filter("n > 0 and doc_id is not null")
    top = (found.filter("not doc").groupBy("fp").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "fp").limit(HEAVY).toPandas())  # at most HEAVY rows
    tokens = top["fp"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens, kind="stable")
    pairs = save(links(docs, usable, tokens[order], -order), "set-links")
    comp = components(pairs).withColumnRenamed("node", "f").withColumnRenamed("component", "c")
    of_set = usable.groupBy("fp").agg(F.min("doc_id").alias("rep")).join(comp, F.col("fp") == F.col("f"), "left").select("fp", "rep", F.coalesce("c", "fp").alias("c"))
    smallest = of_set.groupBy("c").agg(F.min("rep").alias("component_id"))
    of_set = of_set.join(smallest, "c").select(F.col("fp").alias("f"), "c", "component_id")
    linked = usable.select("fp").distinct().join(of_set, F.col("fp") == F.col("f")).select("f", "c", "component_id")
    out = sets.join(linked, (F.col("fp") == F.col("f")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "fp", F.col("c").alias("comp"), F.coalesce("component_id", "doc_id").alias("component_id"))


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    return grouped(docs).drop("fp", "comp")


def _with_set(columns: list[str]):
    """Rows with _fp and _n, the set of their text."""
    def run(batches):
        for b in batches:
            for i, j, buf, off in blocks(b.column("text")):
                sets = shingles(buf, off)
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in columns], pa.array(fingerprints(sets)), pa.array([len(s) for s in sets], pa.int64())],
                                                 [*columns, "_fp", "_n"])

    return run


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id. Rows without words or doc_id stay.

    Where a doc_id has rows of several texts, each counts on its own: the component's row is the one of its smallest doc_id whose
    text belongs to it (of several such texts the one with the smallest set key, of repeated rows any one).
    """
    columns = docs.columns
    groups = save(grouped(docs).filter("doc_id is not null"), "groups")
    winners = groups.filter("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("doc_id", "fp")).alias("w")).select(F.col("w.doc_id").alias("_w"), F.col("w.fp").alias("_f"))
    ids = groups.groupBy("doc_id").agg((F.count("*") > 1).alias("_many"), F.max("n_shingles").alias("_size"))
    single = ids.join(winners.select("_w").distinct(), F.col("doc_id") == F.col("_w"), "left").filter("not _many and (_w is not null or _size = 0)").select(F.col("doc_id").alias("_d"))
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(columns)])
    out = plain.join(single, F.col("doc_id") == F.col("_d"), "left").filter("doc_id is null or _d is not null").select(*plain.columns)
    many = ids.filter("_many").select(F.col("doc_id").alias("_m"))
    if many.limit(1).count():
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", _fp bigint, _n bigint"
        rows = plain.join(many, F.col("doc_id") == F.col("_m"), "left_semi").mapInArrow(_with_set(plain.columns), schema)
        rows = rows.join(winners, (F.col("doc_id") == F.col("_w")) & (F.col("_fp") == F.col("_f")), "left").filter("_w is not null or _n = 0")
        again = F.row_number().over(Window.partitionBy("doc_id", "_fp").orderBy(F.length("text").desc_nulls_last()))
        out = out.unionByName(rows.withColumn("_k", again).filter("_k = 1 or _n = 0").select(*plain.columns))
    return out.toDF(*columns)


@query("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    return similar(table(spark, sf_dir, "documents"))
