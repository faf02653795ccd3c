"""Embedding near-dedup: small-world graphs per shard.

Vectors of a label are dealt by a hash into shards of about ``SHARD`` vectors; each
shard gets its own graph. Every vector queries every shard of its label. Per shard
and chunk of queries, beams are widened until the audit passes, and a query whose beam
is full of links goes on with a wider one, in the end with the whole shard. The audit has
a fixed sample: about ``AUDITED`` queries, which are compared with the whole shard, and
as many probes, vectors made to lie just within the bound of a node that isn't crowded, so that it ends
on data without links too. Of the probes, and of the audited queries that have links, at least
``RECALL`` of those that the graph answers must get every link. All other queries are answered by the graph, with that beam. A shard in which no beam is less
than 1 / ``WIDE`` of it is compared whole. Found pairs are verified by their cosine in double precision; components are
the union over all shards.

Equal vectors of a label are one class and are searched once. Links leave a task as
counts and as one star per connected set, never as all pairs. A query meets each
shard of its label once, so work grows with vectors x shards of the label.

Edge cases: rows with a null label, null, empty or zero vector, or null or non-finite
components link with nothing (component: their own vec_id, kept); a cosine that equals the bound links; vectors of
different lengths never link; a null vec_id links with nothing and has a null
component; repeated rows are copies of each other (and share their vec_id).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glean.llm.common import components, save, splitmix, table, with_columns_of
from glean.llm.hnsw import M, Graph
from glean.llm.registry import query

COSINE = 0.93
#: Vectors of a shard, queries that meet a shard at once (one audit), queries searched at once.
SHARD, CHUNK, BLOCK = 4096, 2048, 512
BEAM, RECALL, AUDITED = 64, 0.995, 128
#: How far within the bound a probe lies.
PROBE = 0.002
#: A beam over more than 1 / WIDE of a shard costs more than comparing with all of it, which is done instead.
WIDE = 8
#: Graph search works in single precision; what it finds below the bound by less than this is verified too.
SLACK = 1e-4


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision and their unit vectors in single precision (scaled first: no overflow)."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v, (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def build_graph(pdf: pd.DataFrame) -> pd.DataFrame:
    """The graph of one shard, with its vectors."""
    pdf = pdf.sort_values("rep", kind="stable")
    v = _matrix(pdf["embedding"])
    _, x = _unit(v)
    u = (splitmix(pdf["rep"].to_numpy().astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    levels = np.minimum((-np.log(np.maximum(u, 1e-18)) / np.log(M)).astype(int), 5)
    g = Graph.build(x, levels)
    return pd.DataFrame({"label": [pdf["label"].iloc[0]], "dim": [v.shape[1]], "shard": [pdf["shard"].iloc[0]],
                         "reps": [pdf["rep"].to_numpy().astype("<i8").tobytes()], "sizes": [pdf["size"].to_numpy().astype("<i8").tobytes()],
                         "vectors": [v.astype("<f8").tobytes()], "graph": [g.to_bytes()]})


def probes(own: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes spread over the shard, and for each a vector whose cosine with it is just above the bound, off in a random direction."""
    nodes = np.unique(np.linspace(0, len(own) - 1, count).astype(int))
    x = own[nodes] / np.linalg.norm(own[nodes], axis=1)[:, None]
    away = np.random.default_rng(len(own)).normal(size=x.shape)
    away -= np.einsum("nd,nd->n", away, x)[:, None] * x
    away /= np.maximum(np.linalg.norm(away, axis=1), 1e-12)[:, None]
    c = min(1.0, COSINE + PROBE)
    return nodes, (c * x + np.sqrt(1 - c * c) * away).astype(np.float32)


def links_in_shard(g: Graph, own: np.ndarray, q: np.ndarray, q_double: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, node) pairs with cosine of at least ``COSINE``, and the number of queries that the graph answered."""
    n = len(own)
    unit = own / np.linalg.norm(own, axis=1)[:, None]
    q_unit = q_double / np.linalg.norm(q_double, axis=1)[:, None]

    def search(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of ``rows``, and of all queries whether they were compared with the whole shard."""
        found, whole = [], np.zeros(len(q), bool)
        for k in range(0, len(rows), BLOCK):
            part, w = rows[k:k + BLOCK], width
            while len(part):
                if w >= n // WIDE:
                    r, c = np.nonzero(q[part] @ g.x.T >= COSINE - SLACK)
                    found.append((part[r], c))
                    whole[part] = True
                    break
                ids, sims = g.search(q[part], w)
                hit = sims >= COSINE - SLACK
                full = hit.all(1)
                r, c = np.nonzero(hit & ~full[:, None])
                found.append((part[r], ids[r, c]))
                part, w = part[full], w * 4
        r, c = (np.concatenate(p) for p in zip(*found)) if found else (np.zeros(0, int),) * 2
        ok = np.zeros(len(r), bool)
        for k in range(0, len(r), 1 << 16):
            part = slice(k, k + (1 << 16))
            ok[part] = np.einsum("nd,nd->n", q_unit[r[part]], unit[c[part]]) >= COSINE
        return r[ok], c[ok], whole

    def others(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Links of each query with vectors other than its own."""
        out = np.zeros(len(q), int)
        for k in range(0, len(r), 1 << 16):
            part = slice(k, k + (1 << 16))
            np.add.at(out, r[part], (q_double[r[part]] != own[c[part]]).any(1))
        return out

    everyone = np.arange(len(q))
    if n // WIDE <= BEAM:
        r, c, _ = search(everyone, n)
        return r, c, 0
    # The audit: a fixed sample of queries, compared with the whole shard, and of probes, whose nearest node is known.
    audited = everyone % max(1, len(q) // AUDITED) == 0
    exact = search(everyone[audited], n)[:2]
    true = others(*exact)
    nodes, near = probes(own, AUDITED)
    near = near[(g.x[nodes] @ g.x.T >= COSINE).sum(1) < BEAM]  # queries at a crowded node meet the whole shard anyway
    around = (near @ g.x.T >= COSINE + SLACK).sum(1)
    width, asked = BEAM, everyone[audited & (true > 0)]
    while width < n // WIDE:
        _, sims = g.search(near, width)
        reached = ((sims >= COSINE + SLACK / 2).sum(1) >= around) | (sims >= COSINE - SLACK).all(1)  # a beam full of links goes on with a wider one
        r, c, whole = search(asked, width)
        # judged one by one: a query with many links must not make up for others, and what the whole shard answers proves nothing
        judged = asked[~whole[asked]]
        if reached.sum() >= RECALL * len(near) and (others(r, c)[judged] == true[judged]).sum() >= RECALL * len(judged):
            break
        width *= 2
    r, c, whole = search(everyone[~audited], width)
    return np.concatenate([exact[0], r]), np.concatenate([exact[1], c]), int((~whole & ~audited).sum())


def answer(key, queries: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
    """Rows of one (label, shard, chunk): per query its number of links and the smallest member of its set."""
    out = {"node": [], "root": [], "links": []}
    if len(queries) and len(graphs):
        row = graphs.iloc[0]
        reps, sizes = np.frombuffer(row["reps"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        own = np.frombuffer(row["vectors"], "<f8").reshape(len(reps), -1)
        own, x = _unit(own)
        g = Graph.from_bytes(x, row["graph"])
        queries = queries.sort_values("rep", kind="stable")
        q_rep = queries["rep"].to_numpy()
        q_double, q = _unit(_matrix(queries["embedding"]))
        all_r, all_c, _ = links_in_shard(g, own, q, q_double)
        for k in range(0, len(queries), BLOCK):
            here = (all_r >= k) & (all_r < k + BLOCK)
            r, c = all_r[here] - k, all_c[here]
            mine = q_rep[k:k + BLOCK]
            other = reps[c] != mine[r]
            r, c = r[other], c[other]
            n_links = np.bincount(r, weights=sizes[c], minlength=len(mine)).astype(np.int64)
            # smallest member of each connected set of queries and nodes
            a, b = mine[r], reps[c]
            nodes, inv = np.unique(np.concatenate([mine, a, b]), return_inverse=True)
            a, b = inv[len(mine):len(mine) + len(a)], inv[len(mine) + len(a):]
            low = np.arange(len(nodes))
            while True:
                new = low.copy()
                np.minimum.at(new, a, low[b])
                np.minimum.at(new, b, new[a])
                new = new[new]
                if (new == low).all():
                    break
                low = new
            links = np.zeros(len(nodes), np.int64)
            links[inv[:len(mine)]] = n_links
            some = (low != np.arange(len(nodes))) | (links > 0)
            out["node"].append(nodes[some])
            out["root"].append(nodes[low[some]])
            out["links"].append(links[some])
    return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    v = with_columns_of(vectors, ["vec_id", "embedding", "label"])
    e = F.col("embedding").cast("array<double>")
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.select("vec_id", F.col("label").cast("long").alias("label"), e.alias("e"))
    v = v.withColumn("valid", F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("e", lambda c: c != 0), F.lit(False)))
    v = v.withColumn("h", F.when(F.col("valid"), F.xxhash64("e")))
    classes = (v.filter("valid").groupBy("label", "h", F.col("e").alias("embedding"))
               .agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")).withColumn("dim", F.size("embedding")))
    classes = save(classes, "vector-classes")
    of_label = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    placed = classes.join(of_label, ["label", "dim"]).withColumn("shards", F.ceil(F.col("n") / SHARD).cast("int"))
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("rep"), "shards").cast("int"))
    graphs = save(placed.groupBy("label", "dim", "shard").applyInPandas(
        lambda pdf: build_graph(pdf), "label bigint, dim int, shard int, reps binary, sizes binary, vectors binary, graph binary"), "graphs")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    queries = placed.select("label", "dim", "rep", "embedding", F.pmod(F.xxhash64("rep", F.lit(1)), chunks).cast("int").alias("chunk"),
                            F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    copies = graphs.join(of_label, ["label", "dim"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).drop("n")
    keys = ["label", "dim", "shard", "chunk"]
    found = save(queries.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(answer, "node bigint, root bigint, links bigint"), "vector-links")
    comp = components(found, "node", "root")
    links = found.filter("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    result = (classes.join(links, F.col("rep") == F.col("node"), "left").drop("node").join(comp, F.col("rep") == F.col("node"), "left")
              .select(F.col("label").alias("l"), F.col("h").alias("k"), F.col("embedding").alias("x"),
                      (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("component", "rep").alias("c")))
    out = v.join(result, (F.col("label") == F.col("l")) & (F.col("h") == F.col("k")) & (F.col("e") == F.col("x")) & F.col("valid"), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


@query("op1_embedding_dedup")
def op1_embedding_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
