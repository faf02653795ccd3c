"""The graph path of the embedding dedup: who answers, and what is found, against brute force."""

import numpy as np
import pytest

from glean.llm import embedding_dedup as E


def shard(kind, n=4096, dim=64):
    rng = np.random.default_rng(11)
    v = rng.normal(size=(n, dim))
    pairs = {"none": 0, "5 %": n // 40, "hot": n // 20}[kind]
    v[n - pairs:] = v[:pairs] + rng.normal(size=(pairs, dim)) * 0.1
    if kind == "hot":  # a third is one group
        v[1000:1000 + n // 3] = v[999] + rng.normal(size=(n // 3, dim)) * 0.1
    return v[rng.permutation(n)]


@pytest.mark.parametrize("kind, least", [("none", 0.9), ("5 %", 0.9), ("hot", 0.55)])
def test_most_queries_are_answered_by_the_graph(kind, least):
    own, x = E._unit(shard(kind))
    levels = np.minimum(np.random.default_rng(1).geometric(1 - 1 / E.M, len(x)) - 1, 5)
    g = E.Graph.build(x, levels)
    unit = own / np.linalg.norm(own, axis=1)[:, None]
    true = unit @ unit.T >= E.COSINE
    by_graph, got = 0, np.zeros_like(true)
    for k in range(0, len(x), E.CHUNK):
        r, c, n = E.links_in_shard(g, own, x[k:k + E.CHUNK], own[k:k + E.CHUNK])
        by_graph += n
        got[r + k, c] = True
    assert by_graph >= least * len(x)  # the audited ones, and queries with very many links, are compared with the whole shard
    assert not (got & ~true).any()
    np.fill_diagonal(true, False)
    np.fill_diagonal(got, False)
    assert got.sum() >= 0.99 * true.sum()
    some = (true.sum(1) > 0) & (true.sum(1) < E.BEAM)
    assert (got[some] == true[some]).all(1).sum() >= 0.99 * some.sum()


def test_probes_lie_within_the_bound():
    own, _ = E._unit(shard("none", 600))
    nodes, p = E.probes(own, E.AUDITED)
    cos = np.einsum("nd,nd->n", p.astype(float), own[nodes] / np.linalg.norm(own[nodes], axis=1)[:, None])
    assert len(nodes) == E.AUDITED and (cos > E.COSINE).all() and (cos < E.COSINE + 2 * E.PROBE).all()


def test_several_shards_through_spark(spark, monkeypatch):
    """Three labels of one, two and several shards against brute force."""
    monkeypatch.setattr(E, "SHARD", 1024)
    rows, want = [], {}
    for label, n in enumerate((600, 1500, 3000)):
        v = shard("5 %", n, 32).astype(np.float32)
        base = label * 10_000
        rows += [(base + k, v[k].tolist(), label) for k in range(n)]
        x = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
        link = x @ x.T >= E.COSINE
        np.fill_diagonal(link, False)
        for k in range(n):
            want[base + k] = (int(link[k].sum()), base + min([k, *np.flatnonzero(link[k]).tolist()]))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert len(got) == len(want) and sum(w[0] for w in want.values()) > 100
    assert sum(got[k] == w for k, w in want.items()) >= 0.999 * len(want)
    assert E.near_duplicates(spark.createDataFrame(rows[:1], "vec_id long, embedding array<float>, label int").limit(0)).count() == 0
