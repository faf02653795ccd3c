"""Hierarchical navigable small-world graph over unit vectors, in numpy.

Inserts and searches run for many vectors at a time: a beam search expands the best
candidates of every query of a batch in lock step.
"""

from __future__ import annotations

import io

import numpy as np

M, M0 = 12, 24  # neighbours in upper layers and in the bottom layer
BUILD_BEAM, BUILD_BATCH, EXPAND = 48, 256, 4


def _diverse(x: np.ndarray, base: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """For each base node up to m of its candidates (-1: none), best first, leaving out those closer to a chosen one
    than to the base; free places are filled with the best that were left out."""
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    n, c = cand.shape
    chosen = np.zeros((n, c), bool)
    count = np.zeros(n, int)
    v = x[np.maximum(cand, 0)]
    between = v @ v.transpose(0, 2, 1)
    for k in range(c):
        worst = np.where(chosen[:, :k], between[:, k, :k], -2).max(1) if k else np.full(n, -2.0)
        ok = (cand[:, k] >= 0) & (count < m) & (worst < sims[:, k])
        chosen[:, k] = ok
        count += ok
    rank = np.where(cand < 0, 2, np.where(chosen, 0, 1))
    keep = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(cand, keep, 1)
    if out.shape[1] < m:
        out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
    return out


class Graph:
    """``x``: unit float32 vectors; ``layers``: for each layer the neighbours of every node (-1: none)."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    @classmethod
    def build(cls, x: np.ndarray, levels: np.ndarray) -> Graph:
        """levels: the top layer of each node."""
        n = len(x)
        order = np.argsort(-levels, kind="stable")
        g = cls(x, [np.full((n, M0 if k == 0 else M), -1, np.int32) for k in range(int(levels.max(initial=0)) + 1)], int(order[0]))
        done, size = 1, 1
        while done < n:
            batch = order[done:done + size]
            g._insert(batch, levels)
            done += len(batch)
            size = min(BUILD_BATCH, done)
        return g

    def _insert(self, batch: np.ndarray, levels: np.ndarray) -> None:
        q = self.x[batch]
        near = np.full((len(batch), 1), self.entry, np.int32)
        within = q @ q.T
        np.fill_diagonal(within, -2)
        for layer in range(len(self.layers) - 1, -1, -1):
            here = np.flatnonzero(levels[batch] >= layer)
            near, sims = self.beam(q, near, layer, BUILD_BEAM if len(here) else 4)
            if not len(here):
                continue
            m = self.layers[layer].shape[1]
            mates = within[np.ix_(here, here)]
            k = min(m, len(here) - 1)
            cand, cs = near[here], sims[here]
            if k > 0:
                top = np.argpartition(-mates, k - 1, axis=1)[:, :k]
                cand = np.concatenate([cand, batch[here][top].astype(np.int32)], 1)
                cs = np.concatenate([cs, np.take_along_axis(mates, top, 1)], 1)
            mine = _diverse(self.x, batch[here], np.where(cs > -1.5, cand, -1), cs, m)
            self.layers[layer][batch[here]] = mine
            self._link_back(layer, np.repeat(batch[here], m), mine.ravel())

    def _link_back(self, layer: int, src: np.ndarray, dst: np.ndarray) -> None:
        src, dst = src[dst >= 0], dst[dst >= 0]
        sim = np.einsum("nd,nd->n", self.x[src], self.x[dst])
        order = np.lexsort((-sim, dst))
        src, dst = src[order], dst[order]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        m = self.layers[layer].shape[1]
        rank = np.arange(len(dst)) - np.repeat(first, count)
        new = np.full((len(nodes), m), -1, np.int32)
        new[np.repeat(np.arange(len(nodes)), count)[rank < m], rank[rank < m]] = src[rank < m]
        cand = np.concatenate([self.layers[layer][nodes], new], 1)
        by = np.argsort(cand, axis=1, kind="stable")
        again = np.take_along_axis(cand, by, 1)
        r, c = np.nonzero(again[:, 1:] == again[:, :-1])
        cand[r, by[r, c + 1]] = -1  # already neighbours
        sims = np.where(cand >= 0, (self.x[np.maximum(cand, 0)] @ self.x[nodes][:, :, None])[:, :, 0], -2)
        self.layers[layer][nodes] = _diverse(self.x, nodes, cand, sims, m)

    def beam(self, q: np.ndarray, entry: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes found for each query in a layer, from its entry nodes (-1: none), and their similarities (-2: none)."""
        n, b = len(self.x), len(q)
        width = min(width, n)
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        ids = np.full((b, width), -1, np.int32)
        sims = np.full((b, width), -2, np.float32)
        k = min(entry.shape[1], width)
        ids[:, :k] = entry[:, :k]
        e = np.maximum(ids[:, :k], 0)
        sims[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("bkd,bd->bk", self.x[e], q), -2)
        seen[rows[:, None], e] |= ids[:, :k] >= 0
        open_ = ids >= 0
        neighbours = self.layers[layer]
        mark = np.zeros((b, n), np.int16)
        active = rows
        while len(active):
            score = np.where(open_[active], sims[active], -3)
            take = min(EXPAND, width)
            pick = np.argpartition(-score, take - 1, axis=1)[:, :take] if take < width else np.tile(np.arange(width), (len(active), 1))
            live = np.take_along_axis(score, pick, 1) > -2.5
            some = live.any(1)
            active, pick, live = active[some], pick[some], live[some]
            if not len(active):
                break
            a = active[:, None]
            node = np.where(live, ids[a, pick], -1)
            open_[a, pick] = False
            nxt = np.where(node[:, :, None] >= 0, neighbours[np.maximum(node, 0)], -1).reshape(len(active), -1)
            at = np.maximum(nxt, 0)
            fresh = (nxt >= 0) & ~seen[a, at]
            col = np.arange(1, nxt.shape[1] + 1, dtype=np.int16)
            r, c = np.nonzero(fresh)
            mark[active[r], at[r, c]] = col[c]
            fresh[r, c] = mark[active[r], at[r, c]] == col[c]  # one of equal ones
            r, c = np.nonzero(fresh)
            seen[active[r], at[r, c]] = True
            s = np.full(nxt.shape, -2, np.float32)
            s[r, c] = np.einsum("nd,nd->n", self.x[at[r, c]], q[active[r]])
            all_s = np.concatenate([sims[active], s], 1)
            all_i = np.concatenate([ids[active], np.where(fresh, nxt, -1)], 1)
            all_o = np.concatenate([open_[active], fresh], 1)
            best = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
            sims[active] = np.take_along_axis(all_s, best, 1)
            ids[active] = np.take_along_axis(all_i, best, 1)
            open_[active] = np.take_along_axis(all_o, best, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        near = np.full((len(q), 1), self.entry, np.int32)
        for layer in range(len(self.layers) - 1, 0, -1):
            near, _ = self.beam(q, near, layer, 4)
        return self.beam(q, near, 0, width)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, entry=np.int64(self.entry), **{f"l{k}": a for k, a in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, x: np.ndarray, blob: bytes) -> Graph:
        z = np.load(io.BytesIO(blob))
        return cls(x, [z[f"l{k}"] for k in range(len(z.files) - 1)], int(z["entry"]))
