"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages (``PASSAGE_WORDS`` words each, every word of the
text). Each passage is encoded (byte histogram and two repetition figures, then a
learned layer); gated attention weights, learned from document labels only, weigh
the encodings, and the weighted sum is scored. Training runs in numpy on a bounded
sample of labelled documents (``TRAIN_DOCS`` documents, of each at most
``TRAIN_PASSAGES`` evenly spread passages); scoring reads whole texts.

Edge cases: null, empty and blank texts are one empty passage and get its score;
labels that are null or disagree for a doc_id are not learned from; without any
label the score is 0.5; repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glean.llm.common import blocks, table, with_columns_of, word_hashes, words
from glean.llm.registry import query

PASSAGE_WORDS = 64
HIDDEN, GATE = 24, 12
N_FEATURES = 256 + 4
#: Bounds of the training sample.
TRAIN_DOCS, TRAIN_PASSAGES = 6000, 24
EPOCHS, BATCH, RATE = 24, 64, 4e-3
#: ``predicted`` is 1 from here.
CUTOFF = 0.7
HELD_OUT_MOD, HELD_OUT_REST = 4, 2


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_MOD == HELD_OUT_REST, F.lit(False))


def passages(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage and its row. Every row has at least one passage."""
    n = len(off) - 1
    starts, ends, row = words(buf, off)
    per_row = np.bincount(row, minlength=n)
    count = np.maximum(1, -(-per_row // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(n), count)
    x = np.zeros((first[-1], N_FEATURES), np.float32)
    if len(starts) == 0:
        return x, owner
    rank = np.arange(len(starts)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    of_word = first[row] + rank // PASSAGE_WORDS
    # bytes belong to the passage of the word they are in or follow
    lead = np.searchsorted(starts, np.arange(len(buf)), side="right") - 1
    byte_row = np.repeat(np.arange(n), np.diff(off))
    of_byte = np.where((lead >= 0) & (row[np.maximum(lead, 0)] == byte_row), of_word[np.maximum(lead, 0)], first[byte_row])
    x[:, :256] = np.bincount(of_byte * 256 + buf, minlength=len(x) * 256).reshape(-1, 256)
    n_bytes = np.maximum(x[:, :256].sum(1, keepdims=True), 1)
    x[:, :256] = np.sqrt(x[:, :256] / n_bytes)
    h = word_hashes(buf, starts, ends, lower=True)
    n_words = np.maximum(np.bincount(of_word, minlength=len(x)), 1)
    for col, (key, owner_of) in enumerate(((h, of_word), (h[:-1] * np.uint64(3) + h[1:], of_word[:-1]))):
        order = np.lexsort((key, owner_of))
        same = (key[order][1:] == key[order][:-1]) & (owner_of[order][1:] == owner_of[order][:-1])
        x[:, 256 + col] = np.bincount(owner_of[order][1:][same], minlength=len(x)) / n_words
    x[:, 258] = np.bincount(of_word, weights=ends - starts, minlength=len(x)) / n_words / 10
    x[:, 259] = n_words / PASSAGE_WORDS
    return x, owner


def _segment(owner: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])


def forward(p: dict, x: np.ndarray, owner: np.ndarray) -> dict:
    """Scores of the bags; ``owner`` is ascending and has every bag."""
    h = np.tanh(x @ p["We"] + p["be"])
    t, s = np.tanh(h @ p["Wt"] + p["bt"]), 1 / (1 + np.exp(-(h @ p["Ws"] + p["bs"])))
    a = (t * s) @ p["wa"]
    seg = _segment(owner)
    bag = np.cumsum(np.concatenate([[0], np.diff(owner) != 0]))
    a = np.exp(a - np.maximum.reduceat(a, seg)[bag])
    a /= np.add.reduceat(a, seg)[bag]
    z = np.add.reduceat(a[:, None] * h, seg, axis=0)
    y = 1 / (1 + np.exp(-np.clip(z @ p["wc"] + p["bc"], -30, 30)))
    return {"h": h, "t": t, "s": s, "a": a, "seg": seg, "bag": bag, "z": z, "y": y}


def gradients(p: dict, x: np.ndarray, f: dict, label: np.ndarray) -> dict:
    """Gradients of the mean cross-entropy."""
    d = ((f["y"] - label) / len(label)).astype(np.float32)
    g = {"wc": f["z"].T @ d, "bc": np.array([d.sum()], np.float32)}
    dz = d[:, None] * p["wc"][None, :]
    dh = f["a"][:, None] * dz[f["bag"]]
    da = (dz[f["bag"]] * f["h"]).sum(1)
    da = f["a"] * (da - np.add.reduceat(f["a"] * da, f["seg"])[f["bag"]])
    g["wa"] = (f["t"] * f["s"]).T @ da
    dg = da[:, None] * p["wa"][None, :]
    dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
    g["Wt"], g["bt"], g["Ws"], g["bs"] = f["h"].T @ dt, dt.sum(0), f["h"].T @ ds, ds.sum(0)
    dh = (dh + dt @ p["Wt"].T + ds @ p["Ws"].T) * (1 - f["h"] ** 2)
    g["We"], g["be"] = x.T @ dh, dh.sum(0)
    return g


def train(x: np.ndarray, owner: np.ndarray, label: np.ndarray, seed: int = 7) -> dict | None:
    """Adam on the bags (owner ascending, one label a bag); None without labels."""
    if len(label) == 0:
        return None
    rng = np.random.default_rng(seed)
    mean, std = x.mean(0), x.std(0) + 1e-3
    x = ((x - mean) / std).astype(np.float32)
    shape = {"We": (x.shape[1], HIDDEN), "be": HIDDEN, "Wt": (HIDDEN, GATE), "bt": GATE, "Ws": (HIDDEN, GATE),
             "bs": GATE, "wa": GATE, "wc": HIDDEN, "bc": 1}
    p = {k: (rng.normal(0, 0.1, s) if k[0] in "Ww" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    m, v, step = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    at = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])), [len(owner)]])
    epochs = EPOCHS if len(label) >= 2000 else EPOCHS * 3
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for k in range(0, len(order), BATCH):
            take = order[k:k + BATCH]
            rows = np.concatenate([np.arange(at[b], at[b + 1]) for b in take])
            own = np.repeat(np.arange(len(take)), at[take + 1] - at[take])
            g = gradients(p, x[rows], forward(p, x[rows], own), label[take])
            step += 1
            for name in p:
                grad = g[name] + 1e-4 * p[name]
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.999 * v[name] + 0.001 * grad * grad
                p[name] = p[name] - (RATE * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p | {"mean": mean, "std": std}


def _encode(batches):
    """Training rows: the doc's passages as one blob."""
    for b in batches:
        for i, j, buf, off in blocks(b.column("text")):
            x, owner = passages(buf, off)
            at = np.searchsorted(owner, np.arange(j - i + 1))
            blobs = []
            for k in range(j - i):
                n = at[k + 1] - at[k]
                pick = at[k] + (np.arange(n) if n <= TRAIN_PASSAGES else np.arange(TRAIN_PASSAGES) * n // TRAIN_PASSAGES)
                blobs.append(x[pick].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("label").slice(i, j - i), pa.array(blobs, pa.binary())], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Learn from labelled documents outside the held-out fold."""
    lab = (labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
           .agg(F.min("quality").cast("int").alias("label"), F.max("quality").cast("int").alias("hi"))
           .filter("label = hi").filter(~held_out()).select("doc_id", "label")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS))
    rows = (docs.select("doc_id", "text").filter(~held_out()).join(F.broadcast(lab), "doc_id")  # at most TRAIN_DOCS rows
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text").mapInArrow(_encode, "label int, x binary").toPandas())
    rows["k"] = [hash_bytes(b) for b in rows["x"]]
    rows = rows.sort_values(["k", "label"], kind="stable")
    bags = [np.frombuffer(b, np.float16).reshape(-1, N_FEATURES) for b in rows["x"]]
    if not bags:
        return None
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return train(np.concatenate(bags).astype(np.float32), owner, rows["label"].to_numpy(np.float32))


def hash_bytes(b: bytes) -> int:
    import zlib

    return zlib.crc32(b)


def score_texts(buf: np.ndarray, off: np.ndarray, model: dict | None) -> np.ndarray:
    if model is None:
        return np.full(len(off) - 1, 0.5)
    x, owner = passages(buf, off)
    return forward(model, ((x - model["mean"]) / model["std"]).astype(np.float32), owner)["y"].astype(np.float64)


def scored(docs: DataFrame, model: dict | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of docs (must not include "score") and the score of each row's text."""
    schema = docs.select(*keep).schema.add("score", "double")
    names = [*keep, "score"]

    def run(batches):
        for b in batches:
            for i, j, buf, off in blocks(b.column("text")):
                cols = [b.column(k).slice(i, j - i) for k in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score_texts(buf, off, model), pa.float64())], names)

    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    docs = with_columns_of(docs, ["doc_id", "text"])
    return scored(docs, fit(docs, labels), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier accepts, with their own columns."""
    columns = docs.columns
    model = fit(with_columns_of(docs, ["doc_id", "text"]), labels)
    renamed = docs.toDF(*[f"c{i}" if c != "text" else c for i, c in enumerate(columns)])
    out = scored(renamed, model, renamed.columns).filter(F.col("score") >= CUTOFF).drop("score")
    return out.toDF(*columns)


@query("op2_mil_quality")
def op2_mil_quality(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
