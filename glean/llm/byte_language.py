"""Language ID: a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes, all of them; filters of several
widths run over the bytes of a window, each filter's largest response is kept, and a
softmax layer names the language. A document's probabilities are the mean of its
windows'. The network is trained in numpy on a bounded sample: ``TRAIN_DOCS``
labelled documents outside the held-out fold, dealt evenly to the languages so that
a rare one is learned too, each with its whole text. ``STEPS`` batches are drawn,
however large the sample: every step takes the next documents of a shuffled order,
so one counts the same however long it is, and any window of each.

A filter over one-hot bytes is a sum of table rows, so it is applied by look-ups:
one for each byte pair.

Edge cases: null texts and texts without a letter are ``und`` with score 0; an
unlabelled or empty table learns nothing and every text is ``und``; equally likely
languages: the first by name; repeated rows are learned once and judged each; very
long texts go through in blocks; other columns of docs are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glean.llm.common import blocks, table, with_columns_of
from glean.llm.registry import query

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 16
#: Bound of the training sample, in documents (over all languages).
TRAIN_DOCS = 4000
STEPS, BATCH, RATE = 1500, 64, 0.01
HELD_OUT_MOD = 5

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_MOD == 0, F.lit(False))


def windows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows x WINDOW) bytes, zero-padded, and each window's row."""
    size = np.diff(off)
    count = np.maximum(1, -(-size // WINDOW))
    first = np.concatenate([[0], np.cumsum(count)])
    flat = np.zeros(first[-1] * WINDOW, np.uint8)
    if len(buf):
        flat[np.arange(len(buf)) + np.repeat(first[:-1] * WINDOW - off[:-1], size)] = buf
    return flat.reshape(-1, WINDOW), np.repeat(np.arange(len(size)), count)


def has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_ASCII_LETTER[buf])])
    out = seen[off[1:]] > seen[off[:-1]]
    for k in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[k] = any(c.isalpha() for c in buf[off[k]:off[k + 1]].tobytes().decode("utf-8", "replace"))
    return out


class Network:
    """filters: for each width an array (width, 256, FILTERS); dense: (filters, classes)."""

    def __init__(self, classes: list[str], rng: np.random.Generator):
        self.classes = classes
        self.p = {f"f{w}": rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.p["dense"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.p["bias"] = np.zeros(len(classes), np.float32)
        self.tables: dict | None = None

    def _responses(self, w: int, x: np.ndarray) -> np.ndarray:
        f = self.p[f"f{w}"]
        n = WINDOW - w + 1
        return sum(f[o][x[:, o:o + n]] for o in range(w))

    def loss_gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        pooled, where = [], []
        for w in WIDTHS:
            r = self._responses(w, x)
            where.append(r.argmax(1))
            pooled.append(np.take_along_axis(r, where[-1][:, None, :], 1)[:, 0])
        h = np.concatenate(pooled, 1)
        live = h > 0
        h = h * live
        z = h @ self.p["dense"] + self.p["bias"]
        z = np.exp(z - z.max(1, keepdims=True))
        d = z / z.sum(1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"dense": h.T @ d, "bias": d.sum(0)}
        dh = (d @ self.p["dense"].T) * live
        rows = np.arange(len(x))[:, None]
        for k, w in enumerate(WIDTHS):
            part = dh[:, k * FILTERS:(k + 1) * FILTERS]
            grad = np.zeros(w * 256 * FILTERS)
            for o in range(w):
                at = (o * 256 + x[rows, where[k] + o].astype(np.int64)) * FILTERS + np.arange(FILTERS)
                grad += np.bincount(at.ravel(), weights=part.ravel(), minlength=len(grad))
            g[f"f{w}"] = grad.reshape(w, 256, FILTERS).astype(np.float32)
        return g

    def train(self, bags: list[np.ndarray], label: np.ndarray, rng: np.random.Generator) -> Network:
        """Adam on drawn windows; ``bags`` has the windows of each document."""
        m, v = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}
        order = np.concatenate([rng.permutation(len(bags)) for _ in range(-(-STEPS * BATCH // len(bags)))])
        for step in range(1, STEPS + 1):
            take = order[(step - 1) * BATCH:step * BATCH]
            x = np.stack([bags[k][rng.integers(len(bags[k]))] for k in take])
            g = self.loss_gradients(x, label[take])
            for n in self.p:
                m[n] = 0.9 * m[n] + 0.1 * g[n]
                v[n] = 0.999 * v[n] + 0.001 * g[n] * g[n]
                self.p[n] = (self.p[n] - RATE * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of each window; filters run as look-ups of byte pairs."""
        if self.tables is None:
            f = self.p
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
            self.tables = {w: [pair(f[f"f{w}"][o], f[f"f{w}"][o + 1]) for o in range(0, w - 1, 2)] for w in WIDTHS}
        out = []
        for k in range(0, len(x), 128):
            b = x[k:k + 128]
            two = b[:, :-1].astype(np.intp) * 256 + b[:, 1:]
            pooled = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                r = np.take(self.tables[w][0], two[:, :n], axis=0)
                for t, table_ in enumerate(self.tables[w][1:], 1):
                    r += np.take(table_, two[:, 2 * t:2 * t + n], axis=0)
                if w % 2:
                    r += np.take(self.p[f"f{w}"][w - 1], b[:, w - 1:w - 1 + n], axis=0)
                pooled.append(r.max(1))
            z = np.maximum(np.concatenate(pooled, 1), 0) @ self.p["dense"] + self.p["bias"]
            z = np.exp(z - z.max(1, keepdims=True))
            out.append(z / z.sum(1, keepdims=True))
        return np.concatenate(out)


def _training_windows(batches):
    for b in batches:
        for i, j, buf, off in blocks(b.column("text")):
            x, row = windows(buf, off)
            at = np.searchsorted(row, np.arange(j - i + 1))
            blobs = [x[at[k]:at[k + 1]].tobytes() for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column("lang").slice(i, j - i), pa.array(blobs, pa.binary())], ["lang", "x"])


def fit(docs: DataFrame) -> Network | None:
    """Learn from text and non-null lang outside the held-out fold."""
    usable = docs.filter("lang is not null and text is not null").filter(~held_out()).select(
        "text", "lang", F.xxhash64(F.col("doc_id"), F.lit(5)).alias("k"), F.xxhash64("text").alias("h"))
    n_langs = usable.agg(F.count_distinct("lang")).first()[0]
    each = F.row_number().over(Window.partitionBy("lang").orderBy("k", "h"))
    keys = (usable.select("lang", "k", "h").distinct().withColumn("n", each).filter(F.col("n") <= max(1, TRAIN_DOCS // max(1, n_langs)))
            .orderBy("n", "lang").limit(TRAIN_DOCS).select("lang", "k", "h"))  # texts stay where they are
    chosen = usable.join(F.broadcast(keys), ["lang", "k", "h"]).groupBy("k", "h", "lang").agg(F.min("text").alias("text")).select("text", "lang")
    rows = chosen.mapInArrow(_training_windows, "lang string, x binary").toPandas().sort_values(["lang", "x"], kind="stable")
    if not len(rows):
        return None
    classes = sorted(set(rows["lang"]))
    bags = [np.frombuffer(b, np.uint8).reshape(-1, WINDOW) for b in rows["x"]]
    label = np.array([classes.index(c) for c in rows["lang"]])
    rng = np.random.default_rng(11)
    return Network(classes, rng).train(bags, label, rng)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""

    def run(batches):
        for b in batches:
            for i, j, buf, off in blocks(b.column("text")):
                lang, score = np.full(j - i, "und", object), np.zeros(j - i)
                if network is not None:
                    x, row = windows(buf, off)
                    p = network.probabilities(x)
                    p = np.add.reduceat(p, np.searchsorted(row, np.arange(j - i)), axis=0) / np.bincount(row)[:, None]
                    ok = has_letter(buf, off)
                    lang[ok] = np.array(network.classes, object)[p.argmax(1)[ok]]
                    score[ok] = np.clip(p.max(1)[ok], 0, 1)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])

    schema = docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double")
    return with_columns_of(docs, ["doc_id", "text"]).mapInArrow(run, schema)


@query("op10_byte_language")
def op10_byte_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit(with_columns_of(docs, ["doc_id", "text", "lang"])))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
