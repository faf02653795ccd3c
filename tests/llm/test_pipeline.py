"""run() of the pipeline: each stage's table against a brute-force version of its decision on its own input."""

import collections
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from glean.llm import mil_quality, mixing
from tests.llm.test_operators import SCHEMA, prose, texts

SECRETS = {"password = hunter22x": "[secret]", "user=alice\nkey aB3dE5fG7hI9jK1lM3nO5 here": "[secret]\nkey [secret] here"}


def test_run(spark, tmp, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    all_ = texts() + [(20 + k, prose(20 + k, 100) + " " + s) for k, s in enumerate(SECRETS)]
    docs = spark.createDataFrame([(i, t, "en", f"s{k % 3}", 0, "a", "b", "c") for k, (i, t) in enumerate(all_)], SCHEMA)
    docs.write.parquet(f"{tmp}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i not in (11, 12, 17)), 0) for i in range(1, 22)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp}/labels.parquet")
    tables, save = [], corpus_pipeline.save
    monkeypatch.setattr(corpus_pipeline, "save", lambda df, name: tables.append(save(df, name)) or tables[-1])
    corpus_pipeline.run(spark, tmp)
    good, one, masked, mixed, pieces = ([tuple(r) for r in t.collect()] for t in tables)
    assert all(t.columns == docs.columns for t in tables[:4])

    model = mil_quality.fit(spark.read.parquet(f"{tmp}/documents.parquet"), labels)
    rows = [tuple(r) for r in docs.collect()]
    score = lambda b: mil_quality.score_texts(np.frombuffer(b, np.uint8), np.array([0, len(b)]), model)[0]
    assert collections.Counter(good) == collections.Counter(r for r in rows if score((r[1] or "").encode()) >= 0.7)
    assert len(good) < len(rows) and {20, 21} <= {r[0] for r in good}

    sets = []
    for r in good:
        w = re.findall(r"[^\x20\x09-\x0d]+", (r[1] or "").lower())
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = {r[0]: r[0] for r in good}
    for _ in good:
        for a, s in zip(good, sets):
            for b, t in zip(good, sets):
                if None not in (a[0], b[0]) and s and 100 * len(s & t) >= 75 * len(s | t):
                    root[a[0]] = root[b[0]] = min(root[a[0]], root[b[0]])
    seen = [r[:2] for r in good]  # of repeated rows any one
    first = [x for k, x in enumerate(seen) if x[0] is None or not sets[k] or (root[x[0]] == x[0] and x not in seen[:k])]
    assert collections.Counter(r[:2] for r in one) == collections.Counter(first) and not collections.Counter(one) - collections.Counter(good)

    def hide(t):
        for s, m in SECRETS.items():
            t = t and t.replace(s, m)
        return t

    assert collections.Counter(masked) == collections.Counter((r[0], hide(r[1]), *r[2:]) for r in one)

    taken = collections.Counter()
    for r in mixing.plan(tables[2]).collect():
        taken[r["doc_id"]] += r["taken"]
    have = collections.Counter({r["doc_id"]: r["n"] for r in tables[3].groupBy("doc_id").agg(F.sum(mixing.size_of()).alias("n")).collect()})
    assert set(mixed) <= set(masked) and mixed and +have == +taken

    full = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want, got = collections.Counter(), collections.Counter()
    for r in mixed:
        want[r[0]] += len(full.encode(r[1] or "", add_special_tokens=False).ids) + 1
    for r in tables[4].collect():
        got[r["doc_id"]] += r["length"]
    assert got == want
