"""Periodic runs, license markup and term divergence against brute force on awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glean.llm import jaccard_join, license_markup, periodic_runs, term_divergence
from tests.llm.test_operators import SCHEMA, docs, prose, texts  # noqa: F401

GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
       "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ab " * 40), (6, "x y " * 300), (6, "x y " * 300), (None, "a b c d e f " * 5),
           (7, GPL), (8, "Licensed under the Apache License, Version 2.0."), (9, "mit license mit license"), (10, "é" * 300 + " CC-BY é ß"), (11, "a\x00b\x1fc")]


def frame(spark, rows):
    """Rows with extra columns whose names operators use themselves."""
    wide = [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 4 else None, 0, "a", "b", "c") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, SCHEMA)


# ---------------------------------------------------------------- periodic runs


def runs_of(x):
    n, best = len(x), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and x[j] == x[j + p]:
                j += 1
            if j - i + p >= max(12, 2 * p) and j > i:
                best.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, p, n_) for (s, n_), p in best.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(w, runs):
    keep = np.ones(len(w), bool)
    for s, p, n in runs:
        keep[s + p:s + n] = False
    return " ".join(x for x, k in zip(w, keep) if k)


def test_z_function():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = rng.integers(0, rng.integers(1, 4), int(rng.integers(0, 60)))
        want = [0] * len(x)
        for i in range(1, len(x)):
            while i + want[i] < len(x) and x[want[i]] == x[i + want[i]]:
                want[i] += 1
        assert periodic_runs.z_function(x) == {i: k for i, k in enumerate(want) if k}


def test_periodic_runs(spark, docs, monkeypatch):  # noqa: F811
    rng = np.random.default_rng(5)
    rows = AWKWARD + [(50, prose(50, 40) + " " + " ".join(prose(51, 37).split() * 9) + " " + prose(52, 60))]
    for k in range(60):  # few words, planted periods, some broken
        x = rng.integers(0, int(rng.integers(1, 5)) if k % 2 else 300, int(rng.integers(0, 500))).tolist()
        if k % 3 and len(x) > 20:
            a, p = int(rng.integers(0, len(x))), 1 + int(rng.integers(0, len(x) // 3))
            x[a:] = [x[a + (i - a) % p] if a + (i - a) % p < len(x) else 0 for i in range(a, len(x))]
            x[int(rng.integers(0, len(x)))] = 999
        rows.append((100 + k, " ".join(f"w{v}" for v in x)))
    want = collections.Counter()
    for i, t in rows:
        w = words_of(t)
        r = runs_of(w)
        want[i, len(w), tuple(r), collapsed(w, r)] += 1
    assert sum(len(k[2]) for k in want) > 40
    df = frame(spark, rows).repartition(3)
    for size in (periodic_runs.ROW_WORDS, 1):  # many boundaries a row, and each on its own
        monkeypatch.setattr(periodic_runs, "ROW_WORDS", size)
        got = periodic_runs.periodic_runs(df).collect()
        assert collections.Counter((r["doc_id"], r["n"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in got) == want
    digests = periodic_runs.periodic_runs(df, texts=False).collect()
    assert collections.Counter(r["collapsed"] for r in digests) == collections.Counter(
        x for k, n in want.items() for x in [hashlib.sha256(k[3].encode()).hexdigest()] * n)


def test_periodic_runs_in_a_long_text(spark):
    """Over 1 MB: a period of 20,000 words three and a half times, after and before other words."""
    head, part, tail = (prose(s, n).split() for s, n in ((60, 120_000), (61, 20_000), (62, 50_000)))
    w = head + ["start"] + part * 3 + part[:10_000] + ["end"] + tail
    (r,) = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")).collect()
    assert len(" ".join(w)) > 1 << 20
    assert [tuple(x) for x in r["runs"] if x["period"] > 1000] == [(120_001, 20_000, 70_000)]
    assert r["collapsed"] == collapsed(w, [tuple(x) for x in r["runs"]])


def test_looped_documents(spark):
    rows = [(i, prose(i, 5 + i % 70) if i % 9 else "") for i in range(300)] + [(None, "a b"), (301, None)]
    got = {r["doc_id"]: r["text"] for r in periodic_runs.looped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    changed = 0
    for i, t in rows:
        h, w = zlib.crc32(str(i).encode()) if i is not None else 1, words_of(t)
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        assert words_of(got[i]) == w
    assert changed > 10


# ---------------------------------------------------------------- license markup


def test_markup():
    machine = license_markup.Automaton((("x", "[[the]] big {{0,2}} box {{of|from}} {{red hats|socks}} [[in [[a]] row]]"),), (("big box", "b"),))
    found = lambda t: sorted(set(machine.scan(license_markup.pieces(t))))
    assert found("A BIG box, of socks") == [("b", 2, 2), ("x", 0, 4)]
    assert found("the big old grey box from red-hats in a row") == [("x", 0, 7), ("x", 0, 10)]
    assert found("the big old grey fat box of socks") == [] and found("big box of hats") == [("b", 2, 1)]
    for t in ("[[a", "a]]", "{{1,2}}", "a|b"):
        with pytest.raises((ValueError, IndexError)):
            license_markup.Automaton((("x", t),), ())


def test_templates_match_as_regular_expressions():
    """Automaton against regular expressions on wordings drawn from the templates, some with a word changed."""
    rng, machine = np.random.default_rng(6), license_markup.Automaton()

    def draw(parts):
        for p in parts:
            if isinstance(p, str):
                yield p
            elif p[0] == "any":
                yield from prose(int(rng.integers(1 << 20)), int(rng.integers(p[1], p[2] + 2))).split()
            elif p[0] == "one" or rng.random() < 0.5:
                yield from draw(p[1][int(rng.integers(len(p[1])))])

    hits = 0
    for _ in range(15):
        for _, markup in license_markup.TEMPLATES:
            w = [*prose(1, 3).split(), *draw(license_markup.parse(markup)), "end"]
            if rng.random() < 0.4:
                w[int(rng.integers(len(w)))] = "changed"
            got = {label for label, size, _ in machine.scan([[x.encode() for x in w]]) if not size}
            joined = " " + " ".join(w) + " "
            assert got == {label for label, t in license_markup.TEMPLATES if re.search(license_markup.as_regex(license_markup.parse(t)) + " ", joined)}
            hits += bool(got)
    assert 100 < hits < 15 * len(license_markup.TEMPLATES)


def test_licenses(spark, monkeypatch):
    long_ = prose(9, 60_000) + " " + GPL + " " + prose(10, 250_000) + " " + "licensed under " + "\n" * 90 + " the MIT License"
    rows = AWKWARD + [(20, long_)]
    got = {}
    for size in (license_markup.PIECE, 50):  # the automaton's state goes from piece to piece
        monkeypatch.setattr(license_markup, "PIECE", size)
        found = license_markup.scan(frame(spark, rows)).collect()
        assert len(found) == len(rows)
        got[size] = [tuple(r) for r in found]
        by = {r["doc_id"]: r for r in found}
        assert (by[7]["labels"], by[7]["base_labels"], by[7]["first_word"], by[7]["score"]) == ("gpl,gpl-3.0", "gpl", 18, 1.0)
        assert (by[8]["labels"], by[8]["score"]) == ("apache,apache-2.0", 1.0)
        assert (by[9]["n_base"], by[9]["first_word"], by[9]["last_word"], by[9]["labels"], by[9]["score"]) == (2, 0, 2, "mit", 0.5)
        assert (by[10]["labels"], by[10]["n_words"], by[10]["first_word"]) == ("cc-by", 5, 1)
        assert (by[1]["n_words"], by[1]["labels"], by[1]["score"], by[1]["first_word"]) == (0, "", 0.0, None) and by[11]["n_words"] == 3
        assert by[20]["labels"] == "gpl,gpl-3.0,mit,mit-notice" and by[20]["last_word"] == by[20]["n_words"] - 2
    a, b = got.values()
    assert collections.Counter(map(str, a)) == collections.Counter(map(str, b))


# ---------------------------------------------------------------- term divergence


def test_transducer():
    rng = np.random.default_rng(7)
    for n in (0, 1, 5, 400):
        words = sorted({bytes(rng.integers(97, 100, int(rng.integers(1, 7))).tolist()) for _ in range(n)} | ({"é".encode()} if n else set()))
        t = term_divergence.Transducer.from_bytes(term_divergence.Transducer.build(words).to_bytes())
        assert list(t.terms()) == words and [t.rank(w) for w in words] == list(range(len(words)))
        assert all(t.rank(x) == (words.index(x) if x in words else -1) for x in (b"", b"a", b"ab", b"zz", b"abcabcabc"))
        # Minimal: as many states as there are different sets of endings.
        prefixes = {w[:k] for w in words for k in range(len(w) + 1)} | {b""}
        endings = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
        assert len(t.final) == len(endings)


def brute_audit(rows, min_docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, n, groups, out = collections.Counter(), collections.Counter(), set(), []
    for lang, source, text in rows:
        t = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        df.update((lang, x) for x in set(t))
        n.update((lang, source, x) for x in t)
    for lang in {g[0] for g in groups}:
        kept = sorted((x for (o, x), k in df.items() if o == lang and k >= min_docs), key=lambda x: x.encode())
        sources = sorted(s for o, s in groups if o == lang)
        count = {s: [n[lang, s, x] for x in kept] for s in sources}
        every = [sum(c) for c in zip(*count.values())]
        share = lambda c: [1 + 10 ** 9 * (k + 5) // (sum(c) + 5 * len(kept)) for k in c]
        p, q = {s: share(c) for s, c in count.items()}, share(every)
        for s in sources:
            pairs = sorted(((-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode(), o) for o in sources if o != s))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            more = sorted((q[i] - p[s][i], x.encode(), x) for i, x in enumerate(kept) if count[s][i] and p[s][i] > q[i])[:50]
            out += [(lang, s, "term", x, -v, k + 1) for k, (v, _, x) in enumerate(more)]
    return out


def test_divergence(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vocab = [prose(k, 1) + suffix for k, suffix in enumerate(["", "é", "日本", "x", "yy", "zzz"] * 20)]
    rows = [(["en", "de", None][k % 3], ["a", "b", "c", None, "é", ""][int(rng.integers(6))],
             " ".join(rng.choice(vocab, int(rng.integers(0, 60)), p=None).tolist()) + " A1b-C") for k in range(150)]
    rows += [("fr", "a", "rare words"), ("fr", "b", None), ("fr", "z", ""), ("xx", "only", "alone"), ("en", "quiet", "1 2 3")]
    df = spark.createDataFrame([(k, t, o, s, 0, "a", "b", "c") for k, (o, s, t) in enumerate(rows)], SCHEMA).repartition(3)
    want = brute_audit(rows, 9)
    for chunk, room, held, block in ((1 << 16, 1 << 26, 1 << 19, 1024), (7, 200, 20, 5)):  # one of each, and many
        for name, value in (("CHUNK", chunk), ("ROUND_BYTES", room), ("HELD", held), ("BLOCK", block)):
            monkeypatch.setattr(term_divergence, name, value)
        got = [tuple(r) for r in term_divergence.audit(df, 9).collect()]
        assert sorted(got) == sorted(want) and len(got) > 300


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = prose(70, 300_000)
    whole = text.encode().split()
    assert [t for p in term_divergence.terms(text) for t in p] == whole and len(text) > 1 << 20
    monkeypatch.setattr(term_divergence, "PIECE", 10)
    got = [t.decode() for p in term_divergence.terms("Ab1cd  é-F" * 50) for t in p]
    assert got == ["ab", "cd", "é"] + ["fab", "cd", "é"] * 49 + ["f"]


# ---------------------------------------------------------------- tables without rows or words

NEW = [lambda d: periodic_runs.periodic_runs(d), lambda d: periodic_runs.periodic_runs(periodic_runs.looped(d)), lambda d: license_markup.scan(d)]


@pytest.mark.parametrize("run", [*NEW, term_divergence.audit])
def test_empty(spark, run):
    assert run(frame(spark, [(1, "a")]).limit(0)).count() == 0


@pytest.mark.parametrize("run", [*NEW, jaccard_join.similar, jaccard_join.keep_one])
def test_rows_without_words(spark, run):
    """One row, and rows that lie alone in their partitions."""
    for text in (None, "", " \n", "word"):
        assert run(frame(spark, [(1, text)]).coalesce(1)).count() == 1
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word"), (5, None)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(frame(spark, rows).collect(), 5), SCHEMA)
    assert run(df).count() == 5


def test_divergence_without_terms(spark):
    df = frame(spark, [(1, None), (2, ""), (3, "1 2"), (4, "word")])
    got = [tuple(r) for r in term_divergence.audit(df).collect()]
    assert sorted(got) == sorted(brute_audit([(r["lang"], r["source"], r["text"]) for r in df.collect()], 30)) and got
    assert all(r[2] == "pair" and r[4] == 0 for r in got)


def test_words_of_queries_are_whole(spark):
    """The digest columns of the periodic query against brute force, planted loops included."""
    rows = [(i, prose(i, 20 + 3 * i)) for i in range(120)] + [(None, "a b"), (500, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    looped = {r["doc_id"]: r["text"] for r in periodic_runs.looped(df).collect()}
    got = periodic_runs.periodic_runs(periodic_runs.looped(df)).withColumn("best", periodic_runs.longest()).select(
        "doc_id", "runs", F.col("best.length").alias("length"), (-F.col("best.back")).alias("start"), (-F.col("best.small")).alias("period")).collect()
    for r in got:
        runs = runs_of(words_of(looped[r["doc_id"]]))
        best = max(runs, key=lambda x: (x[2], -x[0], -x[1]), default=(None, None, None))
        assert ([tuple(x) for x in r["runs"]], r["start"], r["period"], r["length"]) == (runs, *best)
