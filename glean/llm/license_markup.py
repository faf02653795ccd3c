"""License scans by template markup.

Templates are license wordings with marked regions: ``[[ ... ]]`` may be left out,
``{{m,n}}`` stands for m to n words of any kind (names, years, addresses), and
``{{a|b c}}`` for one of the alternatives. All other wording is mandatory, word by word. Templates
and the fixed phrases are compiled into one token automaton; its deterministic states
are made when a text first reaches them. A text is read once, word by word, and gets
the label of each template whose mandatory wording it holds exactly, in one piece.

A text without any of the automaton's key words (each template and phrase has a
mandatory one) holds no match and is only counted. Texts are read in pieces of
``PIECE`` bytes cut between words; the automaton's state goes from piece to piece, so
memory doesn't grow with the text.

Score: 1 if a template matches, 0.5 if only phrases do, else 0.

Edge cases: null and empty texts have no words, no labels and score 0; ties don't
occur (labels are a sorted set, all places count); repeated rows get equal rows; an empty table gives
an empty result; of extra columns none is read, and none clashes.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glean.llm.common import rows_of, table
from glean.llm.registry import query

#: Phrase, label.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

_GRANT = "{{licensed|released|distributed|available|published|redistribute it and or modify it}} under {{the|a}} [[terms of the]] [[conditions of the]]"
_CC = "{{licensed|released|distributed|available|published}} under [[the|a]] [[terms of the]] [[creative commons]]"
_GNU = "[[as published by the Free Software Foundation]] [[either]] version"
_LATER = "[[of the License]] [[or [[at your option]] any later version]]"
_AS_IS = "THIS SOFTWARE IS PROVIDED BY {{1,20}} AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES INCLUDING BUT NOT LIMITED TO THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"
_SOURCE = "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_CLAUSE_1 = "[[1]] Redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
_CLAUSE_2 = "[[2]] Redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_CLAUSE_3 = "[[3]] Neither the name of {{1,20}} nor the names of {{1,10}} may be used to endorse or promote products derived from this software without specific prior written permission"

#: Label, template. Version numbers are words of their own ("2.0" is "2 0").
TEMPLATES = (
    ("agpl-3.0", f"{_GRANT} GNU Affero General Public License {_GNU} 3 {_LATER}"),
    ("apache-2.0", f"{_GRANT} Apache License Version 2 0 [[the License]]"),
    ("bsd-2-clause", f"{_SOURCE} {_CLAUSE_1} [[and]] {_CLAUSE_2} {_AS_IS}"),
    ("bsd-3-clause", f"{_SOURCE} {_CLAUSE_1} {_CLAUSE_2} [[and]] {_CLAUSE_3} {_AS_IS}"),
    ("cc-by-4.0", f"{_CC} {{{{CC BY|Attribution}}}} 4 0 [[International]] [[License]]"),
    ("cc-by-nc-4.0", f"{_CC} {{{{CC BY NC|Attribution NonCommercial}}}} 4 0 [[International]] [[License]]"),
    ("cc-by-sa-4.0", f"{_CC} {{{{CC BY SA|Attribution ShareAlike}}}} 4 0 [[International]] [[License]]"),
    ("cc0-1.0", f"{_CC} {{{{CC0|Zero}}}} 1 0 [[Universal]] [[Public Domain Dedication]]"),
    ("gpl-2.0", f"{_GRANT} GNU General Public License {_GNU} 2 {_LATER}"),
    ("gpl-3.0", f"{_GRANT} GNU General Public License {_GNU} 3 {_LATER}"),
    ("isc", "Permission to use copy modify and {{or distribute|distribute}} this software for any purpose with or without fee is hereby granted provided that "
            "the above copyright notice and this permission notice appear in all copies"),
    ("lgpl-2.1", f"{_GRANT} GNU Lesser General Public License {_GNU} 2 1 {_LATER}"),
    ("lgpl-3.0", f"{_GRANT} GNU Lesser General Public License {_GNU} 3 {_LATER}"),
    ("mit-notice", f"{_GRANT} MIT License"),
    ("mit-text", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the Software to deal "
                 "in the Software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the Software and to permit persons to whom the Software is furnished to do so subject to the following conditions "
                 "[[The above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the Software]]"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License v 2 0"),
    ("mpl-2.0", f"{_GRANT} Mozilla Public License [[Version|v]] 2 0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Bytes to words: A-Z lower-cased, ASCII letters, digits and all non-ASCII stay, the rest parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PIECE = 1 << 20
#: Deterministic states held at once.
STATES = 1 << 15


def words_of(text: str) -> list[str]:
    return [w.decode() for w in text.encode().translate(_FOLD).split()]


# ---------------------------------------------------------------- markup

_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+),(\d+)\}\}|\{\{(.*?)\}\}|\|")


def parse(template: str):
    """The template as a list of parts: a word, ("any", m, n), ("one", alternatives) or ("optional", alternatives)."""
    stack, at = [[[]]], 0
    for m in [*_MARK.finditer(template), None]:
        stack[-1][-1].extend(words_of(template[at:m.start() if m else len(template)]))
        if m is None:
            break
        at, mark = m.end(), m.group()
        if mark == "[[":
            stack.append([[]])
        elif mark == "]]":
            part = ("optional", stack.pop())
            stack[-1][-1].append(part)
        elif mark == "|":
            stack[-1].append([])
        elif m.group(1):
            stack[-1][-1].append(("any", int(m.group(1)), int(m.group(2))))
        else:
            stack[-1][-1].append(("one", [words_of(x) for x in m.group(3).split("|")]))
    if len(stack) != 1 or len(stack[0]) != 1:
        raise ValueError(f"unbalanced marks: {template}")
    return stack[0][0]


def as_regex(parts) -> str:
    """The template over words with a space before each; add a space for the end of the last."""
    out = []
    for p in parts:
        if isinstance(p, str):
            out.append(" " + p)
        elif p[0] == "any":
            out.append(f"(?: [^ ]+){{{p[1]},{p[2]}}}")
        else:
            out.append("(?:" + "|".join(map(as_regex, p[1])) + (")?" if p[0] == "optional" else ")"))
    return "".join(out)


# ---------------------------------------------------------------- automaton


class Automaton:
    """All templates and phrases as one automaton over words, made deterministic as texts need it."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.empty: list[list[int]] = []  # state -> states reached without a word
        self.moves: list[list[tuple]] = []  # state -> (word, or None for any word, state)
        self.accepts: dict[int, tuple] = {}  # state -> (label, words of the phrase; 0: a template)
        self.keys: set[bytes] = set()
        self.start = self._state()
        for markup, label, size in [*((t, label, 0) for label, t in templates), *((p, label, len(words_of(p))) for p, label in phrases)]:
            parts = parse(markup)
            fixed = [p for p in parts if isinstance(p, str)]
            if not fixed:
                raise ValueError(f"no mandatory word: {markup}")
            self.keys.add(max(fixed, key=len).encode())
            begin = self._state()
            self.empty[self.start].append(begin)
            self.accepts[self._append(begin, parts)] = (label, size)
        self.words = {w for moves in self.moves for w, _ in moves if w is not None}
        self._clear()

    def _state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def _append(self, state: int, parts) -> int:
        for p in parts:
            end = self._state()
            if isinstance(p, str):
                self.moves[state].append((p.encode(), end))
            elif p[0] == "any":
                for k in range(p[2]):
                    if k >= p[1]:
                        self.empty[state].append(end)
                    after = self._state()
                    self.moves[state].append((None, after))
                    state = after
                self.empty[state].append(end)
            else:
                for alternative in p[1]:
                    self.empty[self._append(state, alternative)].append(end)
                if p[0] == "optional":
                    self.empty[state].append(end)
            state = end
        return state

    def _clear(self):
        self.ids: dict[frozenset, int] = {}
        self.rows: list[dict] = []
        self.members: list[frozenset] = []
        self.found: list[tuple] = []
        self.first = self._id({self.start})

    def _id(self, states) -> int:
        seen, stack = set(states), list(states)
        while stack:
            for s in self.empty[stack.pop()]:
                if s not in seen:
                    seen.add(s)
                    stack.append(s)
        key = frozenset(seen)
        if key not in self.ids:
            self.ids[key] = len(self.rows)
            self.rows.append({})
            self.members.append(key)
            self.found.append(tuple(sorted(self.accepts[s] for s in key if s in self.accepts)))
        return self.ids[key]

    def _step(self, at: int, word) -> int:
        nxt = {t for s in self.members[at] for w, t in self.moves[s] if w is None or w == word}
        return self._id(nxt | {self.start})  # a match may begin at any word

    def scan(self, pieces):
        """(label, phrase words or 0, number of the last word) of each match of the text in ``pieces`` (lists of words)."""
        if len(self.rows) > STATES:
            self._clear()
        at, k, known = self.first, 0, self.words
        for piece in pieces:
            for w in piece:
                row = self.rows[at]
                w = w if w in known else None
                to = row.get(w)
                if to is None:
                    to = row[w] = self._step(at, w)
                at = to
                if self.found[at]:
                    for label, size in self.found[at]:
                        yield label, size, k
                k += 1


def pieces(text: str | None):
    """Lists of the text's words, a piece of the text at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(data):
        end = len(data) if at + PIECE >= len(data) else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


_OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "templates array<struct<label: string, last_word: long>>")


def _scanner(templates, phrases):
    def run(batches):
        machine = Automaton(templates, phrases)
        kinds = pa.list_(pa.struct([("label", pa.string()), ("last_word", pa.int64())]))
        types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), kinds]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "templates"]
        for b in batches:
            rows = []
            for doc_id, text in rows_of(b, "doc_id", "text"):
                n, hit = 0, False
                for piece in pieces(text):
                    n += len(piece)
                    hit = hit or not machine.keys.isdisjoint(piece)
                base, count, low, high, full = set(), 0, None, None, {}
                if hit:
                    for label, size, k in machine.scan(pieces(text)):
                        if size:
                            base.add(label)
                            count += 1
                            low = k - size + 1 if low is None else min(low, k - size + 1)
                            high = k - size + 1 if high is None else max(high, k - size + 1)
                        else:
                            full.setdefault(label, k)
                rows.append((doc_id, n, count, low, high, ",".join(sorted(base)), ",".join(sorted(base | full.keys())),
                             1.0 if full else 0.5 if base else 0.0, [{"label": x, "last_word": k} for x, k in sorted(full.items())]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names)

    return run


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """doc_id, n_words, phrase places (n_base, first_word, last_word, base_labels), labels, score and, per
    matched template, the number of the word where it first ends."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scanner(templates, phrases), _OUT)


def _oracle() -> str:
    place = lambda phrase: " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words_of(phrase)))
    found = [f"[{{'l': '{label}', 'i': i}} for i in range(1, len(w) + 1) if {place(phrase)}]" for phrase, label in PHRASES]
    full = [f"CASE WHEN regexp_matches(j, '{as_regex(parse(t))} ') THEN ['{label}'] ELSE [] END" for label, t in TEMPLATES]
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j FROM d),
p AS (SELECT doc_id, w, list_concat({', '.join(found)}) AS p,
        list_sort(list_distinct(flatten([{', '.join(full)}]))) AS t FROM e)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
  CAST(list_min([x.i for x in p]) - 1 AS BIGINT) AS first_word, CAST(list_max([x.i for x in p]) - 1 AS BIGINT) AS last_word,
  COALESCE(array_to_string(list_sort(list_distinct([x.l for x in p])), ','), '') AS base_labels,
  COALESCE(array_to_string(list_sort(list_distinct(list_concat([x.l for x in p], t))), ','), '') AS labels,
  CASE WHEN len(t) > 0 THEN 1.0::DOUBLE WHEN len(p) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM p
"""


@query("op12_license_markup", _oracle())
def op12_license_markup(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents")).drop("templates")
