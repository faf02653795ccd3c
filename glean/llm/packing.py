"""Hierarchical multi-length packing.

A document is its token ids and an end id. Documents are routed to context tiers
(``TIERS``, powers of two): the shortest tier that holds them; of a longer document
every full window is a sequence, and the rest is routed. From the longest tier down,
each document opens a window; its gap is filled with whole documents of shorter
tiers, the longest that fits first, and closed by cutting one. What is left when a
partition ends is laid out in windows of powers of two, so no sequence is padded.
Sequences of a block are dealt into step groups of about equal attention cost (the
sum of squared piece lengths), most expensive first.

Each input partition packs its own rows in blocks of ``BLOCK_TOKENS``: no shuffle,
memory bounded by the block and the longest document, and a lost task packs again
alike (input rows come in the same order from a scan or a saved table).

Edge cases: null and empty texts are one end id; repeated rows are packed each; an
empty table has no sequences; doc_id may be null.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from glean.llm.common import BLOCK_BYTES, table, with_columns_of
from glean.llm.registry import query

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
BLOCK_TOKENS = 1 << 21
STEP_TOKENS = 64 * 4096
#: Distinct words, and distinct pieces of words, whose ids a worker remembers (twice each, halves are dropped in turn).
CACHE_WORDS = 1 << 19


class Recent:
    """What was looked up lately: two halves of about ``CACHE_WORDS`` entries, the older one dropped in turn."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def unseen(self, keys: set) -> list:
        """The keys to be learned; all others are in ``new`` afterwards."""
        if len(self.new) >= CACHE_WORDS:
            self.old, self.new = self.new, {}
        missing = keys.difference(self.new)  # looks up each key; "keys - self.new.keys()" would walk all that is remembered
        known = missing & self.old.keys()
        self.new.update((k, self.old[k]) for k in known)
        return list(missing - known)


class WordTokenizer:
    """Ids of whole texts, word by word.

    The tokenizer splits at white space before anything else and no rule looks
    across it, so a text's ids are its words' ids; words repeat, so each is encoded
    once. Words of Latin letters are split into pieces here, and the new pieces of a
    block of texts are encoded by the model in one call; any other word goes through
    the whole tokenizer, and so does a text that spells a special token.
    """

    #: Fixed values of the vocabulary file's pre-tokenizer and model.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LAST = "</w>"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.full.model)  # pieces between blanks, nothing else
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.full.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a piece
        self.last[[i for t, i in vocab.items() if t.endswith(self.LAST)]] = True
        self.pieces = regex.compile(self.PIECES)
        self.latin = re.compile(r"[^\sɐ-\U0010ffff\x00-\x1f\x7f-\xa0]+\Z")
        self.letter = [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else None for b in range(256)]
        spare = iter(range(256, 512))
        self.letter = [c or chr(next(spare)) for c in self.letter]  # the byte-level alphabet
        self.words, self.parts = Recent(), Recent()

    def _learn_pieces(self, pieces: set[str]) -> None:
        new = self.parts.unseen(pieces)
        if not new:
            return
        spelled = " ".join([p if p.isascii() else "".join([self.letter[b] for b in p.encode()]) for p in new])
        ids = np.array(self.plain.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u2")
        end = (2 * np.flatnonzero(self.last[ids]) + 2).tolist()
        if len(end) != len(new):
            raise ValueError("the vocabulary doesn't spell every piece to its end")
        raw = ids.tobytes()
        self.parts.new.update(zip(new, [raw[a:b] for a, b in zip([0, *end], end)]))

    def _learn_words(self, words: set[bytes]) -> None:
        new, flat, ends = [], [], []  # the pieces of all new words in one list: no container a word
        missing = self.words.unseen(words)
        letters = [w for w in missing if w.isalpha()]  # of ASCII letters: a piece each
        spelled = b" ".join(letters).lower().decode().split()
        for word in missing:
            if word.isalpha():
                continue
            text = word.decode("utf-8", "replace")
            if not self.latin.match(text):
                self.words.new[word] = np.array(self.full.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
                continue
            flat += self.pieces.findall(text.lower())
            new.append(word)
            ends.append(len(flat))
        self._learn_pieces({*spelled, *flat})
        ids = list(map(self.parts.new.__getitem__, flat))
        at, known = 0, self.words.new
        known.update(zip(letters, map(self.parts.new.__getitem__, spelled)))
        for word, end in zip(new, ends):
            known[word] = ids[at] if end - at == 1 else b"".join(ids[at:end])
            at = end

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text; the words of all of them are learned together."""
        split = [None if b"<|" in t else t.split() for t in texts]
        self._learn_words(set().union(*[w for w in split if w]))
        known = self.words.new.__getitem__
        return [np.array(self.full.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u2") if w is None
                else np.frombuffer(b"".join(map(known, w)), "<u2") for t, w in zip(texts, split)]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Pools:
    """Pieces (document, start, length) waiting in tiers, each tier in order of length."""

    def __init__(self):
        self.tiers: list[list[tuple[int, int, int]]] = [[] for _ in TIERS]
        self.next: list[int] = []

    def put(self, doc: int, start: int, length: int) -> None:
        tier = next(i for i, t in enumerate(TIERS) if length <= t)
        insort(self.tiers[tier], (length, doc, start))

    def fitting(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``gap`` in the tiers under ``below``."""
        for pool in reversed(self.tiers[:below]):
            k = bisect_right(pool, (gap, 1 << 62, 0))
            if k:
                return pool.pop(k - 1)
        return None

    def shortest(self) -> tuple[int, int, int] | None:
        for pool in self.tiers:
            if pool:
                return pool.pop(0)
        return None


def pack(lengths: list[tuple[int, int, int]], last: bool) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) and the pieces left over.

    ``lengths`` has (document, start, length) of what is to be packed. Every sequence
    is as long as a tier; with ``last`` nothing is left, and the final sequences are
    as long as smaller powers of two.
    """
    top, done, pools = TIERS[-1], [], Pools()
    for doc, start, length in lengths:
        while length > top:
            done.append([(doc, start, top)])
            start, length = start + top, length - top
        if length:
            pools.put(doc, start, length)
    left: list[tuple[int, int, int]] = []
    for tier in range(len(TIERS) - 1, -1, -1):
        while pools.tiers[tier]:
            length, doc, start = pools.tiers[tier].pop()
            window, gap = [(doc, start, length)], TIERS[tier] - length
            while gap:
                whole = pools.fitting(gap, tier + 1)
                if whole:
                    window.append((whole[1], whole[2], whole[0]))
                    gap -= whole[0]
                    continue
                cut = pools.shortest()
                if cut is None:
                    break
                window.append((cut[1], cut[2], gap))
                pools.put(cut[1], cut[2] + gap, cut[0] - gap)
                gap = 0
            if gap:
                left += window
            else:
                done.append(window)
    if last and left:
        rest, bits = sum(x[2] for x in left), []
        while rest:
            bits.append(1 << (rest.bit_length() - 1))
            rest -= bits[-1]
        queue = left[::-1]
        for size in bits:
            window = []
            while size:
                doc, start, length = queue.pop()
                take = min(size, length)
                window.append((doc, start, take))
                if length > take:
                    queue.append((doc, start + take, length - take))
                size -= take
            done.append(window)
        left = []
    return done, left


def step_groups(sequences: list[list[tuple[int, int, int]]]) -> list[int]:
    """A group for each sequence; groups get about equal attention cost."""
    cost = [sum(x[2] ** 2 for x in s) for s in sequences]
    n = max(1, round(sum(x[2] for s in sequences for x in s) / STEP_TOKENS))
    heap, out = [(0, g) for g in range(n)], [0] * len(sequences)
    for k in sorted(range(len(sequences)), key=lambda k: -cost[k]):
        load, g = heapq.heappop(heap)
        out[k] = g
        heapq.heappush(heap, (load + cost[k], g))
    return out


SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, context bigint, step_group bigint")


def packed(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece; ``context`` is the sequence's length, ``step_group`` its group."""

    def run(batches):
        from pyspark import TaskContext

        tok, part = tokenizer(path), TaskContext.get().partitionId()
        docs_, waiting, tokens, n_seq, n_group = {}, [], 0, 0, 0  # documents not yet wholly packed

        def flush(last):
            nonlocal waiting, tokens, n_seq, n_group
            sequences, waiting = pack(waiting, last)
            groups, rows = step_groups(sequences), []
            for seq, group in zip(sequences, groups):
                offset, context = 0, sum(x[2] for x in seq)
                for k, start, length in seq:
                    doc_id, ids = docs_[k]
                    crc = zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
                    rows.append((doc_id, start, length, crc, len(ids), (part << 36) + n_seq, offset, context, (part << 36) + n_group + group))
                    offset += length
                n_seq += 1
            n_group += max(groups, default=-1) + 1
            need = {x[0] for x in waiting}
            for k in [k for k in docs_ if k not in need]:
                del docs_[k]
            tokens = sum(x[2] for x in waiting)
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(names))], names)

        def texts_by_block():
            """(doc_id, text) lists of about ``BLOCK_BYTES`` of text, 256 rows or one text."""
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    ids_ = b.column("doc_id").slice(at, 256).cast(pa.int64()).to_pylist()
                    texts = b.column("text").slice(at, 256).cast(pa.large_binary()).to_pylist()
                    block, size = [], 0
                    for doc_id, text in zip(ids_, texts):
                        if block and size + len(text or b"") > BLOCK_BYTES:
                            yield block
                            block, size = [], 0
                        block.append((doc_id, text or b""))
                        size += len(text or b"")
                    yield block

        seen = 0
        for block in texts_by_block():
            for (doc_id, _), ids in zip(block, tok.ids([text for _, text in block])):
                ids = np.append(ids, np.uint16(END_ID))
                docs_[seen] = (doc_id, ids)
                waiting.append((seen, 0, len(ids)))
                seen, tokens = seen + 1, tokens + len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield flush(False)
        yield flush(True)

    return with_columns_of(docs, ["doc_id", "text"]).mapInArrow(run, SCHEMA)


@query("op7_packing")
def op7_packing(spark, sf_dir):
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
