"""Shared helpers of the training-data operators.

* tables that cut lineage are Parquet files in the shared checkpoint folder;
* texts reach numpy as the byte buffers of Arrow batches, in blocks of bounded
  size, so a task's memory follows the block (or the longest text), not the batch;
* connected components are computed with joins and aggregates only.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, \t, \n, \v, \f, \r.
WORD_RE = r"[^\x20\x09-\x0D]+"
#: Bytes of text that numpy works on at once.
BLOCK_BYTES = 1 << 20

_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a scratch folder only if unset on a local master (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    path = "file://" + tempfile.mkdtemp(prefix="glean-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: what follows never recomputes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/glean-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns_of(df: DataFrame, names: list[str]) -> DataFrame:
    """Only ``names``: extra columns of the input can't clash with what operators add."""
    return df.select(*[F.col(f"`{n}`") for n in names])


# ---------------------------------------------------------------- bytes of texts


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads the bits of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POW.get("n", 0)
    if have < n:
        size = max(n, 1 << 20)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            done, step = 1, base
            while done < size:
                take = min(done, size - done)
                p[done:done + take] = p[:take] * np.uint64(step)
                step = step * step & _MASK
                done += take
            out.append(p)
        _POW.update(n=size, up=out[0], down=out[1])
    return _POW["up"][:n], _POW["down"][:n]


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and its row offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, off


def blocks(column, limit: int = BLOCK_BYTES):
    """(first row, last row + 1, bytes, offsets from 0) for consecutive rows of at most ``limit`` bytes (or one row)."""
    buf, off = text_buffer(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, i + 4096, n)
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def rows_of(batch: pa.RecordBatch, *names: str, step: int = 64):
    """The rows of an Arrow batch as tuples, decoded a few at a time (long texts)."""
    for at in range(0, batch.num_rows, step):
        yield from zip(*[batch.column(n).slice(at, step).to_pylist() for n in names])


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and row of each word; words never cross rows."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~IS_SPACE[buf]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = ink[1:]
    ends = np.flatnonzero(ink & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words (polynomial prefix sums modulo 2**64, then mixed); ``lower`` folds A-Z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * up[:len(buf)], out=total[1:])
    return splitmix((total[ends] - total[starts]) * down[starts])


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges``.

    Alternates "large star" and "small star" steps: each links the neighbours of a
    node to the smallest of them, with an aggregate and a join on the node (a hub
    with very many neighbours is pre-aggregated and its join partition can be
    split). The edge set ends as one star per component, after a number of rounds
    that grows with the logarithm of the longest path. Each round is a table in the
    shared folder. Nodes without edges don't appear.
    """
    e = save(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")
        ).select("x.u", "x.v").filter("u <> v").distinct()
        e = save(small, "edges")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
