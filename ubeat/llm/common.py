"""Helpers the operators share: table access, checkpoints, Arrow text buffers,
vectorised tokenising and prefix hashes, and iterative components."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task (one longer document is one piece).
PIECE_BYTES = 1 << 20

#: Bytes that end a word of the "words [^\x20\x09-\x0D]+" contracts.
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~_SPACES

#: Word bytes of "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+" after A-Z became a-z.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Byte -> byte with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: The words of the white-space contracts as a Java / DuckDB regular expression.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; one of our own only where the
    session names none and runs locally, as in tests."""
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="ubeat-checkpoint-")
        sc.setCheckpointDir(named)
        found = sc._jsc.sc().getCheckpointDir()
    return found.get()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


# ---------------------------------------------------------------- Arrow text

def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """(i, j) ranges of documents with at most ``limit`` bytes, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """(starts, ends, first) of the words; ``first[d]:first[d + 1]`` are
    document d's words. Words never cross documents."""
    inside = is_word[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# -------------------------------------------------------------- prefix hashes

_ODD = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, PIECE_BYTES + 64)

        def run(b: int) -> np.ndarray:
            a = np.full(size, b, np.uint64)
            a[0] = 1
            return np.cumprod(a, dtype=np.uint64)

        have = run(base), run(pow(base, -1, 1 << 64))
        if size <= 2 * PIECE_BYTES:  # tables of one very long text are not kept
            _POWERS[base] = have
    return have


class PrefixHash:
    """Hashes of any slice of a sequence of 64-bit symbols from one cumulative
    sum: sum of symbol[i] * base**i, brought back to exponent 0, finalised."""

    def __init__(self, symbols: np.ndarray, base: int = _ODD):
        n = len(symbols)
        up, self.down = _powers(n + 1, base)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * up[:n], dtype=np.uint64, out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix64(raw + (ends - starts).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = (self.sums[size:] - self.sums[:n]) * self.down[:n]
        return mix64(raw + np.uint64(size))


def byte_hash(data: np.ndarray, base: int = _ODD) -> PrefixHash:
    return PrefixHash(data.astype(np.uint64) + np.uint64(1), base)


# ---------------------------------------------------------------- components

def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over undirected links.

    Alternates large-star and small-star rounds (each node hangs itself and its
    larger, then its smaller neighbours under the smallest one) until no link
    changes; every round is a checkpointed pair of aggregations, so the number
    of rounds is logarithmic and no lineage builds up. Nodes without a link are
    not returned.
    """
    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    links = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    links = checkpoint(links)
    done = None
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = smallest(large)
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        links = checkpoint(small)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == done:
            break
        done = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
