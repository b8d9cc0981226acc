"""Exchange of packed hash tables between text chunks and hash buckets.

Exact repeat search needs a global question per hash ("does it occur anywhere
else?") without moving the texts around: documents are dealt to chunks of about
``CHUNK_BYTES`` or more; a chunk sends each hash bucket one packed, sorted blob, the
bucket answers with one blob per chunk. What a chunk repeats itself is packed
before it is sent, so a key that is frequent everywhere arrives in its bucket at
most once per chunk. Chunks are rebuilt identically from the documents (a hash
deals them, a sort orders them), so a lost task can be run again at any time.
All stages are one lazy plan; the documents' exchange is shared by them.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.llm.common import text_bytes

#: Text bytes of a chunk, and text bytes whose hashes fall into one bucket. Every
#: chunk sends every bucket a blob, so from ``GROW_BYTES`` on both sizes grow with
#: the square root of the corpus and the number of blobs in proportion to it, up
#: to ``MAX_GROWTH`` times (256 MB and 1 GB at 16 TB, which asks for executors
#: with some GB for Python).
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
GROW_BYTES = 4 << 30
MAX_GROWTH = 64
PACKED = "bucket int, chunk int, blob binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("blob", pa.binary())])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes (equal high bytes vanish), compressed."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.reshape(-1, 1).view(np.uint8).T if a.itemsize > 1 else a
        out.append((a.dtype.str, a.shape, squeeze(planes.tobytes())))
    return pickle.dumps(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    out = []
    for dtype, shape, data in pickle.loads(blob):
        kind, raw = np.dtype(dtype), np.frombuffer(expand(data), np.uint8)
        if kind.itemsize > 1:
            raw = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T)
        out.append(raw.view(kind).reshape(shape))
    return out


def rising(values: np.ndarray) -> np.ndarray:
    """Differences of a sorted array (its own inverse is cumsum)."""
    return np.diff(values, prepend=values.dtype.type(0))


def summed(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)


class Plan:
    """``docs`` (doc_id, text) dealt to chunks, and the number of hash buckets;
    ``bucket_share`` makes buckets smaller where more than hashes is sent."""

    def __init__(self, docs: DataFrame, bucket_share: float = 1.0):
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        growth = min(max(1.0, math.sqrt(total / GROW_BYTES)), MAX_GROWTH)
        self.chunks = max(1, math.ceil(total / (CHUNK_BYTES * growth)))
        self.buckets = max(1, math.ceil(total / (BUCKET_BYTES * growth * bucket_share)))
        self.docs = rows.withColumn("tie", F.xxhash64("text")).withColumn(
            "chunk", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(self.chunks)).cast("int"))

    def send(self, make) -> DataFrame:
        """``make(Chunk)`` yields (bucket, arrays) for every chunk."""
        def run(table: pa.Table) -> pa.Table:
            chunk = Chunk(table)
            return _packed((b, chunk.number, pack(*arrays)) for b, arrays in make(chunk))

        return self.docs.groupBy("chunk").applyInArrow(run, PACKED)

    def send_after(self, replies: DataFrame, make) -> DataFrame:
        """Like ``send``; ``make(Chunk, {bucket: arrays})`` also gets the replies."""
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left):
                return _packed(())
            chunk = Chunk(left)
            return _packed((b, chunk.number, pack(*arrays)) for b, arrays in make(chunk, _by_bucket(right)))

        return self.docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, PACKED)

    def finish(self, replies: DataFrame, make, schema: str, columns: pa.Schema) -> DataFrame:
        """``make(Chunk, {bucket: arrays})`` gives the result columns of its documents."""
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left):
                return columns.empty_table()
            return pa.table(make(Chunk(left), _by_bucket(right)), schema=columns)

        return self.docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


def answer(sent: DataFrame, make) -> DataFrame:
    """``make({chunk: arrays})`` yields (chunk, arrays) for every bucket."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = {c: unpack(b) for c, b in sorted(zip(table.column("chunk").to_pylist(),
                                                     table.column("blob").to_pylist(), strict=True))}
        return _packed((bucket, c, pack(*arrays)) for c, arrays in make(blobs))

    return sent.groupBy("bucket").applyInArrow(run, PACKED)


def _packed(rows) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PACKED, strict=True)], schema=_PACKED)


def _by_bucket(table: pa.Table) -> dict[int, list[np.ndarray]]:
    return {b: unpack(x) for b, x in zip(table.column("bucket").to_pylist(), table.column("blob").to_pylist(), strict=True)}


class Chunk:
    """The documents of one chunk in their fixed order."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id")
        known = np.asarray(ids.is_valid().to_numpy())
        value = ids.fill_null(0).to_numpy()
        order = np.lexsort((table.column("tie").to_numpy(), value, known))
        table = table.take(pa.array(order))
        self.number = table.column("chunk")[0].as_py()
        self.doc_id = table.column("doc_id")
        # A null id is smaller than none.
        self.ids = np.where(known, value, np.iinfo(np.int64).max)[order]
        self.data, self.offsets = text_bytes(table.column("text"))
        self.n = len(order)


def cuts(hashes: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where the ranges of the buckets begin in sorted ``bits``-bit hashes."""
    edges = np.array([(b << bits) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))
