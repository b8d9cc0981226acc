"""Document fingerprints by winnowing.

Every run of ``K`` bytes of a text gets a rolling hash; of each window of ``W``
consecutive hashes the smallest is kept, the rightmost on ties, with its
position. So a passage of at least K + W - 1 bytes that two texts share gives a
common selected hash in both. A text of fewer than K bytes has one hash, of the
whole text; a text of fewer than W hashes is one window.

The fingerprint string is the selected hashes' upper 32 bits in order of
position, 8 hex digits each, a hash that follows itself written once. Likeness
is the Jaccard index of two sets of selected hashes.

For the edited text a document needs its successor by doc_id. Documents are
sorted by range of id once; the first document of every range is also sent to
the range before it, so every task streams its documents in order and holds two
at a time.

Edge cases: a null text is empty; an empty text's fingerprint is that of the
empty text, and two empty texts have likeness 1; a very long text is a piece of its
own, held by one task; rows with equal doc_ids follow
each other by the hash of their text, and null ids come first; a single document
is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.llm.common import byte_hash

K = 8
W = 13
#: Rows a range should have, and the number of ranges that are told apart at most
#: (a range is streamed, so its size is not bounded by memory).
RANGE_ROWS = 4_000
MAX_RANGES = 512
FLUSH_BYTES = 4 << 20


def sliding_minima(hashes: np.ndarray, w: int) -> np.ndarray:
    """Position of the rightmost minimum of every window of ``w`` 32-bit hashes.

    Hash and reversed position make one key without ties; sliding minima come
    from running minima of blocks of ``w`` in both directions."""
    n = len(hashes)
    last = np.uint64(0xFFFFFFFF)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = (hashes.astype(np.uint64) << np.uint64(32)) | (last - np.arange(n, dtype=np.uint64))
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - w + 1], ahead[w - 1:n])
    return (last - (least & last)).astype(np.int64)


def window_minima(hashes: np.ndarray, w: int) -> np.ndarray:
    """The positions that are the rightmost minimum of some window, in order (a
    text shorter than a window is one)."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    at = sliding_minima(hashes, min(w, len(hashes)))
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def winnow(text: bytes, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) selected from ``text``."""
    data = np.frombuffer(text, np.uint8)
    size = min(k, len(data))
    hashes = byte_hash(data).windows(size) if size else np.zeros(1, np.uint64)
    hashes = (hashes >> np.uint64(32)).astype(np.uint32)
    at = window_minima(hashes, w)
    return hashes[at], at


def written(hashes: np.ndarray) -> str:
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))].astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _chars(text: bytes) -> np.ndarray:
    """Byte positions where code points start, and the end."""
    data = np.frombuffer(text, np.uint8)
    return np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))


def edited(text: bytes, following: bytes) -> bytes:
    """The last quarter of the code points replaced from the following text."""
    own, other = _chars(text), _chars(following)
    n = len(own) - 1
    return text[:own[n - n // 4]] + following[:other[min(n // 4, len(other) - 1)]]


def in_order(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, text, bin, extra) sorted in ranges of ids; ``extra`` marks the
    copy of the first document of the next range (for the last, of the first)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.select("doc_id").where("doc_id is not null")
    ranges = ranges or max(1, min(MAX_RANGES, known.count() // RANGE_ROWS))
    cuts = known.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    table = F.array(*[F.lit(c).cast("long") for c in sorted({int(c) for c in cuts})]).cast("array<long>")
    rows = rows.withColumn("own", F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.size(F.filter(table, lambda c: c <= F.col("doc_id")))))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # One row per range: where it starts.
    heads = sorted(rows.groupBy("own").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie"))
                                           .alias("head")).collect(), key=lambda r: r.own)
    first = F.lit(False)
    to = F.lit(None).cast("int")
    for i, r in enumerate(heads):
        here = (F.col("own") == r.own) & F.col("doc_id").eqNullSafe(F.lit(r.head.doc_id)) & (F.col("tie") == r.head.tie)
        first, to = first | here, F.when(here, heads[i - 1].own).otherwise(to)
    copies = F.array(F.struct(F.col("own").alias("bin"), F.lit(False).alias("extra")),
                     F.struct(to.alias("bin"), F.lit(True).alias("extra")))
    rows = rows.withColumn("to", F.explode(F.when(first, copies).otherwise(F.slice(copies, 1, 1))))
    return (rows.select("doc_id", "text", "tie", "to.bin", "to.extra").repartition("bin")
            .sortWithinPartitions("bin", "extra", "doc_id", "tie"))


def fingerprint_edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Per document its fingerprint (string and positions), its edited text's,
    and their likeness to each other and to the next document's."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, positions array<long>, "
              "edited_fingerprint string, near_edited double, near_next double")

    def judged(doc_id, text, own, after, after_own):
        changed = edited(text, after)
        other = winnow(changed, k, w)
        return {"doc_id": doc_id, "n_chars": len(_chars(text)) - 1, "edited_sha256": hashlib.sha256(changed).hexdigest(),
                "fingerprint": written(own[0]), "positions": own[1].tolist(), "edited_fingerprint": written(other[0]),
                "near_edited": likeness(own[0], other[0]), "near_next": likeness(own[0], after_own[0])}

    columns = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                         ("fingerprint", pa.string()), ("positions", pa.list_(pa.int64())),
                         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches):
        wait = None  # the document whose successor is still to come: (bin, id, text, fingerprint)
        for batch in batches:
            out, room = [], FLUSH_BYTES
            ids, bins, extras = (batch.column(c).to_pylist() for c in ("doc_id", "bin", "extra"))
            for doc_id, text, here, extra in zip(ids, batch.column("text").cast(pa.binary()), bins, extras, strict=True):
                if extra and (wait is None or wait[0] != here):
                    continue  # a repeated first row
                text = text.as_py()
                own = winnow(text, k, w)
                if wait is not None:
                    out.append(judged(*wait[1:], text, own))
                    room -= len(wait[2])
                wait = None if extra else (here, doc_id, text, own)
                if room < 0:
                    yield pa.RecordBatch.from_pylist(out, columns)
                    out, room = [], FLUSH_BYTES
            yield pa.RecordBatch.from_pylist(out, columns)

    return in_order(docs).select("doc_id", "text", "bin", "extra").mapInArrow(run, schema)


def op8_fingerprints(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fingerprint_edits(docs).drop("positions")
