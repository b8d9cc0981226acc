"""Byte-exact dedup with a distributed difference-cover suffix sort.

Which 50-byte strings also start in a document with a smaller id is read off
suffixes in sorted order. Sorting every suffix of a corpus in one order would
ship each byte's position several times over, so the sort is dealt out by
content, without loss:

1. every 50-byte window has an anchor, the rightmost smallest hash of its 35
   16-byte grams; equal windows have equal anchors. Anchors that occur once in
   the corpus are dropped (``ubeat.llm.exchange``): their windows occur once.
2. the bytes around every other anchor (its windows' union, at most 84 bytes) go
   to the bucket of the anchor's hash, equal ones of a chunk once, with their
   documents. All occurrences of a window meet in one bucket.
3. a bucket sorts the suffixes of its distinct contexts by the difference cover
   modulo 3: sampled suffixes are sorted and named by triples, again by triples
   of those names until a name spans 50 bytes, and the remaining suffixes are
   merged by their first bytes and the name of a sampled one. Adjacent suffixes are compared on
   their first 50 bytes; each run of equal ones has a smallest document.
4. the spans to remove go back to their chunks and are cut out.

Edge cases: null and empty texts have no bytes; a very long text is one document of
its chunk and held by one task; a null doc_id is smaller than no
id; rows with equal ids do not cut each other; removed spans may split a code
point (the result is bytes); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.llm.common import byte_hash, mix64, pieces
from ubeat.llm.exchange import Chunk, Plan, answer, cuts, rising, summed
from ubeat.llm.fingerprints import sliding_minima

LENGTH = 50
GRAM = 16
#: Bytes of contexts sorted at once (the contexts of one anchor stay together).
SORT_BYTES = 1 << 20
#: Occurrences marked at once, and the size of a bucket: contexts are larger than hashes.
MARK_ROWS = 1 << 15
BUCKET_SHARE = 0.35


# ---------------------------------------------------- difference-cover sorting

def _dense(x: np.ndarray) -> np.ndarray:
    """Order-preserving names 1, 2, ... of the values."""
    order = np.argsort(x)
    x = x[order]
    out = np.empty(len(x), np.int64)
    out[order] = np.concatenate(([1], 1 + np.cumsum(x[1:] != x[:-1])))
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number per pair of names, ordered as the pairs."""
    most_a, most_b = int(a.max(initial=0)), int(b.max(initial=0))
    if (most_a + 1) * (most_b + 1) >= 1 << 63:
        a = _dense(a)
    return a * (most_b + 1) + b


def suffix_ranks(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes of ``text`` (bytes) at ``starts``: suffixes that
    differ in their first ``length`` bytes are in order, suffixes that agree
    there have neighbouring ranks.

    The cover's residues are 1 and 2 modulo 3. Sampled suffixes are named by
    their first 8 bytes, then by triples of names, then by triples of those
    names, until a name spans ``length`` bytes (the parts of a triple may
    overlap, so that all its positions are of one residue).
    """
    n, reach = len(text), 3 * length + 24
    padded = np.concatenate((text, np.zeros(reach, np.uint8)))
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[:n]).view(">u8").ravel()
    sample = np.flatnonzero(np.arange(n) % 3)
    name = np.zeros(n + reach, np.int64)
    span = 8
    name[sample] = _dense(words[sample].astype(np.uint64)) if len(sample) else 0
    while span < length:
        step = span // 3 * 3
        pair = _joined(name[sample], name[sample + step])
        name[sample] = _dense(_joined(pair, name[sample + 2 * step])) if len(sample) else 0
        span += 2 * step
    # Remaining suffixes (residue 0) meet each other and residue 1 by (byte, name
    # of the next suffix), residue 2 by (byte, byte, name of the one after).
    by = [starts[starts % 3 == r] for r in range(3)]
    first, second = {}, {}
    both = np.concatenate((by[0], by[2]))
    joint = _joined(padded[both].astype(np.int64) * 256 + padded[both + 1], name[both + 2])
    second[0], second[2] = joint[:len(by[0])], joint[len(by[0]):]
    together = np.concatenate((by[0], by[1]))
    joint = _joined(padded[together].astype(np.int64), name[together + 1])
    first[0], first[1] = joint[:len(by[0])], joint[len(by[0]):]
    sampled = np.concatenate((name[by[1]], name[by[2]]))
    order = [np.sort(first[0]), np.sort(first[1]), np.sort(second[2]), np.sort(second[0]), np.sort(sampled)]
    out = np.empty(len(starts), np.int64)
    out[starts % 3 == 0] = _below(order[0], first[0]) + _below(order[1], first[0]) + _below(order[2], second[0])
    out[starts % 3 == 1] = _below(order[4], name[by[1]]) + _below(order[0], first[1])
    out[starts % 3 == 2] = _below(order[4], name[by[2]]) + _below(order[3], second[2])
    return out


def _below(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many of a sorted table are smaller than each value."""
    order = np.argsort(values)
    out = np.empty(len(values), np.int64)
    out[order] = np.searchsorted(table, values[order])
    return out


def _smallest_owner(contexts: np.ndarray, sizes: np.ndarray, owner: np.ndarray, length: int):
    """Smallest owner of the string that starts at each window of the contexts
    (rows of ``contexts``, ``sizes`` bytes long), windows in order."""
    windows = sizes - length + 1
    inside = np.arange(contexts.shape[1]) < sizes[:, None]
    text = contexts[inside]
    begin = np.cumsum(sizes) - sizes
    before = np.cumsum(windows) - windows
    start = np.repeat(begin - before, windows) + np.arange(windows.sum())
    order = np.argsort(suffix_ranks(text, start, length), kind="stable")
    strings = np.lib.stride_tricks.sliding_window_view(text, length)
    sorted_start = start[order]
    new = np.ones(len(order), bool)
    for i in range(0, len(order) - 1, 1 << 16):
        here = strings[sorted_start[i:i + (1 << 16) + 1]]
        new[i + 1:i + len(here)] = (here[1:] != here[:-1]).any(axis=1)
    runs = np.flatnonzero(new)
    least = np.minimum.reduceat(np.repeat(owner, windows)[order], runs)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(runs, len(order))))
    return out


def _removed(smallest, at, windows, context, ids, number):
    """(occurrence, first window, last window) of the runs of windows that also
    start in a document smaller than the occurrence's own (``ids``)."""
    n = windows[context]
    before = np.cumsum(n) - n
    occurrence = np.repeat(np.arange(len(context)), n)
    offset = np.arange(len(occurrence)) - before[occurrence]
    cut = smallest[at[context][occurrence] + offset] < ids[occurrence]
    new = np.concatenate(([True], occurrence[1:] != occurrence[:-1]))
    edge, stop = cut.copy(), cut.copy()
    edge[1:] &= ~cut[:-1] | new[1:]
    stop[:-1] &= ~cut[1:] | new[1:]
    a, z = np.flatnonzero(edge), np.flatnonzero(stop)
    return occurrence[a] + number, offset[a], offset[z]


# ---------------------------------------------------------------- distribution

class _Anchors:
    """Anchors of one chunk's documents, in order of position."""

    def __init__(self, chunk: Chunk, length: int, gram: int):
        doc, first, last, hashes = [], [], [], []
        for i, j in pieces(chunk.offsets):
            base = chunk.offsets[i]
            data, offsets = chunk.data[base:chunk.offsets[j]], chunk.offsets[i:j + 1] - base
            grams = byte_hash(data).windows(gram)
            size = length - gram + 1
            if len(grams) < size:
                continue
            at = sliding_minima((grams >> np.uint64(32)).astype(np.uint32), size)
            start = np.arange(len(at))
            owner = np.searchsorted(offsets, start, side="right") - 1
            valid = start + length <= offsets[owner + 1]
            start, at, owner = start[valid], at[valid], owner[valid]
            if not len(start):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
            edge = np.flatnonzero(new)
            doc.append(owner[edge] + i)
            first.append(start[edge] + base)
            last.append(start[np.append(edge[1:], len(start)) - 1] + base)
            # Anchors are minima, so their hashes are small; mixed again they spread evenly.
            hashes.append(mix64(grams[at[edge]]) >> np.uint64(16))
        none = np.zeros(0, np.int64)
        self.doc, self.first, self.last = (np.concatenate([none, *x]) for x in (doc, first, last))
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.order = np.argsort(self.hashes, kind="stable")


def dedup_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, kept, spans): the bytes left and those removed."""
    plan = Plan(docs, BUCKET_SHARE)
    buckets, width = plan.buckets, 2 * length - gram

    def anchors(chunk: Chunk):
        found = _Anchors(chunk, length, gram)
        hashes = found.hashes[found.order]
        at = cuts(hashes, buckets, 48)
        for b in range(buckets):
            if at[b] < at[b + 1]:
                yield b, (rising(hashes[at[b]:at[b + 1]]),)

    def repeated(blobs: dict):
        sent = {c: summed(h) for c, (h,) in blobs.items()}
        value, count = np.unique(np.concatenate(list(sent.values())), return_counts=True)
        value = value[count > 1]
        for c, h in sent.items():
            keep = value[np.minimum(np.searchsorted(value, h), len(value) - 1)] == h if len(value) else np.zeros(len(h), bool)
            yield c, (np.packbits(keep),)

    def contexts(chunk: Chunk, replies: dict):
        found = _Anchors(chunk, length, gram)
        at = cuts(found.hashes[found.order], buckets, 48)
        padded = np.concatenate((chunk.data, np.zeros(width, np.uint8)))
        for b in range(buckets):
            if at[b] == at[b + 1]:
                continue
            keep = np.unpackbits(replies[b][0], count=int(at[b + 1] - at[b])).astype(bool)
            own = found.order[at[b]:at[b + 1]][keep]
            if not len(own):
                continue
            size = found.last[own] - found.first[own] + length
            rows = np.empty((len(own), width + 9), np.uint8)
            rows[:, :8] = found.hashes[own].astype(">u8").view(np.uint8).reshape(-1, 8)
            rows[:, 8] = size
            rows[:, 9:] = np.lib.stride_tricks.sliding_window_view(padded, width)[found.first[own]]
            rows[:, 9:][np.arange(width) >= size[:, None]] = 0
            row = np.ascontiguousarray(rows).view(np.dtype((np.void, width + 9))).ravel()
            distinct, which = np.unique(row, return_inverse=True)
            table = distinct.view(np.uint8).reshape(-1, width + 9)
            order = np.argsort(which, kind="stable")
            doc = found.doc[own][order]
            yield b, (table[:, :8].copy().view(">u8").ravel().astype(np.uint64), table[:, 8].copy(),
                      table[:, 9:].copy().view(np.uint8).ravel(), np.bincount(which).astype(np.uint32),
                      chunk.ids[doc], doc.astype(np.uint32), (found.first[own][order] - chunk.offsets[doc]).astype(np.uint64))

    def sort(blobs: dict):
        names = sorted(blobs)
        anchor = np.concatenate([blobs[c][0] for c in names])
        size = np.concatenate([blobs[c][1] for c in names])
        rows = np.concatenate([blobs[c][2].reshape(-1, width) for c in names])
        count = np.concatenate([blobs[c][3] for c in names]).astype(np.int64)
        ids, doc, first = (np.concatenate([blobs[c][k] for c in names]) for k in (4, 5, 6))
        begin = np.cumsum(count) - count
        owner = np.minimum.reduceat(ids, begin)
        # Equal contexts of all chunks are one; contexts of one anchor stay together.
        n_blobs = [len(blobs[c][4]) for c in names]
        blobs.clear()
        whole = np.concatenate((anchor.astype(">u8").view(np.uint8).reshape(-1, 8), size[:, None], rows), axis=1)
        key, which = np.unique(whole.view(np.dtype((np.void, width + 9))).ravel(), return_inverse=True)
        del whole, rows
        table = key.view(np.uint8).reshape(-1, width + 9)
        least = np.full(len(key), np.iinfo(np.int64).max)
        np.minimum.at(least, which, owner)
        sizes = table[:, 8].astype(np.int64)
        total = np.cumsum(sizes)
        starts = [0]
        same = np.concatenate(([False], (table[1:, :8] == table[:-1, :8]).all(axis=1)))
        free = np.append(np.flatnonzero(~same), len(key))
        while starts[-1] < len(key):
            spent = total[starts[-1] - 1] if starts[-1] else 0
            k = int(np.searchsorted(total, spent + SORT_BYTES, side="right"))
            k = free[np.searchsorted(free, max(k, starts[-1] + 1))]
            starts.append(int(k))
        smallest = [_smallest_owner(table[i:j, 9:], sizes[i:j], least[i:j], length)
                    for i, j in zip(starts[:-1], starts[1:], strict=True)]
        smallest = np.concatenate(smallest)
        windows = sizes - length + 1
        at = np.cumsum(windows) - windows
        context = np.repeat(which, count)
        spans = [_removed(smallest, at, windows, context[i:i + MARK_ROWS], ids[i:i + MARK_ROWS], i)
                 for i in range(0, len(context), MARK_ROWS)]
        span, begins, ends = (np.concatenate(x) for x in zip(*spans, strict=True))
        border = np.searchsorted(span, np.concatenate(([0], np.cumsum(n_blobs))))
        for c, i, j in zip(names, border[:-1], border[1:], strict=True):
            if i < j:
                yield c, (doc[span[i:j]], first[span[i:j]].astype(np.int64) + begins[i:j],
                          (ends[i:j] - begins[i:j] + length).astype(np.int32))

    columns = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
                         ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def cut_out(chunk: Chunk, replies: dict):
        cover = np.zeros(len(chunk.data) + 1, np.int32)
        for doc, first, size in replies.values():
            start = chunk.offsets[doc] + first
            np.add.at(cover, start, 1)
            np.add.at(cover, start + size, -1)
        gone = np.cumsum(cover)[:-1] > 0
        kept, removed, spans = [], [], []
        for i in range(chunk.n):
            drop = gone[chunk.offsets[i]:chunk.offsets[i + 1]]
            edge = np.diff(np.concatenate(([False], drop, [False])).astype(np.int8))
            a, z = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            kept.append(chunk.data[chunk.offsets[i]:chunk.offsets[i + 1]][~drop].tobytes())
            removed.append(int((z - a).sum()))
            spans.append([{"start": s, "end": e} for s, e in zip(a.tolist(), z.tolist(), strict=True)])
        return [chunk.doc_id.combine_chunks(), pa.array(np.diff(chunk.offsets), pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()), pa.array(spans, columns.field("spans").type)]

    marked = answer(plan.send(anchors), repeated)
    spans = answer(plan.send_after(marked, contexts), sort)
    return plan.finish(spans, cut_out, "doc_id long, n_bytes long, n_removed long, kept binary, "
                                       "spans array<struct<start:long,end:long>>", columns)


def op4_suffix_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                                    F.sha2("kept", 256).alias("kept_sha256"))
