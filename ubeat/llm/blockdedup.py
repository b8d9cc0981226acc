"""Substring dedup over words with fixed-block anchors.

Any 35 consecutive words hold a whole block of 18 words that starts at a
multiple of 18 in their document. So the non-overlapping blocks of every
document are indexed (7 % of the positions), every rolling window of 18 words of
every document probes the index, and a block found at any second place is an
anchor hit in all its places. Each hit is extended to the 35-word windows around
it; those are looked up once more (96 bits over 64-bit hashes of the words), and runs
of windows that really occur elsewhere make the maximal exact repeats whose
words are removed. Both lookups go through ``ubeat.llm.exchange``.

Edge cases: null and empty texts have no words; a very long text is one document of
its chunk, hashed piece by piece; texts of fewer than 35 words are
never cut; a text whose window repeats within itself is cut like any other;
repeated rows are separate documents; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.llm.common import NOT_SPACE, PrefixHash, byte_hash, pieces, word_spans
from ubeat.llm.exchange import Chunk, Plan, answer, cuts, rising, summed

WINDOW = 35
BLOCK = (WINDOW + 1) // 2
_BASES = (0xD1342543DE82EF95, 0xA0761D6478BD642F)


class _Words:
    """Word windows of one chunk, document after document."""

    def __init__(self, chunk: Chunk, window: int, block: int):
        self.first = [0]
        blocks, aligned, long_a, long_b = [], [], [], []
        self.block_doc, self.window_doc = [0], [0]
        for i, j in pieces(chunk.offsets):
            base = chunk.offsets[i]
            data, offsets = chunk.data[base:chunk.offsets[j]], chunk.offsets[i:j + 1] - base
            starts, ends, first = word_spans(data, offsets, NOT_SPACE)
            words = byte_hash(data).slices(starts, ends)
            one, two = PrefixHash(words, _BASES[0]), PrefixHash(words, _BASES[1])
            n = np.diff(first)
            b, w = np.maximum(n - block + 1, 0), np.maximum(n - window + 1, 0)
            b[n < window] = 0
            at_b, at_w = _ranges(first[:-1], b), _ranges(first[:-1], w)
            blocks.append(one.windows(block)[at_b] if len(at_b) else np.zeros(0, np.uint64))
            aligned.append((at_b - np.repeat(first[:-1], b)) % block == 0)
            long_a.append(one.windows(window)[at_w] if len(at_w) else np.zeros(0, np.uint64))
            long_b.append(two.windows(window)[at_w] if len(at_w) else np.zeros(0, np.uint64))
            self.first += (self.first[-1] + np.cumsum(n)).tolist()
            self.block_doc += (self.block_doc[-1] + np.cumsum(b)).tolist()
            self.window_doc += (self.window_doc[-1] + np.cumsum(w)).tolist()
        none = np.zeros(0, np.uint64)
        self.blocks = np.concatenate([none, *blocks]) >> np.uint64(16)
        self.aligned = np.concatenate([np.zeros(0, bool), *aligned])
        self.long_a = np.concatenate([none, *long_a])
        self.long_b = (np.concatenate([none, *long_b]) >> np.uint64(32)).astype(np.uint32)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... sizes[i] numbers for every i."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def _by_parts(order: np.ndarray, at: np.ndarray, replies: dict, which: int) -> np.ndarray:
    """Reply bits of all buckets, put back in the chunk's own order."""
    out = np.zeros(len(order), bool)
    for b in range(len(at) - 1):
        if at[b] < at[b + 1]:
            out[order[at[b]:at[b + 1]]] = np.unpackbits(replies[b][which], count=int(at[b + 1] - at[b])).astype(bool)
    return out


def dedup_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans): the text without repeated
    windows, its words joined by one space, and the removed word ranges."""
    block = (window + 1) // 2
    plan = Plan(docs)
    buckets = plan.buckets

    # A chunk sends each hash once, with a bit that says whether it has it more than once, and
    # spreads the reply over its own occurrences: a hash that is everywhere costs one per chunk.
    def probes(chunk: Chunk):
        words = _Words(chunk, window, block)
        hashes, place, n = np.unique(words.blocks, return_inverse=True, return_counts=True)
        aligned = np.zeros(len(hashes), bool)
        aligned[place[words.aligned]] = True
        at = cuts(hashes, buckets, 48)
        for b in range(buckets):
            part = slice(at[b], at[b + 1])
            if at[b] < at[b + 1]:
                yield b, (rising(hashes[part]), np.packbits(n[part] > 1), np.packbits(aligned[part]))

    def hits(blobs: dict):
        sent = {c: (summed(h), _bits(several, len(h)), _bits(aligned, len(h))) for c, (h, several, aligned) in blobs.items()}
        indexed = np.unique(np.concatenate([h[aligned] for h, _, aligned in sent.values()]))
        probed = np.zeros(len(indexed), np.int64)
        for h, several, _ in sent.values():
            at = np.minimum(np.searchsorted(h, indexed), len(h) - 1)
            probed += (h[at] == indexed) * (1 + several[at].astype(np.int64))
        anchors = indexed[probed > 1]
        for c, (h, _, _) in sent.items():
            yield c, (np.packbits(_among(h, anchors)),)

    def extended(chunk: Chunk, replies: dict):
        """Windows around anchor hits, in the order of their hashes: (their positions, the
        number of each one's distinct hash, where these begin, cuts of the distinct ones)."""
        words = _Words(chunk, window, block)
        hashes, place = np.unique(words.blocks, return_inverse=True)
        hit = _by_parts(np.arange(len(hashes)), cuts(hashes, buckets, 48), replies, 0)[place]
        total = np.concatenate(([0], np.cumsum(hit)))
        sizes = np.diff(words.window_doc)
        begin = _ranges(np.array(words.block_doc[:-1], np.int64), sizes)
        near = np.flatnonzero(total[begin + window - block + 1] > total[begin])
        near = near[np.lexsort((words.long_b[near], words.long_a[near]))]
        a, b = words.long_a[near], words.long_b[near]
        new = np.ones(len(near), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        return words, near, np.cumsum(new) - 1, first, cuts(a[first], buckets, 64)

    def candidates(chunk: Chunk, replies: dict):
        words, near, group, first, at = extended(chunk, replies)
        n = np.bincount(group, minlength=len(first))
        for b in range(buckets):
            part = slice(at[b], at[b + 1])
            if at[b] < at[b + 1]:
                once = near[first[part]]
                yield b, (rising(words.long_a[once]), words.long_b[once], np.packbits(n[part] > 1))

    def repeats(blobs: dict):
        sent = [(c, summed(a), b, _bits(several, len(b))) for c, (a, b, several) in blobs.items()]
        a, b = np.concatenate([x[1] for x in sent]), np.concatenate([x[2] for x in sent])
        order = np.lexsort((b, a))
        same = np.zeros(len(a) + 1, bool)
        same[1:-1] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        found = np.zeros(len(a), bool)
        found[order] = same[1:] | same[:-1]
        end = 0
        for c, h, _, several in sent:
            yield c, (np.zeros(0, np.uint8), np.packbits(found[end:end + len(h)] | several))
            end += len(h)

    columns = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                         ("kept", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def cut(chunk: Chunk, replies: dict):
        first = {b: x for b, x in replies.items() if b < buckets}
        second = {b - buckets: x for b, x in replies.items() if b >= buckets}
        words, near, group, begins, at = extended(chunk, first)
        found = near[_by_parts(np.arange(len(begins)), at, second, 1)[group]]
        sizes = np.diff(words.window_doc)
        word = _ranges(np.array(words.first[:-1], np.int64), sizes)[found]
        cover = np.zeros(words.first[-1] + 1, np.int64)
        np.add.at(cover, word, 1)
        np.add.at(cover, word + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        kept, removed, spans = [], [], []
        for i in range(chunk.n):
            text = chunk.data[chunk.offsets[i]:chunk.offsets[i + 1]]
            starts, ends, _ = word_spans(text, np.array([0, len(text)]), NOT_SPACE)
            drop = gone[words.first[i]:words.first[i + 1]]
            kept.append(_joined(text, starts[~drop], ends[~drop]))
            removed.append(int(drop.sum()))
            edge = np.diff(np.concatenate(([False], drop, [False])).astype(np.int8))
            spans.append([{"start": s, "end": e} for s, e in
                          zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)])
        return [chunk.doc_id.combine_chunks(), pa.array(np.diff(words.first), pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.string()), pa.array(spans, columns.field("spans").type)]

    hit = answer(plan.send(probes), hits)
    found = answer(plan.send_after(hit, candidates), repeats)
    both = hit.union(found.selectExpr(f"bucket + {buckets} AS bucket", "chunk", "blob"))
    return plan.finish(both, cut, "doc_id long, n_words long, n_removed long, kept string, "
                                  "spans array<struct<start:long,end:long>>", columns)


def _bits(packed: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(packed, count=n).astype(bool)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _joined(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    flat = text.tobytes()
    return b" ".join([flat[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]).decode()


def op3_substring_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_words(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
