"""Benchmark decontamination with an FM-index per training shard.

Every task cuts its documents into shards, maps their words to the symbols of
the test phrases (any other word, and every document border, is a separator),
builds an FM-index of the symbol sequence (suffix order, Burrows-Wheeler
transform in a wavelet matrix, sampled suffix positions), searches all phrases
backwards at once, locates their occurrences through the samples and merges
them into removal spans. Runs of phrase words shorter than the shortest phrase
cannot hold an occurrence and are not indexed.

The phrases are a stated query set: they reach the tasks in blocks of at most
``BLOCK_BYTES`` of item text, one broadcast each, and every shard is searched
block by block, so memory does not grow with the number of blocks. The documents
are never shuffled.

Edge cases: a null or empty text has no words and is not contaminated; a very long
text is a shard's piece of its own, judged whole; an item
without words has no window; an item id that comes twice counts once, a null id
as ``null``; no items at all leave every count 0; extra document columns pass
through, and a column named like an added one is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ubeat.llm.common import ALNUM, LOWER, pieces, text_bytes, word_spans

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
SAMPLE = 16

_ADDED = {"n_words": T.LongType(), "n_hit": T.LongType(), "item_ids": T.ArrayType(T.StringType()),
          "spans": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))}


class FMIndex:
    """FM-index of a symbol sequence; 0 separates runs and ends the sequence."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        n = len(text)
        order = self._suffix_order(text)
        start_of_run = np.ones(n, bool)
        start_of_run[1:] = text[:-1] == 0
        # Run starts are sampled, so no walk crosses a separator.
        kept = (start_of_run | (np.arange(n) % sample == 0))[order]
        self.kept, self.kept_before, self.positions = kept, np.cumsum(kept) - kept, order[kept]
        bwt = text[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))))
        self.levels = []
        for bit in range(max(int(text.max()).bit_length(), 1) - 1, -1, -1):
            one = (bwt >> bit) & 1 == 1
            zeros = np.zeros(n + 1, np.int64)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros))
            bwt = np.concatenate((bwt[~one], bwt[one]))
        self.n = n

    @staticmethod
    def _suffix_order(text: np.ndarray) -> np.ndarray:
        """Suffixes in order by prefix doubling; each separator is a symbol of
        its own, in order of position and below all others."""
        n = len(text)
        sep = text == 0
        rank = np.where(sep, np.cumsum(sep) - 1, text.astype(np.int64) + int(sep.sum()))
        width = 1
        while True:
            later = np.zeros(n, np.int64)
            later[:-width or None] = rank[width:] + 1 if width < n else 0
            key = rank * (int(rank.max()) + 2) + later if width else rank
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            rank = new
            if rank.max() == n - 1:
                return order
            width *= 2

    def _rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each row."""
        low = np.zeros_like(row)
        for bit, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            row = np.where(one, zeros[-1] + row - zeros[row], zeros[row])
            low = np.where(one, zeros[-1] + low - zeros[low], zeros[low])
        return row - low

    def _back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that starts one symbol earlier."""
        at, low, symbol = row, np.zeros_like(row), np.zeros_like(row)
        for bit, zeros in self.levels:
            one = zeros[at + 1] == zeros[at]
            symbol |= one.astype(np.int64) << bit
            at = np.where(one, zeros[-1] + at - zeros[at], zeros[at])
            low = np.where(one, zeros[-1] + low - zeros[low], zeros[low])
        return self.before[symbol] + at - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each row of ``phrases``."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.flatnonzero((phrases < len(self.before) - 1).all(axis=1))
        hi[np.setdiff1d(np.arange(len(phrases)), live)] = 0
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, j]
            lo[live] = self.before[symbol] + self._rank(symbol, lo[live])
            hi[live] = self.before[symbol] + self._rank(symbol, hi[live])
            live = live[lo[live] < hi[live]]
        hi = np.maximum(hi, lo)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in ``rows``."""
        out = np.empty(len(rows), np.int64)
        wait, steps = np.arange(len(rows)), 0
        while len(wait):
            at = rows[wait]
            known = self.kept[at]
            out[wait[known]] = self.positions[self.kept_before[at[known]]] + steps
            wait = wait[~known]
            rows = rows.copy()
            rows[wait] = self._back(rows[wait])
            steps += 1
        return out


class Phrases:
    """Word windows of one block of items, as symbols of the block's own words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        symbols: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            data = np.frombuffer(text, np.uint8)
            lowered = LOWER[data]
            starts, ends, _ = word_spans(lowered, np.array([0, len(data)]), ALNUM)
            flat = lowered.tobytes()
            ids = [symbols.setdefault(flat[s:e], len(symbols) + 1) for s, e in zip(starts, ends, strict=True)]
            for i in range(max(len(ids) - window + 1, 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + window]), set()).add(item_id)
        self.words = list(symbols)
        self.lengths: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for size in sorted({len(w) for w in owners}):
            own = [w for w in owners if len(w) == size]
            self.lengths[size] = np.array(own, np.int64), [sorted(owners[w]) for w in own]

    def occurrences(self, words: pa.Array, first: np.ndarray):
        """Yields (word positions, window length, owner ids per position)."""
        if not self.lengths or not len(words):
            return
        shortest = min(self.lengths)
        symbol = pc.index_in(words, value_set=pa.array(self.words, pa.large_binary()))
        symbol = symbol.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        known = np.flatnonzero(symbol)
        if not len(known):
            return
        new_doc = np.zeros(len(symbol) + 1, bool)
        new_doc[first] = True
        starts = np.flatnonzero(np.concatenate(([True], (np.diff(known) > 1) | new_doc[known[1:]])))
        size = np.diff(np.concatenate((starts, [len(known)])))
        known = known[np.repeat(size >= shortest, size)]
        if not len(known):
            return
        runs = np.concatenate(([True], (np.diff(known) > 1) | new_doc[known[1:]]))
        at = np.arange(len(known)) + np.cumsum(runs) - 1
        text = np.zeros(at[-1] + 2, np.int64)
        origin = np.zeros(len(text), np.int64)
        text[at], origin[at] = symbol[known], known
        index = FMIndex(text)
        for length, (windows, owners) in self.lengths.items():
            lo, hi = index.search(windows)
            found = hi - lo
            if found.any():
                which = np.repeat(np.arange(len(windows)), found)
                rows = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + lo[which]
                yield origin[index.locate(rows)], length, which, owners


def _judge(data: np.ndarray, offsets: np.ndarray, blocks) -> tuple:
    """Per document of one shard: words, hit words, item ids, spans."""
    n_docs = len(offsets) - 1
    lowered = LOWER[data]
    starts, ends, first = word_spans(lowered, offsets, ALNUM)
    flat = lowered[ALNUM[lowered]]
    where = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(where), pa.py_buffer(np.ascontiguousarray(flat))])
    cover = np.zeros(len(starts) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(n_docs)]
    for block in blocks:
        for position, length, which, owners in block.occurrences(words, first):
            np.add.at(cover, position, 1)
            np.add.at(cover, position + length, -1)
            doc = np.searchsorted(first, position, side="right") - 1
            for d, w in np.unique(np.stack((doc, which)), axis=1).T.tolist():
                items[d].update(owners[w])
    hit = np.cumsum(cover)[:-1] > 0
    total = np.concatenate(([0], np.cumsum(hit)))
    begin = hit.copy()
    begin[1:] &= ~hit[:-1]
    stop = hit.copy()
    stop[:-1] &= ~hit[1:]
    border = first[(first > 0) & (first < len(hit))]
    begin[border] |= hit[border]
    stop[border - 1] |= hit[border - 1]
    s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    at = np.searchsorted(s, first)
    spans = [[{"start": int(a - f), "end": int(b - f)} for a, b in zip(s[i:j], e[i:j], strict=True)]
             for f, i, j in zip(first[:-1], at[:-1], at[1:], strict=True)]
    return np.diff(first), total[first[1:]] - total[first[:-1]], [sorted(x) for x in items], spans


def phrase_blocks(items: DataFrame, window: int = WINDOW) -> list:
    """Broadcasts of the items' windows, one per ``BLOCK_BYTES`` of text."""
    sc = items.sparkSession.sparkContext
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                        F.coalesce(F.col("text"), F.lit("")).alias("t"))
    blocks, block, size = [], [], 0
    for row in rows.toLocalIterator():
        text = row.t.encode()
        if block and size + len(text) > BLOCK_BYTES:
            blocks.append(sc.broadcast(Phrases(block, window)))
            block, size = [], 0
        block.append((row.i, text))
        size += len(text)
    return blocks + ([sc.broadcast(Phrases(block, window))] if block else [])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted) and spans (word ranges to remove)."""
    blocks = phrase_blocks(items, window)
    base = docs.drop(*_ADDED)
    schema = T.StructType([*base.schema.fields, *[T.StructField(k, v) for k, v in _ADDED.items()]])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        one = blocks[0].value if len(blocks) == 1 else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in pieces(offsets, SHARD_BYTES):
                # Several blocks are read from their files in turn and not kept.
                load = [one] if one else (b.load_from_path(b._path) if b._path else b.value for b in blocks)
                words, hits, ids, spans = _judge(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], load)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns, pa.array(words, pa.int64()), pa.array(hits, pa.int64()),
                     pa.array(ids, pa.list_(pa.string())), pa.array(spans, span)], schema.names)

    return base.mapInArrow(run, schema)


def contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op1_decontaminate(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), contaminated().alias("contaminated"))
