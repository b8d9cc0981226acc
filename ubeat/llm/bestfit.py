"""Best-fit packing planned over a histogram of lengths.

Documents are turned into token ids, only those longer than a sequence are cut
(the remainder first, then full pieces), and the pieces are packed into
sequences of at most ``size`` tokens. Best-fit decreasing needs nothing but the
number of pieces of each length, so it runs over that histogram: all bins of
one remaining space are taken at once, and the plan is a short list of slots
(length, first rank, first bin, pieces a bin, offset), however many documents
there are. Pieces are then numbered within their length and take their slot by a
join on length and rank.

The histogram has at most ``size`` rows, and so the plan does not grow with the
corpus; a length that many pieces share is numbered in blocks of bounded size.

Ids are those of ``tokenizers`` for its file. For a plain byte-level BPE they are
computed by ``tiktoken`` from the file's own vocabulary, which takes a third of
the time; a tokenizer of another kind encodes the texts itself.

Edge cases: a null text is empty and an empty text is one piece, the end id; a
very long text is cut like any other and encoded slice by slice;
repeated rows are documents of their own (equal ones may swap places); a null
doc_id is kept; extra columns are ignored; no documents give no pieces.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ubeat.llm.common import checkpoint, table

SIZE = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Pieces of one length that are numbered by one task.
BLOCK_ROWS = 10_000
#: Fixed value: the pattern of the byte-level BPE files, as their library documents it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a slice of a long text.
LONG_CHARS = 1 << 20
_CUT = regex.compile(r"(?<=\S)\s")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


# ------------------------------------------------------------------ token ids

def byte_chars() -> dict[str, int]:
    """Character -> the byte it stands for in a byte-level vocabulary: printable
    Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_ranks(how: dict) -> dict[bytes, int] | None:
    """The tokens' bytes with their ids, if the tokenizer described by ``how`` is a plain
    byte-level BPE whose ids rise in the order of its merges; else None."""
    before, model = how.get("pre_tokenizer") or {}, how.get("model") or {}
    plain = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
             and how.get("normalizer") is None and model.get("type") == "BPE"
             and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
             and not any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in how.get("added_tokens", [])))
    if not plain:
        return None
    chars, vocab = byte_chars(), model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    added = {x["content"] for x in how.get("added_tokens", [])}
    ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in added}
    if merged != sorted(merged) or len(ranks) != len(merged) + 256 or any(bytes([b]) not in ranks for b in range(256)):
        return None
    return ranks


class Encoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            how = json.load(f)
        self.added = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in how.get("added_tokens", [])}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.path, self.tokenizer, self.byte_pairs = path, None, None
        if ranks := byte_ranks(how):
            import tiktoken

            self.byte_pairs = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def load(cls, path: str | None) -> Encoder:
        """One encoder for each file and Python worker."""
        path = path or tokenizer_path()
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _library(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        try:
            return self.byte_pairs.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # its pattern matcher gives up on very long runs of white space
            return self._library(text)

    def _part(self, text: str) -> bytes:
        out, at = [], 0
        while len(text) - at > LONG_CHARS:
            # No word goes from a character that is no space to a space.
            found = _CUT.search(text, at + LONG_CHARS)
            if not found:
                break
            out.append(self._ids(text[at:found.start()]))
            at = found.start()
        return b"".join([*out, self._ids(text[at:])])

    def encode(self, text: str) -> bytes:
        if self.byte_pairs is None:
            return self._library(text)
        if self.cut is None or not any(x in text for x in self.added):
            return self._part(text)
        return b"".join(self.added.get(x) or self._part(x) for x in self.cut.split(text))


def cut_points(n: int, size: int) -> list[int]:
    """Where the pieces of a document of ``n`` ids begin, and its end: the first
    piece takes the remainder, all others are full."""
    first = n % size or min(n, size)
    return [0, *range(first, n + 1, size)]


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    end = np.array([end_id], "<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        encode = Encoder.load(path).encode
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                points = cut_points(len(ids) // 4, size)
                for k, (a, b) in enumerate(zip(points[:-1], points[1:], strict=True)):
                    part = ids[4 * a:4 * b]
                    row = (doc, k, a, b - a, zlib.crc32(part)) + ((np.frombuffer(part, "<u4").astype(np.int32),) * with_ids)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, fields, strict=True)],
                                             names=[n for n, _ in fields])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


# ------------------------------------------------------------------- the plan

def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: pieces}``: slots (length, first rank,
    end rank, first bin, pieces a bin, offset). The i-th piece of a slot goes to
    bin ``first + i // per_bin`` at ``offset + i % per_bin * length``."""
    spaces: list[int] = []                                   # remaining spaces that some bin has, ascending
    bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space -> (first bin, bins)
    slots, made = [], 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if not bins[space]:
                insort(spaces, space)
            bins[space].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):                             # the tightest bins that hold it
                space = spaces[at]
                first, n = bins[space].pop()
                if not bins[space]:
                    del spaces[at]
            else:
                space, first, n = size, made, -(-left // (size // length))
                made += n
            each = space // length
            full = min(n, left // each)
            if full:
                use, take = full, full * each
            else:
                use, each, take = 1, left, left
            slots.append((length, rank, rank + take, first, each, size - space))
            put(space - each * length, first, use)
            put(space, first + use, n - use)
            rank, left = rank + take, left - take
    return slots


def pack(parts: DataFrame, size: int = SIZE, key: tuple[str, ...] = ("doc_id", "piece", "start", "ids_crc32")) -> DataFrame:
    """``parts`` with sequence_id and offset; ``length`` is 1 to ``size``.

    ``parts`` is read three times, so it should be stored (``checkpoint``); ``key``
    orders equal lengths, rows equal in it must be interchangeable.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(length is None or not 0 < length <= size for length in counts):
        raise ValueError(f"lengths must be 1 to {size}")
    slots = spark.createDataFrame(plan(counts, size),
                                  "slot_length long, a long, b long, bin long, each long, base long")
    blocks = spark.createDataFrame([(n, -(-c // BLOCK_ROWS)) for n, c in counts.items()],
                                   "block_length long, blocks long")
    # Numbers within a length: blocks by hash, their sizes summed up, rows numbered within a block.
    rows = parts.join(F.broadcast(blocks), F.col("length") == F.col("block_length"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*key), F.col("blocks"))).drop("block_length", "blocks")
    sizes = rows.groupBy("length", "_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_block").orderBy(*key)
    rows = rows.withColumn("_i", F.row_number().over(within) - 1).join(sizes, ["length", "_block"])
    rows = rows.withColumn("_rank", F.col("_before") + F.col("_i"))
    i = F.col("_rank") - F.col("a")
    placed = rows.join(F.broadcast(slots), (F.col("length") == F.col("slot_length"))
                       & (F.col("_rank") >= F.col("a")) & (F.col("_rank") < F.col("b")))
    return placed.select(*[F.col(c) for c in parts.columns],
                         (F.col("bin") + F.floor(i / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("base") + F.pmod(i, F.col("each")) * F.col("length")).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, lengths): the packed pieces, made by
    ``pieces(..., with_ids=True)``, put together; a sequence has at most ``size`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("parts")
    return packed.groupBy("sequence_id").agg(parts).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.length").alias("lengths"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(checkpoint(pieces(table(spark, sf_dir, "documents"))))
