"""op13: ids against the tokenizer itself, the plan against best-fit over documents, whole packings."""

import functools
import json
import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ubeat.llm import bestfit
from ubeat.llm.common import checkpoint

SF = "/root/testdata/sf0.001"


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bestfit.tokenizer_path())


def library_ids(text):
    return library().encode(text, add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(bestfit.Encoder.load(None).encode(text), "<u4").tolist()


@pytest.mark.parametrize("text", [
    "", " ", "\n\n  x\t\ty ", "it's they'll 'S ''", "a<|endoftext|>b  <|endoftext|>", "힣é ​12 34½", "  　 trailing  ",
    "\x00\x7f퟿\U0001f600", "A" * 5000, " " * 3000 + "end", " " * 400_000, "x1y2 z3!?…--"])
def test_ids_are_the_tokenizers(text):
    assert own_ids(text) == library_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_ids_of_any_text(text):
    assert own_ids(text) == library_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.text(" \n\t a'.s1　", max_size=60))
def test_slices_change_nothing(text):
    kept, bestfit.LONG_CHARS = bestfit.LONG_CHARS, 3
    try:
        assert own_ids(text) == library_ids(text)
    finally:
        bestfit.LONG_CHARS = kept


def test_every_token_and_the_texts_of_a_table():
    import duckdb

    chars = bestfit.byte_chars()
    with open(bestfit.tokenizer_path(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    texts = [bytes(chars[c] for c in t).decode(errors="replace") for t in vocab if all(c in chars for c in t)]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    assert len(texts) > 50_000 and all(own_ids(t) == library_ids(t) for t in texts)


def test_other_tokenizers_encode_themselves(tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, here's one   more."
    got = np.frombuffer(bestfit.Encoder.load(path).encode(text), "<u4").tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def brute_best_fit(lengths, size):
    """Best-fit decreasing, one piece at a time; the number of bins."""
    spaces, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(spaces, n)
        if at == len(spaces):
            bins += 1
            space = size
        else:
            space = spaces.pop(at)
        insort(spaces, space - n)
    return bins


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40), max_size=12))
def test_plan_is_best_fit(counts):
    slots = bestfit.plan(counts, 24)
    fill, taken = {}, {n: [] for n in counts}
    for length, a, b, first, each, base in slots:
        for i in range(b - a):
            fill.setdefault(first + i // each, []).append((base + i % each * length, length))
        taken[length] += range(a, b)
    assert all(sorted(r) == list(range(counts[n])) for n, r in taken.items())
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 24
    assert len(fill) == brute_best_fit([n for n, c in counts.items() for _ in range(c)], 24)


def test_cut_points():
    assert bestfit.cut_points(5, 10) == [0, 5]
    assert bestfit.cut_points(10, 10) == [0, 10]
    assert bestfit.cut_points(11, 10) == [0, 1, 11]
    assert bestfit.cut_points(30, 10) == [0, 10, 20, 30]


def check(rows, texts, size):
    """rows: every piece once, cut as asked, gapless sequences."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        ids = [*library_ids(text or ""), bestfit.END_ID]
        found = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(len(found)))
        at = 0
        for r in found:
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
        assert len(found) == -(-len(ids) // size) and all(r["length"] == size for r in found[1:])
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    assert len(by_seq) == brute_best_fit([r["length"] for r in rows], size)


def test_query_packs_the_whole_table(spark):
    rows = bestfit.op13_best_fit(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert {r["doc_id"] for r in rows} == {d["doc_id"] for d in docs}
    check(rows, {d["doc_id"]: d["text"] for d in docs}, bestfit.SIZE)


def test_edge_cases_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(bestfit, "BLOCK_ROWS", 3)
    texts = {0: None, 1: "", 2: "word " * 500, 3: " same text here", 4: " same text here", 5: "x", -7: "y" * 300}
    texts |= {10 + i: " a b" for i in range(20)}
    rows = [(k, v, 1, "L", "B") for k, v in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, slot_length string, bin string")
    packed = bestfit.pack(checkpoint(bestfit.pieces(docs, size=16, with_ids=True)), size=16)
    check(packed.collect(), texts, 16)
    made = bestfit.sequences(packed).collect()
    whole = {}
    for r in made:
        assert len(r["ids"]) == sum(r["lengths"]) <= 16
    for r in packed.orderBy("doc_id", "piece").collect():
        whole.setdefault(r["doc_id"], []).extend(r["ids"])
    assert whole == {k: [*library_ids(v or ""), bestfit.END_ID] for k, v in texts.items()}


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    rows = bestfit.pack(checkpoint(bestfit.pieces(docs))).collect()
    assert len(rows) == 4 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 4
    assert bestfit.pack(checkpoint(bestfit.pieces(docs.where(F.lit(False))))).collect() == []
