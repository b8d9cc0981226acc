"""Repeat removal, near-duplicates and decontamination against brute force."""
import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ubeat.llm import blockdedup, decontamination, simhash, suffixdedup
from ubeat.llm.common import components
from ubeat.llm.exchange import pack, unpack
from ubeat.llm.fingerprints import sliding_minima, window_minima

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_block_dedup(docs, corpus):
    texts = [(r[0], WORD.findall(r[1] or "")) for r in corpus]
    seen = collections.Counter(tuple(w[i:i + 35]) for _, w in texts for i in range(len(w) - 34))
    want = []
    for doc_id, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        want.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    got = blockdedup.dedup_words(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert _sorted(map(tuple, got)) == _sorted(want)


def test_suffix_dedup(docs, corpus):
    none = np.iinfo(np.int64).max
    texts = [(r[0], (r[1] or "").encode()) for r in corpus]
    first = {}
    for doc_id, b in texts:
        key = none if doc_id is None else doc_id
        for i in range(len(b) - 49):
            s = b[i:i + 50]
            first[s] = min(first.get(s, none), key)
    want = []
    for doc_id, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < (none if doc_id is None else doc_id):
                gone[i:i + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = suffixdedup.dedup_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert _sorted(map(tuple, got)) == _sorted(want)


def test_repeats_spread_over_many_chunks_and_buckets(spark, docs, monkeypatch):
    from ubeat.llm import exchange
    whole = _sorted(map(tuple, suffixdedup.dedup_bytes(docs).select("doc_id", "n_removed", F.sha2("kept", 256)).collect()))
    words = _sorted(map(tuple, blockdedup.dedup_words(docs).select("doc_id", "n_removed", "kept").collect()))
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 30_000)
    cut = suffixdedup.dedup_bytes(docs).select("doc_id", "n_removed", F.sha2("kept", 256))
    assert _sorted(map(tuple, cut.collect())) == whole
    cut = blockdedup.dedup_words(docs).select("doc_id", "n_removed", "kept")
    assert _sorted(map(tuple, cut.collect())) == words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=120), st.integers(1, 60), st.integers(1, 4))
def test_suffix_ranks_order_prefixes(symbols, depth, copies):
    text = bytes(symbols * copies)
    inside = np.array([i for i in range(len(text)) if i + depth <= len(text)], np.int64)
    rank = suffixdedup.suffix_ranks(np.frombuffer(text, np.uint8), inside, depth)
    in_order = inside[np.argsort(rank, kind="stable")]
    assert [text[i:i + depth] for i in in_order] == sorted(text[i:i + depth] for i in inside)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=80), st.data())
def test_anchor_of_every_window(hashes, data):
    w = data.draw(st.integers(1, len(hashes)))
    h = np.array(hashes, np.uint32)
    want = [max(range(i, i + w), key=lambda p: (-hashes[p], p)) for i in range(len(hashes) - w + 1)]
    assert sliding_minima(h, w).tolist() == want
    assert window_minima(h, w).tolist() == sorted(set(want))


def test_packed_arrays_come_back():
    for a in (np.array([], np.uint64), np.arange(9, dtype=np.uint32), np.array([1, 255], np.uint8), np.array([-3, 1 << 60])):
        assert unpack(pack(a, a))[1].tolist() == a.tolist()


def _fingerprint(text):
    w = WORD.findall((text or "").translate(LOW))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, corpus):
    fps = {r[1]: _fingerprint(r[1]) for r in corpus}
    nodes = sorted(set(fps.values()))
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for r in corpus:
        k = find(fps[r[1]])
        least[k] = min((x for x in (least.get(k), r[0]) if x is not None), default=None)
    want = [(r[0], f"{fps[r[1]]:016x}", least[find(fps[r[1]])]) for r in corpus]
    got = simhash.near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert _sorted(map(tuple, got)) == _sorted(want)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({find(f) for f in fps.values()})
    assert {r.doc_id for r in kept.collect()} - {None} == {v for v in least.values() if v is not None}


@pytest.mark.parametrize("max_bits", [1, 2, 3, 5])
def test_links_find_every_close_pair(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    fps = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64)]
    for f in list(fps):
        for flips in range(1, 8):
            g = f
            for b in rng.choice(64, flips, replace=False):
                g ^= (1 << int(b)) if b < 63 else -(1 << 63)
            fps.append(g)
    fps = sorted(set(fps))
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits}
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits)
    assert {tuple(r) for r in got.collect()} == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame([*path, *star, (7, 7)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{1000 + i: 1000 for i in range(40)}}


def _contamination(corpus, items):
    windows = collections.defaultdict(set)
    for item_id, text in items:
        w = ALNUM.findall((text or "").translate(LOW))
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[i:i + 13])].add("null" if item_id is None else str(item_id))
    out = []
    for r in corpus:
        w = ALNUM.findall((r[1] or "").translate(LOW))
        hit, found = [False] * len(w), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit[i:i + size] = [True] * size
                    found |= windows[tuple(w[i:i + size])]
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[x] for x in hit))]
        out.append((r[0], len(w), sum(hit), str(sorted(found)), str(spans)))
    return out


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_decontamination(spark, docs, corpus, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 3000)
    passage = (corpus[0][1].split("\n")[1]).split()
    items = [(1, " ".join(passage[5:30]).upper()), (2, "Ünï çöde"), (3, None), (4, "..."), (None, " ".join(passage[20:33])),
             (10, corpus[3][1]), (10, "one"), (6, "nowhere to be found")]
    got = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == [*docs.columns, "n_words", "n_hit", "item_ids", "spans"]
    got = [(r.doc_id, r.n_words, r.n_hit, str(r.item_ids), str([tuple(s) for s in r.spans])) for r in got.collect()]
    assert _sorted(got) == _sorted(_contamination(corpus, items))


def test_empty_tables_and_clashing_columns(spark, docs, none):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert blockdedup.dedup_words(none).count() == 0
    assert suffixdedup.dedup_bytes(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert decontamination.contamination(none, items).count() == 0
    no_items = decontamination.contamination(docs, items.limit(0))
    assert no_items.agg(F.sum("n_hit")).first()[0] == 0
    clash = docs.select("doc_id", "text", *[F.lit(9).alias(c) for c in (
        "n_words", "n_hit", "spans", "chunk", "tie", "fp", "component_id", "root", "kept", "n_removed")])
    assert blockdedup.dedup_words(clash).agg(F.max("n_words")).first()[0] > 9
    assert suffixdedup.dedup_bytes(clash).count() == docs.count()
    assert simhash.near_duplicates(clash).count() == docs.count()
    assert decontamination.contamination(clash, items).select("chunk", "n_words").count() == docs.count()
