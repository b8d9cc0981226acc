"""op11: the Z-fast trie against plain prefixes, the operator against a brute-force model."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ubeat.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, conv string, n int, depth string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=9).map(lambda s: s * 3) | st.text("abc", max_size=14), max_size=25))
def test_trie_of_any_words(words):
    trie = prefixtrie.ZFastTrie()
    for i, w in enumerate(words):
        keys = [w[:j + 1].encode().ljust(16) for j in range(len(w))]
        now, _ = trie.exit_node(keys)
        whole = [n for n, _ in trie.nodes() if n.keys[n.hi - 1] in keys]
        assert now.hi == max((n.hi for n in whole), default=0)
        trie.insert(keys, [1] * len(w), (1, i, i))
    got = {}
    for node, (n, ids, least) in trie.nodes():
        for k in node.keys[node.lo:node.hi]:
            assert k not in got
            got[k.decode().rstrip()] = (n, ids, least)
    want = {}
    for i, w in enumerate(words):
        for j in range(1, len(w) + 1):
            n, ids, least = want.get(w[:j], (0, 0, i))
            want[w[:j]] = (n + 1, ids + i, min(least, i))
    assert got == want
    # Every edge is under its handle and nothing else is.
    assert {id(n) for n in trie.handles.values()} == {id(n) for n, _ in trie.nodes()}


def test_fat_search_probes_few_depths():
    trie = prefixtrie.ZFastTrie()
    keys = [b"%016d" % i for i in range(4096)]
    trie.insert(keys, [0] * 4096, (1, 0, 0))
    trie.probes = 0
    trie.insert(keys[:3000], [0] * 3000, (1, 0, 1))
    assert trie.probes <= 13


def test_two_fattest():
    for b in range(1, 70):
        for a in range(b):
            assert prefixtrie.two_fattest(a, b) == max(range(a + 1, b + 1), key=lambda x: x & -x)


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(who) - 1) * (len(p[-1][1]) if p else 0)
    return {(min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, who in members.items()}


def run(spark, rows, tmp_path, parts=3):
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts).write.mode("overwrite") \
        .parquet(f"{tmp_path}/conversations.parquet")
    out = prefixtrie.op11_prefix_trie(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


def fixture(seed):
    rng = random.Random(seed)
    said = ["", "a", "bb", "Grüße", "😀 ok", None]
    rows = []
    for c in [*range(40), *range(90, 110), *range(205, 240), *range(300, 303), -5, -100, -101]:
        for t in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(said[:2] if c % 3 else said)))
    rows += [(300, None, "system", "first"), (300, None, None, "first"), (300, 1, "z", "tie"), (300, 1, "y", "tie"),
             (301, 0, "user", "same"), (301, 0, "user", "same"), (None, 0, "user", "lost"), (302, 7, None, None)]
    rows += [(400, t, "user", f"long {t // 9}") for t in range(90)] + [(401, t, "user", f"long {t // 9}") for t in range(90)]
    rows += [(c, t, "user", "copy") for c in range(500, 560) for t in range(6)]
    return rows


def test_brute_force(spark, tmp_path, monkeypatch):
    rows = fixture(3)
    want = brute(rows)
    assert len(want) > 150
    assert run(spark, rows, tmp_path) == want
    # Small pieces, batches of ids and tries; borders of ranges inside conversations.
    monkeypatch.setattr(prefixtrie, "SEGMENT", 3)
    monkeypatch.setattr(prefixtrie, "FLUSH_TURNS", 40)
    monkeypatch.setattr(prefixtrie, "IDS_AT_ONCE", 7)
    monkeypatch.setattr(prefixtrie, "RANGE_ROWS", 60)
    assert run(spark, rows, tmp_path) == want


def test_one_long_conversation_is_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SEGMENT", 16)
    df = spark.createDataFrame([(100, t, "u", str(t)) for t in range(300)] + [(101, 0, "u", "x")],
                               "conv_id long, turn long, role string, text string")
    parts = prefixtrie.pieces(df).collect()
    assert sum(r.n for r in parts) == 301 and max(r.n for r in parts) <= 16
    assert sorted(r.pos for r in parts if r.conv == 100)[1] <= 16 and sum(r.last for r in parts) == 2


def test_no_rows_and_turnless(spark, tmp_path):
    assert run(spark, [], tmp_path) == set()
    assert run(spark, [(None, 1, "u", "x")], tmp_path) == set()
    # Conversation 7 takes two turns from an absent one and has no third turn of its own.
    rows = [(c, 0, "u", "x") for c in range(1, 30)]
    want = brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in want)
    assert run(spark, rows, tmp_path) == want
