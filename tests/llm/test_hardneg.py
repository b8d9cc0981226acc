"""op12: bounds against exact scores, the whole operator against brute force."""

import math
import random

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ubeat.llm import hardneg

SCHEMA = "vec_id long, label int, embedding array<float>, score int, g string, rank string"


def brute(rows, anchor_every=100):
    """Rows (vec_id, label, embedding) -> the query's rows, as sets of tuples."""
    own = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        own[vec_id] = min(own.get(vec_id, row), row)
    out = set()
    for a, (label, q) in own.items():
        if a % anchor_every:
            continue
        score = {v: sum(x * y for x, y in zip(q, w, strict=False)) for v, (_, w) in own.items()}
        near = sorted((v for v in own if v != a and own[v][0] == label), key=lambda v: (-score[v], v))[:5]
        for p in near:
            far = [v for v in own if own[v][0] != label and 80 * score[p] <= 100 * score[v] <= 100 * score[p]]
            for r, v in enumerate(sorted(far, key=lambda v: (-score[v], v))[:5], 1):
                out.add((a, p, r, v, score[p], score[v]))
    return out


def got(df):
    rows = df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def run(spark, rows, tmp_path):
    spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).write.mode("overwrite") \
        .parquet(f"{tmp_path}/embeddings.parquet")
    return got(hardneg.op12_hard_negatives(spark, str(tmp_path)))


vectors = st.integers(1, 40).flatmap(lambda n: st.tuples(
    *[st.lists(st.integers(-300, 300), min_size=n, max_size=n)] * 2))


@settings(max_examples=80, deadline=None)
@given(vectors)
def test_bounds_hold_at_every_level(pair):
    width = hardneg.padded_width(len(pair[0]))
    x = np.zeros((2, width))
    x[:, :len(pair[0])] = pair
    exact = x[0] @ x[1]
    for segments in hardneg.levels(width):
        mean, dev = hardneg.summaries(x, segments)
        assert mean[0] @ mean[1] - dev[0] @ dev[1] - 1e-3 <= exact <= mean[0] @ mean[1] + dev[0] @ dev[1] + 1e-3


def clustered(n, seed):
    """Vectors round a few centres, with ties, copies and a hot label."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, 3 if i % 3 == 0 else rng.randrange(10), [x + rng.gauss(0, 0.05) for x in c]))
    for i in range(0, n, 9):
        rows[i] = (i, rows[i][1], rows[0][2])
    return rows


def test_brute_force_and_small_groups(spark, tmp_path, monkeypatch):
    rows = clustered(420, 4)
    want = brute(rows)
    assert len(want) > 60
    assert run(spark, rows, tmp_path) == want
    monkeypatch.setattr(hardneg, "GROUP_ROWS", 40)
    monkeypatch.setattr(hardneg, "ANCHORS_AT_ONCE", 2)
    assert run(spark, rows, tmp_path) == want


def test_edge_rows(spark, tmp_path):
    rows = clustered(130, 7)
    v = rows[5][2]
    rows += [(200, None, v), (201, 3, None), (202, 3, [None] * 12), (203, 3, [math.nan] + v[1:]), (204, 3, [math.inf] + v[1:]),
             (None, 3, v), (300, 3, []), (301, 4, v[:5]), (302, 4, v + [0.5, 0.25]), (100, rows[100][1], rows[100][2]),
             (10, 3, v), (10, 2, v), (-100, 3, v), (400, 9, [0.0] * 12)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_huge_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [rng.choice((1, -1)) * (2**30 + rng.randrange(4)) for _ in range(6)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    found = got(hardneg.mine(df, F.col("vec_id") % 20 == 0, low_pct=-100))
    score = {(a, b): sum(x * y for x, y in zip(rows[a][2], rows[b][2], strict=True)) for a in range(0, 60, 20) for b in range(60)}
    assert found and all(score[a, p] == ps and score[a, n] == ns and -ps <= ns <= ps for a, p, _, n, ps, ns in found)
    a = 20
    best = sorted((b for b in range(60) if b % 2 == a % 2 and b != a), key=lambda b: (-score[a, b], b))[:5]
    assert {p for x, p, *_ in found if x == a} <= set(best)


def test_no_rows(spark, tmp_path):
    assert run(spark, [], tmp_path) == set()
    assert run(spark, [(100, 1, [0.5])], tmp_path) == set()


def test_filter_drops_rows_of_separated_clusters():
    rng = np.random.default_rng(0)
    far = np.repeat(rng.normal(0, 60, (8, 4)), 4, axis=1)
    x = np.concatenate([c + rng.normal(0, 1, (200, 16)) for c in far]).round().astype(np.int64)
    group = hardneg.Group(np.arange(len(x)), np.zeros(len(x), np.int64), list(x))
    found = list(group.best(np.array([0]), 0, [x[0]], True, [[(-math.inf, math.inf)]], 5))
    best = sorted(range(1, len(x)), key=lambda i: (-(x[i] @ x[0]), i))[:5]
    assert found[0][2].tolist() == best and group.scored < 0.3 * group.tried


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = con.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({hardneg.SQL})").fetchall()
    assert want and got(hardneg.op12_hard_negatives(spark, sf)) == set(want)
