from pyspark.sql import functions as F

from conftest import rows, ts, utc
from ubeat.functions.hashing import bitmap_offset
from ubeat.operators import windows

BEHAVIOR = "user_id long, item_id long, category int, behavior string, ts timestamp_ntz, seq long"


def _beh(spark, data):
    return spark.createDataFrame([(u, i, 1, b, ts(t), n) for n, (u, i, b, t) in enumerate(data)], BEHAVIOR)


def test_bitmap_offsets_of_known_ids(spark):
    # Worked out as whole polynomials of the digits, reduced once at the end.
    df = spark.createDataFrame([(101,), (90210,), (777000777,)], "id long")
    got = dict(df.select("id", bitmap_offset(F.col("id"), 1 << 29, 61).alias("o")).collect())
    assert got == {101: 185306, 90210: 263426200, 777000777: 496029290}


def test_bitmap_offset_python_model(spark):
    ids = [0, 7, 12345678901, -42, 999999999999]

    def model(v, bits, seed):
        h = 0
        for ch in str(v):
            h = (h * seed + ord(ch)) & 0xFFFFFFFF  # 32-bit wrap as in the reference
        return h & (bits - 1)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for bits in (64, 1 << 20, 1 << 32):
        got = dict(df.select("id", bitmap_offset(F.col("id"), bits, 61).alias("o")).collect())
        assert got == {i: model(i, bits, 61) for i in ids}


def test_page_views_and_uv(spark):
    data = [(1, 10, "pv", 0), (1, 11, "pv", 10), (2, 10, "pv", 3599), (3, 10, "buy", 20), (2, 12, "pv", 3600)]
    df = _beh(spark, data)
    assert rows(windows.page_views(df), "window_end", "pv") == [(ts(3600), 3), (ts(7200), 1)]
    assert rows(windows.page_views_two_phase(df, salt_buckets=3), "window_end", "pv") == [(ts(3600), 3), (ts(7200), 1)]
    assert rows(windows.unique_visitors(df), "window_end", "uv") == [(ts(3600), 2), (ts(7200), 1)]
    approx = rows(windows.unique_visitors_approx(df), "window_end", "uv")
    assert approx == [(ts(3600), 2), (ts(7200), 1)]
    # 1-bit map: every id lands on offset 0 -> one visitor per window.
    assert rows(windows.unique_visitors_bitmap(df, bits=1), "window_end", "uv") == [(ts(3600), 1), (ts(7200), 1)]


def test_running_unique_visitors(spark):
    data = [(5, 1, "pv", 10), (6, 1, "pv", 20), (5, 1, "pv", 30), (7, 1, "pv", 40), (5, 1, "pv", 3700)]
    df = _beh(spark, data)
    got = rows(windows.running_unique_visitors(df, blocks=3), "window_end", "user_id", "uv")
    assert got == [(ts(3600), 5, 1), (ts(3600), 6, 2), (ts(3600), 7, 3), (ts(7200), 5, 1)]


def test_sliding_hot_items_counts(spark):
    # One pv at t=0 falls in 12 hour-long windows sliding by 5 minutes.
    df = _beh(spark, [(1, 7, "pv", 0), (2, 7, "pv", 299), (3, 8, "pv", 300)])
    got = rows(windows.item_view_counts(df), "item_id", "window_end", "cnt")
    assert len([g for g in got if g[0] == 7]) == 12
    assert (7, ts(300), 2) in got and (8, ts(300 + 3600), 1) in got
    assert sum(g[2] for g in got) == 36


def test_market_counts_drop_uninstall(spark):
    df = spark.createDataFrame([("u1", "view", "weibo", ts(0)), ("u2", "uninstall", "weibo", ts(1)),
                                ("u3", "view", "weibo", ts(2))],
                               "user_id string, behavior string, channel string, ts timestamp_ntz")
    got = windows.market_counts(df, "1 hour", "10 minutes")
    r = rows(got, "window_start", "window_end", "channel", "behavior", "cnt")
    assert len(r) == 6 and all(x[3] == "view" and x[4] == 2 for x in r)


def test_window_aggregate_with_pandas_udaf(spark):
    import pandas as pd

    @F.pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    df = _beh(spark, [(1, 10, "pv", 0), (5, 10, "pv", 10), (2, 11, "pv", 20), (9, 10, "pv", 4000)])
    got = windows.window_aggregate(df, ["item_id"], "1 hour", spread=spread(F.col("user_id")))
    assert rows(got, "item_id", "window_end", "spread") == \
        [(10, ts(3600), 4.0), (10, ts(7200), 0.0), (11, ts(3600), 0.0)]
    sums = windows.window_aggregate(df, ["item_id"], "1 hour", "30 minutes", n=F.count(F.lit(1)))
    assert rows(sums.where("item_id = 10"), "window_end", "n") == \
        [(ts(1800), 2), (ts(3600), 2), (ts(5400), 1), (ts(7200), 1)]


def test_window_apply(spark):
    import pandas as pd

    def users(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"window_end": [pdf["window_end"].iloc[0]], "users": [",".join(
            str(u) for u in sorted(set(pdf["user_id"])))]})
    df = _beh(spark, [(3, 10, "pv", 0), (1, 10, "pv", 10), (3, 11, "pv", 20)])
    got = windows.window_apply(df, [], "1 hour", users, "window_end timestamp_ntz, users string")
    assert rows(got, "window_end", "users") == [(ts(3600), "1,3")]


def test_sliding_merge_equals_windows(spark):
    import random

    from ubeat.plans.sliding import sliding_merge
    rng = random.Random(8)
    data = [(rng.choice("ab"), ts(1_600_000_000 + rng.randrange(9_000)), rng.randrange(1000), rng.randrange(60)) for _ in range(700)]
    df = spark.createDataFrame(data, "b string, ts timestamp_ntz, v long, user long")
    pair = F.struct(F.max("v").alias("t"), F.min("v").alias("low"))
    for size, slide in (("10 minutes", "5 seconds"), ("10 minutes", "4 minutes"), ("1 minute", "1 minute")):
        got = sliding_merge(df, ["b"], size, slide, partial=pair, parts={"t": (F.max, F.greatest), "low": (F.min, F.least)})
        want = df.groupBy(F.window("ts", size, slide).alias("w"), "b").agg(F.max("v").alias("t"), F.min("v").alias("low")) \
            .select("b", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "t", "low")
        assert rows(got, "b", "window_start", "window_end", "t", "low") == rows(want, "b", "window_start", "window_end", "t", "low")
        assert "Expand" not in got._jdf.queryExecution().toString()
    sketch = sliding_merge(df, [], "10 minutes", "1 minute", partial=F.struct(F.hll_sketch_agg("user").alias("s")),
                           parts={"s": (F.hll_union_agg, F.hll_union)})
    got = dict(rows(sketch.select("window_end", F.hll_sketch_estimate("s").alias("n")), "window_end", "n"))
    want = dict(rows(df.groupBy(F.window("ts", "10 minutes", "1 minute").end.alias("e")).agg(F.count_distinct("user").alias("n")), "e", "n"))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= max(1, 0.05 * want[k]) for k in want)


def test_window_stream_reads_a_large_window_in_bounded_batches(spark):
    import pandas as pd

    from ubeat.operators.windows import window_stream
    n = 400_000
    df = spark.range(n).select((F.col("id") % 2).alias("k"), F.timestamp_seconds(F.lit(3600) + F.col("id") % 3600).alias("ts"),
                               (F.lit(n) - F.col("id")).alias("v"))
    df = df.unionByName(spark.createDataFrame([(7, utc(99_999), 1), (None, utc(99_999), 2)], df.schema))

    def walk(key, frames):
        total = most = 0
        last = None
        for f in frames:
            assert f["v"].is_monotonic_increasing and (last is None or f["v"].iloc[0] >= last)
            total, most, last = total + len(f), max(most, len(f)), f["v"].iloc[-1]
        yield pd.DataFrame({"window_end": [key[0]], "k": pd.array([key[1]], "Int64"), "n": [total], "most": [most]})

    got = window_stream(df, ["k"], "1 hour", walk, "window_end timestamp, k long, n long, most long", order=["v"], columns=["v"]).collect()
    assert sorted((r.k is None, r.k or 0, r.n) for r in got) == [(False, 0, n // 2), (False, 1, n // 2), (False, 7, 1), (True, 0, 1)]
    assert max(r.most for r in got) <= int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
