"""Physical-plan equivalences: the skew-safe plans equal the plain ones."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows, ts
from ubeat.plans.scan import blocked_running, previous_row, seq_block
from ubeat.plans.sliding import window_counts


def _events(spark, n=400, keys=3, span=6 * 3600, seed=7, hot=True):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = 0 if (hot and rnd.random() < 0.5) else rnd.randrange(keys)
        data.append((i, k, ts(1_700_000_000 + rnd.randrange(span)), rnd.choice(["fail", "success"]),
                     rnd.randrange(100)))
    return spark.createDataFrame(data, "seq long, k long, ts timestamp_ntz, event_type string, v long")


def test_change_points_equal_direct(spark):
    df = _events(spark)
    for size, slide in [("10 minutes", "5 seconds"), ("1 hour", "1 minute"), ("30 minutes", "30 minutes")]:
        direct = window_counts(df, "ts", ["k"], size, slide, plan="direct")
        cp = window_counts(df, "ts", ["k"], size, slide, plan="change_points", block_us=3_600_000_000)
        assert rows(cp, "k", "window_start", "window_end", "cnt") == \
            rows(direct, "k", "window_start", "window_end", "cnt")


def test_change_points_no_keys_and_block_edges(spark):
    # Rows exactly on block and window boundaries; tiny blocks force carries.
    data = [(i, ts(3600 * h + s)) for i, (h, s) in enumerate([(0, 0), (0, 599), (1, 0), (1, 1), (2, 3599), (5, 0)])]
    df = spark.createDataFrame(data, "seq long, ts timestamp_ntz")
    direct = window_counts(df, "ts", [], "10 minutes", "5 seconds", plan="direct")
    cp = window_counts(df, "ts", [], "10 minutes", "5 seconds", plan="change_points", block_us=600_000_000)
    assert rows(cp, "window_end", "cnt") == rows(direct, "window_end", "cnt")
    assert sum(r[1] for r in rows(cp, "window_end", "cnt")) == 6 * 120


def test_change_points_timestamp_type(spark):
    df = _events(spark, n=50).withColumn("ts", F.col("ts").cast("timestamp"))
    direct = window_counts(df, "ts", ["k"], "10 minutes", "10 seconds", plan="direct")
    cp = window_counts(df, "ts", ["k"], "10 minutes", "10 seconds", plan="change_points")
    assert rows(cp, "k", "window_end", "cnt") == rows(direct, "k", "window_end", "cnt")


def test_blocked_running_equals_window(spark):
    df = _events(spark).withColumn("blk", seq_block("seq", 17))
    for how, inclusive in [("sum", True), ("sum", False), ("max", True), ("max", False), ("count", True),
                           ("min", False)]:
        got = blocked_running(df, ["k"], ["seq"], "v", "blk", "r", how=how, inclusive=inclusive)
        frame = (Window.unboundedPreceding, 0 if inclusive else -1)
        w = Window.partitionBy("k").orderBy("seq").rowsBetween(*frame)
        agg = {"sum": F.sum, "max": F.max, "count": F.count, "min": F.min}[how]
        want = df.withColumn("r", agg("v").over(w))
        if how in ("sum", "count") and inclusive:
            want = want.withColumn("r", F.coalesce("r", F.lit(0)))
        assert rows(got, "seq", "r") == rows(want, "seq", "r"), (how, inclusive)


def test_previous_row_equals_lag(spark):
    df = _events(spark).withColumn("blk", seq_block("seq", 13))
    got = previous_row(df, ["k"], ["seq"], ["event_type", "v"], "blk")
    w = Window.partitionBy("k").orderBy("seq")
    want = df.withColumn("prev_event_type", F.lag("event_type").over(w)).withColumn("prev_v", F.lag("v").over(w))
    assert rows(got, "seq", "prev_event_type", "prev_v") == rows(want, "seq", "prev_event_type", "prev_v")


def test_next_rows_equals_lead(spark):
    from ubeat.plans.scan import next_rows
    df = _events(spark, n=300).withColumn("blk", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600e6))
    got = next_rows(df, ["k"], ["ts", "seq"], ["seq", "v"], 3, "blk", prefix="n")
    w = Window.partitionBy("k").orderBy("ts", "seq")
    want = df
    for j in (1, 2, 3):
        want = want.withColumn(f"n{j}_seq", F.lead("seq", j).over(w)).withColumn(f"n{j}_v", F.lead("v", j).over(w))
    cols = ["seq"] + [f"n{j}_{f}" for j in (1, 2, 3) for f in ("seq", "v")]
    assert rows(got, *cols) == rows(want, *cols)


def test_next_match_equals_unbounded_following(spark):
    from ubeat.plans.scan import next_match
    df = _events(spark, n=300).withColumn("blk", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 300e6))
    m = F.col("event_type") == "fail"
    got = next_match(df, ["k"], ["ts", "seq"], m, ["seq"], "blk", prefix="nm_")
    w = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(1, Window.unboundedFollowing)
    want = df.withColumn("nm_seq", F.first(F.when(m, F.col("seq")), ignorenulls=True).over(w))
    assert rows(got, "seq", "nm_seq") == rows(want, "seq", "nm_seq")


def test_ntz_micros_independent_of_session_zone(spark):
    from ubeat.functions.time import from_micros, to_micros
    from pyspark.sql import types as T
    df = spark.createDataFrame([(ts(0),), (ts(1_720_000_000.123456),), (ts(-86_400 * 400 + 0.5),)], "t timestamp_ntz")
    want = [r[0] for r in df.select(to_micros("t", T.TimestampNTZType())).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(to_micros("t", T.TimestampNTZType())).collect()]
        back = [r[0] for r in df.select(from_micros(to_micros("t", T.TimestampNTZType()), T.TimestampNTZType()))
                .collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want == [0, 1_720_000_000_123_456, -86_400_000_000 * 400 + 500_000]
    assert back == [r[0] for r in df.collect()]


try:
    from hypothesis import given, settings
    from hypothesis import strategies as st
except ImportError:  # pragma: no cover
    given = None

if given is not None:
    @settings(max_examples=12, deadline=None)
    @given(slide=st.sampled_from([1, 2, 5, 60]), ratio=st.integers(1, 40), block=st.sampled_from([1, 3, 10]),
           seed=st.integers(0, 10_000))
    def test_change_points_property(spark, slide, ratio, block, seed):
        import random as _r
        rnd = _r.Random(seed)
        data = [(i, rnd.randrange(3), ts(1_000_000 + rnd.randrange(4 * slide * ratio + 7))) for i in range(40)]
        df = spark.createDataFrame(data, "seq long, k long, ts timestamp_ntz")
        size = slide * ratio
        cp = window_counts(df, "ts", ["k"], f"{size} seconds", f"{slide} seconds", plan="change_points",
                           block_us=block * size * 1_000_000)
        direct = window_counts(df, "ts", ["k"], f"{size} seconds", f"{slide} seconds", plan="direct")
        cols = ("k", "window_start", "window_end", "cnt")
        assert rows(cp, *cols) == rows(direct, *cols)


def test_row_blocks_bound_a_hot_key_inside_one_minute(spark):
    from pyspark.sql import functions as F

    from ubeat.plans.scan import row_blocks
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
                                  (F.col("id") * 6000).alias("us"), F.col("id").alias("seq"))
    blocked = row_blocks(df, ["k"], ["us", "seq"], blocks=30)
    sizes = blocked.groupBy("k", "__blk").count().where("k = 1").collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) <= 2 * 9000 / 30
    order = blocked.where("k = 1").orderBy("us", "seq").select("__blk").collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)


def test_sparse_sequence_numbers_do_not_make_many_blocks(spark):
    from pyspark.sql import functions as F

    from ubeat.plans.scan import row_blocks
    df = spark.range(500).select((F.col("id") * 10**12).alias("seq"))
    assert row_blocks(df, [], ["seq"], blocks=4).select("__blk").distinct().count() == 4


def test_blocks_follow_the_rows_not_the_setting(spark, monkeypatch):
    from ubeat.plans import scan
    monkeypatch.setattr(scan, "ROWS_PER_BLOCK", 500)
    for n in (4_000, 40_000):
        df = spark.range(n).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
        blocked = scan.row_blocks(df, ["k"], ["seq"])
        assert blocked.groupBy("__blk").count().agg(F.max("count")).first()[0] <= 1_000
    small = spark.range(900).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    assert "__blk" not in scan.row_blocks(small, ["k"], ["seq"]).columns
    assert "__blk" in scan.row_blocks(small, [], ["seq"]).columns  # 900 rows of one key


def test_queries_are_the_same_with_and_without_blocks(spark, monkeypatch):
    import __spark_entry__ as entry
    from ubeat.plans import scan
    names = ("login_fail_pair", "login_fail_timer", "login_fail_sequence", "order_timeout", "order_pay_pattern",
             "running_unique_visitors", "late_split")
    whole = {n: entry.queries()[n](spark, "/root/testdata/sf0.001").collect() for n in names}
    monkeypatch.setattr(scan, "ROWS_PER_BLOCK", 7)
    for n in names:
        cut = entry.queries()[n](spark, "/root/testdata/sf0.001").collect()
        assert sorted(map(repr, cut)) == sorted(map(repr, whole[n])), n


def test_uneven_windows_equal_direct_windows(spark):
    from pyspark.sql import functions as F

    from ubeat.plans.sliding import window_counts
    df = _events(spark).withColumn("ts", F.timestamp_seconds(F.col("seq") * 37 % 4000).cast("timestamp_ntz"))
    for size, slide in (("100 seconds", "7 seconds"), ("90 seconds", "60 seconds"), ("3 minutes", "50 seconds")):
        got = window_counts(df, "ts", ["k"], size, slide, block_us=1)
        want = window_counts(df, "ts", ["k"], size, slide, plan="direct")
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_a_day_sliding_by_seven_seconds_plans_at_once(spark):
    from pyspark.sql import functions as F

    from ubeat.plans.sliding import window_counts
    df = spark.range(100).select(F.timestamp_seconds("id").alias("ts"))
    # Starts are the multiples of 7 from -86394 to 98.
    assert window_counts(df, "ts", [], "1 day", "7 seconds").count() == 12342 + 14 + 1
