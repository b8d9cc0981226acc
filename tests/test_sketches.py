"""Mergeable visitor summaries and exact sliding distinct counts against plain windows."""
import random

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from ubeat.operators import sketches, windows
from ubeat.plans.sliding import sliding_distinct


def _views(spark, n=3000, users=90, span=400_000, seed=1):
    rng = random.Random(seed)
    data = [(u if rng.random() < 0.7 else 7, "pv" if rng.random() < 0.9 else "buy", ts(1_600_000_000 + rng.randrange(span)))
            for u in (rng.randrange(users) for _ in range(n))]
    return spark.createDataFrame(data, "user_id long, behavior string, ts timestamp_ntz")


@pytest.mark.parametrize("bits", [64, 1 << 16, 1 << 29])
def test_merged_bitmaps_equal_distinct_offsets(spark, bits):
    beh = _views(spark)
    hourly = sketches.visitor_bitmaps(beh, "1 hour", bits=bits)
    assert rows(sketches.bitmap_visitors(hourly), "window_end", "uv") == \
        rows(windows.unique_visitors_bitmap(beh, "1 hour", bits=bits), "window_end", "uv")
    day = sketches.merge_bitmaps(hourly, "1 day")
    assert rows(sketches.bitmap_visitors(day), "window_end", "uv") == \
        rows(windows.unique_visitors_bitmap(beh, "1 day", bits=bits), "window_end", "uv")
    week = sketches.bitmap_visitors(sketches.merge_bitmaps(day, "7 days"))
    assert rows(week, "window_end", "uv") == rows(windows.unique_visitors_bitmap(beh, "7 days", bits=bits), "window_end", "uv")


def test_sketches_of_panes_unite_to_windows(spark):
    beh = _views(spark)
    panes = sketches.visitor_sketches(beh, "5 minutes", lg_k=12)
    got = dict(rows(sketches.sketch_visitors(panes, "1 hour", "5 minutes"), "window_end", "uv"))
    pv = beh.where("behavior = 'pv'")
    want = dict(rows(pv.groupBy(F.window("ts", "1 hour", "5 minutes").end.alias("e")).agg(F.count_distinct("user_id").alias("n")), "e", "n"))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= max(1, 0.05 * want[k]) for k in want)


@pytest.mark.parametrize("size,slide,block", [("10 minutes", "5 seconds", None), ("1 hour", "7 minutes", 8 * 3_600_000_000),
                                              ("30 minutes", "30 minutes", None)])
def test_sliding_distinct_equals_windows(spark, size, slide, block):
    beh = _views(spark, n=900, span=90_000).withColumn("k", F.col("user_id") % 2)
    none = spark.createDataFrame([(None, "pv", ts(1_600_000_000), 1)], beh.schema)
    beh = beh.unionByName(none)
    got = sliding_distinct(beh, ["k"], "user_id", size, slide, count_col="n", block_us=block)
    w = F.window("ts", size, slide)
    want = beh.groupBy(w.alias("w"), "k").agg(F.count_distinct("user_id").alias("n")).where("n > 0").select("k", F.col("w.end").alias("window_end"), "n")
    assert rows(got, "k", "window_end", "n") == rows(want, "k", "window_end", "n")
    assert "Expand" not in got._jdf.queryExecution().toString()
