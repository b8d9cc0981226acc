from pyspark.sql import functions as F

from conftest import rows, ts
from ubeat.operators import ranking
from ubeat.operators.fraud import click_fraud_filter, passed, warnings

CLICK = "user_id long, ad_id long, province string, city string, ts timestamp_ntz, seq long"


def test_fraud_filter_hot_key(spark):
    # One (user, ad) key clicks 121 times: 100 pass, one warning, 20 vanish.
    data = [(7, 9, "beijing", "beijing", ts(1000 + i), i) for i in range(121)]
    data += [(8, 9, "hebei", "x", ts(5000 + i), 200 + i) for i in range(3)]
    df = spark.createDataFrame(data, CLICK)
    out = click_fraud_filter(df, limit=100)
    tags = dict(out.groupBy("tag").count().collect())
    assert tags == {"pass": 103, "warning": 1}
    w = warnings(out).collect()
    assert [(r.user_id, r.ad_id, r.msg) for r in w] == [(7, 9, "Click ad over 100 times today.")]
    # The warning is raised by the 101st click in arrival order.
    assert out.where("tag = 'warning'").first().seq == 100
    assert passed(out).where("user_id = 7").agg(F.max("seq")).first()[0] == 99


def test_fraud_filter_daily_reset(spark):
    # 3 clicks late on one local (UTC+8) day, 3 early the next: limit 2 per day.
    base = 16 * 3600  # 16:00 UTC = 00:00 UTC+8
    data = [(1, 1, "p", "c", ts(base - 30 + i), i) for i in range(3)] + \
           [(1, 1, "p", "c", ts(base + 10 + i), 10 + i) for i in range(3)]
    df = spark.createDataFrame(data, CLICK)
    never = click_fraud_filter(df, limit=2)
    daily = click_fraud_filter(df, limit=2, reset="daily")
    assert rows(never, "seq", "tag") == [(0, "pass"), (1, "pass"), (2, "warning")]
    assert rows(daily, "seq", "tag") == [(0, "pass"), (1, "pass"), (2, "warning"),
                                         (10, "pass"), (11, "pass"), (12, "warning")]


def test_top_n_ties_and_report(spark):
    df = spark.createDataFrame([(3, ts(3600), 5), (1, ts(3600), 5), (2, ts(3600), 9), (4, ts(3600), 1),
                                (1, ts(7200), 2)], "item_id long, window_end timestamp_ntz, cnt long")
    top = ranking.hot_items(df, 2)
    assert rows(top, "window_end", "row_num", "item_id") == [(ts(3600), 1, 2), (ts(3600), 2, 1), (ts(7200), 1, 1)]
    rep = dict(ranking.format_report(top, "item_id").collect())
    # The reference's report layout.
    assert rep[ts(3600)] == ("窗口结束时间：1970-01-01 01:00:00.0\n"
                             "NO1: \t商品ID=2\t热门度=9\n"
                             "NO2: \t商品ID=1\t热门度=5\n"
                             "=============================\n\n")


def test_hot_items_sql_equals_dataframe(spark):
    data = [(u, i, 1, "pv", ts(t), n) for n, (u, i, t) in enumerate(
        [(1, 1, 0), (2, 1, 60), (3, 2, 120), (4, 3, 400), (5, 3, 500), (6, 3, 4000), (7, 2, 4100)])]
    df = spark.createDataFrame(data, "user_id long, item_id long, category int, behavior string, "
                                     "ts timestamp_ntz, seq long")
    df.createOrReplaceTempView("t_behavior")
    from ubeat.operators import windows
    a = ranking.hot_items(windows.item_view_counts(df), 2)
    b = ranking.hot_items_sql(spark, "t_behavior", n=2)
    cols = ("item_id", "window_end", "cnt", "row_num")
    assert rows(a, *cols) == rows(b, *cols)
