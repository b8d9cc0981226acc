from pyspark.sql import functions as F

from conftest import rows, ts
from ubeat.operators.late import kept_window_counts, split_late
from ubeat.sources.text import parse_access_log, read_logins, read_orders

# Minutes after midnight of one day in arrival order; the hours they fall into are
# 6, 6, 8, 6, 7, 9, 1, 8, 12, 11, 12, 9.
MINUTES = [365, 410, 491, 379, 479, 540, 75, 539, 735, 719, 722, 545]


def test_split_late_rows(spark):
    day = 1_400_025_600
    df = spark.createDataFrame([(10 * i, ts(day + 60 * m)) for i, m in enumerate(MINUTES)], "seq long, ts timestamp_ntz")
    out = split_late(df, "1 hour")
    # The greatest earlier minute is 491 at 379 and 479, 540 at 75 and 539, 735 at the last three.
    assert [s for s, tag in rows(out, "seq", "tag") if tag == "late"] == [30, 40, 60, 70, 90, 110]
    kept = rows(kept_window_counts(out, "1 hour"), "window_end", "cnt")
    assert kept == [(ts(day + 3600 * h), n) for h, n in ((7, 2), (9, 1), (10, 1), (13, 2))]


def test_split_late_same_batch_and_lateness(spark):
    # Rows sharing an arrival key see the same watermark.
    df = spark.createDataFrame([(1, ts(7200)), (1, ts(0)), (2, ts(10))], "seq long, ts timestamp_ntz")
    assert rows(split_late(df, "1 hour"), "seq", "ts", "tag") == \
        [(1, ts(0), "on_time"), (1, ts(7200), "on_time"), (2, ts(10), "late")]
    assert rows(split_late(df, "1 hour", lateness="1 hour"), "seq", "tag")[-1] == (2, "late")
    assert rows(split_late(df, "1 hour", lateness="2 hours"), "tag") == [("on_time",)] * 3


def test_parse_access_log(spark, tmp_path):
    p = tmp_path / "access.log"
    p.write_text("1.1.1.1 - - 17/05/2015:10:25:59 +0000 GET /a\n\n"
                 "1.1.1.1 - - 17/05/2015:10:25:63 +0000 GET /a\n"
                 "2.2.2.2 - - 17/05/2015:10:26:00 +0000 POST /b\n   \n")
    from ubeat.sources.text import read_lines
    got = rows(parse_access_log(read_lines(spark, str(p))), "ip", "ts", "method", "url")
    base = 1431858300  # 2015-05-17 10:25:00 UTC
    assert got == [("1.1.1.1", ts(base + 59), "GET", "/a"), ("1.1.1.1", ts(base + 63), "GET", "/a"),
                   ("2.2.2.2", ts(base + 60), "POST", "/b")]


def test_csv_readers(spark, tmp_path):
    p = tmp_path / "logins.csv"
    p.write_text("71,10.1.2.3,success,1700000007\n905,10.9.8.7,fail,1700000031\n")
    got = rows(read_logins(spark, str(p)), "user_id", "event_type", "ts")
    assert got == [(71, "success", ts(1700000007)), (905, "fail", ts(1700000031))]
    q = tmp_path / "orders.csv"
    q.write_text("12,create,,1700000100\n12,pay,tx-a1,1700000160\n")
    assert rows(read_orders(spark, str(q)), "order_id", "tx_id") == [(12, "tx-a1"), (12, None)]


def test_user_behavior_csv_end_to_end(spark, tmp_path):
    from ubeat.operators import ranking, windows
    from ubeat.sources.text import read_user_behavior
    p = tmp_path / "behavior.csv"
    hour = 534_722 * 3600
    lines = [(3, 41, 2, "pv", 100), (5, 41, 2, "pv", 130), (5, 41, 2, "cart", 140), (3, 58, 2, "pv", 3700),
             (5, 58, 1, "pv", 3720), (3, 58, 1, "pv", 3790), (9, 41, 2, "pv", 7300)]
    p.write_text("".join(f"{u},{i},{c},{b},{hour + t}\n" for u, i, c, b, t in lines))
    beh = read_user_behavior(spark, str(p))
    pv = rows(windows.page_views(beh), "window_end", "pv")
    uv = rows(windows.unique_visitors(beh), "window_end", "uv")
    assert pv == [(ts(hour + 3600), 2), (ts(hour + 7200), 3), (ts(hour + 10800), 1)]
    assert uv == [(ts(hour + 3600), 2), (ts(hour + 7200), 2), (ts(hour + 10800), 1)]
    top = ranking.hot_items(windows.item_view_counts(beh), 1)
    assert rows(top.where(F.col("window_end") == ts(hour + 300)), "item_id", "cnt") == [(41, 2)]
    rep = dict(ranking.format_report(top, "item_id").collect())
    assert rep[ts(hour + 300)].startswith(f"窗口结束时间：{ts(hour + 300)}.0\nNO1: \t商品ID=41\t")


def test_parse_lines_batch_and_stream(spark, tmp_path):
    from ubeat.sources.text import LOGIN, ORDER, parse_lines, read_lines
    p = tmp_path / "lines"
    p.mkdir()
    (p / "a.txt").write_text("71,10.1.2.3,success,1700000007\n\n905,10.9.8.7,fail,1700000031\n")
    got = rows(parse_lines(read_lines(spark, str(p)), LOGIN), "user_id", "event_type", "ts")
    assert got == [(71, "success", ts(1700000007)), (905, "fail", ts(1700000031))]
    s = parse_lines(read_lines(spark, str(p), stream=True), LOGIN)
    assert s.isStreaming and s.schema["ts"].dataType.typeName() == "timestamp"
    q = s.writeStream.format("memory").queryName("parsed_lines").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("parsed_lines").count() == 2
    o = tmp_path / "orders"
    o.mkdir()
    (o / "a.txt").write_text("88,create,,1700000200\n88,pay,tx-b2,1700000290\n")
    assert rows(parse_lines(read_lines(spark, str(o)), ORDER), "order_id", "tx_id") == \
        [(88, "tx-b2"), (88, None)]
