"""Stream forms equal the batch operators (closed windows / fired timers)."""
import itertools
import os
from datetime import timedelta

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import rows, ts
from ubeat.operators import ranking, windows
from ubeat.operators.fraud import click_fraud_filter
from ubeat.operators.logins import login_fail_pair, login_fail_timer
from ubeat.operators.orders import order_timeout, tx_match
from ubeat.sources import tables as tb
from ubeat.streaming import ranking as sr
from ubeat.streaming import stateful as st
from ubeat.streaming import windows as sw
from ubeat.streaming.sources import table_stream

SF = "/root/testdata/sf0.001"
_ids = itertools.count()


def run_stream(spark, df, tmp_path):
    name = f"s{next(_ids)}"
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.table(name)


def run_each(spark, df, fn, tmp_path, mode="append"):
    q = (df.writeStream.outputMode(mode).foreachBatch(fn)
         .option("checkpointLocation", str(tmp_path / f"s{next(_ids)}")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None


def write_parts(spark, df, path, parts=3, order="seq"):
    """Split a small table into ``parts`` files by arrival order (one per micro-batch)."""
    n = df.count()
    df = df.withColumn("__part", F.floor(F.row_number().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy(order)) * parts / (n + 1)))
    for i in range(parts):
        df.where(F.col("__part") == i).drop("__part").coalesce(1).write.parquet(os.path.join(path, f"t{i:03d}"))
    return df.drop("__part")


def stream_of(spark, path, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(os.path.join(path, "t*")))


def test_stream_hot_items_equals_batch_on_closed_windows(spark, tmp_path):
    ev = tb.load(spark, SF, "events")
    beh_s = tb.user_behavior(table_stream(spark, SF, "events"))
    run_each(spark, sw.stream_item_view_counts(beh_s), sr.each_batch(lambda b: ranking.hot_items(b, 5), str(tmp_path / "out")),
             tmp_path)
    got = rows(spark.read.parquet(str(tmp_path / "out")), "item_id", "window_end", "cnt", "row_num")
    # The watermark follows the pv rows: windows up to the last view are closed.
    last = ev.where("event_type = 'view'").agg(F.max("ts")).first()[0]
    batch = ranking.hot_items(windows.item_view_counts(tb.user_behavior(ev)), 5).where(F.col("window_end") <= last)
    assert got == rows(batch, "item_id", "window_end", "cnt", "row_num")


def test_stream_pv_uv_equal_batch(spark, tmp_path):
    ev = tb.load(spark, SF, "events")
    last = ev.where("event_type = 'view'").agg(F.max("ts")).first()[0]
    beh_s = tb.user_behavior(table_stream(spark, SF, "events"))
    pv = rows(run_stream(spark, sw.stream_page_views(beh_s), tmp_path), "window_end", "pv")
    uv = rows(run_stream(spark, sw.stream_unique_visitors(beh_s), tmp_path), "window_end", "uv")
    bm = rows(run_stream(spark, sw.stream_unique_visitors(beh_s, bits=64), tmp_path), "window_end", "uv")
    beh = tb.user_behavior(ev)
    assert pv == rows(windows.page_views(beh).where(F.col("window_end") <= last), "window_end", "pv")
    assert uv == rows(windows.unique_visitors(beh).where(F.col("window_end") <= last), "window_end", "uv")
    assert bm == rows(windows.unique_visitors_bitmap(beh, bits=64).where(F.col("window_end") <= last),
                      "window_end", "uv")


def test_stream_fraud_filter_equals_batch(spark, tmp_path):
    ev = tb.load(spark, SF, "events").select("user_id", "event_type", "ts", F.col("event_id").alias("seq"))
    write_parts(spark, ev, str(tmp_path / "clicks"))
    s = stream_of(spark, str(tmp_path / "clicks"), ev.schema)
    got = run_stream(spark, st.stream_click_fraud_filter(s, ("user_id", "event_type"), 3), tmp_path)
    want = click_fraud_filter(ev, ("user_id", "event_type"), 3)
    assert rows(got, "seq", "tag", "msg") == rows(want, "seq", "tag", "msg")


def _login_table(spark, sentinel=True):
    lg = tb.logins(tb.load(spark, SF, "events")).select("user_id", "event_type", "ts", "seq")
    if sentinel:
        far = spark.createDataFrame([(-1, "success", ts(4_000_000_000), 10**9)], lg.schema)
        lg = lg.unionByName(far)
    return lg


def test_stream_login_alarms_equal_batch(spark, tmp_path):
    lg = _login_table(spark)
    write_parts(spark, lg, str(tmp_path / "logins"))
    s = stream_of(spark, str(tmp_path / "logins"), lg.schema)
    pair = run_stream(spark, st.stream_login_fail_pair(s, "2 hours"), tmp_path)
    cols = ("user_id", "first_fail", "last_fail", "msg")
    assert rows(pair, *cols) == rows(login_fail_pair(lg, "2 hours"), *cols)
    timer = run_stream(spark, st.stream_login_fail_timer(s, 2, "6 hours", delay="0 seconds"), tmp_path)
    assert rows(timer, *cols) == rows(login_fail_timer(lg, 2, "6 hours"), *cols)


def test_stream_order_timeout_equals_batch_however_it_is_cut(spark, tmp_path):
    od = tb.order_events(tb.load(spark, SF, "events"), per="user_item").select("order_id", "event_type", "ts", "seq")
    again = od.withColumn("ts", F.col("ts") + F.expr("INTERVAL 7 HOURS")).withColumn("seq", F.col("seq") + 10**6)
    far = spark.createDataFrame([(-1, "pay", ts(4_000_000_000), 10**9)], od.schema)
    od = od.unionByName(again)
    cols = ("order_id", "create_ts", "pay_ts", "tag", "result")
    want = rows(order_timeout(od, "12 hours", timers=True), *cols)
    assert {r[4] for r in want} == {"payed successfully", "payed but not found create log", "order timeout"}
    for files in (1, 2, 5):
        # Order by arrival; the end of input comes last.
        path = str(tmp_path / f"orders{files}")
        od.repartitionByRange(files, "ts").write.parquet(path)
        far.coalesce(1).write.mode("append").parquet(path)
        s = (spark.readStream.schema(od.schema).option("maxFilesPerTrigger", 1 if files > 1 else 100).parquet(path))
        got = run_stream(spark, st.stream_order_timeout(s, "12 hours", delay="3650 days"), tmp_path / str(files))
        assert rows(got.where("order_id <> -1"), *cols) == want, files


def test_stream_tx_match_equals_batch(spark, tmp_path):
    ev = tb.load(spark, SF, "events")
    p, r = tb.pays(ev), tb.receipts(ev)
    far_p = spark.createDataFrame([(-1, "zz", ts(4_000_000_000), 10**9)], p.schema)
    far_r = spark.createDataFrame([("zz", "wechat", ts(4_000_000_000), 10**9)], r.schema)
    p, r = p.unionByName(far_p), r.unionByName(far_r)
    write_parts(spark, p, str(tmp_path / "pays"))
    write_parts(spark, r, str(tmp_path / "receipts"))
    ps = stream_of(spark, str(tmp_path / "pays"), p.schema)
    rs = stream_of(spark, str(tmp_path / "receipts"), r.schema)
    got = run_stream(spark, st.stream_tx_match(ps, rs, "5 hours", "3 hours"), tmp_path).where("tx_id <> 'zz'")
    want = tx_match(p, r, "5 hours", "3 hours").where("tx_id <> 'zz'")
    cols = ("tag", "tx_id", "pay_seq", "receipt_seq")
    assert rows(got, *cols) == rows(want, *cols)


def test_registered_tx_stream_gives_lonely_rows(spark):
    got = {(r.tag, r.pay_seq, r.receipt_seq): r for r in entry.queries()["stream_tx_reconcile"](spark, SF).collect()}
    ev = tb.load(spark, SF, "events")
    want = {(r.tag, r.pay_seq, r.receipt_seq): r for r in tx_match(tb.pays(ev), tb.receipts(ev), "5 hours", "3 hours").collect()}
    assert {k[0] for k in got} == {"matched", "unmatched_pay", "unmatched_receipt"} and got.keys() <= want.keys()
    last = min(max(r.pay_ts for r in want.values() if r.pay_ts), max(r.receipt_ts for r in want.values() if r.receipt_ts))
    for r in (want[k] for k in want.keys() - got.keys()):
        assert (r.pay_ts or r.receipt_ts) + timedelta(hours=5 if r.pay_ts else 3) > last - timedelta(milliseconds=1)


def test_stream_fraud_filter_daily_reset(spark, tmp_path):
    base = 16 * 3600  # 00:00 at UTC+8
    data = [(1, "click", ts(base - 30 + i), i) for i in range(3)] + \
           [(1, "click", ts(base + 10 + i), 10 + i) for i in range(3)] + [(2, "click", ts(base + 3 * 86400), 99)]
    df = spark.createDataFrame(data, "user_id long, event_type string, ts timestamp_ntz, seq long")
    write_parts(spark, df, str(tmp_path / "clicks"), parts=2)
    s = stream_of(spark, str(tmp_path / "clicks"), df.schema)
    got = run_stream(spark, st.stream_click_fraud_filter(s, ("user_id", "event_type"), 2, reset="daily"), tmp_path)
    want = click_fraud_filter(df, ("user_id", "event_type"), 2, reset="daily")
    assert rows(got, "seq", "tag") == rows(want, "seq", "tag")


T0 = 1_600_000_000


def test_stream_revised_top_n_updates_on_late_rows(spark, tmp_path):
    # File 1: requests at t=0..2; file 2 advances the watermark past the first
    # windows; file 3 brings a late request (within the lateness) for t=1.
    files = [[("/a", 0, 0), ("/b", 1, 1), ("/b", 2, 2)],
             [("/c", 40, 3)],
             [("/a", 1, 4), ("/a", 1, 5)],
             [("/z", 500, 6)]]
    for i, part in enumerate(files):
        spark.createDataFrame([(u, "GET", ts(T0 + t), s) for u, t, s in part],
                              "url string, method string, ts timestamp_ntz, seq long") \
            .coalesce(1).write.parquet(str(tmp_path / "log" / f"t{i:03d}"))
    schema = "url string, method string, ts timestamp_ntz, seq long"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log" / "t*"))
    run_each(spark, sr.changing_panes(s, "10 seconds", "5 seconds", delay="0 seconds", lateness="1 minute"),
             sr.revised_top_n(str(tmp_path / "r"), 2, "10 seconds", "5 seconds", delay="0 seconds", bucket="20 seconds"),
             tmp_path, "update")
    out = spark.read.parquet(str(tmp_path / "r" / "ranked"))
    got = rows(out.where(F.col("window_end") == ts(T0 + 5)), "epoch", "row_num", "url", "cnt")
    # Ranked when file 2 closes the window: b=2, a=1; after the late rows: a=3, b=2.
    first, again = sorted({r[0] for r in got})
    assert got == [(first, 1, "/b", 2), (first, 2, "/a", 1), (again, 1, "/a", 3), (again, 2, "/b", 2)]


def test_stream_patterns_equal_batch(spark, tmp_path):
    from ubeat.operators.patterns import login_fail_sequence, order_pay_pattern
    lg = _login_table(spark)
    write_parts(spark, lg, str(tmp_path / "lg"), parts=4)
    s = stream_of(spark, str(tmp_path / "lg"), lg.schema)
    got = run_stream(spark, st.stream_login_fail_sequence(s, 3, "1 day", delay="0 seconds"), tmp_path)
    cols = ("user_id", "first_fail", "last_fail", "msg")
    assert rows(got, *cols) == rows(login_fail_sequence(lg, 3, "1 day"), *cols)

    od = tb.order_events(tb.load(spark, SF, "events"), per="user").select("order_id", "event_type", "ts", "seq")
    od = od.unionByName(spark.createDataFrame([(-1, "pay", ts(4_000_000_000), 10**9)], od.schema))
    write_parts(spark, od, str(tmp_path / "od"), parts=4)
    s2 = stream_of(spark, str(tmp_path / "od"), od.schema)
    got2 = run_stream(spark, st.stream_order_pay_pattern(s2, "12 hours"), tmp_path).where("order_id <> -1")
    cols2 = ("order_id", "create_ts", "pay_ts", "tag", "result")
    assert rows(got2, *cols2) == rows(order_pay_pattern(od, "12 hours").where("order_id <> -1"), *cols2)


def test_stream_late_split_equals_batch_by_micro_batch(spark, tmp_path):
    from ubeat.operators.late import split_late
    from ubeat.streaming.late import late_splitter
    sh = tb.shipments(tb.load(spark, SF, "lineitem"))
    # Four micro-batches by order key; the batch rule with seq = batch number.
    parts = 4
    n = sh.agg(F.max("seq")).first()[0] + 1
    sh = sh.withColumn("batch", F.floor(F.col("seq") * parts / n).cast("long"))
    for i in range(parts):
        sh.where(F.col("batch") == i).drop("batch").coalesce(1).write.parquet(str(tmp_path / "sh" / f"t{i:03d}"))
    s = stream_of(spark, str(tmp_path / "sh"), sh.drop("batch").schema)
    out = str(tmp_path / "tagged")

    def sink(df, epoch):
        df.write.mode("append").parquet(out)
    fn = late_splitter("7 days", "1 day", delay="1 day", lateness="30 days", state_path=str(tmp_path / "wm"),
                       sink=sink)
    q = (s.writeStream.foreachBatch(fn).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = rows(spark.read.parquet(out), "seq", "l_linenumber", "l_partkey", "tag")
    want = split_late(sh.withColumn("seq_orig", F.col("seq")).withColumn("seq", F.col("batch")),
                      "7 days", "1 day", delay="1 day", lateness="30 days")
    want = want.withColumn("seq", F.col("seq_orig"))
    assert got == rows(want, "seq", "l_linenumber", "l_partkey", "tag")
    assert {t for *_, t in got} == {"late", "on_time"}


def test_stream_panes_then_change_points(spark, tmp_path):
    # Stream: closed 5 s pane counts per url appended to a table; batch: the
    # change-point plan over that table equals the direct 10 min / 5 s windows.
    log = tb.access_log(tb.load(spark, SF, "events")).where("method = 'GET'").select("url", "ts", "seq")
    log = log.unionByName(spark.createDataFrame([("/z", ts(4_000_000_000), 10**9)], log.schema))
    write_parts(spark, log, str(tmp_path / "log"), parts=3)
    s = stream_of(spark, str(tmp_path / "log"), log.schema)
    panes = run_stream(spark, sw.stream_pane_counts(s, ["url"], "5 seconds"), tmp_path).where("url <> '/z'")
    panes = panes.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    got = sw.windows_from_panes(panes, ["url"], "10 minutes", "5 seconds")
    want = windows.sliding_count(log.where("url <> '/z'"), ["url"], "10 minutes", "5 seconds", plan="direct")
    cols = ("url", "window_start", "window_end", "cnt")
    assert rows(got, *cols) == rows(want, *cols)


def test_line_stream_to_hot_items(spark, tmp_path):
    from ubeat.sources.sinks import write_tagged
    from ubeat.sources.text import USER_BEHAVIOR, parse_lines, read_lines
    # Text lines arrive in three files (micro-batches), as from a topic.
    beh = tb.user_behavior(tb.load(spark, SF, "events")).where("behavior = 'pv'")
    lines = beh.select(F.concat_ws(",", "user_id", "item_id", "category", "behavior",
                                   F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")).alias("value"),
                       "seq")
    n = lines.agg(F.max("seq")).first()[0] + 1
    for i in range(3):  # contiguous arrival ranges: later files hold later events
        lines.where(F.floor(F.col("seq") * 3 / n) == i).select("value").coalesce(1) \
            .write.text(str(tmp_path / "in" / f"t{i}"))
    s = parse_lines(spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in" / "t*")),
                    USER_BEHAVIOR)
    counts = sw.stream_item_view_counts(s, delay="1 day").withColumn("tag", F.lit("hot_items"))
    q = write_tagged(counts, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination(300)
    got = ranking.hot_items(spark.read.parquet(str(tmp_path / "out")), 5)
    last = beh.agg(F.max("ts")).first()[0]
    # Whole seconds in the lines; windows closed by the final watermark (1 day behind).
    beh_s = beh.withColumn("ts", F.date_trunc("second", "ts"))
    want = ranking.hot_items(windows.item_view_counts(beh_s), 5) \
        .where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 1 DAY"))
    cols = ("item_id", "window_end", "cnt", "row_num")
    got = got.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    assert rows(got, *cols) == rows(want, *cols)
