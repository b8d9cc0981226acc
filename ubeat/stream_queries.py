"""Registered stream queries: the events replayed in ``PARTS`` micro-batches.

Each query replays the whole ``events`` table (it is in event-time order by
``event_id``): parts are written to the query's input folder and the query runs
over what is new, a part per micro-batch, from its checkpoint, so state and
watermark are carried between the parts and recovered between the ``RUNS`` starts.
Input, output and checkpoint are folders under the session's shared checkpoint
folder and are removed when the result has been checkpointed.
Windows and timers that the final watermark has not reached are not emitted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ubeat.functions.time import to_micros
from ubeat.operators import ranking, windows
from ubeat.operators.sketches import sketch_visitors
from ubeat.queries import (
    _FRAUD_ORACLE,
    _HOUR_END,
    _K,
    _LOGINS,
    _ORACLES,
    _PAGE_COUNTS_ORACLE,
    _hop,
    HOT_ITEMS_ORACLE,
    OFFSET16,
    register,
)
from ubeat.session import delete, ensure_checkpoint_dir, kept, keyed_state
from ubeat.sources import tables as tb
from ubeat.streaming import ranking as sr
from ubeat.streaming import stateful as st
from ubeat.streaming import windows as sw
from ubeat.streaming.late import late_splitter

PARTS = 4
#: Times that a query is started; it goes on from its checkpoint.
RUNS = 2
#: Rows of an input file (each part has as many files), rows per state partition and the
#: most state partitions: each has its own stores, loaded and committed at every
#: micro-batch, and every task reports a metric for each of them, so tasks that grow with
#: the rows would send the driver the square of their number.
FILE_ROWS, STATE_ROWS, STATES = 1_000_000, 250_000, 48
_LAST_VIEW = "(SELECT max(ts) FROM events WHERE event_type = 'view')"
#: The final watermark of a query over all events, in whole milliseconds.
_LAST = "(SELECT make_timestamp(epoch_us(max(ts)) // 1000 * 1000) FROM events)"


def _replay(spark: SparkSession, sf: str, name: str, build: Callable[[DataFrame], DataFrame], mode: str = "append",
            each: Callable[[str], Callable] | None = None, table: str = "events", order: str = "ts",
            arrival: Callable[[Column], Column] | None = None) -> str:
    """Run ``build(stream)`` over all parts of ``table``; returns the folder.

    Parts follow ``order``, or what ``arrival`` makes of it (rows out of order).

    The output is ``<folder>/out``, or what the ``foreachBatch`` function
    ``each(folder)`` writes."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ubeat-{name}-{uuid.uuid4().hex}"
    rows = tb.load(spark, sf, table)
    by = F.col(order) if order != "ts" else to_micros("ts", rows.schema["ts"].dataType)
    by = by if arrival is None else arrival(by)
    low, high, n = rows.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    cut = [low + (high + 1 - low) * i // PARTS for i in range(PARTS + 1)] if low is not None else [0] * (PARTS + 1)
    files = -(-n // (PARTS * FILE_ROWS)) or 1
    states = min(int(spark.conf.get("spark.sql.shuffle.partitions")), STATES, -(-n // STATE_ROWS) or 1)
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        part = rows.where((by >= a) & (by < b))
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.mode("append").parquet(f"{base}/in")
        if i % (PARTS // RUNS) != PARTS // RUNS - 1:
            continue
        out = build(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in"))
        writer = out.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        writer = writer.foreachBatch(each(base)) if each else writer.format("parquet").option("path", f"{base}/out")
        with keyed_state(spark, states):
            query = writer.start()
            query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    for part in ("in", "checkpoint"):
        delete(spark, f"{base}/{part}")
    return base


def _result(spark: SparkSession, sf: str, name: str, build, *times: str) -> DataFrame:
    """Everything the stream wrote, with the NTZ times of the table."""
    base = _replay(spark, sf, name, build)
    out = spark.read.parquet(f"{base}/out")
    for t in times:
        out = out.withColumn(t, F.col(t).cast("timestamp_ntz"))
    return kept(out, base)


def _views(ev: DataFrame) -> DataFrame:
    return tb.only(ev, "view")


# --- windows -----------------------------------------------------------------------------------

def _ranked_items(spark: SparkSession, sf: str, name: str, transform) -> DataFrame:
    base = _replay(spark, sf, name, lambda ev: sw.stream_item_view_counts(tb.user_behavior(_views(ev))),
                   each=lambda base: sr.each_batch(transform, f"{base}/out"))
    out = spark.read.parquet(f"{base}/out").drop("epoch")
    return kept(out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), base)


@register("stream_hot_items", f"SELECT * FROM ({HOT_ITEMS_ORACLE}) WHERE window_end <= {_LAST_VIEW}")
def stream_hot_items(spark: SparkSession, sf: str) -> DataFrame:
    """Closed windows' counts as a stream, ranked per micro-batch."""
    return _ranked_items(spark, sf, "hot-items", lambda b: ranking.hot_items(b.drop("window_start"), 5)) \
        .select("item_id", "window_end", "cnt", "row_num")


@register("stream_hot_items_report", f"SELECT * FROM ({_ORACLES['hot_items_report']}) WHERE window_end <= {_LAST_VIEW}")
def stream_hot_items_report(spark: SparkSession, sf: str) -> DataFrame:
    """R5 on a stream: one text block per closed window."""
    def report(batch: DataFrame) -> DataFrame:
        ranked = ranking.hot_items(batch.drop("window_start"), 5)
        return ranking.format_report(ranked.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")),
                                     "item_id", ranking.ITEM_LABEL)
    return _ranked_items(spark, sf, "report", report)


_REQUESTS = f"SELECT '/page/' || CAST({_K} AS VARCHAR) AS url, epoch_us(ts) AS us, event_id FROM events WHERE event_type = 'view'"


@register("stream_hot_pages", f"""
WITH req AS ({_REQUESTS}),
c AS (SELECT url, window_end, CAST(count(*) AS BIGINT) AS cnt
      FROM ({_hop('req', 'url', 'us', 600_000_000, 5_000_000)}) GROUP BY url, window_end)
SELECT url, window_end, cnt, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS row_num FROM c)
WHERE row_num <= 3 AND window_end <= {_LAST_VIEW} - INTERVAL 1 SECOND""")
def stream_hot_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages per 10 min sliding by 5 s with a delay of 1 s and a lateness of
    1 min; the last ranking of every window."""
    base = _replay(spark, sf, "hot-pages",
                   lambda ev: sr.changing_panes(tb.access_log(_views(ev)), "10 minutes", "5 seconds", method="GET"),
                   mode="update", each=lambda base: sr.revised_top_n(base, 3, "10 minutes", "5 seconds"))
    return _last_ranking(spark, base).select("url", "window_end", "cnt", "row_num")


def _last_ranking(spark: SparkSession, base: str) -> DataFrame:
    out = spark.read.parquet(f"{base}/ranked")
    last = out.groupBy("window_end").agg(F.max("epoch").alias("epoch"), F.count_distinct("epoch").alias("rankings"))
    return kept(out.join(last, ["window_end", "epoch"]).withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), base)


#: An event arrives up to five hours after it happened.
_JITTER_S = 18_000
_ARRIVAL = f"epoch_us(ts) + event_id * 7919 % {_JITTER_S} * 1000000"


@register("stream_hot_pages_late", f"""
WITH a AS (SELECT event_type, {_K} AS k, epoch_us(ts) AS us, {_ARRIVAL} AS arrival FROM events),
cut AS (SELECT i, lo + (hi + 1 - lo) * i // {PARTS} AS low FROM range(0, {PARTS}) t(i),
        (SELECT min(arrival) AS lo, max(arrival) AS hi FROM a)),
req AS (SELECT '/page/' || CAST(k AS VARCHAR) AS url, us, (SELECT max(i) FROM cut WHERE low <= arrival) AS part
        FROM a WHERE event_type = 'view'),
reach AS (SELECT part, max(max(us)) OVER (ORDER BY part) - 600000000 AS reached FROM req GROUP BY part),
hop AS ({_hop('req', 'url, part', 'us', 3_600_000_000, 300_000_000)}),
c AS (SELECT url, window_end, CAST(count(*) AS BIGINT) AS cnt FROM hop GROUP BY url, window_end),
w AS (SELECT window_end, part FROM hop GROUP BY ALL),
-- A window is ranked in the part that first reaches its end and in later parts that change it.
f AS (SELECT window_end, min(part) AS part FROM (SELECT DISTINCT window_end FROM w) JOIN reach ON epoch_us(window_end) <= reached GROUP BY window_end),
r AS (SELECT f.window_end, CAST(max((w.part <= f.part)::INT) + count(*) FILTER (w.part > f.part) AS BIGINT) AS rankings
      FROM f JOIN w USING (window_end) GROUP BY f.window_end)
SELECT url, window_end, cnt, row_num, rankings FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS row_num FROM c) JOIN r USING (window_end)
WHERE row_num <= 3""")
def stream_hot_pages_late(spark: SparkSession, sf: str) -> DataFrame:
    """R4 / W3 with rows that arrive out of order: pages per 1 h sliding by 5 min, delay
    10 min, lateness 6 h; events replayed by arrival, up to 5 h after their time. The last
    ranking of every window and how often it was ranked."""
    opts = {"delay": "10 minutes", "lateness": "6 hours"}
    base = _replay(spark, sf, "hot-pages-late",
                   lambda ev: sr.changing_panes(tb.access_log(_views(ev)), "1 hour", "5 minutes", method="GET", **opts),
                   mode="update", each=lambda base: sr.revised_top_n(base, 3, "1 hour", "5 minutes", **opts),
                   arrival=lambda us: us + F.col("event_id") * 7919 % _JITTER_S * 1_000_000)
    return _last_ranking(spark, base).select("url", "window_end", "cnt", "row_num", "rankings")


@register("stream_page_views", f"SELECT * FROM ({_ORACLES['page_views']}) WHERE window_end <= {_LAST_VIEW}")
def stream_page_views(spark: SparkSession, sf: str) -> DataFrame:
    """A7 on a stream."""
    return _result(spark, sf, "pv", lambda ev: sw.stream_page_views(tb.user_behavior(_views(ev)), "1 hour"), "window_end")


@register("stream_unique_visitors", f"""
SELECT {_HOUR_END} AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1 HAVING {_HOUR_END} <= {_LAST_VIEW}
""")
def stream_unique_visitors(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct viewers per hour as a stream (two chained aggregates)."""
    return _result(spark, sf, "uv", lambda ev: sw.stream_unique_visitors(tb.user_behavior(_views(ev)), "1 hour"),
                   "window_end")


@register("stream_unique_visitors_bitmap",
          f"SELECT * FROM ({_ORACLES['unique_visitors_bitmap']}) WHERE window_end <= {_LAST_VIEW}")
def stream_unique_visitors_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """A11 on a stream: distinct bitmap offsets (64 bits) per hour."""
    return _result(spark, sf, "bitmap",
                   lambda ev: sw.stream_unique_visitors(tb.user_behavior(_views(ev)), "1 hour", bits=64), "window_end")


@register("stream_running_visitors", f"""
SELECT window_end, user_id, ts AS first_ts, row_number() OVER (PARTITION BY window_end ORDER BY ts) AS uv FROM (
  SELECT {_HOUR_END} AS window_end, user_id, min(ts) AS ts FROM events WHERE event_type = 'view' GROUP BY ALL)
""")
def stream_running_visitors(spark: SparkSession, sf: str) -> DataFrame:
    """First views per hour and visitor in update mode, counted in order."""
    from ubeat.plans.scan import blocked_running, row_blocks
    base = _replay(spark, sf, "running", lambda ev: sw.stream_running_visitors(tb.user_behavior(_views(ev)), "1 hour"),
                   mode="update", each=lambda base: sr.each_batch(lambda b: b, f"{base}/out"))
    out = kept(spark.read.parquet(f"{base}/out"), base).groupBy("window_end", "user_id").agg(F.min("first_ts").alias("first_ts"))
    out = row_blocks(out.withColumn("one", F.lit(1)), ["window_end"], ["first_ts", "user_id"])
    out = blocked_running(out, ["window_end"], ["first_ts", "user_id"], "one", "__blk", "uv")
    return out.select(*[F.col(t).cast("timestamp_ntz").alias(t) for t in ("window_end", "first_ts")], "user_id", "uv")


#: The micro-batch that brings an event: ``PARTS`` equal cuts of the events' time.
_PART = f"""(SELECT max(i) FROM range(0, {PARTS}) t(i), (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)
  WHERE lo + (hi + 1 - lo) * i // {PARTS} <= epoch_us(e.ts))"""


@register("stream_visitor_counts", f"""
WITH f AS (SELECT window_end, o, min(part) AS part FROM (
  SELECT {_HOUR_END} AS window_end, {OFFSET16} AS o, {_PART} AS part FROM events e WHERE event_type = 'view') GROUP BY ALL)
SELECT window_end, CAST(sum(n) OVER (PARTITION BY window_end ORDER BY part) AS BIGINT) AS uv
FROM (SELECT window_end, part, count(*) AS n FROM f GROUP BY ALL)
""")
def stream_visitor_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The running number of visitors per hour as the stream emits it, from
    bitmaps of 65,536 bits in keyed state."""
    return _result(spark, sf, "visitors", lambda ev: sw.stream_visitor_counts(tb.user_behavior(_views(ev)), "1 hour", bits=1 << 16),
                   "window_end")


@register("stream_visitor_sketches", f"""
SELECT {_HOUR_END} AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv, TRUE AS near
FROM events WHERE event_type = 'view' GROUP BY 1 HAVING {_HOUR_END} <= {_LAST_VIEW}
""")
def stream_visitor_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """A10: 5-minute HLL sketches as a stream, united to hours, next to the exact number:
    within 5 % (and one visitor)."""
    panes = _result(spark, sf, "sketches", lambda ev: sw.stream_visitor_sketches(tb.user_behavior(_views(ev))), "window_start")
    approx = sketch_visitors(panes, "1 hour").withColumnRenamed("uv", "approx")
    views = _views(tb.load(spark, sf, "events"))
    closed = F.col("window_end") <= F.lit(views.agg(F.max("ts")).first()[0])
    both = windows.unique_visitors(tb.user_behavior(views), "1 hour").where(closed).join(approx, "window_end", "left")
    return both.select("window_end", "uv",
                       F.coalesce(F.abs(F.col("approx") - F.col("uv")) <= F.greatest(F.lit(1.0), 0.05 * F.col("uv")), F.lit(False))
                       .alias("near"))


@register("stream_page_counts", f"""
SELECT * FROM ({_PAGE_COUNTS_ORACLE.replace("WHERE event_type = 'view'", f"""WHERE event_type = 'view'
  AND make_timestamp((epoch_us(ts) // 5000000 + 1) * 5000000) <= {_LAST_VIEW}""")})
""")
def stream_page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A4 on a stream: closed 5 s pane counts, then the change-point plan over them."""
    panes = _result(spark, sf, "panes", lambda ev: sw.stream_pane_counts(tb.access_log(_views(ev)), ["url"], "5 seconds"),
                    "window_start")
    return sw.windows_from_panes(panes, ["url"], "10 minutes", "5 seconds").select("url", "window_end", "cnt")


# --- keyed state -------------------------------------------------------------------------------

@register("stream_login_fail_pair", _ORACLES["login_fail_pair"])
def stream_login_fail_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Two fails in a row (arrival order) less than 2 h apart, with per-user state."""
    return _result(spark, sf, "login-pair", lambda ev: st.stream_login_fail_pair(tb.logins(ev), "2 hours"),
                   "first_fail", "last_fail")


@register("stream_login_fail_timer", _ORACLES["login_fail_timer"].replace(
    "max(i) FROM l GROUP BY user_id)", f"max(i) FROM l GROUP BY user_id)\n    AND anchor + INTERVAL 6 HOUR <= {_LAST}"))
def stream_login_fail_timer(spark: SparkSession, sf: str) -> DataFrame:
    """At least 2 fails in the 6 h after a first fail, with event-time timers."""
    return _result(spark, sf, "login-timer",
                   lambda ev: st.stream_login_fail_timer(tb.logins(ev), 2, "6 hours", delay="0 seconds"),
                   "first_fail", "last_fail")


@register("stream_login_fail_sequence", f"SELECT * FROM ({_ORACLES['login_fail_sequence']}) WHERE last_fail <= {_LAST}")
def stream_login_fail_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Three consecutive fails (event time) within 1 day."""
    return _result(spark, sf, "login-sequence",
                   lambda ev: st.stream_login_fail_sequence(tb.logins(ev), 3, "1 day", delay="0 seconds"),
                   "first_fail", "last_fail")


_ORDER_EVENTS = f"""SELECT user_id * 100 + {_K} AS order_id, event_type, ts, event_id FROM events
  WHERE event_type IN ('click', 'purchase')"""
#: The final watermark of a query over order events.
_LAST_ORDER = "(SELECT make_timestamp(epoch_us(max(ts)) // 1000 * 1000) FROM events WHERE event_type IN ('click', 'purchase'))"


@register("stream_order_timeout", f"""
WITH w AS (SELECT *, lead(event_type) OVER k AS nt, lead(ts) OVER k AS nts, lag(event_type) OVER k AS pt, lag(ts) OVER k AS pts
           FROM ({_ORDER_EVENTS}) WHERE ts <= {_LAST_ORDER}
           WINDOW k AS (PARTITION BY order_id ORDER BY ts, event_type, event_id))
SELECT order_id, ts AS create_ts, nts AS pay_ts, 'payed' AS tag, 'payed successfully' AS result
FROM w WHERE event_type = 'click' AND nt = 'purchase' AND nts < ts + INTERVAL 12 HOUR
UNION ALL
SELECT order_id, ts, NULL, 'timeout', 'order timeout' FROM w
WHERE event_type = 'click' AND NOT coalesce(nt = 'purchase' AND nts < ts + INTERVAL 12 HOUR, FALSE)
  AND (nt IS NOT NULL OR ts + INTERVAL 12 HOUR <= {_LAST_ORDER})
UNION ALL
SELECT order_id, NULL, ts, 'timeout', 'payed but not found create log' FROM w
WHERE event_type = 'purchase' AND NOT coalesce(pt = 'click' AND ts < pts + INTERVAL 12 HOUR, FALSE)
""")
def stream_order_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """P5: every create/pay cycle per (user, item) order, with timers."""
    return _result(spark, sf, "orders",
                   lambda ev: st.stream_order_timeout(tb.order_events(ev, per="user_item"), "12 hours"),
                   "create_ts", "pay_ts")


@register("stream_order_pay_pattern", f"""
SELECT * FROM ({_ORACLES['order_pay_pattern']})
WHERE CASE WHEN tag = 'payed' THEN pay_ts <= {_LAST_ORDER} ELSE create_ts + INTERVAL 12 HOUR <= {_LAST_ORDER} END
""")
def stream_order_pay_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """A click followed by the user's next purchase within 12 h, else a timeout."""
    return _result(spark, sf, "order-pay", lambda ev: st.stream_order_pay_pattern(tb.order_events(ev, per="user"), "12 hours"),
                   "create_ts", "pay_ts")


@register("stream_click_fraud_daily", _ORACLES["click_fraud_daily"])
def stream_click_fraud_daily(spark: SparkSession, sf: str) -> DataFrame:
    """At most 2 events per (user, event type) and local day, the 3rd warns; a timer at
    the end of the day clears the state."""
    out = _result(spark, sf, "fraud-daily", lambda ev: st.stream_click_fraud_filter(
        tb.ad_clicks(ev), ("user_id", "event_type"), 2, reset="daily"), "ts")
    return out.select("user_id", "event_type", "ts", "seq", "tag")


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    out = _result(spark, sf, "tx", lambda ev: st.stream_tx_match(tb.pays(ev), tb.receipts(ev), "5 hours", "3 hours"),
                  "pay_ts", "receipt_ts")
    return out.select("tag", "tx_id", "pay_order_id", "pay_ts", "pay_seq", "receipt_pay_channel", "receipt_ts", "receipt_seq")


@register("stream_tx_match", f"SELECT * FROM ({_ORACLES['tx_match']}) WHERE tag = 'matched'")
def stream_tx_match(spark: SparkSession, sf: str) -> DataFrame:
    """The matched rows of the full outer stream-stream join; ``stream_tx_reconcile``
    has the lonely ones too."""
    return _tx(spark, sf).where("tag = 'matched'")


#: The final watermark of pays and receipts: the lower of the two, none without rows of both.
_LAST_TX = """(SELECT CASE WHEN count(*) = 2 THEN make_timestamp(epoch_us(min(t)) // 1000 * 1000) END FROM (
  SELECT max(ts) AS t FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY event_type))"""


@register("stream_tx_reconcile", f"""
SELECT * FROM ({_ORACLES['tx_match']}) WHERE tag = 'matched'
  OR tag = 'unmatched_pay' AND pay_ts + INTERVAL 5 HOUR <= {_LAST_TX}
  OR tag = 'unmatched_receipt' AND receipt_ts + INTERVAL 3 HOUR <= {_LAST_TX}
""")
def stream_tx_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the full outer stream-stream join, lonely ones once the
    watermark of both sides has passed their band."""
    return _tx(spark, sf)


@register("stream_click_fraud_filter", _FRAUD_ORACLE)
def stream_click_fraud_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The fraud filter with per-key state; provinces joined afterwards (stream-static)."""
    out = _result(spark, sf, "fraud",
                  lambda ev: st.stream_click_fraud_filter(tb.ad_clicks(ev), ("user_id", "event_type"), 10), "ts")
    out = tb.with_province(out, tb.load(spark, sf, "customer"), tb.load(spark, sf, "nation"))
    return out.select("user_id", "ad_id", "event_type", "province", "ts", "seq", "tag", "msg")


# --- late rows -----------------------------------------------------------------------------------

@register("stream_late_split", f"""
WITH s AS (SELECT l_orderkey AS seq, l_linenumber, l_partkey, l_shipdate AS ts FROM lineitem),
r AS (SELECT min(seq) AS lo, max(seq) + 1 AS hi FROM s),
cuts AS (SELECT i, lo + (hi - lo) * i // {PARTS} AS a FROM r, range(0, {PARTS}) t(i)),
p AS (SELECT s.*, (SELECT max(i) FROM cuts WHERE a <= seq) AS part FROM s),
m AS (SELECT part, max(max(epoch_us(ts))) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             - 86400000000 AS wm FROM p GROUP BY part)
SELECT seq, l_linenumber, l_partkey, ts, CASE WHEN wm IS NOT NULL
  AND epoch_us(ts) // 86400000000 * 86400000000 + 7 * 86400000000 - 1 + 30 * 86400000000 <= wm THEN 'late' ELSE 'on_time' END AS tag
FROM p JOIN m USING (part)
""")
def stream_late_split(spark: SparkSession, sf: str) -> DataFrame:
    """Line items tagged against the watermark that the earlier micro-batches left."""
    base = _replay(
        spark, sf, "late", tb.shipments, table="lineitem", order="l_orderkey",
        each=lambda base: late_splitter(
            "7 days", "1 day", delay="1 day", lateness="30 days", state_path=f"{base}/watermark",
            sink=lambda df, epoch: df.write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")))
    return kept(spark.read.parquet(f"{base}/out").select("seq", "l_linenumber", "l_partkey", "ts", "tag"), base)
