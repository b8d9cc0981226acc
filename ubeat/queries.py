"""Registered queries over the driver tables and their DuckDB oracles.

Every query but ``tx_pair`` has an oracle; the stream forms are in ``ubeat.stream_queries``.

Every query reads whole tables (no sampling, no id subsets) through the views
in ``ubeat.sources.tables``.  Parameters are the reference's, except where the
driver data is too sparse for them (per-user gaps of hours): those durations are
stated next to the query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ubeat.operators import ranking, sketches, windows
from ubeat.operators.fraud import click_fraud_filter as _click_fraud_filter
from ubeat.operators.fraud import passed as _passed
from ubeat.operators.late import kept_window_counts, split_late
from ubeat.operators.logins import login_fail_pair as _login_fail_pair
from ubeat.operators.logins import login_fail_timer as _login_fail_timer
from ubeat.operators.orders import order_timeout as _order_timeout
from ubeat.operators.orders import tx_match as _tx_match
from ubeat.operators.orders import tx_pair as _tx_pair
from ubeat.operators.patterns import login_fail_sequence as _login_fail_sequence
from ubeat.operators.patterns import order_pay_pattern as _order_pay_pattern
from ubeat.plans.sliding import sliding_distinct, sliding_merge
from ubeat.session import checkpointed
from ubeat.sources import tables as tb
from ubeat.sources.text import parse_access_log

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    return tb.load(spark, sf, "events")


def _views(spark: SparkSession, sf: str) -> DataFrame:
    """Page-view rows only: the operators' own ``pv`` / ``GET`` filter, stated on
    the stored column so it is pushed into the parquet scan."""
    return tb.only(_ev(spark, sf), "view")


# --- shared oracle fragments (DuckDB) ------------------------------------------

_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def _hop(source: str, keys: str, ts_us: str, size_us: int, slide_us: int, extra_cols: str = "") -> str:
    """DuckDB: rows of ``source`` expanded to every hop window they fall in."""
    r = size_us // slide_us
    return (f"SELECT {keys}{extra_cols}, make_timestamp((({ts_us}) // {slide_us} + 1 + j) * {slide_us}) AS window_end "
            f"FROM {source} CROSS JOIN range(0, {r}) t(j)")


# --- hot items (A1 + R1), SQL form (A3 + R2), counts only (A1) ----------------------

HOT_ITEMS_ORACLE = f"""
WITH pv AS (SELECT {_K} AS item_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'),
c AS (SELECT item_id, window_end, CAST(count(*) AS BIGINT) AS cnt
      FROM ({_hop('pv', 'item_id', 'us', 3_600_000_000, 300_000_000)}) GROUP BY item_id, window_end)
SELECT item_id, window_end, cnt, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM c)
WHERE row_num <= 5
"""


@register("hot_items", HOT_ITEMS_ORACLE)
def hot_items(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 viewed items per 1 h window sliding by 5 min."""
    counts = windows.item_view_counts(tb.user_behavior(_views(spark, sf)), "1 hour", "5 minutes")
    return ranking.hot_items(counts, 5)


@register("hot_items_sql", HOT_ITEMS_ORACLE)
def hot_items_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same Top-N as one SQL text over a temp view."""
    tb.user_behavior(_views(spark, sf)).createOrReplaceTempView("ubeat_user_behavior")
    return ranking.hot_items_sql(spark, "ubeat_user_behavior", "1 hour", "5 minutes", 5)


@register("item_view_counts", f"""
WITH pv AS (SELECT {_K} AS item_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view')
SELECT item_id, window_end, CAST(count(*) AS BIGINT) AS cnt
FROM ({_hop('pv', 'item_id', 'us', 3_600_000_000, 300_000_000)}) GROUP BY item_id, window_end
""")
def item_view_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Hop-window counts per item (1 h / 5 min) before ranking."""
    return windows.item_view_counts(tb.user_behavior(_views(spark, sf)), "1 hour", "5 minutes")


# --- hot pages: access log -> 10 min / 5 s counts per url -> top 3 (A4 + R1) ----------

_URL = f"'/page/' || CAST({_K} AS VARCHAR)"
_PAGE_COUNTS_ORACLE = f"""
WITH req AS (SELECT {_URL} AS url, epoch_us(ts) AS us FROM events WHERE event_type = 'view')
SELECT url, window_end, CAST(count(*) AS BIGINT) AS cnt
FROM ({_hop('req', 'url', 'us', 600_000_000, 5_000_000)}) GROUP BY url, window_end
"""


@register("page_counts", _PAGE_COUNTS_ORACLE)
def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """GET requests per url per 10 min window sliding by 5 s (change-point plan)."""
    return windows.page_counts(tb.access_log(_views(spark, sf)), "10 minutes", "5 seconds")


@register("hot_pages", f"""
WITH c AS ({_PAGE_COUNTS_ORACLE})
SELECT url, window_end, cnt, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS row_num FROM c)
WHERE row_num <= 3
""")
def hot_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Top 3 urls per 10 min window sliding by 5 s."""
    return ranking.hot_pages(page_counts(spark, sf), 3)


@register("access_log_hot_pages", f"""
WITH req AS (SELECT {_URL} AS url, epoch_us(date_trunc('second', ts)) AS us FROM events WHERE event_type = 'view'),
c AS (SELECT url, window_end, CAST(count(*) AS BIGINT) AS cnt
      FROM ({_hop('req', 'url', 'us', 600_000_000, 5_000_000)}) GROUP BY url, window_end)
SELECT url, window_end, cnt, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS row_num FROM c)
WHERE row_num <= 3
""")
def access_log_hot_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Hot pages from access-log *text*: events rendered as log lines, parsed back."""
    log = parse_access_log(tb.access_log_lines(_ev(spark, sf)))
    return ranking.hot_pages(windows.page_counts(log, "10 minutes", "5 seconds"), 3)


# --- page views and unique visitors (A7–A12) -------------------------------------------

_HOUR_END = "make_timestamp((epoch_us(ts) // 3600000000 + 1) * 3600000000)"
_PV_ORACLE = f"""
SELECT {_HOUR_END} AS window_end, CAST(count(*) AS BIGINT) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1
"""


@register("page_views", _PV_ORACLE)
def page_views(spark: SparkSession, sf: str) -> DataFrame:
    """Views per tumbling hour."""
    return windows.page_views(tb.user_behavior(_views(spark, sf)), "1 hour")


@register("page_views_two_phase", _PV_ORACLE)
def page_views_two_phase(spark: SparkSession, sf: str) -> DataFrame:
    """Views per hour via the salted two-phase total."""
    return windows.page_views_two_phase(tb.user_behavior(_views(spark, sf)), "1 hour")


@register("unique_visitors", f"""
SELECT {_HOUR_END} AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def unique_visitors(spark: SparkSession, sf: str) -> DataFrame:
    """Exact distinct viewers per tumbling hour."""
    return windows.unique_visitors(tb.user_behavior(_views(spark, sf)), "1 hour")


@register("unique_visitors_approx", f"""
SELECT {_HOUR_END} AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv, TRUE AS near
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def unique_visitors_approx(spark: SparkSession, sf: str) -> DataFrame:
    """HyperLogLog distinct viewers per hour next to the exact count: within 3 x its
    relative standard deviation (and one visitor)."""
    views = tb.user_behavior(_views(spark, sf))
    approx = windows.unique_visitors_approx(views, "1 hour", 0.01).withColumnRenamed("uv", "approx")
    both = windows.unique_visitors(views, "1 hour").join(approx, "window_end")
    return both.select("window_end", "uv",
                       (F.abs(F.col("approx") - F.col("uv")) <= F.greatest(F.lit(1.0), 0.03 * F.col("uv"))).alias("near"))


@register("click_fraud_daily", """
WITH r AS (SELECT user_id, event_type, ts, event_id AS seq, row_number() OVER (
  PARTITION BY user_id, event_type, (epoch_us(ts) + 28800000000) // 86400000000 ORDER BY event_id) AS rn FROM events)
SELECT user_id, event_type, ts, seq, CASE WHEN rn <= 2 THEN 'pass' ELSE 'warning' END AS tag
FROM r WHERE rn <= 3
""")
def click_fraud_daily(spark: SparkSession, sf: str) -> DataFrame:
    """At most 2 events per (user, event type) and local day (UTC+8), the 3rd warns."""
    out = _click_fraud_filter(tb.ad_clicks(_ev(spark, sf)), keys=("user_id", "event_type"), limit=2, reset="daily")
    return out.select("user_id", "event_type", "ts", "seq", "tag")


_OFFSET64 = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: ascii(c)), "
             "lambda a, x: (a * 61 + x) & 63, 0)")


@register("unique_visitors_bitmap", f"""
SELECT {_HOUR_END} AS window_end, CAST(count(DISTINCT {_OFFSET64}) AS BIGINT) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1
""")
def unique_visitors_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """One-hash bitmap visitors per hour; 64 bits so collisions show with few users."""
    return windows.unique_visitors_bitmap(tb.user_behavior(_views(spark, sf)), "1 hour", bits=64, seed=61)


#: One-hash offset of user_id in a bitmap of 65,536 bits.
OFFSET16 = "list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(string_split(CAST(user_id AS VARCHAR), ''), " \
           "lambda c: CAST(ord(c) AS BIGINT))), lambda h, x: (h * 61 + x) & 65535)"


@register("unique_visitors_rollup", f"""
WITH o AS (SELECT epoch_us(ts) AS us, {OFFSET16} AS o FROM events WHERE event_type = 'view'),
spans(span, size) AS (VALUES ('hour', 3600000000), ('day', 86400000000), ('week', 604800000000))
SELECT span, make_timestamp((us // size + 1) * size) AS window_end, CAST(count(DISTINCT o) AS BIGINT) AS uv
FROM o, spans GROUP BY ALL
""")
def unique_visitors_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Visitors per hour, day and week from stored hourly bitmaps (65,536 bits) by OR."""
    hourly = checkpointed(sketches.visitor_bitmaps(tb.user_behavior(_views(spark, sf)), "1 hour", bits=1 << 16))
    out = None
    for span, size in (("hour", "1 hour"), ("day", "1 day"), ("week", "7 days")):
        merged = hourly if span == "hour" else sketches.merge_bitmaps(hourly, size)
        rows = sketches.bitmap_visitors(merged).select(F.lit(span).alias("span"), "window_end", "uv")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("unique_visitors_sliding", f"""
SELECT window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv, TRUE AS near
FROM ({_hop("(SELECT user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view')", 'user_id', 'us', 3_600_000_000, 300_000_000)})
GROUP BY window_end
""")
def unique_visitors_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """A10: visitors per 1 h sliding by 5 min from 5-minute HLL sketches, next to the exact
    number: within 5 % (and one visitor)."""
    views = tb.user_behavior(_views(spark, sf))
    approx = sketches.sketch_visitors(checkpointed(sketches.visitor_sketches(views)), "1 hour", "5 minutes")
    exact = sliding_distinct(views.select("ts", "user_id"), [], "user_id", "1 hour", "5 minutes", count_col="uv")
    both = exact.select("window_end", "uv").join(approx.withColumnRenamed("uv", "approx"), "window_end")
    return both.select("window_end", "uv",
                       (F.abs(F.col("approx") - F.col("uv")) <= F.greatest(F.lit(1.0), 0.05 * F.col("uv"))).alias("near"))


@register("sliding_value_range", f"""
SELECT event_type, window_end, max(value) AS highest, min(value) AS lowest
FROM ({_hop("(SELECT event_type, epoch_us(ts) AS us, value FROM events WHERE event_type IN ('purchase', 'signup'))",
            'event_type, value', 'us', 600_000_000, 5_000_000)}) GROUP BY event_type, window_end
""")
def sliding_value_range(spark: SparkSession, sf: str) -> DataFrame:
    """Highest and lowest value per event type per 10 min sliding by 5 s, from pane partials."""
    rows = tb.only(_ev(spark, sf), "purchase", "signup").select("event_type", "ts", "value")

    def pair(highest, lowest):
        return F.struct(highest.alias("highest"), lowest.alias("lowest"))

    out = sliding_merge(
        rows, ["event_type"], "10 minutes", "5 seconds", partial=pair(F.max("value"), F.min("value")),
        parts={"highest": (F.max, F.greatest), "lowest": (F.min, F.least)})
    return out.select("event_type", "window_end", "highest", "lowest")


@register("view_gaps", f"""
SELECT {_HOUR_END} AS window_end, CAST(count(*) AS BIGINT) AS views,
       CAST(max(epoch_us(ts) - epoch_us(before)) AS BIGINT) AS longest_gap_us
FROM (SELECT ts, lag(ts) OVER (PARTITION BY {_HOUR_END} ORDER BY ts, event_id) AS before FROM events WHERE event_type = 'view')
GROUP BY 1
""")
def view_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Views and the longest pause between two of them per hour, by a whole-window
    function that reads the hour in order, batch by batch."""
    def gaps(key, frames):
        n, last, longest = 0, None, None
        for frame in frames:
            us = frame["ts"].to_numpy("datetime64[us]").astype("int64")
            steps = np.diff(us if last is None else np.concatenate([[last], us]))
            n, last = n + len(us), us[-1]
            if len(steps):
                longest = int(max(steps.max(), longest if longest is not None else 0))
        yield pd.DataFrame({"window_end": [key[0]], "views": [n], "longest_gap_us": pd.array([longest], "Int64")})

    views = tb.user_behavior(_views(spark, sf))
    return windows.window_stream(views, [], "1 hour", gaps, "window_end timestamp_ntz, views long, longest_gap_us long",
                                 order=["ts", "seq"], columns=["ts"])


@register("running_unique_visitors", f"""
WITH pv AS (SELECT {_HOUR_END} AS window_end, user_id, ts, event_id FROM events WHERE event_type = 'view'),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) AS rn
                     FROM pv) WHERE rn = 1)
SELECT window_end, user_id, ts,
       CAST(count(*) OVER (PARTITION BY window_end ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
FROM f
""")
def running_unique_visitors(spark: SparkSession, sf: str) -> DataFrame:
    """A row per first view of a user in an hour, with the running distinct count."""
    return windows.running_unique_visitors(tb.user_behavior(_views(spark, sf)), "1 hour")


# --- ad clicks: fraud filter (P1) and clicks per province (A5) -----------------------------

_CLICKS = f"""
SELECT e.user_id, {_K} AS ad_id, e.event_type, n.n_name AS province, e.ts, e.event_id AS seq
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
_FRAUD_ORACLE = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY seq) AS rn FROM ({_CLICKS}))
SELECT user_id, ad_id, event_type, province, ts, seq,
       CASE WHEN rn <= 10 THEN 'pass' ELSE 'warning' END AS tag,
       CASE WHEN rn <= 10 THEN NULL ELSE 'Click ad over 10 times today.' END AS msg
FROM r WHERE rn <= 11
"""


def _fraud(spark: SparkSession, sf: str) -> DataFrame:
    tagged = _click_fraud_filter(tb.ad_clicks(_ev(spark, sf)), keys=("user_id", "event_type"), limit=10)
    return tb.with_province(tagged, tb.load(spark, sf, "customer"), tb.load(spark, sf, "nation"))


@register("click_fraud_filter", _FRAUD_ORACLE)
def click_fraud_filter(spark: SparkSession, sf: str) -> DataFrame:
    """First 10 events per (user, event type) pass, the 11th warns, the rest vanish."""
    return _fraud(spark, sf).select("user_id", "ad_id", "event_type", "province", "ts", "seq", "tag", "msg")


@register("ad_clicks_by_province", f"""
WITH p AS (SELECT province, epoch_us(ts) AS us FROM ({_FRAUD_ORACLE}) WHERE tag = 'pass')
SELECT province, window_end, CAST(count(*) AS BIGINT) AS cnt
FROM ({_hop('p', 'province', 'us', 3_600_000_000, 5_000_000)}) GROUP BY province, window_end
""")
def ad_clicks_by_province(spark: SparkSession, sf: str) -> DataFrame:
    """Passed clicks per province per 1 h window sliding by 5 s."""
    return windows.clicks_by_province(_passed(_fraud(spark, sf)), "1 hour", "5 seconds")


# --- marketing counts per channel and behaviour (A6) ----------------------------------------

@register("market_counts", f"""
WITH m AS (
  SELECT CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'download'
                         WHEN 'purchase' THEN 'install' WHEN 'error' THEN 'uninstall' END AS behavior,
         (['appstore', 'weibo', 'wechat', 'tieba'])[{_K} % 4 + 1] AS channel, epoch_us(ts) AS us
  FROM events WHERE event_type <> 'signup'),
k AS (SELECT * FROM m WHERE behavior <> 'uninstall'),
c AS (SELECT channel, behavior, window_end, CAST(count(*) AS BIGINT) AS cnt
      FROM ({_hop('k', 'channel, behavior', 'us', 86_400_000_000, 5_000_000)}) GROUP BY ALL)
SELECT window_end - INTERVAL 1 DAY AS window_start, window_end, channel, behavior, cnt FROM c
""")
def market_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Behaviours per (channel, behaviour) per 1 day window sliding by 5 s."""
    return windows.market_counts(tb.market_behavior(tb.only(_ev(spark, sf), "view", "click", "purchase", "error")),
                                 "1 day", "5 seconds")


# --- login alarms (P3, P4, C1) --------------------------------------------------------------

_LOGINS = "SELECT user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, ts, event_id AS seq FROM events"


@register("login_fail_pair", f"""
WITH l AS (SELECT *, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts FROM ({_LOGINS})
           WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT user_id, pts AS first_fail, ts AS last_fail, 'login fail 2 times in 2 seconds' AS msg
FROM l WHERE event_type = 'fail' AND pt = 'fail' AND ts < pts + INTERVAL 2 HOUR
""")
def login_fail_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Two fails in a row (arrival order) less than 2 h apart."""
    return _login_fail_pair(tb.logins(_ev(spark, sf)), "2 hours")


@register("login_fail_sequence", f"""
WITH l AS (SELECT *, lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
                  lead(ts, 2) OVER w AS ts2 FROM ({_LOGINS})
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq))
SELECT user_id, ts AS first_fail, ts2 AS last_fail, 'login fail' AS msg
FROM l WHERE event_type = 'fail' AND t1 = 'fail' AND t2 = 'fail' AND ts2 < ts + INTERVAL 1 DAY
""")
def login_fail_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Three consecutive fails (event time) within 1 day."""
    return _login_fail_sequence(tb.logins(_ev(spark, sf)), 3, "1 day")


@register("login_fail_timer", f"""
WITH RECURSIVE l AS (
  SELECT user_id, event_type = 'fail' AS fail, ts, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS i FROM ({_LOGINS})),
walk AS (
  SELECT user_id, i, CASE WHEN fail THEN ts END AS anchor, CASE WHEN fail THEN ts END AS last, fail::INT AS n,
         NULL::TIMESTAMP AS f_out, NULL::TIMESTAMP AS l_out, 0 AS n_out FROM l WHERE i = 1
  UNION ALL
  SELECT w.user_id, l.i,
         CASE WHEN NOT l.fail THEN NULL WHEN w.anchor IS NULL OR done THEN l.ts ELSE w.anchor END,
         CASE WHEN l.fail THEN l.ts END,
         CASE WHEN NOT l.fail THEN 0 WHEN w.anchor IS NULL OR done THEN 1 ELSE w.n + 1 END,
         CASE WHEN done THEN w.anchor END, CASE WHEN done THEN w.last END, CASE WHEN done THEN w.n ELSE 0 END
  FROM (SELECT *, i + 1 AS nxt FROM walk) w JOIN l ON l.user_id = w.user_id AND l.i = w.nxt,
       LATERAL (SELECT w.anchor IS NOT NULL AND l.ts >= w.anchor + INTERVAL 6 HOUR AS done)),
ended AS (
  SELECT user_id, f_out AS first_fail, l_out AS last_fail, n_out AS n FROM walk
  UNION ALL SELECT user_id, anchor, last, n FROM walk WHERE (user_id, i) IN (SELECT user_id, max(i) FROM l GROUP BY user_id))
SELECT user_id, first_fail, last_fail, 'login fail in 2s for ' || n || ' times' AS msg FROM ended WHERE n >= 2
""")
def login_fail_timer(spark: SparkSession, sf: str) -> DataFrame:
    """At least 2 fails gathered in the 6 h after a first fail."""
    return _login_fail_timer(tb.logins(_ev(spark, sf)), 2, "6 hours")


# --- orders: pattern (C2–C4), state machine (P5), reconciliation (J1) -------------------------

@register("order_pay_pattern", """
WITH o AS (SELECT user_id AS order_id, CASE WHEN event_type = 'click' THEN 'create' ELSE 'pay' END AS event_type,
                  ts, event_id AS seq FROM events WHERE event_type IN ('click', 'purchase')),
n AS (SELECT *, min(CASE WHEN event_type = 'pay' THEN ts END) OVER (
         PARTITION BY order_id ORDER BY ts, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM o)
SELECT order_id, ts AS create_ts,
       CASE WHEN nxt < ts + INTERVAL 12 HOUR THEN nxt END AS pay_ts,
       CASE WHEN nxt < ts + INTERVAL 12 HOUR THEN 'payed' ELSE 'timeout' END AS tag,
       CASE WHEN nxt < ts + INTERVAL 12 HOUR THEN 'payed success'
            ELSE 'timeout : ' || CAST((epoch_us(ts) + 43200000000) // 1000 AS VARCHAR) END AS result
FROM n WHERE event_type = 'create'
""")
def order_pay_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """Click followed by the user's next purchase within 12 h, else a timeout."""
    return _order_pay_pattern(tb.order_events(_ev(spark, sf), per="user"), "12 hours")


@register("order_timeout", f"""
WITH o AS (SELECT user_id * 100 + {_K} AS order_id, event_type, ts, event_id FROM events
           WHERE event_type IN ('click', 'purchase')),
w AS (SELECT *, lead(event_type) OVER k AS nt, lead(ts) OVER k AS nts, lag(event_type) OVER k AS pt FROM o
      WINDOW k AS (PARTITION BY order_id ORDER BY ts, event_type, event_id)),
a AS (SELECT order_id, ts AS create_ts, CASE WHEN nt = 'purchase' THEN nts END AS pay_ts FROM w WHERE event_type = 'click'
      UNION ALL SELECT order_id, NULL, ts FROM w WHERE event_type = 'purchase' AND pt IS DISTINCT FROM 'click'),
r AS (SELECT *, CASE
        WHEN create_ts IS NULL THEN 'payed but not found create log'
        WHEN pay_ts IS NULL THEN 'order timeout'
        WHEN pay_ts < create_ts + INTERVAL 12 HOUR THEN 'payed successfully'
        ELSE 'payed but already timeout' END AS result FROM a)
SELECT order_id, create_ts, pay_ts, CASE WHEN result = 'payed successfully' THEN 'payed' ELSE 'timeout' END AS tag,
       result FROM r
""")
def order_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """The outcome of every create/pay cycle of a (user, item) order with a 12 h payment limit."""
    return _order_timeout(tb.order_events(_ev(spark, sf), per="user_item"), "12 hours")


@register("tx_match", f"""
WITH p AS (SELECT user_id * 100 + {_K} AS pay_order_id, CAST(user_id AS VARCHAR) AS tx_id, ts AS pay_ts,
                  event_id AS pay_seq FROM events WHERE event_type = 'purchase'),
r AS (SELECT CAST(user_id AS VARCHAR) AS tx_id, (['wechat', 'alipay'])[{_K} % 2 + 1] AS receipt_pay_channel,
             ts AS receipt_ts, event_id AS receipt_seq FROM events WHERE event_type = 'signup'),
m AS (SELECT p.*, r.receipt_pay_channel, r.receipt_ts, r.receipt_seq FROM p JOIN r ON p.tx_id = r.tx_id
      AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 3 HOUR AND p.pay_ts + INTERVAL 5 HOUR)
SELECT 'matched' AS tag, * FROM m
UNION ALL
SELECT 'unmatched_pay', p.*, NULL, NULL, NULL FROM p WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.tx_id = p.tx_id AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 3 HOUR AND p.pay_ts + INTERVAL 5 HOUR)
UNION ALL
SELECT 'unmatched_receipt', NULL, r.tx_id, NULL, NULL, r.receipt_pay_channel, r.receipt_ts, r.receipt_seq FROM r
WHERE NOT EXISTS (
  SELECT 1 FROM p WHERE r.tx_id = p.tx_id AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 3 HOUR AND p.pay_ts + INTERVAL 5 HOUR)
""")
def tx_match(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases vs signups of the same user, receipt within [pay - 3 h, pay + 5 h]."""
    ev = _ev(spark, sf)
    out = _tx_match(tb.pays(ev), tb.receipts(ev), "5 hours", "3 hours")
    return out.select("tag", "tx_id", "pay_order_id", "pay_ts", "pay_seq", "receipt_pay_channel",
                      "receipt_ts", "receipt_seq")


@register("tx_pair")
def tx_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases vs signups one to one, oldest waiting first; same bounds as ``tx_match``.
    No oracle: the queues are state from event to event; tested against a model."""
    ev = _ev(spark, sf)
    out = _tx_pair(tb.pays(ev), tb.receipts(ev), "5 hours", "3 hours")
    return out.select("tag", "tx_id", "pay_order_id", "pay_ts", "pay_seq", "receipt_pay_channel",
                      "receipt_ts", "receipt_seq")


# --- late rows (W4) on line items: arrival by order key, event time = ship date -------------------

_LATE_ORACLE = """
WITH s AS (SELECT l_orderkey AS seq, l_linenumber, l_partkey, l_shipdate AS ts FROM lineitem),
b AS (SELECT seq, max(epoch_us(ts)) AS mx FROM s GROUP BY seq),
w AS (SELECT seq, max(mx) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000000 AS wm
      FROM b),
x AS (SELECT s.*, w.wm, (epoch_us(s.ts) // 86400000000) * 86400000000 + 7 * 86400000000 AS e
      FROM s JOIN w USING (seq))
SELECT seq, l_linenumber, l_partkey, ts, make_timestamp(wm) AS watermark, make_timestamp(e) AS last_window_end,
       CASE WHEN wm IS NOT NULL AND e - 1 + 30 * 86400000000 <= wm THEN 'late' ELSE 'on_time' END AS tag
FROM x
"""


def _late(spark: SparkSession, sf: str) -> DataFrame:
    return split_late(tb.shipments(tb.load(spark, sf, "lineitem")), "7 days", "1 day",
                      delay="1 day", lateness="30 days")


@register("late_split", _LATE_ORACLE)
def late_split(spark: SparkSession, sf: str) -> DataFrame:
    """Line items that arrive (by order key) after their 7-day windows closed."""
    return _late(spark, sf).select("seq", "l_linenumber", "l_partkey", "ts", "watermark", "last_window_end", "tag")


@register("late_kept_counts", f"""
WITH k AS (SELECT epoch_us(ts) AS us FROM ({_LATE_ORACLE}) WHERE tag = 'on_time')
SELECT window_end, CAST(count(*) AS BIGINT) AS cnt
FROM ({_hop('k', '1', 'us', 7 * 86_400_000_000, 86_400_000_000)}) GROUP BY window_end
""")
def late_kept_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per 7-day window sliding daily, late rows removed."""
    return kept_window_counts(_late(spark, sf), "7 days", "1 day")


# --- report text (R5) ----------------------------------------------------------------------------

@register("hot_items_report", f"""
WITH h AS ({HOT_ITEMS_ORACLE})
SELECT window_end,
       '窗口结束时间：' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) ||
       string_agg('NO' || row_num || ': ' || chr(9) || '商品ID=' || item_id || chr(9) || '热门度=' || cnt || chr(10),
                  '' ORDER BY row_num) || '=============================' || chr(10) || chr(10) AS report
FROM h GROUP BY window_end
""")
def hot_items_report(spark: SparkSession, sf: str) -> DataFrame:
    """One text block per window with its top 5 items."""
    return ranking.format_report(hot_items(spark, sf), "item_id", ranking.ITEM_LABEL)


from ubeat import stream_queries, text_queries  # noqa: E402, F401  (they register theirs)
