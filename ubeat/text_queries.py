"""Registered queries that go through the text formats (I1–I5) and tagged output.

The events are written as the reference's comma lines, over several files in
arrival order, and read back by the readers; times become whole seconds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ubeat.operators import ranking, windows
from ubeat.operators.fraud import click_fraud_filter
from ubeat.operators.logins import login_fail_pair
from ubeat.operators.orders import tx_match
from ubeat.queries import _K, _LOGINS, HOT_ITEMS_ORACLE, register
from ubeat.session import ensure_checkpoint_dir, kept, keyed_state
from ubeat.sources import sinks, text
from ubeat.sources import tables as tb
from ubeat.streaming.stateful import stream_login_fail_pair

FILES = 4


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ubeat-{name}-{uuid.uuid4().hex}"


def _seconds(ts: str = "ts") -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp")).cast("string")


def _written(spark: SparkSession, name: str, rows: DataFrame, *fields: Column) -> str:
    """Comma lines of ``rows`` in order of ``seq`` over files in order of their names."""
    return _lines(rows, _folder(spark, name), *fields)


def _lines(rows: DataFrame, path: str, *fields: Column) -> str:
    lines = rows.select(F.concat_ws(",", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]).alias("value"), "seq")
    lines.repartitionByRange(FILES, "seq").sortWithinPartitions("seq").select("value").write.text(path)
    return path


@register("text_hot_items", HOT_ITEMS_ORACLE)
def text_hot_items(spark: SparkSession, sf: str) -> DataFrame:
    """Behaviour lines to the hot items."""
    rows = tb.user_behavior(tb.only(tb.load(spark, sf, "events"), "view"))
    path = _written(spark, "behavior", rows, F.col("user_id"), F.col("item_id"), F.col("category"), F.col("behavior"), _seconds())
    return kept(ranking.hot_items(windows.item_view_counts(text.read_user_behavior(spark, path)), 5), path)


@register("text_click_fraud", f"""
WITH r AS (SELECT user_id, {_K} AS ad_id, date_trunc('second', ts) AS ts,
                  row_number() OVER (PARTITION BY user_id, {_K} ORDER BY event_id) AS rn FROM events)
SELECT user_id, ad_id, ts, CASE WHEN rn <= 1 THEN 'pass' ELSE 'warning' END AS tag FROM r WHERE rn <= 2
""")
def text_click_fraud(spark: SparkSession, sf: str) -> DataFrame:
    """Click lines through the fraud filter, both outputs written by tag and read back."""
    rows = tb.with_province(tb.ad_clicks(tb.load(spark, sf, "events")), tb.load(spark, sf, "customer"),
                            tb.load(spark, sf, "nation"))
    path = _written(spark, "clicks", rows, F.col("user_id"), F.col("ad_id"), F.col("province"), F.col("city"), _seconds())
    out = _folder(spark, "tagged")
    sinks.write_tagged(click_fraud_filter(text.read_ad_clicks(spark, path), limit=1), out)
    return kept(spark.read.parquet(out).select("user_id", "ad_id", "ts", "tag"), path, out)


_SECOND_LOGINS = _LOGINS.replace(", ts,", ", date_trunc('second', ts) AS ts,")


@register("text_login_fail_pair", f"""
WITH l AS (SELECT *, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts FROM ({_SECOND_LOGINS})
           WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT user_id, pts AS first_fail, ts AS last_fail, 'login fail 2 times in 2 seconds' AS msg
FROM l WHERE event_type = 'fail' AND pt = 'fail' AND ts < pts + INTERVAL 2 HOUR
""")
def text_login_fail_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Login lines over several files; the pairs depend on their arrival order."""
    rows = tb.logins(tb.load(spark, sf, "events"))
    path = _written(spark, "logins", rows, F.col("user_id"), F.col("ip"), F.col("event_type"), _seconds())
    return kept(login_fail_pair(text.read_logins(spark, path), "2 hours"), path)


@register("stream_text_login_fail", f"""
WITH l AS (SELECT *, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts FROM ({_SECOND_LOGINS})
           WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT user_id, pts AS first_fail, ts AS last_fail, 'login fail 2 times in 2 seconds' AS msg
FROM l WHERE event_type = 'fail' AND pt = 'fail' AND ts < pts + INTERVAL 2 HOUR
""")
def stream_text_login_fail(spark: SparkSession, sf: str) -> DataFrame:
    """I3 to P4 as one stream: login lines in two deliveries, parsed and numbered in file and
    line order, keyed state that the second start takes up again, alarms."""
    rows = tb.logins(tb.load(spark, sf, "events"))
    half = rows.agg(F.expr("floor((min(seq) + max(seq)) / 2)")).first()[0] or 0
    base = _folder(spark, "login-alarms")
    for i, part in enumerate((rows.where(F.col("seq") <= half), rows.where(F.col("seq") > half))):
        _lines(part, f"{base}/in/{i}", F.col("user_id"), F.col("ip"), F.col("event_type"), _seconds())
        logins = text.parse_lines(text.read_lines(spark, f"{base}/in/*", stream=True), text.LOGIN)
        alarms = stream_login_fail_pair(logins, "2 hours", seq=["file", "seq"])
        writer = alarms.writeStream.format("parquet").option("path", f"{base}/out") \
            .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        with keyed_state(spark):
            query = writer.start()
            query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    out = spark.read.parquet(f"{base}/out")
    return kept(out.withColumns({t: F.col(t).cast("timestamp_ntz") for t in ("first_fail", "last_fail")}), base)


@register("text_tx_match", f"""
WITH p AS (SELECT user_id * 100 + {_K} AS pay_order_id, CAST(user_id AS VARCHAR) AS tx_id, date_trunc('second', ts) AS pay_ts
           FROM events WHERE event_type = 'purchase'),
r AS (SELECT CAST(user_id AS VARCHAR) AS tx_id, (['wechat', 'alipay'])[{_K} % 2 + 1] AS receipt_pay_channel,
             date_trunc('second', ts) AS receipt_ts FROM events WHERE event_type = 'signup'),
m AS (SELECT p.*, r.receipt_pay_channel, r.receipt_ts FROM p LEFT JOIN r ON p.tx_id = r.tx_id
      AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 3 HOUR AND p.pay_ts + INTERVAL 5 HOUR)
SELECT CASE WHEN receipt_ts IS NULL THEN 'unmatched_pay' ELSE 'matched' END AS tag, * FROM m
UNION ALL
SELECT 'unmatched_receipt', NULL, r.tx_id, NULL, r.receipt_pay_channel, r.receipt_ts FROM r
WHERE NOT EXISTS (
  SELECT 1 FROM p WHERE r.tx_id = p.tx_id AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 3 HOUR AND p.pay_ts + INTERVAL 5 HOUR)
""")
def text_tx_match(spark: SparkSession, sf: str) -> DataFrame:
    """Order and receipt lines reconciled."""
    ev = tb.load(spark, sf, "events")
    pays = tb.pays(ev)
    orders = _written(spark, "orders", pays, F.col("order_id"), F.lit("pay"), F.col("tx_id"), _seconds())
    receipts = _written(spark, "receipts", tb.receipts(ev), F.col("tx_id"), F.col("pay_channel"), _seconds())
    pays = text.read_orders(spark, orders).select("order_id", "tx_id", "ts", "seq")
    out = tx_match(pays, text.read_receipts(spark, receipts), "5 hours", "3 hours")
    return kept(out.select("tag", "tx_id", "pay_order_id", "pay_ts", "receipt_pay_channel", "receipt_ts"), orders, receipts)
