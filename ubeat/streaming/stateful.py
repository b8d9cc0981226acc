"""Keyed stateful operators on streams (P1–P5, C1–C4 stream forms; J1 stream join).

The processors themselves are in ``ubeat.streaming.processors``: ``transformWithState``
operators with value, list and map states and event-time timers (W6–W8, U4). Here
their inputs are cut to the columns they need (times as epoch microseconds) and their
outputs get the batch operators' columns. Rows of a micro-batch are taken in arrival
order (``seq``) or, behind the watermark, in event-time order. Outputs are append-only.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ubeat.functions.time import duration_us, interval_str
from ubeat.operators.fraud import WARNING_TEXT, local_day
from ubeat.operators.logins import PAIR_TEXT, TIMER_TEXT_HEAD, TIMER_TEXT_TAIL
from ubeat.operators.orders import ORDER_TIMEOUT, PAY_NO_CREATE, PAYED_OK
from ubeat.operators.patterns import LOGIN_FAIL_TEXT, PAYED_TEXT, TIMEOUT_PREFIX
from ubeat.streaming import processors as P
from ubeat.streaming.sources import event_time


def _order(seq: str | Sequence[str]) -> list[str]:
    """The columns that give the arrival order inside a micro-batch."""
    return [seq] if isinstance(seq, str) else list(seq)


def _watermarked(df: DataFrame, ts: str, delay) -> DataFrame:
    return event_time(df, ts).withWatermark(ts, interval_str(duration_us(delay)))


def _schema(df: DataFrame, key: str, name: str, rest: str) -> T.StructType:
    """``name`` with the type of the input's key, then the columns of the DDL ``rest``."""
    return T.StructType([T.StructField(name, df.schema[key].dataType), *T.StructType.fromDDL(rest).fields])


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the hash bucket of its keys, whose keys share a processor's calls."""
    return df.withColumn("__bucket", F.pmod(F.hash(*keys), F.lit(P.BUCKETS)))


def _times(df: DataFrame, **columns: str) -> DataFrame:
    """Microsecond columns as timestamps under new names (``new=old``)."""
    return df.withColumns({new: F.timestamp_micros(F.col(old)) for new, old in columns.items()}).drop(*columns.values())


def stream_click_fraud_filter(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), limit: int = 100, *,
                              seq: str | Sequence[str] = "seq", ts: str = "ts", reset: str | None = None,
                              tz: str = "+08:00", delay="0 seconds") -> DataFrame:
    """P1/P2 on a stream: number of rows passed and a warned flag per key; -> input columns + tag + msg.

    ``reset='daily'`` keys the state by local day as well and drops it with an
    event-time timer at the end of that day, so state does not grow with time.
    A micro-batch costs a key at most ``limit + 1`` rows of memory.
    """
    if reset not in (None, "daily"):
        raise ValueError("reset must be None or 'daily'")
    out_schema = T.StructType(df.schema.fields + [T.StructField("tag", T.StringType()), T.StructField("msg", T.StringType())])
    text = WARNING_TEXT.format(limit=limit)
    key_fields = [df.schema[k] for k in keys]
    if reset is None:
        return bucketed(df, *keys).groupBy("__bucket").transformWithState(
            P.FraudFilter(df.columns, key_fields, _order(seq), limit, text), out_schema, "Append", "None")
    src = _watermarked(df, ts, delay)
    src = src.withColumn("__day", local_day(ts, src.schema[ts].dataType, tz))
    out_schema = T.StructType([T.StructField(f.name, src.schema[f.name].dataType) if f.name == ts else f for f in out_schema])
    key_fields = [src.schema[k] for k in keys]
    out = bucketed(src, *keys).groupBy("__bucket", "__day").transformWithState(
        P.FraudFilter(df.columns, key_fields, _order(seq), limit, text, _day_end_ms(tz)), out_schema, "Append", "EventTime")
    return out


def _day_end_ms(tz: str):
    """Epoch ms of the local midnight ending a given date in zone ``tz``."""
    if tz[:1] in "+-":
        sign = 1 if tz[0] == "+" else -1
        hh, mm = (tz[1:].split(":") + ["0"])[:2]
        zone = dt.timezone(sign * dt.timedelta(hours=int(hh), minutes=int(mm)))
    else:
        zone = zoneinfo.ZoneInfo(tz)

    def end(day) -> int:
        nxt = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), tzinfo=zone)
        return int(nxt.timestamp() * 1000)
    return end


def _logins(logins: DataFrame, key: str, ts: str, seq: str | Sequence[str]) -> DataFrame:
    return logins.select(F.col(key).alias("user_id"), ts, *_order(seq), F.unix_micros(ts).alias("us"),
                         (F.col("event_type") == "fail").alias("fail"))


_ALARM = "first_us LONG, last_us LONG, msg STRING"


def _alarms(df: DataFrame) -> DataFrame:
    return _times(df, first_fail="first_us", last_fail="last_us").select("user_id", "first_fail", "last_fail", "msg")


def stream_login_fail_pair(logins: DataFrame, within="2 seconds", *, key: str = "user_id", ts: str = "ts",
                           seq: str | Sequence[str] = "seq") -> DataFrame:
    """P4 on a stream: state = time of the user's last fail (cleared by a success)."""
    src = _logins(event_time(logins, ts), key, ts, seq)
    return _alarms(bucketed(src, "user_id").groupBy("__bucket").transformWithState(
        P.LoginFailPair(logins.schema[key].dataType, duration_us(within), _order(seq), PAIR_TEXT), _schema(logins, key, "user_id", _ALARM), "Append", "None"))


def stream_login_fail_timer(logins: DataFrame, n: int = 2, wait="5 seconds", *, key: str = "user_id",
                            ts: str = "ts", seq: str | Sequence[str] = "seq", delay="3 seconds") -> DataFrame:
    """P3 on a stream: the open span per user and a timer at anchor + wait.

    The timer fires once the watermark (max event time - ``delay``) passes it, then
    the span alarms if it holds ``n`` fails; a success or a later fail deletes it.
    Rows of one batch are applied in arrival order with the batch rule.
    """
    src = _logins(_watermarked(logins, ts, delay), key, ts, seq)
    return _alarms(bucketed(src, "user_id").groupBy("__bucket").transformWithState(
        P.LoginFailTimer(logins.schema[key].dataType, n, duration_us(wait), _order(seq), TIMER_TEXT_HEAD, TIMER_TEXT_TAIL),
        _schema(logins, key, "user_id", _ALARM), "Append", "EventTime"))


def stream_order_timeout(orders: DataFrame, within="15 minutes", *, key: str = "order_id", ts: str = "ts",
                         seq: str = "seq", delay="0 seconds") -> DataFrame:
    """P5 on a stream: every create / pay cycle, equal to the batch operator with
    ``timers`` however the input is cut into micro-batches.

    Events wait in the state until the watermark passes them and are then taken
    in the batch operator's order; an open create ends with its pay, with the
    next create or when its time is up.
    -> order_id, create_ts, pay_ts, tag, result
    """
    src = (_watermarked(orders, ts, delay).where(F.col("event_type").isin("create", "pay"))
           .select(F.col(key).alias("order_id"), ts, F.unix_micros(ts).alias("us"),
                   (F.col("event_type") == "pay").alias("pay"), F.col(seq).cast("long").alias("seq")))
    out = bucketed(src, "order_id").groupBy("__bucket").transformWithState(
        P.OrderTimeout(orders.schema[key].dataType, duration_us(within), PAYED_OK, PAY_NO_CREATE, ORDER_TIMEOUT),
        _schema(orders, key, "order_id", "create_us LONG, pay_us LONG, result STRING"), "Append", "EventTime")
    tag = F.when(F.col("result") == PAYED_OK, F.lit("payed")).otherwise(F.lit("timeout"))
    return _times(out.withColumn("tag", tag), create_ts="create_us", pay_ts="pay_us").select(
        "order_id", "create_ts", "pay_ts", "tag", "result")


def stream_tx_match(pays: DataFrame, receipts: DataFrame, pay_wait="5 seconds", receipt_wait="3 seconds", *,
                    key: str = "tx_id", ts: str = "ts", delay="0 seconds") -> DataFrame:
    """J1 on streams: full outer stream-stream join with the time band.

    Both sides are watermarked, so unmatched rows are emitted (with null on the
    other side) once the watermark passes the band, and join state is evicted.
    -> tag, key, pay_* and receipt_* columns, like the batch operator.
    """
    d = interval_str(duration_us(delay))
    p = event_time(pays, ts)
    r = event_time(receipts, ts)
    p = p.select(*[F.col(c).alias(c if c == key else f"pay_{c}") for c in p.columns]) \
        .withWatermark(f"pay_{ts}", d)
    r = r.select(*[F.col(c).alias(f"r_{key}" if c == key else f"receipt_{c}") for c in r.columns]) \
        .withWatermark(f"receipt_{ts}", d)
    pw, rw = interval_str(duration_us(pay_wait)), interval_str(duration_us(receipt_wait))
    cond = F.expr(f"{key} = r_{key} AND receipt_{ts} >= pay_{ts} - INTERVAL {rw} "
                  f"AND receipt_{ts} <= pay_{ts} + INTERVAL {pw}")
    j = p.join(r, cond, "full_outer")
    tag = (F.when(F.col(f"pay_{ts}").isNotNull() & F.col(f"receipt_{ts}").isNotNull(), F.lit("matched"))
           .when(F.col(f"pay_{ts}").isNotNull(), F.lit("unmatched_pay")).otherwise(F.lit("unmatched_receipt")))
    pcols = [c for c in p.columns if c.startswith("pay_")]
    rcols = [c for c in r.columns if c.startswith("receipt_")]
    return j.select(tag.alias("tag"), F.coalesce(F.col(key), F.col(f"r_{key}")).alias(key), *pcols, *rcols)


def stream_login_fail_sequence(logins: DataFrame, times: int = 3, within="5 seconds", *, key: str = "user_id",
                               ts: str = "ts", seq: str = "seq", delay="3 seconds") -> DataFrame:
    """C1 on a stream: ``times`` consecutive fails (event-time order) within ``within``.

    Rows wait in the state until the watermark passes them (then no earlier row
    can still arrive), are matched in (ts, seq) order, and only the last
    ``times - 1`` final rows are kept, as long as a run can go on from them.
    -> user_id, first_fail, last_fail, msg
    """
    src = _logins(_watermarked(logins, ts, delay).withColumn(seq, F.col(seq).cast("long")), key, ts, seq)
    src = src.withColumnRenamed(seq, "seq")
    return _alarms(bucketed(src, "user_id").groupBy("__bucket").transformWithState(
        P.FailSequence(logins.schema[key].dataType, times, duration_us(within), LOGIN_FAIL_TEXT), _schema(logins, key, "user_id", _ALARM), "Append", "EventTime"))


def stream_order_pay_pattern(orders: DataFrame, within="15 minutes", *, key: str = "order_id", ts: str = "ts",
                             seq: str = "seq", delay="0 seconds") -> DataFrame:
    """C2–C4 on a stream: each create with the key's next pay (event-time order).

    Final rows (behind the watermark) are matched in (ts, seq) order: a pay
    completes every pending create (matched if less than ``within`` later,
    else a timeout); a create still pending when the watermark passes
    create + ``within`` times out.  -> order_id, create_ts, pay_ts, tag, result
    """
    within_us = duration_us(within)
    src = (_watermarked(orders, ts, delay)
           .select(F.col(key).alias("order_id"), ts, F.unix_micros(ts).alias("us"), F.col(seq).cast("long").alias("seq"),
                   (F.col("event_type") == "create").alias("create"), (F.col("event_type") == "pay").alias("pay")))
    out = bucketed(src, "order_id").groupBy("__bucket").transformWithState(
        P.FollowedBy(orders.schema[key].dataType, within_us), _schema(orders, key, "order_id", "create_us LONG, pay_us LONG"), "Append", "EventTime")
    paid = F.col("pay_us").isNotNull()
    late = F.concat(F.lit(TIMEOUT_PREFIX), F.floor((F.col("create_us") + F.lit(within_us)) / 1000).cast("string"))
    out = out.withColumns({"tag": F.when(paid, "payed").otherwise("timeout"), "result": F.when(paid, PAYED_TEXT).otherwise(late)})
    return _times(out, create_ts="create_us", pay_ts="pay_us").select("order_id", "create_ts", "pay_ts", "tag", "result")
