"""Sequence patterns over keyed events, in event-time order.

Order inside a key is (ts, seq).  Look-ahead is a two-level scan over blocks of
a bounded number of rows (``plans.scan.row_blocks``, ``next_rows``,
``next_match``): inside a (key, block) partition ``lead`` or a descending scan,
across blocks a carry from the following blocks' first rows.  One key holding a
third of all rows is cut into blocks however close its rows are in time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ubeat.functions.time import duration_us, to_micros
from ubeat.plans.scan import next_match, next_rows, row_blocks

# The reference's pattern result texts.
LOGIN_FAIL_TEXT = "login fail"
PAYED_TEXT = "payed success"
TIMEOUT_PREFIX = "timeout : "


def strict_sequence(df: DataFrame, key: str, conds: Sequence[Column], within, *, ts: str = "ts",
                    seq: str = "seq", blocks: int | None = None) -> DataFrame:
    """Every run of ``len(conds)`` *consecutive* events of a key where event i
    meets ``conds[i]`` and the last is less than ``within`` after the first.

    Overlapping runs are all reported.  Returns the input columns of the first
    event plus ``last_ts`` (time of the last event of the run).
    """
    k = len(conds)
    within_us = duration_us(within)
    x = df.withColumn("__us", to_micros(ts, df.schema[ts].dataType))
    for i, c in enumerate(conds):
        x = x.withColumn(f"__c{i}", F.coalesce(c, F.lit(False)))
    x = row_blocks(x, [key], ["__us", seq], "__b", blocks)
    nf = ["__us", ts] + [f"__c{i}" for i in range(1, k)]
    x = next_rows(x, [key], ["__us", seq], nf, k - 1, "__b", prefix="__n") if k > 1 else x
    hit = F.col("__c0")
    for j in range(1, k):
        hit = hit & F.coalesce(F.col(f"__n{j}___c{j}"), F.lit(False))
    last_us = F.col(f"__n{k - 1}___us") if k > 1 else F.col("__us")
    last_ts = F.col(f"__n{k - 1}_{ts}") if k > 1 else F.col(ts)
    hit = hit & (last_us - F.col("__us") < F.lit(within_us))
    out = x.where(hit).withColumn("last_ts", last_ts)
    return out.select(*df.columns, "last_ts")


def login_fail_sequence(logins: DataFrame, times: int = 3, within="5 seconds", *, key: str = "user_id",
                        ts: str = "ts", seq: str = "seq") -> DataFrame:
    """C1 + C3: ``times`` consecutive fails within ``within`` -> user_id, first_fail, last_fail, msg."""
    conds = [F.col("event_type") == "fail"] * times
    m = strict_sequence(logins, key, conds, within, ts=ts, seq=seq)
    return m.select(F.col(key).alias("user_id"), F.col(ts).alias("first_fail"),
                    F.col("last_ts").alias("last_fail"), F.lit(LOGIN_FAIL_TEXT).alias("msg"))


def followed_by(df: DataFrame, key: str, first: Column, then: Column, within, *, ts: str = "ts",
                seq: str = "seq", blocks: int | None = None) -> DataFrame:
    """C2 + C4: each ``first`` event with the next ``then`` event of its key.

    Other events in between are skipped (relaxed contiguity).  Returns the
    ``first`` rows plus ``then_ts`` (null unless matched) and ``matched`` (the
    next ``then`` came less than ``within`` later).
    """
    within_us = duration_us(within)
    x = (df.withColumn("__us", to_micros(ts, df.schema[ts].dataType))
         .withColumn("__is_first", F.coalesce(first, F.lit(False)))
         .withColumn("__is_then", F.coalesce(then, F.lit(False))))
    x = row_blocks(x, [key], ["__us", seq], "__b", blocks)
    x = next_match(x, [key], ["__us", seq], F.col("__is_then"), ["__us", ts], "__b", prefix="__nx")
    x = x.where(F.col("__is_first"))
    matched = F.col("__nx__us").isNotNull() & (F.col("__nx__us") - F.col("__us") < F.lit(within_us))
    return (x.withColumn("matched", matched)
            .withColumn("then_ts", F.when(F.col("matched"), F.col(f"__nx{ts}")))
            .select(*df.columns, "then_ts", "matched"))


def order_pay_pattern(orders: DataFrame, within="15 minutes", *, key: str = "order_id", ts: str = "ts",
                      seq: str = "seq") -> DataFrame:
    """Create followed by pay within ``within``.

    -> order_id, create_ts, pay_ts, tag ('payed' | 'timeout'), result.
    A timeout reports ``timeout : <create + within, epoch ms>``.
    """
    within_us = duration_us(within)
    m = followed_by(orders, key, F.col("event_type") == "create", F.col("event_type") == "pay", within,
                    ts=ts, seq=seq)
    dtype = orders.schema[ts].dataType
    timeout_ms = F.call_function("div", to_micros(ts, dtype) + F.lit(within_us), F.lit(1000))
    return m.select(
        F.col(key).alias("order_id"), F.col(ts).alias("create_ts"), F.col("then_ts").alias("pay_ts"),
        F.when(F.col("matched"), F.lit("payed")).otherwise(F.lit("timeout")).alias("tag"),
        F.when(F.col("matched"), F.lit(PAYED_TEXT))
        .otherwise(F.concat(F.lit(TIMEOUT_PREFIX), timeout_ms.cast("string"))).alias("result"))
