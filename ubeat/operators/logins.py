"""Login-failure alarms in arrival order.

Both rules read a user's events in arrival order (``seq``), as the reference's
keyed process functions do; ``ubeat.operators.patterns.login_fail_sequence`` is
the event-time variant (C1).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ubeat.functions.time import duration_us, from_micros, to_micros
from ubeat.plans.scan import blocked_running, blocked_running_many, previous_row, row_blocks

# The reference's alarm texts.
PAIR_TEXT = "login fail 2 times in 2 seconds"
TIMER_TEXT_HEAD = "login fail in 2s for "
TIMER_TEXT_TAIL = " times"


def login_fail_pair(logins: DataFrame, within="2 seconds", *, key: str = "user_id", ts: str = "ts",
                    seq: str = "seq", blocks: int | None = None) -> DataFrame:
    """A fail whose previous event (arrival order) is a fail less than ``within`` earlier.

    A success in between clears the state, a newer fail replaces it — so the
    rule only looks at the immediately preceding event of the user.  The time
    test also holds for negative gaps, as in the reference.
    -> user_id, first_fail, last_fail, msg
    """
    dtype = logins.schema[ts].dataType
    within_us = duration_us(within)
    x = row_blocks(logins.select(key, ts, seq, "event_type", to_micros(ts, dtype).alias("__us")),
                   [key], [seq], "__blk", blocks)
    x = previous_row(x, [key], [seq], ["event_type", ts, "__us"], "__blk", prefix="__prev_")
    hit = ((F.col("event_type") == "fail") & (F.col("__prev_event_type") == "fail")
           & (F.col("__us") < F.col("__prev___us") + F.lit(within_us)))
    return x.where(hit).select(F.col(key).alias("user_id"), F.col(f"__prev_{ts}").alias("first_fail"),
                               F.col(ts).alias("last_fail"), F.lit(PAIR_TEXT).alias("msg"))


def login_fail_timer(logins: DataFrame, n: int = 2, wait="5 seconds", *, key: str = "user_id",
                     ts: str = "ts", seq: str = "seq", blocks: int | None = None) -> DataFrame:
    """Alarm when at least ``n`` fails gather in the ``wait`` after a first fail.

    Table rule, per user in arrival order: the first fail after a success (or
    after a closed alarm span) anchors a span at its time ``a``; later fails with
    time ``< a + wait`` join it; a fail at or after ``a + wait`` closes the span
    and anchors the next.  A success with time ``< a + wait`` cancels the open
    span; one at or after ``a + wait`` arrives after the timer fired, so the span
    is judged first.  A closed span with at least ``n`` fails gives
    (user_id, first_fail, last_fail, msg) with first/last in arrival order.

    Plan: islands between successes (a running count of successes) cut further
    where a fail comes ``wait`` after every earlier fail of the user — such a
    fail anchors a new span whatever happened before, so the pieces
    (sub-islands) are independent.  Both running values are blocked scans, so
    a hot user is not ordered in one task.  Only a sub-island is sequential;
    those holding at least ``n`` fails — the only ones that can alarm — are
    walked in arrival order by one pandas pass per partition; all others never
    leave the JVM.  Inside a sub-island every anchor is at or after all earlier
    fails, so the next anchor is found by a binary search in the running maximum:
    a batch costs one step per span, and four numbers are carried between batches.
    """
    dtype = logins.schema[ts].dataType
    wait_us = duration_us(wait)
    x = logins.select(F.col(key).alias("__key"), F.col(seq).alias("__seq"),
                      (F.col("event_type") == "fail").alias("__fail"),
                      to_micros(ts, dtype).alias("__us"))
    x = row_blocks(x, ["__key"], ["__seq"], "__blk", blocks)
    x = (x.withColumn("__succ", F.when(F.col("__fail"), 0).otherwise(1))
         .withColumn("__fus", F.when(F.col("__fail"), F.col("__us"))))
    # One scan: island = successes strictly before the row (a success closes
    # its island); __mx = the user's maximum fail time before the row.
    x = blocked_running_many(x, ["__key"], ["__seq"], "__blk",
                             [("__succ", "sum", "__island", False), ("__fus", "max", "__mx", False)])
    x = x.withColumn("__island", F.coalesce(F.col("__island"), F.lit(0)))
    # A fail at least ``wait`` after every earlier fail must anchor a new span
    # whatever came before, so it cuts the island: sub-islands are independent.
    brk = F.col("__fail") & F.col("__mx").isNotNull() & (F.col("__us") >= F.col("__mx") + F.lit(wait_us))
    x = x.withColumn("__brk", F.when(brk, 1).otherwise(0))
    x = blocked_running(x, ["__key"], ["__seq"], "__brk", "__blk", "__sub", how="sum")

    schema = T.StructType([
        T.StructField("__key", logins.schema[key].dataType),
        T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType()),
        T.StructField("fails", T.LongType()),
    ])

    def scan(batches):
        # Rows arrive sorted by (key, island, sub-island, seq); a span is
        # (anchor, first, last, fails) and may go on in the next batch.
        cur, span, out = None, None, []

        def close():
            if span is not None and span[3] >= n:
                out.append((cur[0], *span[1:]))

        for pdf in batches:
            keys = list(zip(pdf["__key"], pdf["__island"], pdf["__sub"], strict=True))
            fail, us = pdf["__fail"].to_numpy(bool), pdf["__us"].to_numpy(np.int64)
            edges = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if keys[i] != cur:
                    close()
                    cur, span = keys[i], None
                times = us[i:j][fail[i:j]]
                top, at = np.maximum.accumulate(times), 0
                while at < len(times):
                    if span is None:
                        span = (times[at], times[at], times[at], 1)
                        at += 1
                    end = int(np.searchsorted(top, span[0] + wait_us))
                    if end > at:
                        span = (span[0], span[1], times[end - 1], span[3] + end - at)
                        at = end
                    if at < len(times):
                        close()
                        span = None
                if not fail[j - 1]:  # a success ends its island
                    if span is not None and us[j - 1] >= span[0] + wait_us:
                        close()
                    span = None
            yield pd.DataFrame(out, columns=["__key", "first_us", "last_us", "fails"])
            out.clear()
        close()
        yield pd.DataFrame(out, columns=["__key", "first_us", "last_us", "fails"])

    # One shuffle on (user, island): islands with fewer than n fails cannot
    # alarm and are dropped in the JVM; the rest are walked in order, one
    # Python pass per partition (no per-island call overhead).
    g = ["__key", "__island", "__sub"]
    nf = F.sum(F.col("__fail").cast("int")).over(Window.partitionBy(*g))
    alarms = (x.select(*g, "__seq", "__fail", "__us").withColumn("__nf", nf).where(F.col("__nf") >= n)
              .sortWithinPartitions(*g, "__seq").drop("__nf")
              .mapInPandas(scan, schema))
    return alarms.select(
        F.col("__key").alias("user_id"), from_micros(F.col("first_us"), dtype).alias("first_fail"),
        from_micros(F.col("last_us"), dtype).alias("last_fail"),
        F.concat(F.lit(TIMER_TEXT_HEAD), F.col("fails").cast("string"), F.lit(TIMER_TEXT_TAIL)).alias("msg"))
