"""Order payment checks: timeout state machine (P5) and pay/receipt matching."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ubeat.functions.time import duration_us, floor_div, to_micros
from ubeat.plans.scan import blocked_running, next_rows, previous_row, row_blocks

# The reference's four outcomes of the order state machine.
PAYED_OK = "payed successfully"
PAYED_LATE = "payed but already timeout"
PAY_NO_CREATE = "payed but not found create log"
ORDER_TIMEOUT = "order timeout"


def order_timeout(orders: DataFrame, within="15 minutes", *, key: str = "order_id", ts: str = "ts",
                  seq: str = "seq", timers: bool = False, blocks: int | None = None) -> DataFrame:
    """P5: one outcome per create / pay cycle of every order.

    An order's events are taken in event time (a create before a pay of the same
    instant, then ``seq``).  The state before an event is decided by the event
    before it alone, because every pay ends its cycle and a new create replaces
    the open one, whose own timer still runs out:

    create, next event a pay less than ``within`` later -> 'payed successfully' (tag payed);
    create, next event a pay later than that            -> 'payed but already timeout';
    create, next event a create, or none                -> 'order timeout';
    pay, previous event a pay, or none                  -> 'payed but not found create log'
    (the last three have tag timeout).  So every create and every pay is in
    exactly one outcome.  With ``timers`` an open create ends when its time is up,
    as a timer does on a stream: it gives 'order timeout', and a pay that comes
    then is one without a create.
    -> order_id, create_ts, pay_ts, tag, result

    Plan: next and previous event by blocked scans, no per-order list or sort
    of a whole order.
    """
    within_us = duration_us(within)
    x = orders.where(F.col("event_type").isin("create", "pay")).select(
        F.col(key).alias("order_id"), F.col(ts).alias("ts"), F.col(seq).alias("seq"),
        to_micros(ts, orders.schema[ts].dataType).alias("__us"), (F.col("event_type") == "pay").alias("__pay"))
    order = ["__us", "__pay", "seq"]
    x = row_blocks(x, ["order_id"], order, "__blk", blocks)
    x = next_rows(x, ["order_id"], order, ["__pay", "__us", "ts"], 1, "__blk", prefix="__n")
    x = previous_row(x, ["order_id"], order, ["__pay", "__us"], "__blk", prefix="__p_")
    paid = ~F.col("__pay") & F.coalesce(F.col("__n1___pay"), F.lit(False))
    in_time = F.col("__n1___us") - F.col("__us") < F.lit(within_us)
    alone = F.coalesce(F.col("__p___pay"), F.lit(True))
    if timers:
        paid = paid & in_time
        alone = alone | (F.col("__us") - F.col("__p___us") >= F.lit(within_us))
    result = (F.when(F.col("__pay"), F.lit(PAY_NO_CREATE)).when(paid & in_time, F.lit(PAYED_OK))
              .when(paid, F.lit(PAYED_LATE)).otherwise(F.lit(ORDER_TIMEOUT)))
    x = x.where(~F.col("__pay") | alone).withColumn("result", result)
    return x.select("order_id", F.when(~F.col("__pay"), F.col("ts")).alias("create_ts"),
                    F.when(F.col("__pay"), F.col("ts")).when(paid, F.col("__n1_ts")).alias("pay_ts"),
                    F.when(F.col("result") == PAYED_OK, F.lit("payed")).otherwise(F.lit("timeout")).alias("tag"),
                    "result")


def tx_match(pays: DataFrame, receipts: DataFrame, pay_wait="5 seconds", receipt_wait="3 seconds", *,
             key: str = "tx_id", ts: str = "ts", bucket=None) -> DataFrame:
    """Match pays and receipts of the same key whose times are close.

    A pay waits ``pay_wait`` for its receipt and a receipt ``receipt_wait`` for
    its pay: they match when ``pay_ts - receipt_wait <= receipt_ts <= pay_ts +
    pay_wait`` (bounds inclusive).  Leftovers go to two side outputs.
    -> tag ('matched' | 'unmatched_pay' | 'unmatched_receipt'), key, pay_* and
       receipt_* columns (null on the side that is missing).

    Plan: a band join on (key, time bucket).  Each pay sits in one bucket of
    length >= the band; a receipt is copied into the (at most two) pay buckets
    that can hold a partner, so every pair is produced exactly once and a hot
    key is spread over its buckets instead of one join partition; an anti join
    on the same bucketing finds the receipts without a pay.  Keys are meant to be
    unique transactions; a key with many pays and receipts within one band gives
    all their pairs, as a SQL join does.
    """
    pw, rw = duration_us(pay_wait), duration_us(receipt_wait)
    band = pw + rw
    b = duration_us(bucket) if bucket else max(2 * band, 1_000_000)
    pdt, rdt = pays.schema[ts].dataType, receipts.schema[ts].dataType
    p = pays.select(*[F.col(c).alias(c if c == key else f"pay_{c}") for c in pays.columns]) \
        .withColumn("__pus", to_micros(f"pay_{ts}", pdt))
    r = receipts.select(*[F.col(c).alias(c if c == key else f"receipt_{c}") for c in receipts.columns]) \
        .withColumn("__rus", to_micros(f"receipt_{ts}", rdt))
    p_b = p.withColumn("__b", floor_div(F.col("__pus"), b))
    r_b = r.withColumn("__b", floor_div(F.col("__rus"), b))
    # Candidate pay buckets of a receipt: pay_ts in [rts - pay_wait, rts + receipt_wait].
    r_x = r.withColumn("__b", F.explode(F.sequence(floor_div(F.col("__rus") - F.lit(pw), b),
                                                    floor_div(F.col("__rus") + F.lit(rw), b))))
    # Candidate receipt buckets of a pay: receipt_ts in [pts - receipt_wait, pts + pay_wait].
    p_x = p.withColumn("__b", F.explode(F.sequence(floor_div(F.col("__pus") - F.lit(rw), b),
                                                    floor_div(F.col("__pus") + F.lit(pw), b))))

    pcols = [c for c in p.columns if c.startswith("pay_")]
    rcols = [c for c in r.columns if c.startswith("receipt_")]
    cond = _band(key, pw, rw)
    # A pay sits in one bucket, so one outer join gives its pairs or its loneliness.
    of_pays = (p_b.alias("p").join(r_x.alias("r"), cond, "left_outer")
               .select(F.when(F.col("r.__rus").isNull(), F.lit("unmatched_pay")).otherwise(F.lit("matched")).alias("tag"),
                       F.col(f"p.{key}").alias(key), *[F.col(f"p.{c}") for c in pcols], *[F.col(f"r.{c}") for c in rcols]))
    lonely_receipts = (r_b.alias("r").join(p_x.alias("p"), cond, "left_anti")
                       .select(F.lit("unmatched_receipt").alias("tag"), F.col(key),
                               *[F.lit(None).cast(p.schema[c].dataType).alias(c) for c in pcols], *rcols))
    return of_pays.unionByName(lonely_receipts)


def _band(key: str, pw: int, rw: int):
    """Same key, same bucket, receipt time within [pay - rw, pay + pw]."""
    return ((F.col(f"p.{key}") == F.col(f"r.{key}")) & (F.col("p.__b") == F.col("r.__b"))
            & (F.col("r.__rus") >= F.col("p.__pus") - F.lit(rw))
            & (F.col("r.__rus") <= F.col("p.__pus") + F.lit(pw)))


def tx_pair(pays: DataFrame, receipts: DataFrame, pay_wait="5 seconds", receipt_wait="3 seconds", *,
            key: str = "tx_id", ts: str = "ts", seq: str = "seq", blocks: int | None = None) -> DataFrame:
    """J1 one to one: every pay and every receipt is in one row, as in a state machine that
    waits for the other side.

    A key's events are taken in event time (pays before receipts of the same instant, then
    ``seq``). A pay is matched with the oldest waiting receipt at most ``receipt_wait``
    earlier, a receipt with the oldest waiting pay at most ``pay_wait`` earlier; what finds
    no partner in its time is ``unmatched_*``. So a key with many pays and receipts gives as
    many rows as it has events, where ``tx_match`` gives all pairs.
    -> the columns of ``tx_match``

    Plan: a pause longer than both waits empties the queues, so a key's events are cut there
    (blocked scans), the pieces are dealt out and each is walked in order, batch by batch;
    memory is the events that are waiting.
    """
    pw, rw = duration_us(pay_wait), duration_us(receipt_wait)
    sides = []
    for df, side in ((pays, "pay"), (receipts, "receipt")):
        dtype = df.schema[ts].dataType
        sides.append(df.select(*[F.col(c).alias(c if c == key else f"{side}_{c}") for c in df.columns],
                               to_micros(ts, dtype).alias("__us"), F.lit(side == "receipt").alias("__receipt"),
                               F.col(seq).cast("long").alias("__seq")))
    x = sides[0].unionByName(sides[1], allowMissingColumns=True)
    columns = [c for c in x.columns if not c.startswith("__")]
    order = ["__us", "__receipt", "__seq"]
    x = row_blocks(x, [key], order, "__blk", blocks)
    x = previous_row(x, [key], order, ["__us"], "__blk", prefix="__before")
    pause = F.coalesce(F.col("__us") - F.col("__before__us") > F.lit(max(pw, rw)), F.lit(False))
    x = blocked_running(x.withColumn("__pause", pause.cast("int")), [key], order, "__pause", "__blk", "__piece")
    # A null key matches nothing.
    walked = x.where(F.col(key).isNotNull()).select(*columns, *order, "__piece")
    schema = T.StructType([T.StructField("tag", T.StringType()), *walked.select(*columns).schema.fields])
    paired = (walked.repartition(key, "__piece").sortWithinPartitions(key, "__piece", *order)
              .mapInArrow(lambda batches: _pair(batches, columns, key, pw, rw), schema))
    lonely = F.when(F.col("__receipt"), "unmatched_receipt").otherwise("unmatched_pay").alias("tag")
    return paired.unionByName(x.where(F.col(key).isNull()).select(lonely, *columns))


def _pair(batches, columns: list[str], key: str, pw: int, rw: int):
    """Walks sorted events; the queues hold (time, row) of the events that still wait."""
    now, queues = None, (deque(), deque())
    waits = (pw, rw)   # how long a pay, a receipt waits
    tags = ("unmatched_pay", "unmatched_receipt")

    def drop(upto, out):
        """Events that no later one can reach."""
        for side, queue in enumerate(queues):
            while queue and (upto is None or queue[0][0] + waits[side] < upto):
                out.append({"tag": tags[side], **queue.popleft()[1]})

    schema = None
    for batch in batches:
        out = []
        if schema is None:
            schema = pa.schema([pa.field("tag", pa.string()), *[batch.schema.field(c) for c in columns]])
        own = [[n for n in columns if n != key and n.startswith(f"{side}_")] for side in ("pay", "receipt")]
        for row in batch.to_pylist():
            piece = (row[key], row["__piece"])
            if piece != now:
                drop(None, out)
                now = piece
            us, side = row["__us"], int(row["__receipt"])
            drop(us, out)
            mine = {n: row[n] for n in own[side]}
            other = queues[1 - side]
            if other:
                out.append({"tag": "matched", **other.popleft()[1], **mine})
            else:
                queues[side].append((us, {key: row[key], **mine}))
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if schema is not None:
        out = []
        drop(None, out)
        yield pa.RecordBatch.from_pylist(out, schema=schema)
