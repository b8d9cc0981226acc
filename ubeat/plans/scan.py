"""Skew-safe ordered scans: running aggregates, previous / next rows, next match.

A plain ``Window.partitionBy(key).orderBy(seq)`` sorts every row of a key in
one task; if one key holds a third of the data that task never finishes.
``row_blocks`` counts the rows per key first (a partial aggregate over the key
column). Where no key has more than ``ROWS_PER_BLOCK`` rows, the plain window is
bounded as it is: all scans over one (key, order) then share one exchange and one
sort, and nothing is written. Otherwise each key's order is split into *blocks*
(the ranges of one range partitioning by key and order, as many as the rows need,
whatever the spacing of times or sequence numbers), and a scan works in two levels:

1. one summary row per (key, block) — a partial aggregate, combinable map-side;
2. a window over the per-key block summaries (rows / ``ROWS_PER_BLOCK`` of them in
   all) gives the value carried into each block;
3. a window over (key, block) — bounded size — finishes the scan, seeded by
   the carried value that is joined back (AQE broadcasts it when small).

Look-ahead scans (``next_rows``, ``next_match``) mirror this with a carry from
the *following* blocks.  Both ways give every row the same result
(tests/test_plans.py checks each against the plain window).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ubeat.session import checkpointed


#: The most rows of a key that one task orders.
ROWS_PER_BLOCK = 1_000_000


def row_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "__blk",
               blocks: int | None = None, counted: DataFrame | None = None) -> DataFrame:
    """``df`` with a block number that is monotone in (keys, order), or ``df`` itself if
    every key has at most ``ROWS_PER_BLOCK`` rows (the scans then take a key as one block;
    without keys all rows are one key).

    Blocks are the ranges of a range partitioning by (keys, order), of about
    ``ROWS_PER_BLOCK`` rows (or ``blocks`` of them): a hot key, even one with all its
    rows in one second, is cut into as many blocks as its share of the rows.  The
    ranges come from a sample, so the result is checkpointed: block summaries and rows
    read the same blocks, also after an executor is lost.  ``counted`` is a frame that is
    cheaper to count than ``df`` and has at least as many rows for every key.
    """
    if blocks is None:
        per_key = (df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        most, rows = per_key.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) <= ROWS_PER_BLOCK:
            return df
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = max(least, math.ceil((rows or 0) / ROWS_PER_BLOCK))
    ranged = df.repartitionByRange(blocks, *[F.col(c) for c in (*keys, *order)])
    return checkpointed(ranged.withColumn(out, F.spark_partition_id()))


_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def _order_cols(order: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def blocked_running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    block: str, out: str, how: str = "sum", inclusive: bool = True) -> DataFrame:
    """Add ``out`` = running ``how`` of ``value`` per ``keys`` in ``order``.

    ``inclusive=False`` aggregates strictly earlier rows only (null when none).
    ``block`` must be monotone in ``order`` within a key (e.g. ``seq div B``).
    """
    return blocked_running_many(df, keys, order, block, [(value, how, out, inclusive)])


def blocked_running_many(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str,
                         specs: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """Several running aggregates in one blocked scan: ``specs`` = (value, how, out, inclusive).

    One summary per (key, block) with all block totals, one carry window over
    the block summaries, one window over (key, block) for the rows.
    """
    keys = list(keys)
    if block not in df.columns:
        for v, h, name, inc in specs:
            w = Window.partitionBy(*keys).orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, 0 if inc else -1)
            run = _AGG[h](v).over(w)
            df = df.withColumn(name, F.coalesce(run, F.lit(0)) if inc and h in ("sum", "count") else run)
        return df
    summary = df.groupBy(*keys, block).agg(*[_AGG[h](v).alias(f"__bt{i}") for i, (v, h, _, _) in enumerate(specs)])
    wk = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(block) \
        .rowsBetween(Window.unboundedPreceding, -1)
    # Block totals combine by sum for counts (count of rows, not of blocks).
    carry = summary.select(*keys, block, *[_AGG["sum" if h == "count" else h](f"__bt{i}").over(wk)
                                           .alias(f"__cy{i}") for i, (_, h, _, _) in enumerate(specs)])
    out = df
    for i, (v, h, _, inc) in enumerate(specs):
        wb = Window.partitionBy(*keys, block).orderBy(*_order_cols(order)) \
            .rowsBetween(Window.unboundedPreceding, 0 if inc else -1)
        out = out.withColumn(f"__in{i}", _AGG[h](v).over(wb))
    out = out.join(carry, on=[*keys, block], how="left")
    for i, (_, h, name, inc) in enumerate(specs):
        cy, wi = F.col(f"__cy{i}"), F.col(f"__in{i}")
        if h in ("sum", "count"):
            # A running count/sum is never null once the row itself is included.
            res = F.when(wi.isNull() & cy.isNull(), F.lit(None) if not inc else F.lit(0)) \
                .otherwise(F.coalesce(cy, F.lit(0)) + F.coalesce(wi, F.lit(0)))
        elif h == "max":
            res = F.greatest(cy, wi)
        else:
            res = F.least(cy, wi)
        out = out.withColumn(name, res)
    return out.drop(*[f"__in{i}" for i in range(len(specs))], *[f"__cy{i}" for i in range(len(specs))])


def global_running(df: DataFrame, order: Sequence[str], value: str, block: str, out: str,
                   how: str = "max", inclusive: bool = True) -> DataFrame:
    """Running aggregate over the whole table (no key) — e.g. a watermark.

    Never a single-partition window over the rows: only the per-block summary
    (one row per block) is ordered globally.
    """
    return blocked_running(df, [], order, value, block, out, how=how, inclusive=inclusive)


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str],
                 block: str, prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + f`` = value of ``f`` in the previous row of the same key.

    Within a block it is ``lag``; the first row of a block takes the last row of
    the key's nearest earlier non-empty block (``max_by`` per block, then ``lag``
    over the per-key block summary).
    """
    keys = list(keys)
    if block not in df.columns:
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
        return df.withColumns({prefix + f: F.lag(f).over(w) for f in fields})
    payload = F.struct(*[F.col(f).alias(f) for f in fields])
    okey = F.struct(*[F.col(c) for c in order])
    last_in_block = (df.groupBy(*keys, block)
                     .agg(F.max_by(payload, okey).alias("__last")))
    wk = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(block)
    carry = last_in_block.select(*keys, block, F.lag("__last").over(wk).alias("__carry"))

    wb = Window.partitionBy(*keys, block).orderBy(*_order_cols(order))
    out = df
    for f in fields:
        out = out.withColumn(f"__lag_{f}", F.lag(f).over(wb))
    out = out.withColumn("__first", F.row_number().over(wb) == 1)
    out = out.join(carry, on=[*keys, block], how="left")
    for f in fields:
        out = out.withColumn(prefix + f, F.when(F.col("__first"), F.col("__carry")[f])
                             .otherwise(F.col(f"__lag_{f}")))
    return out.drop("__first", "__carry", *[f"__lag_{f}" for f in fields])


def seq_block(seq: str, rows_per_block: int) -> Column:
    """Block id for arrival-ordered scans: ``seq div rows_per_block``.

    Bounds every (key, block) window partition to ``rows_per_block`` rows.
    """
    return F.call_function("div", F.col(seq).cast("long"), F.lit(int(rows_per_block)))


def next_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], k: int,
              block: str, prefix: str = "next") -> DataFrame:
    """Add ``{prefix}{j}_{f}`` = field ``f`` of the j-th following row of the key (j = 1..k).

    Within a block it is ``lead(j)``; rows near the end of a block take the
    rest from the first ``k`` rows of the following blocks.  Each block
    contributes at most ``k`` rows to its summary (a partial WindowGroupLimit
    keeps the shuffle bounded) and every non-empty block has at least one row,
    so the next ``k`` blocks always suffice.
    """
    keys = list(keys)
    ocols = _order_cols(order)
    if block not in df.columns:
        w = Window.partitionBy(*keys).orderBy(*ocols)
        return df.withColumns({f"{prefix}{j}_{f}": F.lead(f, j).over(w) for j in range(1, k + 1) for f in fields})
    wb = Window.partitionBy(*keys, block).orderBy(*ocols)
    payload = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                       *[F.col(f).alias(f) for f in fields])
    heads = (df.withColumn("__rn", F.row_number().over(wb)).where(F.col("__rn") <= k)
             .groupBy(*keys, block)
             .agg(F.array_sort(F.collect_list(payload)).alias("__head")))
    wk = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(block) \
        .rowsBetween(1, k)
    carry = heads.select(*keys, block, F.slice(F.flatten(F.collect_list("__head").over(wk)), 1, k).alias("__carry"))

    out = (df.withColumn("__pos", F.row_number().over(wb))
           .withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys, block)))
           .join(carry, on=[*keys, block], how="left"))
    for j in range(1, k + 1):
        spill = (F.col("__pos") + F.lit(j) - F.col("__n")).cast("int")   # 1-based index into the carry
        for f in fields:
            from_carry = F.when(F.size("__carry") >= spill, F.element_at("__carry", spill)[f])
            out = out.withColumn(f"{prefix}{j}_{f}",
                                 F.when(spill <= 0, F.lead(f, j).over(wb)).otherwise(from_carry))
    return out.drop("__pos", "__n", "__carry")


def next_match(df: DataFrame, keys: Sequence[str], order: Sequence[str], is_match: Column, fields: Sequence[str],
               block: str, prefix: str = "next_") -> DataFrame:
    """Add ``prefix + f`` = field ``f`` of the nearest *following* row of the key where
    ``is_match`` holds (relaxed contiguity: other rows in between are skipped).

    Within a block: an incremental scan in descending order (a growing frame,
    not an O(n^2) "1 following .. unbounded following"); across blocks: the
    first match of the nearest later block that has one.
    """
    keys = list(keys)
    okey = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(f).alias(f) for f in fields])
    x = df.withColumn("__m", is_match)
    if block not in df.columns:
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order, descending=True)).rowsBetween(Window.unboundedPreceding, -1)
        x = x.withColumn("__in", F.last(F.when(F.col("__m"), payload), ignorenulls=True).over(w))
        return x.withColumns({prefix + f: F.col("__in")[f] for f in fields}).drop("__m", "__in")
    first = (x.groupBy(*keys, block)
             .agg(F.min_by(F.when(F.col("__m"), payload), F.when(F.col("__m"), okey)).alias("__first")))
    wk = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(F.col(block).desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = first.select(*keys, block, F.last("__first", ignorenulls=True).over(wk).alias("__carry"))

    desc = Window.partitionBy(*keys, block).orderBy(*_order_cols(order, descending=True)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.last(F.when(F.col("__m"), payload), ignorenulls=True).over(desc)
    out = x.withColumn("__in", nxt).join(carry, on=[*keys, block], how="left")
    best = F.coalesce(F.col("__in"), F.col("__carry"))
    for f in fields:
        out = out.withColumn(prefix + f, best[f])
    return out.drop("__m", "__in", "__carry")
