"""Windowed aggregations over event time.

Defaults are the reference's parameters.  All results use ``window_start`` /
``window_end`` of the input's timestamp type; windows are epoch aligned and
half-open like Spark's ``window()``.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ubeat.functions.hashing import bitmap_offset
from ubeat.functions.time import duration_us, interval_str
from ubeat.plans.scan import blocked_running, row_blocks
from ubeat.plans.sliding import window_counts


def sliding_count(df: DataFrame, keys: Sequence[str], size="1 hour", slide="5 minutes", *,
                  ts: str = "ts", count_col: str = "cnt", plan: str = "auto") -> DataFrame:
    """A1/A2: rows per key per hop window -> keys, window_start, window_end, cnt."""
    return window_counts(df, ts, keys, size, slide, count_col=count_col, plan=plan)


def item_view_counts(behavior: DataFrame, size="1 hour", slide="5 minutes", *, ts: str = "ts",
                     plan: str = "auto") -> DataFrame:
    """Hot-items counting stage: ``pv`` rows per item per window -> item_id, window_end, cnt."""
    pv = behavior.where(F.col("behavior") == "pv")
    return sliding_count(pv, ["item_id"], size, slide, ts=ts, plan=plan).select("item_id", "window_end", "cnt")


def page_counts(log: DataFrame, size="10 minutes", slide="5 seconds", *, ts: str = "ts",
                method: str = "GET", plan: str = "auto") -> DataFrame:
    """A4: requests of ``method`` per url per window -> url, window_end, cnt."""
    req = log.where(F.col("method") == method)
    return sliding_count(req, ["url"], size, slide, ts=ts, plan=plan).select("url", "window_end", "cnt")


def clicks_by_province(passed: DataFrame, size="1 hour", slide="5 seconds", *, ts: str = "ts",
                       plan: str = "auto") -> DataFrame:
    """A5: clicks per province per window -> province, window_end, cnt."""
    return sliding_count(passed, ["province"], size, slide, ts=ts, plan=plan) \
        .select("province", "window_end", "cnt")


def market_counts(market: DataFrame, size="1 day", slide="5 seconds", *, ts: str = "ts",
                  plan: str = "auto") -> DataFrame:
    """Behaviours per (channel, behavior) per window, ``uninstall`` excluded.

    -> window_start, window_end, channel, behavior, cnt
    """
    kept = market.where(F.col("behavior") != "uninstall")
    return sliding_count(kept, ["channel", "behavior"], size, slide, ts=ts, plan=plan) \
        .select("window_start", "window_end", "channel", "behavior", "cnt")


def page_views(behavior: DataFrame, size="1 hour", *, ts: str = "ts") -> DataFrame:
    """``pv`` rows per tumbling window -> window_end, pv."""
    pv = behavior.where(F.col("behavior") == "pv")
    w = F.window(ts, interval_str(duration_us(size)))
    return pv.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("pv")).select(F.col("w.end").alias("window_end"), "pv")


def page_views_two_phase(behavior: DataFrame, size="1 hour", *, ts: str = "ts", salt_buckets: int = 64,
                         salt_of: Sequence[str] = ("user_id", "seq")) -> DataFrame:
    """The salted two-phase total — count per (window, salt), then sum per window.

    The salt is a hash of row columns, not a random number, so a recomputed task
    after an executor loss produces the same partial counts.
    """
    pv = behavior.where(F.col("behavior") == "pv")
    w = F.window(ts, interval_str(duration_us(size)))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_of]), F.lit(salt_buckets))
    partial = pv.groupBy(w.alias("w"), salt.alias("salt")).agg(F.count(F.lit(1)).alias("c"))
    return partial.groupBy(F.col("w.end").alias("window_end")).agg(F.sum("c").cast("long").alias("pv"))


def unique_visitors(behavior: DataFrame, size="1 hour", *, ts: str = "ts", user: str = "user_id") -> DataFrame:
    """Exact distinct users per tumbling window -> window_end, uv.

    Catalyst plans the distinct as a two-level aggregate keyed first by
    (window, user), so one busy window is still spread over many tasks.
    """
    pv = behavior.where(F.col("behavior") == "pv")
    w = F.window(ts, interval_str(duration_us(size)))
    return pv.groupBy(w.alias("w")).agg(F.count_distinct(user).alias("uv")) \
        .select(F.col("w.end").alias("window_end"), "uv")


def unique_visitors_approx(behavior: DataFrame, size="1 hour", rsd: float = 0.01, *, ts: str = "ts",
                           user: str = "user_id") -> DataFrame:
    """A10: HyperLogLog++ distinct users per window (mergeable partial sketches)."""
    pv = behavior.where(F.col("behavior") == "pv")
    w = F.window(ts, interval_str(duration_us(size)))
    return pv.groupBy(w.alias("w")).agg(F.approx_count_distinct(user, rsd).alias("uv")) \
        .select(F.col("w.end").alias("window_end"), "uv")


def unique_visitors_bitmap(behavior: DataFrame, size="1 hour", bits: int = 1 << 29, seed: int = 61, *,
                           ts: str = "ts", user: str = "user_id") -> DataFrame:
    """One-hash bitmap count — distinct bit offsets per window -> window_end, uv.

    Two users whose ids hash to the same offset count once, as in the reference.
    """
    pv = behavior.where(F.col("behavior") == "pv").withColumn("offset", bitmap_offset(F.col(user), bits, seed))
    w = F.window(ts, interval_str(duration_us(size)))
    return pv.groupBy(w.alias("w")).agg(F.count_distinct("offset").alias("uv")) \
        .select(F.col("w.end").alias("window_end"), "uv")


def running_unique_visitors(behavior: DataFrame, size="1 hour", *, ts: str = "ts", seq: str = "seq",
                            user: str = "user_id", bits: int | None = None, seed: int = 61,
                            blocks: int | None = None) -> DataFrame:
    """One row each time a new visitor appears in a window (fire per element).

    -> window_end, user_id (or offset), ts, uv  where uv is the running count.
    With ``bits`` the visitor is the bitmap offset, as in the reference's job.
    The running count is a scan over blocks of a bounded number of first
    views, so one busy window (or second) is not ordered in a single task.
    """
    pv = behavior.where(F.col("behavior") == "pv")
    vis = bitmap_offset(F.col(user), bits, seed) if bits else F.col(user)
    vcol = "offset" if bits else user
    w = F.window(ts, interval_str(duration_us(size)))
    first = (pv.select(w.end.alias("window_end"), vis.alias(vcol), F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq")).alias("o"))
             .groupBy("window_end", vcol).agg(F.min("o").alias("o"))
             .select("window_end", vcol, F.col("o.ts").alias("ts"), F.col("o.seq").alias("seq"), F.lit(1).alias("one")))
    first = row_blocks(first, ["window_end"], ["ts", "seq"], "__blk", blocks, counted=pv.select(w.end.alias("window_end")))
    out = blocked_running(first, ["window_end"], ["ts", "seq"], "one", "__blk", "uv", how="sum")
    return out.select("window_end", vcol, "ts", F.col("uv").cast("long").alias("uv"))


def window_aggregate(df: DataFrame, keys: Sequence[str], size, slide=None, *, ts: str = "ts",
                     **aggs: Column) -> DataFrame:
    """Any aggregates per key per window -> keys, window_start, window_end, <aggs>.

    The aggregates are Columns: built-ins (partial aggregation, codegen) or a
    grouped-aggregate pandas UDF for a custom incremental aggregate
    (``@pandas_udf("double") def f(v: pd.Series) -> float``).  Spark does not
    mix pandas aggregate UDFs and built-in aggregates in one call: use one kind
    per call and join the results on (keys, window) if both are needed.
    """
    w = F.window(ts, interval_str(duration_us(size)),
                 interval_str(duration_us(slide if slide is not None else size)))
    return (df.groupBy(w.alias("__w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
            .select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                    *aggs))


def window_apply(df: DataFrame, keys: Sequence[str], size, fn, schema, *, ts: str = "ts") -> DataFrame:
    """A whole-window function — ``fn(pandas.DataFrame) -> pandas.DataFrame`` per
    (tumbling window, key), with ``window_end`` added to its input.

    The fallback for logic no aggregate expression can state: a window's rows
    meet in one Python call, so use it where a window of one key is bounded.
    """
    w = F.window(ts, interval_str(duration_us(size)))
    return df.withColumn("window_end", w.end).groupBy("window_end", *keys).applyInPandas(fn, schema)


def window_stream(df: DataFrame, keys: Sequence[str], size, fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                  schema: str, *, ts: str = "ts", order: Sequence[str] = (), columns: Sequence[str] = ()) -> DataFrame:
    """U3 in bounded memory: ``fn((window_end, *keys), frames)`` per (tumbling window, key).

    ``frames`` iterates over the group's rows batch by batch, ordered by ``order`` (an
    external sort), so a window of any size passes through a worker that holds one Arrow
    batch; ``fn`` yields result frames and may stop reading early. ``columns`` are the
    columns it needs (all by default). A window of one key is one task's work: where it
    can be merged, use ``sliding_merge`` or an aggregate instead.
    """
    group = ["window_end", *keys]
    names = list(dict.fromkeys([*group, *(columns or df.columns), *order]))
    w = F.window(ts, interval_str(duration_us(size)))
    rows = df.withColumn("window_end", w.end).select(*names).repartition(*group).sortWithinPartitions(*group, *order)
    return rows.mapInPandas(lambda batches: _grouped(batches, group, fn), schema)


def _grouped(batches: Iterator[pd.DataFrame], group: list[str], fn) -> Iterator[pd.DataFrame]:
    """Runs ``fn`` over consecutive groups of a stream of sorted batches."""
    def runs():
        for batch in batches:
            if len(batch):
                changed = (batch[group] != batch[group].shift()) & ~(batch[group].isna() & batch[group].shift().isna())
                cuts = [0, *(i for i in np.flatnonzero(changed.any(axis=1)) if i), len(batch)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    part = batch.iloc[a:b]
                    yield tuple(None if pd.isna(x) else x for x in part[group].iloc[0]), part

    for key, parts in itertools.groupby(runs(), key=lambda run: run[0]):
        yield from fn(key, (part for _, part in parts))
