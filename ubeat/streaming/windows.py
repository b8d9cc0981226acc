"""Windowed aggregations on streams (A1–A10, A12 stream forms).

Append mode: a window is emitted once, final, when the watermark passes its
end (W5).  The watermark delay is the reference's out-of-orderness (0 for its
ascending-time jobs).  A stream has no end-of-input flush: the windows still
open when the input stops are not emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.functions.hashing import bitmap_offset
from ubeat.functions.time import duration_us, floor_div, interval_str
from ubeat.operators.sketches import BUCKET_BITS, visitor_sketches
from ubeat.plans.sliding import window_counts
from ubeat.streaming.processors import NewVisitors, VisitorCount
from ubeat.streaming.sources import event_time


def _win(ts: str, size, slide=None):
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    return F.window(ts, interval_str(size_us), interval_str(slide_us))


def stream_window_counts(df: DataFrame, keys: Sequence[str], size, slide=None, *, ts: str = "ts",
                         delay="0 seconds", count_col: str = "cnt") -> DataFrame:
    """Rows per key per window -> keys, window_start, window_end, cnt (append mode).

    Large overlap ratios expand every row ``size/slide`` times; for those, stream
    slide-sized pane counts (``stream_pane_counts``) to a table and run the batch
    change-point plan over it.
    """
    src = event_time(df, ts).withWatermark(ts, interval_str(duration_us(delay)))
    return (src.groupBy(_win(ts, size, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), count_col))


def stream_pane_counts(df: DataFrame, keys: Sequence[str], slide, *, ts: str = "ts", delay="0 seconds") -> DataFrame:
    """Closed slide-sized pane counts (tumbling) — the streaming half of the pane plan."""
    return stream_window_counts(df, keys, slide, None, ts=ts, delay=delay)


def stream_page_views(behavior: DataFrame, size="1 hour", *, ts: str = "ts", delay="0 seconds") -> DataFrame:
    pv = behavior.where(F.col("behavior") == "pv")
    return stream_window_counts(pv, [], size, ts=ts, delay=delay, count_col="pv").select("window_end", "pv")


def stream_unique_visitors(behavior: DataFrame, size="1 hour", *, ts: str = "ts", user: str = "user_id",
                           delay="0 seconds", bits: int | None = None, seed: int = 61) -> DataFrame:
    """Exact (or bitmap-offset) distinct visitors per window: two chained aggregates.

    ``count_distinct`` is refused on streams; first (window, visitor) groups,
    then a count per window — both append-mode, state dropped by the watermark.
    """
    pv = event_time(behavior.where(F.col("behavior") == "pv"), ts) \
        .withWatermark(ts, interval_str(duration_us(delay)))
    vis = bitmap_offset(F.col(user), bits, seed) if bits else F.col(user)
    first = pv.groupBy(_win(ts, size).alias("window"), vis.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return (first.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
            .select(F.col("window.end").alias("window_end"), "uv"))


def stream_unique_visitors_approx(behavior: DataFrame, size="1 hour", rsd: float = 0.01, *, ts: str = "ts",
                                  user: str = "user_id", delay="0 seconds") -> DataFrame:
    pv = event_time(behavior.where(F.col("behavior") == "pv"), ts) \
        .withWatermark(ts, interval_str(duration_us(delay)))
    return (pv.groupBy(_win(ts, size).alias("w")).agg(F.approx_count_distinct(user, rsd).alias("uv"))
            .select(F.col("w.end").alias("window_end"), "uv"))


def stream_item_view_counts(behavior: DataFrame, size="1 hour", slide="5 minutes", *, ts: str = "ts",
                            delay="0 seconds") -> DataFrame:
    """Closed hop-window counts per item; ``streaming.ranking`` ranks them per micro-batch."""
    pv = behavior.where(F.col("behavior") == "pv")
    return stream_window_counts(pv, ["item_id"], size, slide, ts=ts, delay=delay)


def stream_running_visitors(behavior: DataFrame, size="1 hour", *, ts: str = "ts", user: str = "user_id",
                            delay="0 seconds", bits: int | None = None, seed: int = 61) -> DataFrame:
    """A12 / U6 on a stream, for update mode: the first view of every visitor (or
    bitmap offset) of each window, emitted in the micro-batch that brings it and
    again only if an earlier view arrives later.  The running count is the number
    of distinct visitors emitted so far.  -> window_end, user (or offset), first_ts
    """
    pv = event_time(behavior.where(F.col("behavior") == "pv"), ts) \
        .withWatermark(ts, interval_str(duration_us(delay)))
    vis = bitmap_offset(F.col(user), bits, seed) if bits else F.col(user)
    name = "offset" if bits else user
    return (pv.groupBy(_win(ts, size).alias("w"), vis.alias(name)).agg(F.min(ts).alias("first_ts"))
            .select(F.col("w.end").alias("window_end"), name, "first_ts"))


def stream_visitor_counts(behavior: DataFrame, size="1 hour", *, ts: str = "ts", user: str = "user_id",
                          delay="0 seconds", bits: int = 1 << 29, seed: int = 61) -> DataFrame:
    """A12 / U6 on a stream: the running number of visitors itself, (window_end, uv) for
    every micro-batch that brings a window new visitors (append mode).

    Two levels of keyed state: a bitmap of 32,768 bits per (window, bucket of the
    visitor's offset) finds the new bits, and a counter per window adds up one row per
    bucket; a busy window is spread over its buckets. Both are cleared at its end.
    """
    size_us = duration_us(size)
    pv = event_time(behavior.where(F.col("behavior") == "pv"), ts).withWatermark(ts, interval_str(duration_us(delay)))
    end_us = floor_div(F.unix_micros(ts), size_us) * F.lit(size_us) + F.lit(size_us)
    at = bitmap_offset(F.col(user), bits, seed)
    rows = pv.select(F.floor(end_us / 1000).alias("end_ms"), floor_div(at, BUCKET_BITS).alias("bucket"),
                     F.pmod(at, F.lit(BUCKET_BITS)).alias("position"), F.col(ts).alias("ts"))
    new = rows.groupBy("end_ms", "bucket").transformWithState(
        NewVisitors(min(bits, BUCKET_BITS)), "end_ms LONG, ts TIMESTAMP, new LONG", "Append", "EventTime", eventTimeColumnName="ts")
    counts = new.groupBy("end_ms").transformWithState(VisitorCount(), "end_ms LONG, uv LONG", "Append", "EventTime")
    return counts.select(F.timestamp_millis("end_ms").alias("window_end"), "uv")


def stream_visitor_sketches(behavior: DataFrame, pane="5 minutes", lg_k: int = 12, *, ts: str = "ts",
                            user: str = "user_id", delay="0 seconds") -> DataFrame:
    """A10 on a stream: the HLL sketch of every closed pane (append mode);
    ``operators.sketches.sketch_visitors`` unites stored sketches to windows."""
    src = event_time(behavior, ts).withWatermark(ts, interval_str(duration_us(delay)))
    return visitor_sketches(src, pane, lg_k, ts=ts, user=user)


def windows_from_panes(panes: DataFrame, keys: Sequence[str], size, slide, *, count_col: str = "cnt") -> DataFrame:
    """Sliding-window counts from a table of closed pane counts (batch).

    The streaming half of a large-ratio window (hot pages 120x, ad clicks 720x,
    market counts 17,280x) appends ``stream_pane_counts`` output to a table;
    this runs the change-point plan over it, weighting each pane by its count,
    so no row is ever expanded ``size/slide`` times.
    -> keys, window_start, window_end, cnt
    """
    return window_counts(panes, "window_start", keys, size, slide, count_col=count_col, weight=count_col)
