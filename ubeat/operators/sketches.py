"""Visitor counts from stored, mergeable summaries.

A summary is kept per pane (an hour, five minutes) and written once; windows of any
multiple of the pane are made by merging summaries, never by reading rows again:

* bitmaps (A11): the visitor's one-hash offset sets a bit; a bitmap is stored in
  buckets of 32,768 bits (Spark's bitmap functions), merged by OR and counted by its
  bits. A busy pane is spread over its buckets. Equal to the number of distinct offsets.
* HLL sketches (A10): constant size, merged by union, approximate.

A sliding window reads each pane's summary ``size / slide`` times; the rows behind it
are aggregated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.functions.hashing import bitmap_offset
from ubeat.functions.time import duration_us, interval_str

BUCKET_BITS = 32_768


def _pane(ts: str, size, slide=None):
    return F.window(ts, interval_str(duration_us(size)), interval_str(duration_us(slide if slide is not None else size)))


def _views(behavior: DataFrame, pane, ts: str, **columns) -> DataFrame:
    pv = behavior.where(F.col("behavior") == "pv")
    return pv.select(_pane(ts, pane).alias("w"), *[c.alias(n) for n, c in columns.items()])


def visitor_bitmaps(behavior: DataFrame, pane="1 hour", bits: int = 1 << 29, seed: int = 61, *, ts: str = "ts",
                    user: str = "user_id") -> DataFrame:
    """-> window_start, window_end, bucket, bitmap: one row per pane and bucket that has visitors."""
    at = bitmap_offset(F.col(user), bits, seed) + 1
    rows = _views(behavior, pane, ts, bucket=F.bitmap_bucket_number(at), position=F.bitmap_bit_position(at))
    return (rows.groupBy("w", "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bucket", "bitmap"))


def merge_bitmaps(bitmaps: DataFrame, size, slide=None) -> DataFrame:
    """Bitmaps of longer windows (multiples of the pane) by OR, same columns."""
    return (bitmaps.groupBy(_pane("window_start", size, slide).alias("w"), "bucket")
            .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bucket", "bitmap"))


def bitmap_visitors(bitmaps: DataFrame) -> DataFrame:
    """-> window_end, uv: the bits set in all buckets of a window."""
    return bitmaps.groupBy("window_end").agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))


def visitor_sketches(behavior: DataFrame, pane="5 minutes", lg_k: int = 12, *, ts: str = "ts",
                     user: str = "user_id") -> DataFrame:
    """-> window_start, window_end, sketch: one HLL sketch per pane that has visitors.

    Also the stream form: on a watermarked stream in append mode a pane's sketch is
    written once, when the watermark passes its end."""
    return (_views(behavior, pane, ts, visitor=F.col(user)).groupBy("w")
            .agg(F.hll_sketch_agg("visitor", lg_k).alias("sketch"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sketch"))


def sketch_visitors(sketches: DataFrame, size, slide=None) -> DataFrame:
    """-> window_end, uv: approximate visitors of windows made of whole panes."""
    return (sketches.groupBy(_pane("window_start", size, slide).alias("w"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv"))
            .select(F.col("w.end").alias("window_end"), "uv"))
