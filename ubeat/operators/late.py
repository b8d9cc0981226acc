"""Late-row splitting (W4): the side output of rows a windowed count drops.

Table rule over rows with an arrival sequence ``seq`` (rows sharing a ``seq``
arrive together, like one micro-batch):

* watermark(row) = max event time of all rows that arrived earlier - ``delay``
  (null for the first arrivals: nothing is late yet);
* a row belongs to the windows of ``size`` sliding by ``slide`` that contain
  it; its last one ends at ``E``;
* the row is late iff every such window is already cleaned up:
  ``E - 1 us + lateness <= watermark`` (the window's last instant plus the
  allowed lateness has passed).

Plan: max time per arrival key (partial aggregate), then a *global* running max
over those keys — computed as a blocked scan (per-block maxima, a running max
over the block summary, then within blocks), never a single-partition window
over the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ubeat.functions.time import duration_us, floor_div, from_micros, to_micros
from ubeat.plans.scan import global_running, row_blocks
from ubeat.plans.sliding import window_counts


def split_late(df: DataFrame, size, slide=None, *, delay="0 seconds", lateness="0 seconds", ts: str = "ts",
               seq: str = "seq", blocks: int | None = None) -> DataFrame:
    """Tag rows ``late`` / ``on_time`` -> input columns + watermark, last_window_end, tag."""
    dtype = df.schema[ts].dataType
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    delay_us, late_us = duration_us(delay), duration_us(lateness)
    us = to_micros(ts, dtype)
    per_seq = row_blocks(df.groupBy(F.col(seq).alias("__seq")).agg(F.max(us).alias("__mx")),
                         [], ["__seq"], "__blk", blocks, counted=df.select(seq))
    wm = global_running(per_seq, ["__seq"], "__mx", "__blk", "__before", how="max", inclusive=False) \
        .select("__seq", (F.col("__before") - F.lit(delay_us)).alias("__wm"))
    x = df.withColumn("__us", us).join(wm, F.col(seq) == F.col("__seq"), "left").drop("__seq")
    last_end = floor_div(F.col("__us"), slide_us) * F.lit(slide_us) + F.lit(size_us)
    x = x.withColumn("__end", last_end)
    late = F.col("__wm").isNotNull() & (F.col("__end") - F.lit(1) + F.lit(late_us) <= F.col("__wm"))
    return (x.withColumn("watermark", from_micros(F.col("__wm"), dtype))
            .withColumn("last_window_end", from_micros(F.col("__end"), dtype))
            .withColumn("tag", F.when(late, F.lit("late")).otherwise(F.lit("on_time")))
            .drop("__us", "__wm", "__end"))


def kept_window_counts(tagged: DataFrame, size, slide=None, *, ts: str = "ts") -> DataFrame:
    """Window counts of the on-time rows (the main output next to the late side output)."""
    kept = tagged.where(F.col("tag") == "on_time")
    return window_counts(kept, ts, [], size, slide).select("window_end", "cnt")
