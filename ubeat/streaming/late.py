"""W4 on streams: split each micro-batch into on-time and late rows.

Spark drops rows behind the watermark before any stateful operator sees them,
so the side output is produced in ``foreachBatch``: a batch is tagged against
the watermark left by the earlier batches (max event time seen - delay), with
the batch rule of ``ubeat.operators.late`` (a micro-batch is one arrival unit).
The running max is one number per epoch, kept in a small table under the
query's shared checkpoint folder: a restarted query resumes it and a replayed
epoch rewrites the same value (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ubeat.functions.time import duration_us, floor_div, from_micros, to_micros


def _previous(spark: SparkSession, state_path: str, epoch_id: int) -> int | None:
    """Maximum left by the latest epoch before this one; older ones are removed.
    Only a missing folder means that there is none: a damaged one is an error."""
    root = spark._jvm.org.apache.hadoop.fs.Path(state_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    epochs = sorted(int(s.getPath().getName().removeprefix("epoch=")) for s in fs.listStatus(root))
    before = [e for e in epochs if e < epoch_id]
    for e in before[:-2]:  # a replayed epoch still finds the one before it
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{state_path.rstrip('/')}/epoch={e}"), True)
    return spark.read.parquet(f"{state_path.rstrip('/')}/epoch={before[-1]}").first().max_us if before else None


def late_splitter(size, slide=None, *, delay="0 seconds", lateness="0 seconds", ts: str = "ts",
                  state_path: str, sink: Callable[[DataFrame, int], None]):
    """A ``foreachBatch`` function: tag rows (``watermark``, ``tag``) and hand them to ``sink``."""
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    delay_us, late_us = duration_us(delay), duration_us(lateness)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        dtype = batch.schema[ts].dataType
        prev = _previous(spark, state_path, epoch_id)
        us = to_micros(ts, dtype)
        end = floor_div(us, slide_us) * F.lit(slide_us) + F.lit(size_us)
        wm = F.lit(None).cast("long") if prev is None else F.lit(prev - delay_us)
        late = wm.isNotNull() & (end - F.lit(1) + F.lit(late_us) <= wm)
        tagged = (batch.withColumn("watermark", from_micros(wm, dtype))
                  .withColumn("tag", F.when(late, F.lit("late")).otherwise(F.lit("on_time"))))
        sink(tagged, epoch_id)
        mx = batch.agg(F.max(us)).first()[0]
        new = max(v for v in (prev, mx) if v is not None) if (prev is not None or mx is not None) else None
        if new is not None:
            (spark.createDataFrame([(int(epoch_id), int(new))], "epoch long, max_us long")
             .write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/epoch={int(epoch_id)}"))

    return run
