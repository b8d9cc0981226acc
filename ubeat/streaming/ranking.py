"""Top-N and reports on streams (R3, R4, R5): windowed counts, ranked per micro-batch.

Ranking needs no stream state: the counts are a plain stream aggregate, and each
micro-batch of counts is an ordinary DataFrame that the batch operators rank
(``foreachBatch``), with their partial limits before the shuffle.  An epoch's
result goes to a folder of its own and a replayed epoch overwrites it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ubeat.functions.time import duration_us, interval_str, to_micros
from ubeat.operators.ranking import top_n
from ubeat.streaming.sources import event_time
from ubeat.streaming.windows import windows_from_panes


def each_batch(transform: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: ``transform(batch)`` to ``path/epoch=<id>``.

    With append-mode counts a batch holds whole closed windows, so ranking (R3)
    or formatting (R5) them by batch is exact."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
    return run


def changing_panes(log: DataFrame, size="10 minutes", slide="5 seconds", *, key: str = "url", ts: str = "ts",
                   delay="1 second", lateness="1 minute", method: str | None = "GET") -> DataFrame:
    """R4's counts, for update mode: pane (start), key, cnt, seen (latest event time).

    Counts are kept per pane of gcd(size, slide), not per window, so no row is expanded.
    A pane accepts rows until ``lateness`` after its last window was first ranked: the
    watermark trails by ``delay + lateness + size`` and its state ends then (W3)."""
    size_us, pane_us = duration_us(size), math.gcd(duration_us(size), duration_us(slide))
    src = event_time(log if method is None else log.where(F.col("method") == method), ts) \
        .withWatermark(ts, interval_str(duration_us(delay) + duration_us(lateness) + size_us))
    return (src.groupBy(F.window(ts, interval_str(pane_us)).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("cnt"), F.max(ts).alias("seen"))
            .select(F.col("w.start").alias("pane"), key, "cnt", "seen"))


class PaneStore:
    """The last count of every (pane, key) that a ranking can still need.

    Panes are stored by time bucket. An epoch writes new versions of the buckets that it
    changes under ``epoch=<id>`` and a manifest of the versions in force; buckets whose
    windows are final leave the manifest, and versions that neither this manifest nor the
    one before it names are deleted. So an epoch reads and writes the changed and due
    buckets only, however many epochs there were, and a replayed epoch starts from the
    manifest before it and writes the same again.
    """

    def __init__(self, spark: SparkSession, base: str, bucket_us: int):
        self.spark, self.base, self.bucket_us = spark, base.rstrip("/"), bucket_us
        self.root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest")
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _epochs(self, name: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        if not self.fs.exists(path):
            return []
        return sorted(int(s.getPath().getName().removeprefix("epoch=")) for s in self.fs.listStatus(path))

    def before(self, epoch: int) -> tuple[int | None, dict[int, int]]:
        """(event time reached, bucket -> version) left by the epoch before this one."""
        found = [e for e in self._epochs("manifest") if e < epoch]
        if not found:
            return None, {}
        rows = self.spark.read.parquet(f"{self.base}/manifest/epoch={found[-1]}").collect()
        return rows[0].reached, {r.bucket: r.version for r in rows if r.bucket is not None}

    def read(self, buckets, versions: dict[int, int], schema) -> DataFrame:
        paths = [f"{self.base}/panes/epoch={versions[b]}/bucket={b}" for b in sorted(buckets) if b in versions]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, panes: DataFrame, epoch: int) -> None:
        # Tasks write neighbouring buckets: at most a file per bucket and task, not their product.
        panes.repartitionByRange("bucket", "pane").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.base}/panes/epoch={epoch}")

    def finish(self, epoch: int, reached: int, versions: dict[int, int], earlier: dict[int, int]) -> None:
        rows = [(int(epoch), int(reached), b, v) for b, v in versions.items()] or [(int(epoch), int(reached), None, None)]
        self.spark.createDataFrame(rows, "epoch long, reached long, bucket long, version long").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.base}/manifest/epoch={epoch}")
        named = {*versions.values(), *earlier.values(), epoch}
        for name, keep in (("panes", named), ("manifest", set(self._epochs("manifest")[-2:]))):
            for e in self._epochs(name):
                if e not in keep and e < epoch:
                    self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}/epoch={e}"), True)


def revised_top_n(base: str, n: int = 3, size="10 minutes", slide="5 seconds", *, key: str = "url", delay="1 second",
                  lateness="1 minute", bucket="1 hour") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over ``changing_panes`` in update mode.

    A window is ranked once the event time seen so far, less ``delay``, reaches its end,
    and again whenever rows at most ``lateness`` late change it.
    -> ``base/ranked``: window_end, key, cnt, row_num, epoch.
    """
    size_us, late_us, delay_us = duration_us(size), duration_us(lateness), duration_us(delay)
    bucket_us = max(duration_us(bucket), size_us)

    def run(batch: DataFrame, epoch_id: int) -> None:
        # Kept: every use of the batch would run the stream's state again.
        batch = batch.persist()
        try:
            rank(batch, epoch_id)
        finally:
            batch.unpersist()

    def rank(batch: DataFrame, epoch_id: int) -> None:
        store = PaneStore(batch.sparkSession, base, bucket_us)
        dtype = batch.schema["seen"].dataType
        seen, versions = store.before(epoch_id)
        at = F.floor(to_micros("pane", dtype) / bucket_us)
        changed = {r.b: r.us for r in batch.groupBy(at.alias("b")).agg(F.max(to_micros("seen", dtype)).alias("us")).collect()}
        if not changed:
            return
        earlier = seen if seen is not None else -(1 << 62)
        reached = max(earlier, max(changed.values()) - delay_us)
        panes = batch.select("pane", key, "cnt")
        new = panes.withColumn("v", F.lit(1)).unionByName(store.read(changed, versions, panes.schema).withColumn("v", F.lit(0)))
        new = new.groupBy("pane", key).agg(F.max_by("cnt", "v").alias("cnt")).withColumn("bucket", at)
        store.write(new, epoch_id)
        held = versions | dict.fromkeys(changed, epoch_id)
        # Panes of all windows that are due now or that a changed pane is in.
        due = {b for b in held if (b + 1) * bucket_us > earlier - size_us and b * bucket_us < reached}
        near = due | {b + d for b in changed for d in (-1, 0, 1)}
        counts = windows_from_panes(store.read(near, held, panes.schema).withColumnRenamed("pane", "window_start"),
                                    [key], size, slide)
        touched = windows_from_panes(panes.withColumnRenamed("pane", "window_start"), [], size, slide).select("window_end")
        end = to_micros("window_end", dtype)
        counts = counts.where(end <= reached)
        ranked = counts.where(end > earlier).unionByName(
            counts.where((end <= earlier) & (end + late_us > earlier)).join(touched, "window_end", "left_semi"))
        top_n(ranked, ["window_end"], "cnt", [key], n).select("window_end", key, "cnt", "row_num") \
            .write.mode("overwrite").parquet(f"{base}/ranked/epoch={epoch_id}")
        final = reached - late_us - size_us
        store.finish(epoch_id, reached, {b: v for b, v in held.items() if (b + 1) * bucket_us > final}, versions)
    return run
