"""Tagged outputs (I9): a main result and its side outputs in one pass.

The reference prints a main stream and named side outputs.  Here an operator
returns one DataFrame with a ``tag`` column; the sink writes it partitioned by
tag, so every side output lands in its own folder without recomputing the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tagged(df: DataFrame, path: str, tag: str = "tag", mode: str = "append",
                 checkpoint: str | None = None, fmt: str = "parquet", trigger: dict | None = None):
    """Write ``df`` to ``path/<tag>=<value>/``; streams need a checkpoint location."""
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming sink needs a checkpoint location on shared storage")
        w = (df.writeStream.format(fmt).partitionBy(tag).option("path", path)
             .option("checkpointLocation", checkpoint).outputMode("append"))
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    df.write.mode(mode).partitionBy(tag).format(fmt).save(path)
    return None


def side_output(df: DataFrame, name: str, tag: str = "tag") -> DataFrame:
    """Rows of one named output (the reference's ``getSideOutput``)."""
    return df.where(F.col(tag) == name).drop(tag)
