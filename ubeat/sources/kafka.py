"""Kafka line source and sink.

They need the ``spark-sql-kafka-0-10`` package on the cluster's classpath; the
option builders are plain functions so the parsing that follows (I1–I6 on the
``value`` column) is exercised with file streams in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(servers: str, topic: str, starting_offsets: str = "latest",
                         group_id: str | None = None) -> dict[str, str]:
    """Options of the reference's consumer: subscribe to one topic, start at latest."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_lines(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                stream: bool = True) -> DataFrame:
    """Message values of ``topic`` as text lines (``value``), with ``partition``,
    ``offset`` and the broker's ``arrived`` time; ``seq=["partition", "offset"]``
    is the arrival order of the rows of a key that the producer keeps in one
    partition."""
    reader = spark.readStream if stream else spark.read
    opts = kafka_source_options(servers, topic, starting_offsets if stream else "earliest")
    return reader.format("kafka").options(**opts).load().select(
        F.col("value").cast("string").alias("value"), "partition", "offset", F.col("timestamp").alias("arrived"))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish_lines(df: DataFrame, servers: str, topic: str, value: str = "value",
                  checkpoint: str | None = None):
    """I8: publish each line as one message; distributed (every task writes its part).

    Batch DataFrames are written once; streaming ones return the started query.
    """
    out = df.select(F.col(value).cast("string").alias("value"))
    opts = kafka_sink_options(servers, topic)
    if df.isStreaming:
        w = out.writeStream.format("kafka").options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    out.write.format("kafka").options(**opts).save()
    return None
