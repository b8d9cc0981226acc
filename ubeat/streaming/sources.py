"""Streaming inputs: parquet tables and text files as unbounded DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet file(s) of the table ``<dir>/<name>.parquet`` as they appear.

    The schema comes from the parquet footers of a static read (no inference
    pass over the data); a file source needs a directory or a glob, and the glob
    ``<name>.parque[t]`` matches this table alone.
    """
    base = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("basePath", base)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{base}/{name}.parque[t]")


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP: NTZ event times are read as UTC wall clock."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df
