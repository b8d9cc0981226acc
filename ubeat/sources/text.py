"""Readers for the reference's positional text formats.

Every reader takes an explicit schema (no inference), turns epoch seconds into
event time and works for both ``spark.read`` and ``spark.readStream``.

Operators that are defined in arrival order need to know it.  Batch reads get a
dense ``seq``: files in order of their paths, lines in order inside a file,
however Spark packs the files into tasks.  Stream reads get ``file`` and ``seq``,
the line's position in its file, which order the lines of a micro-batch
(``seq=["file", "seq"]`` for the stream operators); the batches themselves come
in order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ubeat.functions.time import epoch_seconds_to_ts, from_micros, to_micros

USER_BEHAVIOR = "user_id LONG, item_id LONG, category INT, behavior STRING, ts_s LONG"
AD_CLICK = "user_id LONG, ad_id LONG, province STRING, city STRING, ts_s LONG"
LOGIN = "user_id LONG, ip STRING, event_type STRING, ts_s LONG"
ORDER = "order_id LONG, event_type STRING, tx_id STRING, ts_s LONG"
RECEIPT = "tx_id STRING, pay_channel STRING, ts_s LONG"
MARKET = "user_id STRING, behavior STRING, channel STRING, ts_ms LONG"


def _read_csv(spark: SparkSession, path: str, schema: str, stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    # PERMISSIVE keeps malformed lines as null fields; they are dropped below.
    return in_arrival_order(reader.schema(schema).option("mode", "PERMISSIVE").csv(path))


def in_arrival_order(lines: DataFrame) -> DataFrame:
    """Rows read from files with ``seq`` (and ``file`` on a stream), see above.

    A split is read from start to end by one task.  Batch: the rows per split, a
    table with one row per split, say how many rows come before it.  Stream: a
    line's number in its split plus the split's first byte, which no later split
    of the file falls below, as a line has a byte at least.
    """
    named = lines.select("*", F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("__at"))
    if lines.isStreaming:
        schema = T.StructType([*lines.schema.fields, T.StructField("file", T.StringType()),
                               T.StructField("seq", T.LongType())])
        return named.mapInArrow(_numbered, schema)
    named = named.withColumn("__id", F.monotonically_increasing_id())
    splits = named.groupBy("file", "__at").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = Window.orderBy("file", "__at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return (named.join(splits, ["file", "__at"])
            .withColumn("seq", F.col("__before") + F.col("__id") - F.col("__first"))
            .select(*lines.columns, "seq"))


def _numbered(batches):
    split, done = None, 0
    for batch in batches:
        names, starts = batch.column("file").to_pylist(), batch.column("__at").to_pylist()
        seq = []
        for here in zip(names, starts, strict=True):
            if here != split:
                split, done = here, 0
            seq.append(here[1] + done)
            done += 1
        keep = [batch.column(c) for c in batch.schema.names if c != "__at"]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(seq, pa.int64())],
                                         [c for c in batch.schema.names if c != "__at"] + ["seq"])


def _finish(df: DataFrame, ntz: bool, ts_col: str = "ts_s", unit: str = "s") -> DataFrame:
    if unit == "s":
        ts = epoch_seconds_to_ts(ts_col, ntz=ntz)
    else:
        us = F.col(ts_col).cast("long") * F.lit(1000)
        ts = from_micros(us, T.TimestampNTZType() if ntz else T.TimestampType())
    return df.where(F.col(ts_col).isNotNull()).withColumn("ts", ts).drop(ts_col)


def read_user_behavior(spark: SparkSession, path: str, stream: bool = False, ntz: bool | None = None) -> DataFrame:
    """``user_id,item_id,category,behavior,epoch_seconds`` lines."""
    return _finish(_read_csv(spark, path, USER_BEHAVIOR, stream), ntz if ntz is not None else not stream)


def read_ad_clicks(spark: SparkSession, path: str, stream: bool = False, ntz: bool | None = None) -> DataFrame:
    """``user_id,ad_id,province,city,epoch_seconds`` lines."""
    return _finish(_read_csv(spark, path, AD_CLICK, stream), ntz if ntz is not None else not stream)


def read_logins(spark: SparkSession, path: str, stream: bool = False, ntz: bool | None = None) -> DataFrame:
    """``user_id,ip,event_type,epoch_seconds`` lines."""
    return _finish(_read_csv(spark, path, LOGIN, stream), ntz if ntz is not None else not stream)


def read_orders(spark: SparkSession, path: str, stream: bool = False, ntz: bool | None = None) -> DataFrame:
    """I4: ``order_id,event_type,tx_id,epoch_seconds``; an empty tx_id becomes null."""
    df = _finish(_read_csv(spark, path, ORDER, stream), ntz if ntz is not None else not stream)
    return df.withColumn("tx_id", F.when(F.length("tx_id") > 0, F.col("tx_id")))


def read_receipts(spark: SparkSession, path: str, stream: bool = False, ntz: bool | None = None) -> DataFrame:
    """``tx_id,pay_channel,epoch_seconds`` lines."""
    return _finish(_read_csv(spark, path, RECEIPT, stream), ntz if ntz is not None else not stream)


def read_market(spark: SparkSession, path: str, stream: bool = False, ntz: bool | None = None) -> DataFrame:
    """Marketing behaviour lines ``user_id,behavior,channel,epoch_millis``."""
    return _finish(_read_csv(spark, path, MARKET, stream), ntz if ntz is not None else not stream,
                   ts_col="ts_ms", unit="ms")


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Raw text lines as ``value``, in arrival order like the records."""
    return in_arrival_order((spark.readStream if stream else spark.read).text(path))


def parse_access_log(lines: DataFrame, value: str = "value", ntz: bool = True) -> DataFrame:
    """``ip - user - dd/MM/yyyy:HH:mm:ss zone method url`` -> ApacheLogEvent.

    Hours, minutes and seconds are lenient (second 60–63 rolls into the next
    minute, as the reference's parser does): the date is built from its integer
    fields and the time of day added as a duration — no formatter, no regex.
    The zone field is ignored and the time read as UTC; lines with fewer than
    7 fields (blank lines) or an invalid date are dropped.

    The record is built in plain projections (codegen, the line split once) and
    invalid lines are dropped by a generator over that record: a ``where`` on
    the parsed fields would be pushed below the projections and re-evaluate the
    split (and whatever produced the line) once per predicate.
    """
    keep = [c for c in lines.columns if c != value]
    f = F.col("__f")
    d = F.split(F.get(f, 3), "[/:]")
    day = F.call_function("try_make_timestamp_ntz", F.get(d, 2).try_cast("int"), F.get(d, 1).try_cast("int"),
                          F.get(d, 0).try_cast("int"), F.lit(0), F.lit(0), F.lit(0))
    secs = F.get(d, 3).try_cast("long") * 3600 + F.get(d, 4).try_cast("long") * 60 + F.get(d, 5).try_cast("long")
    ts_ntz = F.timestamp_add("SECOND", secs, day)
    ts = ts_ntz if ntz else from_micros(to_micros(ts_ntz, T.TimestampNTZType()), T.TimestampType())
    rec = F.struct(F.get(f, 0).alias("ip"), F.get(f, 1).alias("user_id"), ts.alias("ts"), F.get(f, 5).alias("method"),
                   F.get(f, 6).alias("url"), (F.size(f) >= 7).alias("ok"))
    records = (lines.select(F.split(F.col(value), " ").alias("__f"), *keep)
               .select(rec.alias("__r"), *keep))
    valid = F.filter(F.array("__r"), lambda r: r["ok"] & r["ts"].isNotNull())
    return records.select(F.inline(valid), *keep).drop("ok")


def parse_lines(lines: DataFrame, schema: str, value: str = "value", ntz: bool | None = None) -> DataFrame:
    """Comma lines in a ``value`` column (a Kafka topic, a text stream) -> typed records.

    ``schema`` is one of the record schemas above (``USER_BEHAVIOR``, ``AD_CLICK``,
    ``LOGIN``, ``ORDER``, ``RECEIPT``, ``MARKET``): fields are parsed natively
    with ``from_csv``, the epoch field becomes ``ts`` as in the file readers,
    and lines whose time does not parse are dropped.  Other columns of
    ``lines`` (e.g. ``seq``) are kept.
    """
    keep = [c for c in lines.columns if c != value]
    recs = lines.select(F.from_csv(F.col(value), schema, {"mode": "PERMISSIVE"}).alias("__r"), *keep) \
        .select("__r.*", *keep)
    ms = "ts_ms" in recs.columns
    df = _finish(recs, ntz=ntz if ntz is not None else not lines.isStreaming,
                 ts_col="ts_ms" if ms else "ts_s", unit="ms" if ms else "s")
    if schema == ORDER:
        df = df.withColumn("tx_id", F.when(F.length("tx_id") > 0, F.col("tx_id")))
    return df
