"""Click-fraud filter (P1) with optional daily reset.

Per key (user, ad) in arrival order: the first ``limit`` clicks pass, the next
one raises a single warning, the rest are suppressed silently.

Plan: ``row_number() <= limit + 1`` over (key [, local day]) by ``seq``.  Catalyst
turns this into a WindowGroupLimit that already runs *before* the shuffle, so a
hot key (one key may hold a third of all clicks) ships at most ``limit + 1``
rows per map task; the suppressed clicks never leave their map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the reference's warning text (limit substituted).
WARNING_TEXT = "Click ad over {limit} times today."


def local_day(ts: str, dtype: T.DataType, tz: str) -> F.Column:
    """Calendar day of ``ts`` in zone ``tz`` (NTZ values are taken as UTC)."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts)))
    return F.to_date(F.from_utc_timestamp(F.col(ts), tz))


def click_fraud_filter(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), limit: int = 100, *,
                       seq: str = "seq", ts: str = "ts", reset: str | None = None,
                       tz: str = "+08:00") -> DataFrame:
    """Tag clicks ``pass`` / ``warning``; suppressed clicks are not returned.

    ``reset='daily'`` restarts the count at local midnight in ``tz`` (the
    reference's evident intent, UTC+8); ``None`` never resets, as the reference
    actually behaves.  Output: input columns + ``tag`` + ``msg``.
    """
    part = [F.col(k) for k in keys]
    if reset == "daily":
        part.append(local_day(ts, df.schema[ts].dataType, tz))
    elif reset is not None:
        raise ValueError("reset must be None or 'daily'")
    w = Window.partitionBy(*part).orderBy(F.col(seq).asc())
    ranked = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= limit + 1)
    return (ranked
            .withColumn("tag", F.when(F.col("__rn") <= limit, F.lit("pass")).otherwise(F.lit("warning")))
            .withColumn("msg", F.when(F.col("__rn") > limit, F.lit(WARNING_TEXT.format(limit=limit))))
            .drop("__rn"))


def passed(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("tag") == "pass").drop("tag", "msg")


def warnings(tagged: DataFrame, keys: Sequence[str] = ("user_id", "ad_id")) -> DataFrame:
    """The side output: (keys..., msg) once per blacklisted key."""
    return tagged.where(F.col("tag") == "warning").select(*keys, "msg")
