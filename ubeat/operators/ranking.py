"""Per-window ranking, Top-N and the text report.

Ties on the count are broken by the id ascending (the reference keeps arrival
order, which a distributed sort cannot reproduce).  ``row_number() <= n`` lets
Catalyst insert a WindowGroupLimit, i.e. a map-side top-n per partition before
the shuffle, so only ``n`` rows per window and map task cross the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ubeat.functions.time import duration_us, interval_str

# The reference's report text (header, rank prefix, labels, rule).
REPORT_HEADER = "窗口结束时间："
REPORT_RANK = "NO"
ITEM_LABEL = "商品ID="
PAGE_LABEL = "页面URL="
COUNT_LABEL = "热门度="
REPORT_RULE = "=============================\n\n"


def top_n(df: DataFrame, partition: Sequence[str], order_desc: str, tiebreak: Sequence[str], n: int,
          rank_col: str = "row_num") -> DataFrame:
    """Keep the ``n`` rows with the largest ``order_desc`` per partition."""
    w = Window.partitionBy(*partition).orderBy(F.col(order_desc).desc(), *[F.col(c).asc() for c in tiebreak])
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= n)


def hot_items(item_counts: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` items per window end -> item_id, window_end, cnt, row_num."""
    return top_n(item_counts, ["window_end"], "cnt", ["item_id"], n)


def hot_pages(page_counts: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` urls per window end -> url, window_end, cnt, row_num."""
    return top_n(page_counts, ["window_end"], "cnt", ["url"], n)


def hot_items_sql(spark: SparkSession, view: str, size="1 hour", slide="5 minutes", n: int = 5) -> DataFrame:
    """A3 + R2: hop-window counting and Top-N in one SQL text over ``view``.

    ``view`` needs item_id, behavior and ts columns.
    """
    size_s, slide_s = interval_str(duration_us(size)), interval_str(duration_us(slide))
    return spark.sql(f"""
        WITH counted AS (
          SELECT window(ts, '{size_s}', '{slide_s}') AS w, item_id, count(*) AS cnt
          FROM {view} WHERE behavior = 'pv' GROUP BY ALL),
        ranked AS (
          SELECT item_id, w.end AS window_end, cnt,
                 CAST(row_number() OVER (PARTITION BY w.end ORDER BY cnt DESC, item_id) AS BIGINT) AS row_num
          FROM counted)
        SELECT * FROM ranked WHERE row_num <= {int(n)}
    """)


def report_time(c) -> F.Column:
    """Timestamp text like ``java.sql.Timestamp.toString``: fraction trimmed, at least ``.0``."""
    full = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    trimmed = F.regexp_replace(full, "0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def format_report(ranked: DataFrame, id_col: str, label: str = ITEM_LABEL, *, count_col: str = "cnt",
                  rank_col: str = "row_num", window_col: str = "window_end") -> DataFrame:
    """One text block per window -> window_end, report.

    Each window holds at most ``n`` ranked rows, so gathering them is bounded.
    """
    line = F.concat(F.lit(REPORT_RANK), F.col(rank_col).cast("string"), F.lit(": \t"), F.lit(label),
                    F.col(id_col).cast("string"), F.lit("\t"), F.lit(COUNT_LABEL),
                    F.col(count_col).cast("string"), F.lit("\n"))
    grouped = ranked.groupBy(window_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), line.alias("l")))).alias("lines"))
    body = F.array_join(F.transform("lines", lambda s: s["l"]), "")
    text = F.concat(F.lit(REPORT_HEADER), report_time(F.col(window_col)), F.lit("\n"), body, F.lit(REPORT_RULE))
    return grouped.select(window_col, text.alias("report"))
