"""Mixing sources to target weights (DataFrame functions only).

Words are summed per source, targets are the weights' shares of all words with
a ceiling of ``cap`` times the source (water filling in closed form), a
source's repetition rate is target / size, and a document is emitted
``floor(rate)`` times plus once more when a number in [0, 1) hashed from its id
and the seed is below the rate's fraction.

Edge cases: a null text has size 0; a null source is a source of its own, last
in order; a source without words has target and rate 0; a null doc_id draws as
the text ``null``; rows with the same doc_id draw alike; extra columns pass
through (a clash with an added column is overwritten by the added one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ubeat.llm.common import WORD_RE, checkpoint

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17
#: Sources whose targets go to every task; beyond that the join shuffles.
MAX_BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_RE)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size).

    The rows of a source, however many, are summed map-side first; the windows
    below run over one row per source. Ordered by cap/weight, the water level
    before a source's turn is (words left) / (weights left); the level rises
    while sources fill up and falls after the first that does not, so its
    maximum is the final one.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                                                (turn + 1).cast("int")))
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("left", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
           .withColumn("weights_left", F.sum("weight").over(everything)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("level", F.max(F.col("left") / F.col("weights_left")).over(everything)))
    target = F.least((cap * F.col("source_size")).cast("double"), F.col("weight") * F.col("level"))
    return per.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often it is taken)."""
    sized = docs.withColumn("size", word_count(F.col("text")))
    per = source_targets(sized.select("source", "size"), weights, cap).withColumnRenamed("source", "_source")
    per = checkpoint(per)
    if per.count() <= MAX_BROADCAST_SOURCES:
        per = F.broadcast(per)  # so that a hot source's documents are not shuffled to one task
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + F.when(draw(F.col("doc_id"), seed) < rate - whole, 1).otherwise(0)
    sized = sized.drop("source_size", "target", "copies", "_source")
    return (sized.join(per, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
            .withColumn("copies", copies.cast("long")))


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, columns unchanged."""
    out = mixed(docs, weights, cap, seed).where("copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_mix_sources(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target",
                              (F.col("copies") * F.col("size")).alias("taken"))


def sql(documents: str = "documents") -> str:
    """DuckDB: doc_id, source, size, source_size, target, copies of ``documents``."""
    return f"""
WITH sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM {documents}),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS lv
  FROM per
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least({CAP}::DOUBLE * source_size, weight * (SELECT max(lv) FROM levels)) AS target
  FROM levels),
rated AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || md5('{SEED}:' || coalesce(s.doc_id::VARCHAR, 'null'))[1:13])::BIGINT / {float(1 << 52)} AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT * EXCLUDE (rate, u), (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM rated"""


SQL = f"SELECT doc_id, size, source_size, target, copies * size AS taken FROM ({sql()})"
