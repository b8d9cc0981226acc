"""Hard negatives by segment summaries.

A vector is cut into segments and each segment keeps its mean and deviation.
With m components, means u, v and deviations s, t (roots of the summed squared
differences from the mean), a segment's part of an inner product lies in
``m*u*v - s*t .. m*u*v + s*t``; the sums over the segments bound the score. The
bounds are refined from one segment to two, four, ... and a row drops out as
soon as its bounds leave every wanted range of scores or fall under the k-th
score that is already certain; what is left is scored exactly.

Anchors are a set of rows judged against all rows, in blocks: rows are dealt by
hash to groups of bounded size, a task holds one group with its summaries, and
all anchors stream past it. Each group answers with its best few rows per
anchor, which are ranked once more. Two passes: same-label rows give the
positives, whose scores are the ranges of the second pass.

Scores are exact integers (float products below 2^53, Python integers beyond;
reported scores are held to 64 bits).

Edge cases: rows without an id or label, with a null vector or any null or
non-finite component take no part; of rows with one id the smallest (label,
vector) stands for all; shorter vectors count as padded with zeros, an empty one
scores 0; ties go to the smaller id; anchors without positives and positives
without fitting negatives give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ubeat.llm.common import checkpoint, table

#: Rows of a group, which one task holds with their summaries, and anchors
#: handled at once (both bound memory, neither changes a result).
GROUP_ROWS = 1 << 16
ANCHORS_AT_ONCE = 32
#: Components of the shortest segment.
SHORTEST = 4
_LONG = (1 << 63) - 1
_DTYPES = (np.int8, np.int16, np.int32, np.int64)


# --------------------------------------------------------------- preparation

def scaled(column: Column, factor: int = 256) -> Column:
    """Components as integers: floor(factor * component)."""
    return F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))


def usable(vec_id: Column, label: Column, vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return vec_id.isNotNull() & label.isNotNull() & vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec): integer vectors in the narrowest bytes, headed by the width."""
    def run(batches):
        for batch in batches:
            out = []
            for vector in batch.column(2):
                v = np.asarray(vector.values, np.int64)
                width = next(d for d in _DTYPES if not len(v) or np.iinfo(d).min <= v.min() and v.max() <= np.iinfo(d).max)
                out.append(bytes([_DTYPES.index(width)]) + v.astype(width).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "vec"])

    return vectors.mapInArrow(run, "vec_id long, label long, vec binary")


def _unpack(vec: bytes) -> np.ndarray:
    return np.frombuffer(vec, _DTYPES[vec[0]], offset=1)


# ------------------------------------------------------------ segment summaries

def levels(width: int) -> list[int]:
    """Numbers of segments, coarse to fine, of vectors padded to ``width``."""
    out = [1]
    while width // (2 * out[-1]) >= SHORTEST:
        out.append(2 * out[-1])
    return out


def padded_width(components: int) -> int:
    """A width all levels divide."""
    step = 1
    while components / step > 2 * SHORTEST - 1:
        step *= 2
    return max(step * math.ceil(components / step), 1)


def summaries(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(means times sqrt(m), deviations) of every segment; x is rows by width."""
    parts = x.reshape(len(x), segments, x.shape[1] // segments)
    mean = parts.mean(axis=2)
    deviation = np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))
    return mean * math.sqrt(parts.shape[2]), deviation


class _Vectors:
    """Vectors of one width with their summaries of all levels."""

    def __init__(self, vectors: list[np.ndarray], width: int):
        self.exact = vectors
        self.x = np.zeros((len(vectors), width))
        for row, v in zip(self.x, vectors, strict=True):
            row[:len(v)] = v
        self.largest = float(np.abs(self.x).max(initial=0.0))
        self.norm = np.sqrt((self.x ** 2).sum(axis=1))
        self.levels = [summaries(self.x, s) for s in levels(width)]


def _scores(rows: _Vectors, at: np.ndarray, anchors: _Vectors) -> np.ndarray:
    """Exact inner products, rows by anchors."""
    if rows.largest * anchors.largest * rows.x.shape[1] < 2 ** 53:
        return rows.x[at] @ anchors.x.T
    out = np.empty((len(at), len(anchors.exact)), object)
    for i, r in enumerate(at):
        a = rows.exact[r]
        for j, b in enumerate(anchors.exact):
            out[i, j] = sum(int(x) * int(y) for x, y in zip(a, b, strict=False))
    return out


class Group:
    """A bounded group of rows that anchors are held against."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]):
        self.ids, self.labels, self.raw = ids, labels, vectors
        self.longest = max(map(len, vectors), default=0)
        self.made: dict[int, _Vectors] = {}
        self.tried = self.scored = 0

    def vectors(self, width: int) -> _Vectors:
        if width not in self.made:
            self.made = {width: _Vectors(self.raw, width)}
        return self.made[width]

    def best(self, anchor_ids: np.ndarray, label: int, raw: list[np.ndarray], same: bool,
             ranges: list[list[tuple[float, float]]], k: int):
        """For anchors of one label: (anchor, range, ids, scores) of the first ``k`` rows
        with the anchor's label (``same``) or another, for each wanted range of scores."""
        width = padded_width(max(self.longest, *map(len, raw)))
        rows, anchors = self.vectors(width), _Vectors(raw, width)
        at = np.flatnonzero((self.labels == label) if same else (self.labels != label))
        alive = self.ids[at][:, None] != anchor_ids[None, :]
        self.tried += alive.size
        most = max(map(len, ranges))
        lo, hi = np.full((most, len(raw)), np.inf), np.full((most, len(raw)), -np.inf)  # no range: nothing fits
        for j, wanted in enumerate(ranges):
            for i, (a, b) in enumerate(wanted):
                lo[i, j], hi[i, j] = a, b
        for (mean, dev), (a_mean, a_dev) in zip(rows.levels, anchors.levels, strict=True):
            if not len(at):
                break
            middle = mean[at] @ a_mean.T
            slack = dev[at] @ a_dev.T + 1e-9 * np.outer(rows.norm[at], anchors.norm) + 1e-6
            low, high = middle - slack, middle + slack
            keep = np.zeros_like(alive)
            for a, b in zip(lo, hi, strict=True):
                fits = (high >= a) & (low <= b) & alive
                certain = fits & (low >= a) & (high <= b)
                for j in np.flatnonzero(certain.sum(axis=0) >= k):
                    sure = low[certain[:, j], j]
                    fits[:, j] &= high[:, j] >= np.partition(sure, len(sure) - k)[len(sure) - k]
                keep |= fits
            alive = keep
            some = alive.any(axis=1)
            at, alive = at[some], alive[some]
        self.scored += int(alive.sum())
        scores = _scores(rows, at, anchors)
        for j, wanted in enumerate(ranges):
            mine = np.flatnonzero(alive[:, j])
            got = scores[mine, j]
            for i, (a, b) in enumerate(wanted):
                inside = np.flatnonzero((got >= a) & (got <= b))
                values = got[inside]
                if len(inside) > k and values.dtype != object:
                    least = np.partition(values, len(values) - k)[len(values) - k]
                    inside = inside[values >= least]
                # Rows stand in the order of their ids, so a stable sort breaks ties.
                first = sorted(inside, key=lambda r: -got[r])[:k]
                yield j, i, self.ids[at[mine[first]]], [max(-_LONG - 1, min(int(got[r]), _LONG)) for r in first]


# ---------------------------------------------------------------- the two passes

_FOUND = pa.schema([("anchor_id", pa.int64()), ("of_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _pass(rows: DataFrame, anchors: DataFrame, groups: int, same: bool, k: int, low_pct: int, high_pct: int) -> DataFrame:
    """(anchor_id, of_score, vec_id, score): each group's first ``k`` rows for every
    anchor, and for every score in its ``scores`` if negatives are wanted."""
    def wanted(scores):
        if same:
            return [(-math.inf, math.inf)]
        # low_pct * s <= 100 * x <= high_pct * s in integers
        return [(-(-low_pct * s // 100), high_pct * s // 100) for s in scores]

    def answers(group, waiting):
        out = [[], [], [], []]
        by_label: dict[int, list] = {}
        for row in waiting:
            by_label.setdefault(row[1], []).append(row)
        for label, own in by_label.items():
            for i in range(0, len(own), ANCHORS_AT_ONCE):
                some = own[i:i + ANCHORS_AT_ONCE]
                found = group.best(np.array([r[0] for r in some]), label, [_unpack(r[2]) for r in some], same,
                                   [wanted(r[3]) for r in some], k)
                for j, which, ids, scores in found:
                    out[0] += [some[j][0]] * len(ids)
                    out[1] += [None if same else some[j][3][which]] * len(ids)
                    out[2] += ids.tolist()
                    out[3] += scores
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND, strict=True)], schema=_FOUND)

    def run(batches):
        now, held, group = None, [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            waiting = []
            for g, is_anchor, vec_id, label, vec, scores in zip(*columns, strict=True):
                if g != now:
                    if waiting:
                        yield answers(group, waiting)
                        waiting = []
                    now, held, group = g, [], None
                if not is_anchor:
                    if not held or held[-1][0] != vec_id:   # sorted: the first of an id stands for all
                        held.append((vec_id, label, _unpack(vec)))
                    continue
                if group is None:
                    group = Group(np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64),
                                  [h[2] for h in held])
                    held = []
                waiting.append((vec_id, label, vec, scores))
            if waiting:
                yield answers(group, waiting)

    part = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    dealt = rows.select(part.alias("g"), F.lit(False).alias("is_anchor"), "vec_id", "label", "vec",
                        F.lit(None).cast("array<bigint>").alias("scores"))
    shown = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(True).alias("is_anchor"),
                           "vec_id", "label", "vec", "scores")
    order = ["g", "is_anchor", "vec_id", "label", "vec"]
    found = (dealt.unionByName(shown).repartition(groups, "g").sortWithinPartitions(*order)
             .mapInArrow(run, "anchor_id long, of_score long, vec_id long, score long"))
    first = Window.partitionBy("anchor_id", "of_score").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_pct: int = 80,
         high_pct: int = 100) -> DataFrame:
    """Hard negatives of the anchors among all of ``vectors`` (vec_id, label, vector of integers).

    An anchor's positives are its best ``positives`` other rows with its label; for
    each, the best ``negatives`` rows of other labels whose score s satisfies
    ``low_pct * p <= 100 * s <= high_pct * p`` with the positive's score p.
    -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    """
    spark = vectors.sparkSession
    rows = checkpoint(_packed(vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                                             F.col("vector").cast("array<bigint>"))))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(least, math.ceil(rows.count() / GROUP_ROWS), 1)
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row")) \
        .select("vec_id", "row.label", "row.vec")
    nothing = F.lit(None).cast("array<bigint>").alias("scores")
    near = checkpoint(_pass(rows, anchors.select("*", nothing), groups, True, positives, low_pct, high_pct)
                      .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    scores = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("scores"))
    far = _pass(rows, anchors.join(scores, "vec_id"), groups, False, negatives, low_pct, high_pct) \
        .select("anchor_id", F.col("of_score").alias("positive_score"), F.col("rank").cast("int").alias("rank"),
                F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.where(usable(F.col("vec_id"), F.col("label"), F.col("embedding")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = rows.select("vec_id", moved.alias("label"), scaled(F.col("embedding")).alias("vector"))
    return mine(vectors, F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""
