"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Features of a text: densities of lexicons (stated insult, threat and profanity
lists, and a lexicon of words and word beginnings learned from the training
labels), lexicon words near a second person, capitals, punctuation, obfuscation
(letters around digits or symbols, letters repeated, listed words spelt with
look-alikes), repetition and length. Labels, language, source and ids are never
features.

Training rows are the labelled ones that ``trainable`` lets through, at most
``MAX_ROWS`` of them (the smallest hashes of doc_id), a third of which only
calibrate. The lexicon is counted in Spark over the rest: all terms in at least
``MIN_DOCS`` toxic texts whose log-odds reach ``MIN_LOG_ODDS``, however many (the
bound of the rows bounds them). Scoring is one pass over all documents without a
shuffle.

Edge cases: a null or empty text has zero features and is scored like any other;
a label without a document, or a null label, is left out; a doc_id labelled
twice counts as toxic if one label says so; without labels of both classes every
score is the share of toxic labels (0 without any); extra columns pass through,
a column named like an added one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ubeat.llm.common import ALNUM, LOWER, NOT_SPACE, PrefixHash, byte_hash, checkpoint, pieces, text_bytes, word_spans

MAX_ROWS = 24_000
MIN_DOCS = 6
#: Size of the bit table of toxic terms (2 MB); it only saves shuffling.
FILTER_BITS = 1 << 24
MIN_LOG_ODDS = 2.0
THRESHOLD = 0.3
NEAR = 5
STEMS = range(3, 9)

INSULTS = ("idiot idiots moron morons stupid dumb fool loser losers clown scum trash garbage worthless pathetic "
           "disgusting ugly freak pig rat coward liar imbecile cretin jerk").split()
THREATS = "kill die hurt beat destroy hang shoot burn stab rape murder punch".split()
PROFANITY = "damn hell crap shit bastard bitch fuck fucking ass asshole piss whore slut".split()
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
                 "usted ustedes tú ti tuyo vosotros").split()
#: Look-alike bytes and the letters they stand for.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

NAMES = ("words", "word_len", "upper", "caps_words", "exclaim", "question", "punct", "punct_runs", "digits", "foreign",
         "obfuscated", "stretched", "lookalike", "repeated", "distinct", "insults", "threats", "profanity", "second",
         "learned", "learned_weight", "learned_max", "learned_count", "near_second")


def _flags(text: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text)] = True
    return out


_UP, _LOW = _flags(bytes(range(0x41, 0x5B))), _flags(bytes(range(0x61, 0x7B)))
_LETTER = _UP | _LOW | _flags(bytes(range(0x80, 0x100)))
_DIGIT = _flags(b"0123456789")
_PUNCT = _flags(bytes(x for x in range(0x21, 0x7F) if not (_UP | _LOW | _DIGIT)[x]))
_SYMBOL = _DIGIT | _flags(b"@$*#%&!+_^~")
_PLAIN = LOWER.copy()
for _a, _b in LOOKALIKES.items():
    _PLAIN[ord(_a)] = ord(_b)
_STEM = np.uint64(0x5851F42D4C957F2D)


def _word_hashes(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(byte_hash(data).slices(np.array([0]), np.array([len(data)]))[0])
    return np.sort(np.array(out, np.uint64))


_LISTS = {k: _word_hashes(v) for k, v in (("insults", INSULTS), ("threats", THREATS), ("profanity", PROFANITY),
                                          ("second", SECOND_PERSON))}


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index + 1 of each value in a sorted table, 0 where it is not."""
    if not len(table):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at + 1, 0)


def _terms(sums: PrefixHash, starts: np.ndarray, ends: np.ndarray):
    """Yields (word indexes, hashes): the words, then their beginnings."""
    yield np.arange(len(starts)), sums.slices(starts, ends)
    for n in STEMS:
        long = np.flatnonzero(ends - starts > n)
        yield long, sums.slices(starts[long], starts[long] + n) ^ _STEM


@dataclass
class Lexicon:
    """Sorted term hashes with weights."""

    terms: np.ndarray
    weights: np.ndarray


def _features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """One row of NAMES per document of a piece."""
    n_docs = len(offsets) - 1
    lowered = LOWER[data]
    starts, ends, first = word_spans(lowered, offsets, ALNUM)
    n = len(starts)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    words = np.maximum(np.diff(first), 1).astype(float)

    def per_doc(at: np.ndarray, border: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(at, dtype=np.float64)))
        return total[border[1:]] - total[border[:-1]]

    def chars(flag: np.ndarray) -> np.ndarray:
        return per_doc(flag, offsets)

    def of_words(flag: np.ndarray) -> np.ndarray:
        return per_doc(flag, first)

    sums = byte_hash(lowered)
    weight = np.zeros(n)
    own = np.zeros(n, np.uint64)
    for k, (at, hashes) in enumerate(_terms(sums, starts, ends)):
        if k == 0:
            own = hashes
        found = _in(hashes, lexicon.terms)
        hit = found > 0
        weight[at[hit]] = np.maximum(weight[at[hit]], lexicon.weights[found[hit] - 1])
    listed = {k: _in(own, v) > 0 for k, v in _LISTS.items()}
    learned = weight > 0
    bad = learned | listed["insults"] | listed["threats"] | listed["profanity"]

    def near(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag)))
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        at = np.arange(n)
        return total[np.minimum(at + NEAR + 1, first[1:][doc])] > total[np.maximum(at - NEAR, first[:-1][doc])]

    letter, punct = _LETTER[data], _PUNCT[data]
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    before[1:], after[:-1] = data[:-1], data[1:]
    cap, low = np.concatenate(([0], np.cumsum(_UP[data]))), np.concatenate(([0], np.cumsum(_LOW[data])))
    caps_word = (ends - starts > 1) & (cap[ends] - cap[starts] > 0) & (low[ends] == low[starts])
    plain = _PLAIN[data]
    p_starts, p_ends, p_first = word_spans(plain, offsets, ALNUM)
    changed = np.concatenate(([0], np.cumsum(plain != lowered)))
    swapped = changed[p_ends] > changed[p_starts]
    p_hash = byte_hash(plain).slices(p_starts[swapped], p_ends[swapped])
    fake = np.zeros(len(p_starts))
    fake[swapped] = (_in(p_hash, _LISTS["insults"]) > 0) | (_in(p_hash, _LISTS["profanity"]) > 0) | (
        _in(p_hash, lexicon.terms) > 0)
    again = np.zeros(n, bool)
    again[1:] = own[1:] == own[:-1]
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    pair = np.stack((doc.astype(np.uint64), own))
    order = np.lexsort((own, doc))
    fresh = np.ones(n, bool)
    fresh[1:] = (pair[:, order][:, 1:] != pair[:, order][:, :-1]).any(axis=0)
    top = np.zeros(n_docs)
    if n:
        some = np.flatnonzero(np.diff(first))
        top[some] = np.maximum.reduceat(weight, first[:-1][some])
    columns = (
        np.log1p(np.diff(first)), chars(ALNUM[lowered]) / words,
        chars(_UP[data]) / np.maximum(chars(letter), 1), of_words(caps_word) / words,
        chars(data == ord("!")) / words, chars(data == ord("?")) / words, chars(punct) / size,
        chars(punct & (before == data)) / words, chars(_DIGIT[data]) / size, chars(data >= 0x80) / size,
        chars(_SYMBOL[data] & _LETTER[before] & _LETTER[after]) / words,
        chars(letter & (before == data) & (after == data)) / words,
        per_doc(fake, p_first) / words, of_words(again) / words, per_doc(fresh, first) / words,
        of_words(listed["insults"]) / words, of_words(listed["threats"]) / words, of_words(listed["profanity"]) / words,
        of_words(listed["second"]) / words, of_words(learned) / words, of_words(weight) / words, top,
        np.log1p(of_words(learned)), of_words(bad & near(listed["second"])) / words)
    return np.stack(columns, axis=1)


def with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with the array column ``features``; the text stays."""
    base = docs.drop("features")
    schema = T.StructType([*base.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    width = len(NAMES)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows = [_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lexicon)
                    for i, j in pieces(offsets)]
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
            at = np.arange(0, len(flat) + 1, width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], schema.names)

    return base.mapInArrow(run, schema)


# ------------------------------------------------------------------ training

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(text, toxic, calibrates) of a bounded sample of the labelled documents."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # the documented bound of the sample
    known = known.withColumn("calibrates", F.crc32(F.col("doc_id").cast("string")) % 4 == 3)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic", "calibrates")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Terms that toxic texts hold much more often than others.

    Other texts send only terms that a bit table of the toxic candidates lets
    through (``FILTER_BITS`` bits, whatever their number); the join drops the rest.
    """
    def counted(table: np.ndarray | None):
        return lambda batches: _count_terms(batches, table)

    def texts_with(toxic: int, name: str, table: np.ndarray | None) -> DataFrame:
        found = rows.where(F.col("toxic") == toxic).select("text").mapInArrow(counted(table), "term long, docs long")
        return found.groupBy("term").agg(F.sum("docs").alias(name))

    total = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not total.get(0) or not total.get(1):
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    toxic = checkpoint(texts_with(1, "bad", None).where(F.col("bad") >= MIN_DOCS))
    both = toxic.join(texts_with(0, "good", _bit_table(toxic)), "term", "left")
    odds = (F.log((F.col("bad") + 0.5) / F.lit(total[1] + 1.0))
            - F.log((F.coalesce("good", F.lit(0)) + 0.5) / F.lit(total[0] + 1.0)))
    kept = both.select("term", odds.alias("odds")).where(F.col("odds") >= MIN_LOG_ODDS).toPandas()
    terms = kept["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(terms)
    return Lexicon(terms[order], kept["odds"].to_numpy(float)[order])


def _bit_table(terms: DataFrame) -> np.ndarray:
    """One bit for each term modulo ``FILTER_BITS``, made in Spark bucket by bucket."""
    at = F.pmod(F.col("term"), F.lit(FILTER_BITS)) + 1
    buckets = (terms.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p"))
               .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")))
    table = np.zeros((FILTER_BITS // (8 * 4096), 4096), np.uint8)  # buckets of 4096 bytes
    for r in buckets.collect():
        table[r.b - 1] = np.frombuffer(r.bits, np.uint8)
    return table.ravel()


def _count_terms(batches, table: np.ndarray | None):
    """Arrow batches (term, docs): in how many texts of a piece each term occurs, only
    terms whose bit is set if there is a table."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j in pieces(offsets):
            piece, border = LOWER[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
            starts, ends, first = word_spans(piece, border, ALNUM)
            doc = np.repeat(np.arange(j - i), np.diff(first))
            terms, owners = [], []
            for at, hashes in _terms(byte_hash(piece), starts, ends):
                if table is not None:
                    bit = (hashes.view(np.int64) % FILTER_BITS).astype(np.int64)
                    keep = (table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                    at, hashes = at[keep], hashes[keep]
                terms.append(hashes)
                owners.append(doc[at])
            pair = np.unique(np.rec.fromarrays((np.concatenate(terms), np.concatenate(owners)), names="t,d"))
            term, n = np.unique(pair.t, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "docs"])


@dataclass
class Model:
    """Lexicon, trees and calibration, or the constant score without both classes."""

    lexicon: Lexicon
    trees: object = None
    calibration: object = None
    constant: float = 0.0

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with score and predicted."""
        base = docs.drop("score", "predicted")
        if self.trees is None:
            out = base.withColumn("score", F.lit(self.constant))
        else:
            out = self.trees.transform(_vectors(with_features(base, self.lexicon)))
            out = self.calibration.transform(out.withColumn("_p", vector_to_array("_probability")[1]))
            out = out.withColumn("score", F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0)))
            out = out.select(*[F.col(f"`{c}`") for c in base.columns], "score")
        return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("_v", array_to_vector("features"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    rows = checkpoint(training_rows(docs, labels, max_rows))
    fit = rows.where("not calibrates")
    lexicon = learn_lexicon(fit)
    seen = checkpoint(_vectors(with_features(rows, lexicon)).drop("text", "features")).coalesce(4)
    classes = {(r.calibrates, r.toxic): r["count"] for r in seen.groupBy("calibrates", "toxic").count().collect()}
    total = sum(classes.values())
    if not all(classes.get((False, t)) for t in (0, 1)):
        bad = sum(n for (_, t), n in classes.items() if t)
        return Model(lexicon, constant=bad / total if total else 0.0)
    gbt = GBTClassifier(featuresCol="_v", labelCol="toxic", maxDepth=4, maxIter=30, stepSize=0.15, seed=11,
                        predictionCol="_prediction", minInstancesPerNode=5)
    gbt = gbt.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    trees = gbt.fit(seen.where("not calibrates"))
    calibrating = seen.where("calibrates") if classes.get((True, 1)) else seen
    scored = trees.transform(calibrating).withColumn("_p", vector_to_array("_probability")[1])
    isotonic = IsotonicRegression(featuresCol="_p", labelCol="toxic", predictionCol="_score")
    return Model(lexicon, trees, isotonic.fit(scored.select("_p", F.col("toxic").cast("double").alias("toxic"))))


def op10_toxicity(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.score(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
