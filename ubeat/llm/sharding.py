"""Sharding by longest-processing-time scheduling in two levels.

Rows with equal texts form a group that stays together. Groups are dealt to
``O(sqrt(rows))`` parts by the hash of their text. In each part a heap gives the
groups, largest first, to the least loaded of the part's packs; the part's bytes
are cut into tiers (the first half, a quarter, an eighth ...) with packs of
their own, so packs come in geometrically falling sizes. A second heap gives the
packs, largest first, to the least loaded shard: the small packs at the end
level the loads. The second heap sees parts * tiers * shards rows, whatever the
group sizes; neither level holds the rows themselves.

Slots number a shard's rows from 0 without gaps: pack start + group start +
start of the (group, salt) block + row number in that block. A group of copies
that holds a third of all rows is numbered in ``SALTS`` blocks.

Edge cases: a null text is the empty text (size 1, same group as empty texts); a
very long text is one row, whatever its size, and fills a shard by itself if it must;
rows with equal doc_id and text are told apart by nothing and get neighbouring
slots; an empty table gives an empty result; extra columns pass through
``assign`` (a clash with an added column is overwritten).
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
TIERS = 6
SALTS = 64


def _deal(sizes: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each size (given largest first): the least loaded, lowest on ties."""
    heap = [(0, b) for b in range(bins)]
    out = np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        load, b = heap[0]
        out[i] = b
        heapq.heapreplace(heap, (load + size, b))
    return out


def _packs(part: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Groups of one part -> their pack and the rows before them in it."""
    part = part.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
    size = part["bytes"].to_numpy(np.int64)
    done = (np.cumsum(size) - size) / max(int(size.sum()), 1)
    tier = np.minimum(np.floor(-np.log2(np.maximum(1.0 - done, 2.0 ** -TIERS))), TIERS - 1).astype(np.int64)
    pack = np.empty(len(part), np.int64)
    for t in np.unique(tier):
        here = tier == t
        pack[here] = t * shards + _deal(size[here], shards)
    rows = part["rows"].to_numpy(np.int64)
    start = pd.Series(rows).groupby(pack).cumsum().to_numpy() - rows
    return pd.DataFrame({"key": part["key"], "part": part["part"], "pack": pack, "bytes": size, "rows": rows,
                         "start": start})


def _shards(packs: pd.DataFrame, shards: int) -> pd.DataFrame:
    packs = packs.sort_values(["bytes", "part", "pack"], ascending=[False, True, True], kind="stable")
    shard = _deal(packs["bytes"].to_numpy(np.int64), shards)
    rows = packs["rows"].to_numpy(np.int64)
    first = pd.Series(rows).groupby(shard).cumsum().to_numpy() - rows
    return pd.DataFrame({"part": packs["part"], "pack": packs["pack"], "shard": shard.astype(np.int32), "first": first})


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the size of a row and the key of its group."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.withColumn("size", F.octet_length(text).cast("long") + 1)
            .withColumn("_key", F.sha2(text, 256)))


def place(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``keyed`` rows (their texts are not needed any more) with shard and slot."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(SALTS)).cast("int"))
    blocks = rows.groupBy("_key", "_salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    parts = max(1, math.ceil(math.sqrt(rows.count()) / 16))
    groups = (blocks.groupBy("_key").agg(F.sum("b").alias("bytes"), F.sum("n").alias("rows"))
              .select(F.pmod(F.xxhash64("_key"), F.lit(parts)).alias("part"), F.col("_key").alias("key"), "bytes", "rows"))
    packed = groups.groupBy("part").applyInPandas(
        lambda p: _packs(p, shards), "key string, part long, pack long, bytes long, rows long, start long")
    packs = packed.groupBy("part", "pack").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    dealt = packs.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        lambda p: _shards(p, shards), "part long, pack long, shard int, first long")
    placed = packed.join(dealt, ["part", "pack"]).select(
        F.col("key").alias("_key"), "shard", (F.col("first") + F.col("start")).alias("_first"))
    before = Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .join(placed, "_key").select("_key", "_salt", "shard", (F.col("_first") + F.col("_before")).alias("_at")))
    number = F.row_number().over(Window.partitionBy("_key", "_salt").orderBy("doc_id"))
    return (rows.drop("shard", "slot").withColumn("_n", number)
            .join(blocks, ["_key", "_salt"])
            .withColumn("slot", F.col("_at") + F.col("_n") - 1)
            .drop("_key", "_salt", "_n", "_at"))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with size, shard and slot."""
    return place(keyed(docs), shards)


def op7_shard(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = keyed(docs.withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit(""))))).drop("text")
    return place(rows).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
