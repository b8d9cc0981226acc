"""Prefix trie of conversations by Z-fast tries.

A conversation is a sequence of turns; a prefix is known by a 128-bit rolling
hash. A Z-fast trie keeps compacted nodes (an edge over the depths ``lo + 1 ..
hi``) in a table under the hash of their handle, the prefix as long as the
two-fattest number of that range (the one with most trailing zero bits). A new
conversation finds its exit node by fat binary search: probe the two-fattest
depth of the open range, go below on a hit and above on a miss, so some
log(length) probes instead of one per turn. Conversations come in batches, equal
ones once; splitting the exit edge or adding a leaf changes two handles at most.

Tasks build such tries over their shares of the conversations, expand the edges
to one row per depth and Spark adds up the rows of each prefix, so a prefix that
all conversations share arrives once per task. Figures of whole subtrees need no
walk: a node belongs to its smallest member, a conversation carries the sum of
what it owns, and a second pass of tries adds these up along the paths; what the
owner has above the node is taken off again.

A conversation is stored in pieces of at most ``SEGMENT`` turns, each rooted at
the hash of what precedes it, so no task holds a whole long conversation, and a
task's trie is expanded and emptied when it holds ``FLUSH_TURNS`` turns.

Edge cases: rows without a conv_id take no part; a null turn comes first; turns
with equal numbers are ordered by role, then text; repeated rows are turns of
their own; null roles and texts are empty; a conversation whose rebuilt form has
no turn is a member of the root alone; extra columns are ignored; no
conversations give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ubeat.llm.common import checkpoint, table
from ubeat.plans.scan import blocked_running

SEGMENT = 512
FLUSH_TURNS = 400_000
#: Rows of one sorted range of turns, and member ids hashed as one string.
RANGE_ROWS = 1_000_000
IDS_AT_ONCE = 20_000
#: The most turns that a conversation may take from another one.
MAX_HEAD = 5

_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_RECORD = np.dtype([("a", "<u8"), ("b", "<u8"), ("chars", "<i8")])
_ROOT = bytes(16)


# ------------------------------------------------------------- the Z-fast trie

def two_fattest(a: int, b: int) -> int:
    """The number of (a, b] with most trailing zero bits."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class Node:
    """The edge over depths lo + 1 .. hi of one (any) member's path."""

    __slots__ = ("lo", "hi", "keys", "chars", "parent", "children", "own")

    def __init__(self, lo, hi, keys, chars, parent):
        self.lo, self.hi, self.keys, self.chars, self.parent = lo, hi, keys, chars, parent
        self.children: dict[bytes, Node] = {}
        self.own = None                      # [v1, v2, smallest conv] of the sequences that end at hi


def _add(x, y):
    return list(y) if x is None else [x[0] + y[0], x[1] + y[1], min(x[2], y[2])]


class ZFastTrie:
    """Sequences given by the keys of their prefixes; depths count from the root."""

    def __init__(self):
        self.root = Node(0, 0, [], [], None)
        self.handles: dict[bytes, Node] = {}
        self.turns = self.probes = 0

    def exit_node(self, keys: list[bytes]) -> tuple[Node, Node | None]:
        """(deepest node that is a whole prefix of ``keys``, the node below it
        that ``keys`` enters without passing it)."""
        now, low, high = self.root, 0, len(keys)
        while low < high:
            at = two_fattest(low, high)
            self.probes += 1
            node = self.handles.get(keys[at - 1])
            if node is None:
                high = at - 1
            elif node.hi <= len(keys) and node.keys[node.hi - 1] == keys[node.hi - 1]:
                now, low = node, node.hi
            else:
                return node.parent, node
        return now, now.children.get(keys[now.hi]) if now.hi < len(keys) else None

    def _name(self, node: Node) -> None:
        self.handles[node.keys[two_fattest(node.lo, node.hi) - 1]] = node

    def _leaf(self, parent: Node, keys, chars) -> Node:
        leaf = Node(parent.hi, len(keys), keys, chars, parent)
        parent.children[keys[parent.hi]] = leaf
        self._name(leaf)
        self.turns += leaf.hi - leaf.lo
        return leaf

    def _split(self, node: Node, at: int) -> Node:
        """Cut the edge of ``node`` below depth ``at``; returns the upper part."""
        upper = Node(node.lo, at, node.keys, node.chars, node.parent)
        del self.handles[node.keys[two_fattest(node.lo, node.hi) - 1]]
        node.parent.children[node.keys[node.lo]] = upper
        upper.children[node.keys[at]] = node
        node.lo, node.parent = at, upper
        self._name(upper)
        self._name(node)
        return upper

    def insert(self, keys: list[bytes], chars, values) -> None:
        now, node = self.exit_node(keys)
        if node is not None:
            # Equality of prefixes is monotone: find the last common depth on the edge.
            same, other = node.lo, min(node.hi, len(keys)) + 1
            while other - same > 1:
                mid = (same + other) // 2
                same, other = (mid, other) if node.keys[mid - 1] == keys[mid - 1] else (same, mid)
            now = self._split(node, same)
        if now.hi < len(keys):
            now = self._leaf(now, keys, chars)
        now.own = _add(now.own, values)

    def nodes(self):
        """(node, sums over the members that pass it), the root left out."""
        found, stack = [], list(self.root.children.values())
        while stack:
            node = stack.pop()
            found.append(node)
            stack.extend(node.children.values())
        sums: dict[int, list] = {}
        for node in sorted(found, key=lambda x: -x.lo):
            total = node.own
            for child in node.children.values():
                total = _add(total, sums[id(child)])
            sums[id(node)] = total
            yield node, total


# ------------------------------------------------------ pieces of conversations

def _powers(base: int, first: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = pow(base, first, 1 << 64)
    return np.cumprod(out, dtype=np.uint64)


def prefix_keys(turns: np.ndarray, depth: int, start: bytes) -> list[bytes]:
    """Keys of the prefixes that end at each turn; ``start`` is the key at ``depth``."""
    sums = np.empty((len(turns), 2), "<u8")
    for i, (name, base) in enumerate(zip("ab", _BASES, strict=True)):
        np.cumsum(turns[name] * _powers(base, depth, len(turns)), dtype=np.uint64, out=sums[:, i])
    sums += np.frombuffer(start, "<u8")
    raw = sums.tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def turn_rows(turns: DataFrame) -> tuple[DataFrame, list[str]]:
    """(conv, turn, hashes a and b, chars) and the columns that order them; role
    and text are kept only where equal turn numbers need them."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    tied = not rows.groupBy("conv", "turn").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    order = ["conv", "turn"] + ["role", "text"] * tied
    return rows.select(*order, F.xxhash64(F.lit(1), "role", "text").alias("a"),
                       F.xxhash64(F.lit(2), "role", "text").alias("b"), F.char_length("text").cast("long").alias("chars")), order


def pieces(turns: DataFrame) -> DataFrame:
    """(conv, pos, n, last, several, syms): every conversation's turns in order, at
    most ``SEGMENT`` in a row; ``pos`` turns of it come before, ``several`` if it has
    more than one row."""
    rows, order = turn_rows(turns)
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / RANGE_ROWS))
    sorted_rows = rows.repartitionByRange(ranges, *[F.col(c) for c in order]).sortWithinPartitions(*order)

    def run(batches):
        now, at, held = None, 0, np.zeros(0, _RECORD)
        block, out = 0, []

        def done(whole):
            nonlocal at, held
            while len(held) >= SEGMENT or (whole and len(held)):
                out.append((now, block, at, len(held[:SEGMENT]), held[:SEGMENT].tobytes()))
                at, held = at + len(held[:SEGMENT]), held[SEGMENT:]

        for batch in batches:
            conv = batch.column(0).to_numpy()
            records = np.empty(len(conv), _RECORD)
            for i, name in enumerate(("a", "b", "chars"), 2):
                records[name] = batch.column(i).to_numpy().view(_RECORD[name])
            block = batch.column(1)[0].as_py() if len(conv) else block
            edges = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)] if len(conv) else []
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if now is None or conv[i] != now:
                    done(True)
                    now, at = int(conv[i]), 0
                held = np.concatenate([held, records[i:j]])
                done(False)
            yield _batch(_PIECE, out)
            out.clear()
        done(True)
        yield _batch(_PIECE, out)

    parts = checkpoint(sorted_rows.select("conv", F.spark_partition_id().alias("block"), "a", "b", "chars")
                       .mapInArrow(run, "conv long, block int, at long, n long, syms binary"))
    # Only conversations that cross a border of ranges have turns in earlier blocks: one of a block at most.
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (parts.groupBy("conv", "block").agg(F.sum("n").alias("n"))
               .select("conv", "block", F.sum("n").over(earlier).alias("before")).where("before > 0"))
    parts = parts.join(F.broadcast(carried), ["conv", "block"], "left") \
        .withColumn("pos", F.col("at") + F.coalesce("before", F.lit(0)))
    several = parts.where("pos > 0").groupBy("conv").agg(F.max("pos").alias("top"))
    return parts.join(several, "conv", "left").select(
        "conv", "pos", "n", (F.col("pos") == F.coalesce("top", F.lit(0))).alias("last"),
        F.col("top").isNotNull().alias("several"), "syms")


_PIECE = pa.schema([("conv", pa.int64()), ("block", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("syms", pa.binary())])
_BUILT = pa.schema([("conv", pa.int64()), ("pos", pa.int64()), ("depth", pa.int64()), ("last", pa.bool_()),
                    ("several", pa.bool_()), ("syms", pa.binary()), ("a_hi", pa.int64()), ("a_lo", pa.int64()),
                    ("b_hi", pa.int64()), ("b_lo", pa.int64())])


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def rebuilt(parts: DataFrame, base: Column, head: Column) -> DataFrame:
    """``parts`` with the first ``head`` (0 to 5) turns of each conversation replaced by
    those of the conversation ``base`` (all if it has fewer, none if it is absent):
    (conv, pos, depth, last, syms, start), the piece covering the turns from ``depth``
    on behind the prefix with the key ``start``."""
    parts = parts.withColumn("base", base).withColumn("head", head.cast("long"))
    size = _RECORD.itemsize * MAX_HEAD
    heads = (parts.where((F.col("base") == F.col("conv")) & (F.col("pos") < MAX_HEAD))
             .groupBy("base").agg(F.array_sort(F.collect_list(F.struct("pos", F.substring("syms", 1, size).alias("part"))))
                                  .alias("parts")).select("base", F.col("parts.part").alias("parts")))

    def run(batches):
        for batch in batches:
            out = []
            for conv, pos, last, several, syms, h, found in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                front = np.frombuffer(b"".join(found or ()), _RECORD)[:min(h, MAX_HEAD)]
                own = np.frombuffer(syms, _RECORD)
                depth = len(front) + max(pos, h) - h
                turns = own[max(0, h - pos):]
                if pos == 0:
                    depth, turns = 0, np.concatenate([front, turns])
                sums = []
                for name, factor in zip("ab", _BASES, strict=True):
                    total = int((turns[name] * _powers(factor, depth, len(turns))).sum(dtype=np.uint64)) if several else 0
                    sums += [total >> 32, total & 0xFFFFFFFF]
                out.append((conv, pos, depth, last, several, turns.tobytes(), *sums))
            yield _batch(_BUILT, out)

    def build(rows):
        return (rows.join(heads, "base", "left").select("conv", "pos", "last", "several", "syms", "head", "parts")
                .mapInArrow(run, "conv long, pos long, depth long, last boolean, several boolean, syms binary, "
                                 "a_hi long, a_lo long, b_hi long, b_lo long"))

    # The key in front of a later piece: the sums of the earlier ones, in halves that cannot overflow.
    halves = ["a_hi", "a_lo", "b_hi", "b_lo"]
    earlier = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    starts = (build(parts.where("several")).select("conv", "pos", *[F.sum(c).over(earlier).alias(c) for c in halves])
              .where("pos > 0").select("conv", "pos", F.array(*halves).alias("start")))
    return build(parts).drop(*halves, "several").join(starts, ["conv", "pos"], "left")


def _start_key(halves) -> bytes:
    if halves is None:
        return _ROOT
    return b"".join(((hi << 32) + lo & _MASK).to_bytes(8, "little") for hi, lo in (halves[:2], halves[2:]))


_NODE = pa.schema([("ka", pa.int64()), ("kb", pa.int64()), ("depth", pa.int64()), ("pa", pa.int64()), ("pb", pa.int64()),
                   ("chars", pa.int64()), ("v1", pa.int64()), ("v2", pa.int64()), ("conv", pa.int64()), ("is_end", pa.bool_())])
_NODE_DDL = ("ka long, kb long, depth long, pa long, pb long, chars long, v1 long, v2 long, conv long, is_end boolean")


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def trie_rows(built: DataFrame, ends: bool) -> DataFrame:
    """Rows of the tasks' tries over ``built`` with the values v1 and v2 of each
    conversation: one per task and prefix with the sums and the smallest member; with
    ``ends`` also one per conversation with the key of its whole (``is_end``)."""
    def expand(forest):
        keys, parents, depths, chars, sums = [], [], [], [], []
        for (start, depth), (trie, root) in forest.items():
            if root is not None:
                keys.append(_ROOT), parents.append(_ROOT), depths.append(0), chars.append(0), sums.append(root)
            for node, total in trie.nodes():
                own = node.keys[node.lo:node.hi]
                keys += own
                parents.append(node.keys[node.lo - 1] if node.lo else start)
                parents += own[:-1]
                depths += range(depth + node.lo + 1, depth + node.hi + 1)
                chars += node.chars[node.lo:node.hi]
                sums += [total] * len(own)
        if not keys:
            return _batch(_NODE, [])
        columns = [*_halves(keys), depths, *_halves(parents), chars, *zip(*sums, strict=True), [False] * len(keys)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE, strict=True)], schema=_NODE)

    def run(batches):
        forest: dict = {}
        for batch in batches:
            waiting: dict = {}
            finished = []
            for conv, pos, depth, last, syms, start, v1, v2 in zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True):
                root = (_start_key(start), depth)
                turns = np.frombuffer(syms, _RECORD)
                keys = prefix_keys(turns, depth, root[0])
                end = keys[-1] if keys else root[0]
                if last and ends:
                    finished.append((end, depth + len(keys), conv))
                held = waiting.setdefault((root, end, len(keys)), [keys, turns["chars"], None, None])
                held[2] = _add(held[2], (v1, v2, conv))
                if pos == 0:
                    held[3] = _add(held[3], (v1, v2, conv))
            for (root, _, n), (keys, chars, values, firsts) in waiting.items():
                kept = forest.setdefault(root, [ZFastTrie(), None])
                if n:
                    kept[0].insert(keys, chars.tolist(), values)
                if firsts is not None:
                    kept[1] = _add(kept[1], firsts)
            if finished:
                a, b = _halves([e[0] for e in finished])
                none = [None] * len(finished)
                columns = [a, b, [e[1] for e in finished], none, none, none, none, none, [e[2] for e in finished],
                           [True] * len(finished)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE, strict=True)], schema=_NODE)
            if sum(trie.turns for trie, _ in forest.values()) >= FLUSH_TURNS:
                yield expand(forest)
                forest = {}
        yield expand(forest)

    return built.select("conv", "pos", "depth", "last", "syms", "start", "v1", "v2").mapInArrow(run, _NODE_DDL)


_KEY = ["ka", "kb", "depth"]


def member_hashes(ends: DataFrame) -> DataFrame:
    """(ka, kb, depth, ends_sha256): the sorted ids of each key's conversations, comma-joined,
    hashed. Ids are sorted over ranges and joined to long strings there, so the last step
    streams few rows even for a key that most conversations end at."""
    def joined(batches):
        now, ids = None, []
        schema = pa.schema([("ka", pa.int64()), ("kb", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            out = []
            for *key, conv in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if key != now or len(ids) >= IDS_AT_ONCE:
                    if ids:
                        out.append((*now, ids[0], ",".join(map(str, ids))))
                    now, ids = key, []
                ids.append(conv)
            yield _batch(schema, out)
        if ids:
            yield _batch(schema, [(*now, ids[0], ",".join(map(str, ids)))])

    def hashed(batches):
        now, running = None, None
        schema = pa.schema([("ka", pa.int64()), ("kb", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
        for batch in batches:
            out = []
            for *key, ids in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if key != now:
                    if now is not None:
                        out.append((*now, running.hexdigest()))
                    now, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield _batch(schema, out)
        if now is not None:
            yield _batch(schema, [(*now, running.hexdigest())])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_KEY, "conv"]
    strings = (ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
               .mapInArrow(joined, "ka long, kb long, depth long, first long, ids string"))
    return (strings.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").select(*_KEY, "ids")
            .mapInArrow(hashed, "ka long, kb long, depth long, ends_sha256 string"))


def trie(built: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations in ``built`` (see ``rebuilt``)."""
    built = checkpoint(built)
    found = checkpoint(trie_rows(built.withColumns({"v1": F.lit(1).cast("long"), "v2": F.lit(0).cast("long")}), ends=True))
    nodes = checkpoint(found.where("NOT is_end").groupBy(*_KEY).agg(
        F.sum("v1").alias("n"), F.min("conv").alias("conv"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("chars").alias("chars")))
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb"),
                                                (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    saved = (F.col("n") - 1) * F.col("chars")
    nodes = checkpoint(nodes.join(children, _KEY, "left").withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0)), "saved": saved, "block": F.floor(F.col("depth") / SEGMENT)}))
    # What a conversation owns, and what the owner of a node owns above it.
    owned = nodes.groupBy("conv").agg(F.sum("saved").alias("v1"), F.sum((F.col("n_children") == 0).cast("long")).alias("v2"))
    paths = built.join(owned, "conv").where("v1 > 0 OR v2 > 0")
    below = trie_rows(paths, ends=False).groupBy(*_KEY).agg(F.sum("v1").alias("below"), F.sum("v2").alias("n_leaves"))
    nodes = blocked_running(nodes, ["conv"], ["depth"], "saved", "block", "above", inclusive=False)
    parents = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv").alias("parent_conv"))
    up = F.when(F.col("depth") > 0, F.col("parent_conv"))
    none = F.sha2(F.lit(b""), 256)
    return (nodes.join(below, _KEY, "left").join(member_hashes(found.where("is_end")), _KEY, "left")
            .join(parents, ["pa", "pb", "depth"], "left")
            .select("conv", "depth", up.alias("parent_conv"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
                    (F.col("below") - F.coalesce("above", F.lit(0))).alias("saved"),
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    parts = pieces(table(spark, sf_dir, "conversations"))
    built = rebuilt(parts, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6)
    return trie(built).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


#: CRC-32 of the decimal id, bit by bit; the rest is the definition over plain prefixes.
SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT conv_id AS c, list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
           lambda r, x: list_reduce(list_concat([xor(r, x)], range(8)),
                                    lambda s, k: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM (SELECT DISTINCT conv_id FROM t)),
c AS (SELECT c, xor(crc, 4294967295) % 6 AS h FROM bits),
r AS (
  SELECT c, 0 AS part, i, role, text FROM c JOIN t ON t.conv_id = c - c % 100 AND i < h
  UNION ALL SELECT c, 1, i, role, text FROM c JOIN t ON t.conv_id = c AND i >= h),
d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS depth, md5(length(role) || ':' || role || text) AS turn,
             length(text) AS chars FROM r),
m AS (
  SELECT c, depth, chars, md5(string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth)) AS key FROM d
  UNION ALL SELECT c, 0, 0, '' FROM c),
n AS (SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM m GROUP BY key, depth),
p AS (
  SELECT n.*, o.conv_id AS parent_conv_id, o.key AS parent_key FROM n
  LEFT JOIN m ON m.c = n.conv_id AND m.depth = n.depth - 1
  LEFT JOIN n o ON o.key = m.key AND o.depth = m.depth),
k AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM p
      LEFT JOIN (SELECT parent_key, depth - 1 AS depth, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY ALL) x
        ON x.parent_key = p.key AND x.depth = p.depth),
s AS (
  SELECT m.key, m.depth, sum((k.n_convs - 1) * k.chars) AS saved_tokens, count(*) FILTER (k.n_children = 0) AS n_leaves
  FROM k JOIN m ON m.c = k.conv_id AND m.depth <= k.depth GROUP BY m.key, m.depth),
e AS (
  SELECT key, depth, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT *, max(depth) OVER (PARTITION BY c) AS last FROM m) WHERE depth = last GROUP BY key, depth)
SELECT k.conv_id, k.depth, k.parent_conv_id, CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM k JOIN s USING (key, depth) LEFT JOIN e USING (key, depth)
"""
