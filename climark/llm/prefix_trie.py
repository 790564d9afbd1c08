"""Conversation prefix trie as a table of its nodes.

Every distinct sequence of first d turns (role, text) of some conversation is a node,
the textless root has d = 0.  A prefix is a 128-bit digest: the sum, modulo 2**64
twice, of its turns' hashes mixed with their depths.  Equal digests are verified against
depth, parent digest and a third hash of the last turn; should two prefixes meet in a
digest, all are computed anew with another seed.

Shards are ranges of the distinct nodes by (smallest member, depth).  A shard gives its
digests the slots of a minimal perfect hash (``SlotTable``; the digest kept in a slot
verifies every lookup), scatters the nodes' figures into flat numpy arrays by slot, looks
up the parents' slots and adds children to parents from the deepest level up.  Nodes whose
parent lies in another shard are the tops of local trees.  Tops that nothing of another
shard hangs under send their sums to their parents at once; the others form a smaller
tree, which is summed by the same procedure, and their sums follow (``subtree_sums``).

Scale: no step needs a conversation, a node's members or a subtree in one task.  Turns
are numbered and prefix digests added up within ranges of rows; what a range continues
from the one before is a row a range, worked out by the driver.  Texts are read once
and leave the first stage as hashes.  Hashes of member lists are taken over pieces of at
most ``PIECE_IDS`` ids in order.  Parents of many children are joined by ``share_join``.

Defined results for odd input: rows without conv_id are left out; null turns come first,
null role or text is empty; turns of one number are ordered by their hashes, repeated
rows are repeated turns; an empty table gives no node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.llm.common import share_join, stored

WORD = r"[^\x20\x09-\x0D]+"
SHARD_NODES = 200_000
PIECE_IDS = 65_536
CHUNK = 4_096               # turns of one conversation that share a join key
_MASK = 2 ** 64 - 1
EMPTY = hashlib.sha256(b"").hexdigest()


# -- turns ---------------------------------------------------------------------------

def hashed_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, turn, a, b, check, words): turns with three hashes of role and text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    return conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"),
        F.xxhash64(F.lit(3), role, F.length(text), text).alias("check"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).filter("conv is not null")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _starts(conv: np.ndarray, before: int | None) -> np.ndarray:
    """True where a row's conversation is not the row's before."""
    if not len(conv):
        return np.zeros(0, bool)
    return np.concatenate([[before is None or conv[0] != before], conv[1:] != conv[:-1]])


def _runs(values: np.ndarray, starts: np.ndarray, carry: int) -> np.ndarray:
    """Running sums (modulo 2**64) that begin anew at ``starts``; the first run goes on from ``carry``."""
    total = np.cumsum(values, dtype=np.uint64)
    at = np.flatnonzero(starts)
    which = np.cumsum(starts)
    base = np.concatenate([[np.uint64(-carry & _MASK)], (total - values.astype(np.uint64))[at]])
    return total - base[which]


def _carries(ranges: DataFrame, values: list[str], order: str) -> tuple[dict, dict]:
    """({slab: (conv, values)}, {slab: conv}): the conversation that a range of rows continues
    with its running sums before, and the one that goes on in the next range.  ``ranges`` has
    slab, conv, ``order`` and running sums by row; a row a range comes to the driver."""
    found = ranges.groupBy("slab").agg(F.min("conv").alias("first"),
                                       F.max(F.struct("conv", order, *values)).alias("last")).collect()
    before: dict = {}
    goes_on: dict = {}
    left = None                 # slab, conv and sums that the range before ends with
    for slab, first, last in sorted(found):
        if left and left[1] == first:
            before[slab], goes_on[left[0]] = left[1:], first
        own = [v & _MASK for v in last[2:]]
        if slab in before and last["conv"] == first:
            own = [(x + y) & _MASK for x, y in zip(own, before[slab][1])]
        left = slab, last["conv"], own
    return before, goes_on


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, turn, a, b, check, words) with ``place``, from 1 within each conversation."""
    spark = turns.sparkSession
    order = ["conv", F.asc_nulls_first("turn"), "a", "b", "row"]
    turns = stored(turns.withColumn("row", F.monotonically_increasing_id()), "trie_hashes")   # texts are read once
    rows = turns.repartitionByRange(_partitions(spark), *order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("slab"), "conv", "a", "b", "check", "words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place = None, 0
        for batch in batches:
            own = batch.column(1).to_numpy()
            at = _runs(np.ones(len(own), np.uint64), _starts(own, conv), place)
            if len(own):
                conv, place = own[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64))],
                                             names=[*batch.schema.names, "place"])

    local = stored(rows.mapInArrow(count, "slab int, conv long, a long, b long, check long, words long, place long"),
                   "trie_turns")
    carried = [(s, c, v[0]) for s, (c, v) in _carries(local, ["place"], "place")[0].items()]
    if not carried:
        return local.drop("slab")
    before = spark.createDataFrame(carried, "slab int, conv long, before long")
    return local.join(F.broadcast(before), ["slab", "conv"], "left").withColumn(
        "place", F.col("place") + F.coalesce("before", F.lit(0))).drop("slab", "before")


def with_shared_heads(turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of the conversation c - c % ``group``, h =
    crc32(c as text) % ``heads``: (turns with depth, conversations); conversations may have no
    turns left."""
    base = F.col("conv") - F.col("conv") % group
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("long")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select("conv", "n", base.alias("base"), h.alias("h"))
    tops = turns.filter((F.col("conv") % group == 0) & (F.col("place") < heads)).withColumnRenamed("conv", "base")
    convs = stored(convs.join(tops.groupBy("base").agg(F.count(F.lit(1)).alias("top")), "base", "left").withColumn(
        "lent", F.least("h", F.coalesce("top", F.lit(0)))).drop("top"), "trie_convs")
    kept = ["conv", "depth", "a", "b", "check", "words"]
    lent = convs.join(tops, "base").filter(F.col("place") <= F.col("lent")).withColumn("depth", F.col("place"))
    parts = convs.select("conv", "h", "lent", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK))).alias("chunk"))
    own = turns.withColumn("chunk", F.floor((F.col("place") - 1) / CHUNK)).join(parts, ["conv", "chunk"]).filter(
        F.col("place") > F.col("h")).withColumn("depth", F.col("lent") + F.col("place") - F.col("h"))
    return lent.select(*kept).unionByName(own.select(*kept)), convs.select("conv")


# -- prefixes and nodes --------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefixes(turns: DataFrame, seed: int = 0) -> DataFrame:
    """(conv, depth, x, y, px, py, check, words, ends): the digest of the prefix that ends at
    each turn, its parent's, and whether the conversation ends there."""
    spark = turns.sparkSession
    rows = turns.repartitionByRange(_partitions(spark), "conv", "depth").sortWithinPartitions("conv", "depth").select(
        F.spark_partition_id().alias("slab"), "conv", "depth", "a", "b", "check", "words")
    names = ["slab", "conv", "depth", "x", "y", "sx", "sy", "check", "words", "ends"]
    kind = "slab int, conv long, depth long, x long, y long, sx long, sy long, check long, words long, ends boolean"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sums, held = None, [0, 0], None
        for batch in batches:
            if not batch.num_rows:
                continue
            own, depth = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.uint64)
            starts, out = _starts(own, conv), []
            for k, salt in ((3, 0x9E3779B97F4A7C15), (4, 0xC2B2AE3D27D4EB4F)):
                step = _mixed(_mixed(batch.column(k).to_numpy().view(np.uint64) + np.uint64(seed))
                              + depth * np.uint64(salt))
                total = _runs(step, starts, sums[k - 3])
                sums[k - 3] = int(total[-1])
                out.append((total, step))
            if held is not None:      # the row before ends its conversation if this batch begins one
                yield _ended(held, bool(starts[0]))
            ends = np.concatenate([starts[1:], [False]])
            full = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *[pa.array(t.view(np.int64)) for t, _ in out],
                 *[pa.array(s.view(np.int64)) for _, s in out], batch.column(5), batch.column(6), pa.array(ends)], names=names)
            conv = own[-1]
            yield full.slice(0, full.num_rows - 1)
            held = full.slice(full.num_rows - 1)
        if held is not None:
            yield _ended(held, True)

    def _ended(row: pa.RecordBatch, ends: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*row.columns[:-1], pa.array([ends])], names=names)

    local = stored(rows.mapInArrow(add, kind), "trie_prefixes")
    shared = spark.sparkContext.broadcast(_carries(local, ["x", "y"], "depth"))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, goes_on = shared.value
        for batch in batches:
            slab, conv, depth = (batch.column(k).to_numpy() for k in range(3))
            x, y, sx, sy = (batch.column(k).to_numpy().view(np.uint64).copy() for k in range(3, 7))
            ends = batch.column(9).to_numpy(zero_copy_only=False).copy()
            for s in np.unique(slab).tolist():
                if s in known:
                    own = (slab == s) & (conv == known[s][0])
                    x[own] += np.uint64(known[s][1][0])
                    y[own] += np.uint64(known[s][1][1])
                if s in goes_on:
                    ends[(slab == s) & (conv == goes_on[s])] = False
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), *[pa.array(v.view(np.int64)) for v in (x, y, x - sx, y - sy)],
                 batch.column(7), batch.column(8), pa.array(ends)],
                names=["conv", "depth", "x", "y", "px", "py", "check", "words", "ends"])

    return local.mapInArrow(
        carry, "conv long, depth long, x long, y long, px long, py long, check long, words long, ends boolean")


def nodes_of(rows: DataFrame) -> DataFrame:
    """The distinct prefixes: x, y, owner (smallest member), depth, px, py, n, words."""
    both = ["depth", "px", "py", "check", "words"]
    return rows.groupBy("x", "y").agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in both],
        *[F.max(c).alias(f"max_{c}") for c in both])


def _verified(nodes: DataFrame) -> bool:
    clash = [F.col(c) != F.col(f"max_{c}") for c in ("depth", "px", "py", "check", "words")]
    return nodes.filter(clash[0] | clash[1] | clash[2] | clash[3] | clash[4]).isEmpty()


# -- shards --------------------------------------------------------------------------

class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys onto 0 .. n - 1.

    On each level the keys left are hashed into twice as many places; a key alone in
    its place gets the next slot there, the others go on to the next level.  The keys
    are kept by slot, so that a lookup is verified and unknown keys get -1."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.x, self.y = np.empty(len(x), np.uint64), np.empty(len(x), np.uint64)
        left, used = np.arange(len(x)), 0
        while len(left):
            size = 2 * len(left) + 1
            place = self._places(x[left], y[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            rank = np.where(alone, np.cumsum(alone) - 1 + used, -1)
            mine = rank[place]
            found = mine >= 0
            self.x[mine[found]], self.y[mine[found]] = x[left[found]], y[left[found]]
            self.levels.append((rank, size))
            used += int(found.sum())
            left = left[~found]
            if len(self.levels) > 200:
                raise ValueError("keys are not distinct")

    @staticmethod
    def _places(x: np.ndarray, y: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(_mixed(x + np.uint64(level * 0x9E3779B97F4A7C15 & _MASK)) ^ y) % np.uint64(size)).astype(np.int64)

    def slots(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out, left = np.full(len(x), -1, np.int64), np.arange(len(x))
        for level, (rank, size) in enumerate(self.levels):
            slot = rank[self._places(x[left], y[left], level, size)]
            known = slot >= 0
            known[known] = (self.x[slot[known]] == x[left[known]]) & (self.y[slot[known]] == y[left[known]])
            out[left[known]] = slot[known]
            left = left[~known]
        return out


def _summed(shard: pa.Table) -> pa.Table:
    """One shard's nodes with all_leaves and all_saved, added up over the local subtrees, and
    the digest of their local top (rx, ry)."""
    x, y, px, py = (shard[c].to_numpy().view(np.uint64) for c in ("x", "y", "px", "py"))
    depth = shard["depth"].to_numpy()
    table = SlotTable(x, y)
    slot = table.slots(x, y)
    parent_slot = np.full(len(x), -1, np.int64)
    parent_slot[slot] = np.where(depth > 0, table.slots(px, py), -1)
    sums = []
    for name in ("leaves", "saved"):
        flat = np.zeros(len(x), np.int64)
        np.add.at(flat, slot, shard[name].to_numpy())
        sums.append(flat)
    by_depth = slot[np.argsort(depth, kind="stable")]
    levels = np.split(by_depth, np.flatnonzero(np.diff(np.sort(depth))) + 1)
    top = np.arange(len(x))
    for level in reversed(levels):
        inner = level[parent_slot[level] >= 0]
        for flat in sums:
            np.add.at(flat, parent_slot[inner], flat[inner])
    for level in levels:
        inner = level[parent_slot[level] >= 0]
        top[inner] = top[parent_slot[inner]]
    top = top[slot]
    for name, column in (("all_leaves", sums[0][slot]), ("all_saved", sums[1][slot]),
                         ("rx", table.x[top].view(np.int64)), ("ry", table.y[top].view(np.int64)), ("is_top", top == slot)):
        shard = shard.append_column(name, pa.array(column))
    return shard


_NODE = "x long, y long, px long, py long, owner long, depth long"
_SHARD = (f"shard int, {_NODE}, leaves long, saved long, all_leaves long, all_saved long, rx long, ry long, "
          "is_top boolean")
_KEPT = ["shard", "x", "y", "px", "py", "owner", "depth"]


def _partition_summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        yield from _summed(pa.Table.from_batches(held)).combine_chunks().to_batches()


def subtree_sums(nodes: DataFrame, shard_nodes: int = SHARD_NODES, inner: bool = False) -> DataFrame:
    """(x, y, leaves, saved) added up over the subtree of each node (x, y, px, py, owner,
    depth, leaves, saved); the root has depth 0, every other node's parent is a node."""
    spark = nodes.sparkSession
    n = nodes.count()
    if inner and n <= shard_nodes:
        dealt = nodes.repartition(1)
    else:
        dealt = nodes.repartitionByRange(max(_partitions(spark), n // shard_nodes + 1), "owner", "depth")
    shards = dealt.select(F.spark_partition_id().alias("shard"), *_KEPT[1:], "leaves", "saved")
    local = stored(shards.mapInArrow(_partition_summed, _SHARD), "trie_shards")

    result = ["x", "y", "all_leaves as leaves", "all_saved as saved"]
    tops = local.filter("is_top")
    goals = tops.filter("depth > 0").select(F.col("px").alias("x"), F.col("py").alias("y")).distinct().join(
        local.select("x", "y", "rx", "ry"), ["x", "y"])
    goals = stored(goals.toDF("px", "py", "tx", "ty"), "trie_goals")   # parents elsewhere, and their local tops
    if goals.isEmpty():
        return local.selectExpr(*result)
    hit = goals.select(F.col("tx").alias("x"), F.col("ty").alias("y")).distinct()
    sent = stored(tops.filter("depth > 0").join(hit, ["x", "y"], "left_anti").groupBy("px", "py").agg(
        F.sum("all_leaves").alias("leaves"), F.sum("all_saved").alias("saved")), "trie_sent")
    arrived = sent.join(goals, ["px", "py"]).groupBy(F.col("tx").alias("x"), F.col("ty").alias("y")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    bound = tops.join(hit, ["x", "y"], "left_semi")
    upper = bound.join(arrived, ["x", "y"], "left").join(goals, ["px", "py"], "left").select(
        "x", "y", F.coalesce("tx", F.lit(0)).alias("px"), F.coalesce("ty", F.lit(0)).alias("py"), "owner", "depth",
        (F.col("all_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("all_saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
    whole = subtree_sums(stored(upper, "trie_upper"), shard_nodes, True)
    late = bound.filter("depth > 0").select("x", "y", "px", "py").join(whole, ["x", "y"]).select(
        "px", "py", "leaves", "saved")
    total = sent.unionByName(late).groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    again = local.join(total, ["x", "y"], "left").select(
        *_KEPT, *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")])
    return again.groupBy("shard").applyInArrow(_summed, _SHARD).selectExpr(*result)


# -- member lists --------------------------------------------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows (slab, x, y, conv) with one digest as comma-joined ids."""
    names, number = ["x", "y", "slab", "piece", "ids"], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        slab, x, y, conv = (batch.column(k).to_numpy() for k in range(4))
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        cuts = sorted({*np.flatnonzero(new).tolist(), *range(0, len(x), PIECE_IDS)})
        texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts, [*cuts[1:], len(x)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[cuts]), pa.array(y[cuts]), pa.array(slab[cuts]),
             pa.array(np.arange(number, number + len(cuts))), pa.array(texts)], names=names)
        number += len(cuts)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each digest, which come in order."""
    own, state = None, None
    for batch in batches:
        done = []
        for x, y, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 4))):
            if (x, y) != own:
                if own is not None:
                    done.append((*own, state.hexdigest()))
                own, state = (x, y), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["x", "y", "ends_sha256"])
    if own is not None:
        yield pa.RecordBatch.from_pydict({"x": [own[0]], "y": [own[1]], "ends_sha256": [state.hexdigest()]})


def member_hashes(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256) over the conv ids of ``ends`` (x, y, conv), ascending."""
    n = _partitions(ends.sparkSession)
    order = ["x", "y", "conv"]
    pieces = ends.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("slab"), *order).mapInArrow(
        _pieces, "x long, y long, slab int, piece long, ids string")
    return pieces.repartition(n, "x", "y").sortWithinPartitions("x", "y", "slab", "piece").mapInArrow(
        _hashed, "x long, y long, ends_sha256 string")


# -- the trie ------------------------------------------------------------------------

def prefix_trie(turns: DataFrame, convs: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The node table of conversations given as ``turns`` (conv, depth from 1, a, b, check,
    words) and ``convs`` (conv, once each; also those without turns): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seed = 0
    while True:
        rows = stored(prefixes(turns, seed), "trie_rows")
        found = stored(nodes_of(rows), "trie_nodes")
        if _verified(found):
            break
        seed += 1
    bare = convs.join(rows.filter("depth = 1").select("conv"), "conv", "left_anti").select(
        F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "conv")
    root = convs.agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 0").selectExpr(
        "0L as x", "0L as y", "owner", "0L as depth", "0L as px", "0L as py", "n", "0L as words")
    kept = ["x", "y", "owner", "depth", "px", "py", "n", "words"]
    found = root.unionByName(found.select(*kept))
    children = found.filter("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count(F.lit(1)).alias("n_children"))
    found = stored(found.join(children, ["x", "y"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "trie_family")

    figures = found.select("x", "y", "px", "py", "owner", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"),
                           ((F.col("n") - 1) * F.col("words")).alias("saved"))
    sums = subtree_sums(figures, shard_nodes)
    parents = stored(found.filter("n_children > 0").select(
        F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("owner").alias("parent"), "n_children"), "trie_parents")
    family = found.filter("depth > 0").select("x", "y", "px", "py")
    family = share_join(family, parents, [("px", "qx"), ("py", "qy")], "n_children").select("x", "y", "parent")
    hashes = member_hashes(rows.filter("ends").select("x", "y", "conv").unionByName(bare))
    return found.join(sums, ["x", "y"]).join(family, ["x", "y"], "left").join(hashes, ["x", "y"], "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
