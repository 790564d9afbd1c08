"""Exact Jaccard join of documents on word 5-shingles, as components.

Two documents link when their sets of distinct 5-word shingles have Jaccard
similarity 0.75 or more.  The join is size-aware:

* equal sets are one *node*; copies never meet pairwise;
* shingles are ordered by how common they are (a sketch of counts over all
  documents puts frequent ones last; any fixed order gives the same result);
* a *small* set of n shingles lists every pair (a subset of fixed size 2) of
  its first n - ceil(0.75 n) + 2 shingles: sets that link share two of those;
* a *large* set looks up the inverted lists of its first n - ceil(0.75 n) + 1
  shingles; small sets that could link with a large one stand in them too;
* the boundary between small and large is where the listed pairs would cost
  more than scanning the lists, from the histogram of sizes and the sketch.

A list's members are not paired all with all.  First every member meets a
leader of its list (four orders of leaders; lists of frequent shingles are
salted), pairs are verified on the whole sets, and links join nodes to
components.  Lists that still hold more than one component get other leaders
twice, and what is left of them after that is paired across components only.  What is left out this way would link
nodes already connected, so components are exact.

Sets of n and m that link share ceil(0.75 (n + m) / 1.75) shingles, so the shingle (or
the later one of the pair) by which they first meet stands among the first n, and m,
less that many, plus one (two) of each.  Rows carry the place of their shingle: one
whose list has no other set of a size that this allows is dropped, and members
pair up only where both places allow it.

Defined results for odd input: no text or no word gives the empty set, size 0,
linked with nothing; a document of fewer than five words has one shingle, its
whole sequence; repeated rows are separate members of one node; a null doc_id
takes part in links but names no component unless it is alone (then null); an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.llm.common import fresh, in_parts, small_side, stored
from climark.llm.components import components

WORDS = 5
PERCENT = 75                  # links: 100 * intersection >= PERCENT * union
SKETCH = 1 << 19              # counters for all shingles
SCAN_COST = 1.0               # of a member met in a list, against a listed row
LEADER_TURNS = 2              # further leaders of lists with several components, before pairs across them
HOT = 5000                    # rows of a list from which it is salted
BROADCAST_IDS = 1_000_000     # document ids that may be broadcast (8 MB)
CHUNK = 1 << 18               # bytes of text hashed at once (one text at least)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


#: A random 64-bit number for each byte; A-Z have those of a-z.
_BYTES = _mix((np.arange(256, dtype=np.uint64) + np.uint64(32) * ((np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
                                                                 ).astype(np.uint64) + np.uint64(1)) * _BASE)


def _chunk_shingles(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Shingle sets of texts that lie one after another in ``data``; ``ends``
    are their ends.  A word's hash is a polynomial of its bytes, taken from
    running sums over the whole chunk."""
    n = len(ends)
    begins = np.concatenate([[0], ends[:-1]])
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    edge = begins[(begins > 0) & (begins < len(data))]        # a text's end also ends a word
    first[edge] = inside[1:-1][edge]
    last[edge - 1] = inside[1:-1][edge - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    power = np.full(len(data) + 1, _BASE)
    power[0] = 1
    back = np.full(len(data) + 1, _BACK)
    back[0] = 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * np.multiply.accumulate(power)[:-1], out=sums[1:])
    words = _mix((sums[stop] - sums[start]) * np.multiply.accumulate(back)[start])
    at = np.searchsorted(start, np.concatenate([begins, [len(data)]])).tolist()
    whole = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        whole = whole * _BASE + words[k:k + len(whole)]
    whole = _mix(whole ^ np.uint64(WORDS))
    out = []
    for a, b in zip(at[:n], at[1:]):
        if b - a >= WORDS:
            own = np.sort(whole[a:b - WORDS + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = one * _BASE + words[k:k + 1]
            out.append(_mix(one ^ np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        to = min(to, len(texts))
        yield from _chunk_shingles(data[offsets[at]:offsets[to]], offsets[at + 1:to + 1] - offsets[at])
        at = to


def node_of(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def signature(own: np.ndarray) -> bytes:
    """Parities of the set in 2 to 4 cells per member: a set and another differ
    in at least as many members as their signatures do in cells."""
    cells = 1 << max(6, (2 * len(own) - 1).bit_length())
    odd = np.bincount(((own >> np.uint64(20)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(n: int, own: bytes, m: int, other: bytes) -> bool:
    """False if the signatures show that two sets cannot link."""
    x, y = int.from_bytes(own, "little"), int.from_bytes(other, "little")
    cells, to = 8 * len(own), 8 * len(other)
    if cells < to:
        x, y, cells, to = y, x, to, cells
    while cells > to:
        cells //= 2
        x = (x & ((1 << cells) - 1)) ^ (x >> cells)
    overlap = -(-PERCENT * (n + m) // (100 + PERCENT))
    return (x ^ y).bit_count() <= n + m - 2 * overlap


def _keep(n: int) -> int:
    """Least overlap of a set of n with any set it links with."""
    return -(-PERCENT * n // 100)


def _partners(group: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether a row's list has another set that it may link with by size and place; rows are
    sorted by list and size."""
    low = -(-PERCENT * n // 100)
    high = np.maximum(np.minimum(100 * n // PERCENT, (100 + PERCENT) * (n - place) // PERCENT - n), 0)
    rows = (group << 32) + n
    others = np.searchsorted(rows, (group << 32) + high, "right") - np.searchsorted(rows, (group << 32) + low)
    return others > (high >= n)


def _facts(docs: DataFrame) -> DataFrame:
    """Per document its node, size and signature; per task its counts in the sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(SKETCH, np.int64), set()
        for batch in in_parts(batches):
            ns, nodes, signs, new = [], [], [], []
            for own in shingle_sets(batch.column(1)):
                node = node_of(own)
                ns.append(len(own))
                nodes.append(node)
                if node in seen:
                    signs.append(None)             # another row of this task has it
                else:
                    seen.add(node)
                    signs.append(signature(own))
                    new.append((own & np.uint64(SKETCH - 1)).astype(np.int64))
            if new:
                counts += np.bincount(np.concatenate(new), minlength=SKETCH)
            m = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "text_hash": batch.column(2), "n": pa.array(ns, pa.int64()),
                "node": pa.array(nodes, pa.binary()), "sign": pa.array(signs, pa.binary()),
                "slot": pa.nulls(m, pa.int32()), "hits": pa.nulls(m, pa.int64())})
        slots = np.flatnonzero(counts)
        for at in range(0, len(slots), 1 << 16):
            part = slots[at:at + (1 << 16)]
            m = len(part)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.nulls(m, pa.int64()), "text_hash": pa.nulls(m, pa.int64()),
                "n": pa.nulls(m, pa.int64()), "node": pa.nulls(m, pa.binary()), "sign": pa.nulls(m, pa.binary()),
                "slot": pa.array(part, pa.int32()), "hits": pa.array(counts[part], pa.int64())})

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, text_hash long, n long, node binary, sign binary, slot int, hits long")


def frequency_rank(hits: np.ndarray) -> np.ndarray:
    """0 for cells that hold no more than chance puts there, then by doubling
    of what they hold beyond it."""
    typical = float(hits.mean())
    noise = 4 * np.sqrt(typical) + 4
    return np.where(hits - typical < noise, 0, 1 + np.log2(np.maximum(hits - typical, noise) / noise)).astype(np.int64)


def boundary(sizes: dict[int, int], order: np.ndarray) -> int:
    """Largest size of a small set.  Listing a pair of prefix shingles costs a
    row; looking a shingle up costs a row and the scan of its list.  Lists are as
    long as the sketch says for shingles that are not frequent (frequent ones
    come last in the order), above what its cells hold by chance."""
    light = order[frequency_rank(order) == 0].astype(float)
    total = float(light.sum())
    length = max(0.0, float((light ** 2).sum()) / total - float(light.mean()) - 1) if total else 0.0
    best = 3
    for n in sorted(sizes):
        short = n - _keep(n) + 1
        if (short + 1) / 2 > 1 + SCAN_COST * length:
            break
        best = max(best, n)
    return best


def _lists(docs: DataFrame, order: np.ndarray, small: int) -> DataFrame:
    """(key, salt, node, n, big, place): one row for each list a node stands in; salt
    is the part of a frequent list, -1 where the list is whole; place counts from 0, for
    a pair of shingles from its later one, less one."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, seen = shared.value, set()
        rank = frequency_rank(hits)
        for batch in batches:
            keys, salts, nodes, ns, bigs, places = [], [], [], [], [], []
            held = 0
            for own in shingle_sets(batch.column(1)):
                n = len(own)
                node = node_of(own)
                if n < 3 or node in seen:      # sets of one or two shingles link with equal sets only
                    continue
                seen.add(node)
                slot = (own & np.uint64(SKETCH - 1)).astype(np.int64)
                front = np.lexsort((own, rank[slot]))[:n - _keep(n) + 2]
                first, common = own[front], hits[slot[front]]
                found = []
                if n <= small:
                    i, j = np.triu_indices(len(first), 1)
                    found.append((_mix(first[i] * _BASE + first[j]), np.minimum(common[i], common[j]), False, j - 1))
                if 100 * n >= PERCENT * (small + 1):
                    found.append((first[:-1], common[:-1], True, np.arange(len(first) - 1)))
                for key, often, big, place in found:
                    keys.append(key.view(np.int64))
                    parts = often // HOT + 1
                    salts.append(np.where(parts > 1, int.from_bytes(node[:4], "little") % parts, -1).astype(np.int32))
                    nodes += [node] * len(key)
                    ns.append(np.full(len(key), n, np.int32))
                    bigs.append(np.full(len(key), big))
                    places.append(place.astype(np.int32))
                    held += len(key)
                if held > 200_000:
                    yield _rows(keys, salts, nodes, ns, bigs, places)
                    keys, salts, nodes, ns, bigs, places, held = [], [], [], [], [], [], 0
            if held:
                yield _rows(keys, salts, nodes, ns, bigs, places)

    return docs.mapInArrow(run, "key long, salt int, node binary, n int, big boolean, place int")


def _rows(keys, salts, nodes, ns, bigs, places) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "key": pa.array(np.concatenate(keys)), "salt": pa.array(np.concatenate(salts)),
        "node": pa.array(nodes, pa.binary()), "n": pa.array(np.concatenate(ns)), "big": pa.array(np.concatenate(bigs)),
        "place": pa.array(np.concatenate(places))})


def _shared(rows: DataFrame) -> DataFrame:
    """The lists with two or more nodes, each row with a leader of its list, without the
    rows that nothing in their list can link with.  Rows come sorted by list and size; a
    long list is led chunk by chunk, and the chunks' leaders are chained."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lead = None, None          # the last row, if its list may go on; its list's last leader
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            m = batch.num_rows
            key, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
            begin = np.flatnonzero(new)
            size = np.diff(np.concatenate([begin, [m]]))
            group = np.cumsum(new) - 1
            node = batch.column(2)
            first8 = np.frombuffer(node.buffers()[2], "V16", m, 16 * node.offset).view([("x", "<u8"), ("y", "<u8")])["x"]
            # parts of salted lists, and the batch's first and last list, may have members elsewhere
            cut = (salt >= 0) | (group == 0) | (group == group[-1])
            able = cut | _partners(group, batch.column(3).to_numpy().astype(np.int64), batch.column(5).to_numpy().astype(np.int64))
            order = np.where(able, _mix(first8 ^ ((key & 3).view(np.uint64) * _BASE)), ~np.uint64(0))
            low = np.minimum.reduceat(order, begin)
            at = np.flatnonzero(order == low[group])
            leader = np.zeros(len(begin), np.int64)
            leader[group[at][::-1]] = at[::-1]
            # the last row waits for the next batch; a list of one row is none
            left = np.bincount(group, able)[group]
            keep = ((left > 1) | (salt >= 0)) & able
            # a whole list of two has no pair but its leader's
            more = (left > 2) | cut
            chained = pa.array(leader[group])
            leaders, leader_n = node.take(chained), batch.column(3).take(chained)
            keep[-1] = False
            out = pa.RecordBatch.from_arrays([*batch.columns, leaders, leader_n, pa.array(more)],
                                             names=[*batch.schema.names, "leader", "leader_n", "more"])
            yield out.filter(pa.array(keep))
            if lead is not None and lead[0] == key[0] and lead[1] == salt[0]:
                yield _chain(batch, int(leader[0]), lead)
            g = int(group[-1])
            lead = (int(key[-1]), int(salt[-1]), node[int(leader[g])].as_py(), batch.column(3)[int(leader[g])].as_py()) \
                if size[g] > 1 else None
            held = batch.slice(m - 1, 1)
        if held is not None and (lead is not None or held.column(1)[0].as_py() >= 0):
            own = lead or (0, 0, held.column(2)[0].as_py(), held.column(3)[0].as_py())
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array([own[2]], pa.binary()), pa.array([own[3]], pa.int32()), pa.array([True])],
                names=[*held.schema.names, "leader", "leader_n", "more"])

    def _chain(batch: pa.RecordBatch, at: int, lead: tuple) -> pa.RecordBatch:
        row = batch.slice(at, 1)
        return pa.RecordBatch.from_arrays(
            [*row.columns, pa.array([lead[2]], pa.binary()), pa.array([lead[3]], pa.int32()), pa.array([True])],
            names=[*row.schema.names, "leader", "leader_n", "more"])

    return (rows.repartition("key", "salt").sortWithinPartitions("key", "salt", "n").mapInArrow(
        run, "key long, salt int, node binary, n int, big boolean, place int, leader binary, leader_n int, more boolean"))


def _sets(docs: DataFrame, ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of ``nodes``; ``ids`` (doc_id) names a document of each."""
    picked = docs.join(small_side(ids.withColumnRenamed("doc_id", "_pick"), BROADCAST_IDS),
                       F.col("doc_id").eqNullSafe(F.col("_pick")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(shingle_sets(batch.column(1)))
            ends = np.cumsum([0, *map(len, own)])
            flat = np.concatenate([np.zeros(0, np.uint64), *own]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(x) for x in own], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["node", "shingles"])

    # repeated document ids bring several rows; a node keeps one of its equal sets
    return (picked.mapInArrow(run, "node binary, shingles array<long>").join(nodes, "node", "left_semi")
            .dropDuplicates(["node"]))


def _likely(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(2, 6)))
            yield batch.select([0, 1]).filter(pa.array([may_link(*row) for row in rows], pa.bool_()))

    left = signs.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sign").alias("sa"))
    right = signs.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sign").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "sa", "nb", "sb").mapInArrow(
        run, "a binary, b binary")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, verified on the whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def _sizes_fit(x: str, y: str):
    return (100 * F.least(x, y) >= PERCENT * F.greatest(x, y))


def _places_fit(a: str, b: str):
    """Both rows' places allow that their sets link and meet here first."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.ceil(PERCENT * (n + m) / (100 + PERCENT))
    return (F.col(f"{a}.place") <= n - need) & (F.col(f"{b}.place") <= m - need)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles (set size), component_id (the
    smallest doc_id reachable by links, its own included), text_hash (xxhash64
    of the text) and stays: true for the first member of each component by
    doc_id (null last), then text_hash, and for empty sets."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    facts = stored(_facts(rows), "shingle_facts")
    members = facts.filter("n is not null").select("doc_id", "text_hash", "n", "node", "sign")
    member = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")

    # the sketch (SKETCH counters) and the histogram of small sizes are bounded
    order = np.zeros(SKETCH, np.int64)
    for slot, hits in facts.filter("slot is not null").groupBy("slot").agg(F.sum("hits")).toLocalIterator():
        order[slot] = hits
    sizes = {r["n"]: r["c"] for r in members.filter("n between 3 and 4096").groupBy("n").agg(
        F.count(F.lit(1)).alias("c")).collect()}
    small = boundary(sizes, order)

    hot = F.col("salt") >= 0
    lists = stored(_shared(_lists(rows, order, small)), "lists")
    met = lists.filter((F.col("leader") != F.col("node")) & _sizes_fit("n", "leader_n")).select(
        F.col("leader").alias("a"), F.col("node").alias("b"))
    # the leaders of a salted list's parts meet the leader of its first part
    heads = lists.filter(hot & (F.col("leader") == F.col("node"))).select("key", "salt", "node", "n")
    firsts = heads.groupBy("key").agg(F.min(F.struct("salt", "node", "n")).alias("first"))
    across = heads.join(firsts, "key").filter(_sizes_fit("n", "first.n")).select(
        F.col("first.node").alias("a"), F.col("node").alias("b"))
    met = stored(_ordered(met.union(across).filter("a <> b")), "met")

    one = members.groupBy("node").agg(F.min(member).alias("first"), F.min("n").alias("n"), F.min("sign").alias("sign"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that link, by signatures first, then by whole sets."""
        pairs = stored(_likely(pairs, one), "likely")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        ids = one.join(nodes, "node", "left_semi").select(F.col("first.doc_id").alias("doc_id")).distinct()
        return stored(_linked(pairs, stored(_sets(rows, ids, nodes), "sets")), "links")

    found = stored(components(verified(met)), "components")
    open_lists = lists.filter("more").select("key", "node", "n", "big", "place")

    def still_mixed(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
        """The rows of lists that still hold several components, with their component."""
        named = rows.join(found, "node", "left").select(
            "key", "node", "n", "big", "place", F.coalesce("root", "node").alias("root"))
        mixed = named.groupBy("key", "big").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        return stored(named.join(mixed.select("key", "big"), ["key", "big"], "left_semi"), name)

    def linked_too(found: DataFrame, more: DataFrame) -> DataFrame:
        return stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)), "components")

    # other leaders for lists that still hold several components: near copies that
    # missed one leader meet another, which is cheaper than meeting each other
    for turn in range(LEADER_TURNS):
        open_lists = still_mixed(open_lists.select("key", "node", "n", "big", "place"), found, "open_lists")
        if open_lists.isEmpty():
            break
        leaders = open_lists.groupBy("key", "big").agg(F.min_by(
            F.struct("node", "n", "root"), F.xxhash64("node", F.col("key") % 4, F.lit(turn))).alias("lead"))
        again = open_lists.join(leaders, ["key", "big"]).filter(
            (F.col("root") != F.col("lead.root")) & _sizes_fit("n", "lead.n")).select(
            F.col("lead.node").alias("a"), F.col("node").alias("b"))
        again = stored(_ordered(again).join(met, ["a", "b"], "left_anti"), "met_again")
        found = linked_too(found, verified(again))
        met = met.union(again)

    # what is left: pairs across components (an empty frame where nothing is)
    if not open_lists.isEmpty():
        open_lists = still_mixed(open_lists.select("key", "node", "n", "big", "place"), found, "open_lists")
    a, b = open_lists.alias("a"), open_lists.alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.big") == F.col("b.big"))
                   & (F.col("a.root") < F.col("b.root")) & _sizes_fit("a.n", "b.n") & _places_fit("a", "b")
                   & (~F.col("a.big") | (F.greatest("a.n", "b.n") > small))).select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    final = found if open_lists.isEmpty() else linked_too(
        found, verified(_ordered(pairs).join(met, ["a", "b"], "left_anti")))

    # first member of a component; nodes without links stand for themselves
    one = one.select("node", "first")
    final = final.join(one, "node")
    least = final.groupBy("root").agg(F.min("first").alias("least"))
    named = final.join(least, "root").select("node", "least")
    to_first = one.join(named, "node", "left").select("node", F.coalesce("least", "first").alias("least"))
    empty = F.col("n") == 0
    return members.join(to_first, "node").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"), "text_hash",
        (empty | (F.struct(*[member.getField(f) for f in ("no_id", "doc_id", "text_hash")]) == F.col("least"))).alias("stays"))


def first_of_groups(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns kept.  Documents
    without a word stay; of rows equal in doc_id and text one stays."""
    classes = stored(jaccard_components(docs, "doc_id", text_col), "classes")
    gone_id, gone_hash, key = (fresh(docs, x) for x in ("_gone_id", "_gone_hash", "_text_key"))
    text = F.xxhash64(F.col(text_col).cast("string"))
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (text == F.col(gone_hash))

    def keys(found: DataFrame) -> DataFrame:
        return found.select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash))

    kept = docs.join(small_side(keys(classes.filter(~F.col("stays"))).distinct(), BROADCAST_IDS // 2), same, "left_anti")
    again = classes.filter("stays and n_shingles > 0").groupBy("doc_id", "text_hash").count().filter("count > 1")
    if again.isEmpty():
        return kept
    again = stored(keys(again), "repeated_rows")
    single = kept.join(again, same, "left_semi").withColumn(key, text).dropDuplicates(["doc_id", key]).drop(key)
    return kept.join(again, same, "left_anti").unionByName(single)
