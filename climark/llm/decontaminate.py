"""Benchmark decontamination: hashed n-gram windows of the benchmark against
every word window of the documents.

Words are runs of ASCII digits, letters (A-Z lower-cased) and any non-ASCII
character.  Every run of ``n`` consecutive words of an item is a window; an
item with fewer words (but not none) is one window.  The windows' words get
small numbers and each window a 64-bit rolling hash; a worker gets all of it by
broadcast, turns a document into numbers (0 for words no item has), hashes all
its windows at once, looks them up and verifies every hit number by number.

The broadcast is bounded: benchmarks are cut into slices of at most
``SLICE_WINDOWS`` windows, one after another: a slice is read, broadcast, scans all
documents, and is let go before the next is read; the hits of the
slices are joined by document.  One slice (the usual case) needs no shuffle.

Defined results for odd input: null or empty text has no words and no hits, a
null or empty item has no windows; an item without an id
contaminates but is no item of n_items; items with equal words are reported each;
repeated documents are judged one by one; without documents or items there are
no hits; further columns are passed through by ``drop_contaminated`` and
``cut_spans``.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climark.llm.common import fresh, in_parts, stored

WINDOW = 10
SLICE_WINDOWS = 500_000   # windows in one broadcast: about 100 MB in a worker at 10 words
_SPLIT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
               else 0x20 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOUND = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("words", T.IntegerType())]))


def words(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def _mixed(numbers: np.ndarray) -> np.ndarray:
    x = numbers.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _hashes(mixed: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every window of ``n`` numbers."""
    out = np.zeros(max(len(mixed) - n + 1, 0), np.uint64)
    for k in range(n):
        out = out * _BASE + mixed[k:k + len(out)]
    return out


@dataclass
class Grams:
    """The windows of some items, by length: sorted hashes, the numbers of
    their words, and the items of each window."""
    vocabulary: dict
    items: list
    by_length: dict

    @classmethod
    def of(cls, rows: list[tuple], n: int) -> "Grams":
        vocabulary: dict = {}
        windows: dict = {}
        for k, (_, text) in enumerate(rows):
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words((text or "").encode())]
            if numbers:
                m = min(n, len(numbers))
                for i in range(len(numbers) - m + 1):
                    windows.setdefault(m, {}).setdefault(tuple(numbers[i:i + m]), set()).add(k)
        by_length = {}
        for m, found in windows.items():
            keys = np.array(list(found), dtype=np.int64).reshape(len(found), m)
            hashes = np.array([_hashes(_mixed(row), m)[0] for row in keys], np.uint64)
            order = np.argsort(hashes, kind="stable")
            owners = [sorted(found[tuple(keys[o])]) for o in order.tolist()]
            by_length[m] = (hashes[order], keys[order], owners)
        return cls(vocabulary, [item for item, _ in rows], by_length)

    def hits(self, numbers: np.ndarray) -> list[tuple[int, int, list[int]]]:
        """(position, length, items) of every verified window in ``numbers``."""
        out = []
        known = numbers > 0
        mixed = _mixed(numbers)
        for m, (hashes, keys, owners) in self.by_length.items():
            if len(numbers) < m:
                continue
            run = np.cumsum(np.concatenate([[0], known]))
            at = np.flatnonzero(run[m:] - run[:-m] == m)       # windows with known words only
            if not len(at):
                continue
            own = np.zeros(len(at), np.uint64)
            for k in range(m):
                own = own * _BASE + mixed[at + k]
            slot = np.searchsorted(hashes, own)
            for i in np.flatnonzero(hashes.take(slot, mode="clip") == own).tolist():
                s, p = int(slot[i]), int(at[i])
                while s < len(hashes) and hashes[s] == own[i]:
                    if (keys[s] == numbers[p:p + m]).all():
                        out.append((p, m, owners[s]))
                    s += 1
        return out


def item_slices(benchmark: DataFrame, n: int, id_col: str, text_col: str,
                slice_windows: int = SLICE_WINDOWS) -> Iterator[list[tuple]]:
    """Items in slices of bounded windows, in id order; at least one slice.  Items come
    to the driver partition by partition, and it holds the slice at hand only."""
    rows = benchmark.select(F.col(id_col), F.col(text_col).cast("string")).orderBy(id_col, text_col)
    own, held = [], 0
    for item, text in rows.toLocalIterator():
        ws = words((text or "").encode())
        for at in range(0, max(1, len(ws) - n + 1), slice_windows):   # a longer item goes to several slices
            part = ws[at:at + slice_windows + n - 1] if len(ws) >= n else ws
            size = max(1, len(part) - n + 1)
            if own and held + size > slice_windows:
                yield own
                own, held = [], 0
            own.append((item, b" ".join(part).decode()))
            held += size
    yield own


def _with_end(slices: Iterator[list[tuple]]) -> Iterator[tuple[list[tuple], bool]]:
    """Each slice and whether it is the last."""
    own = next(slices)
    for following in slices:
        yield own, False
        own = following
    yield own, True


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence of a
    window), n_items, items_sha256 (of the sorted, comma-joined ids of the items
    found), contaminated; and spans, the hit stretches as (first word, end word)."""
    sc = docs.sparkSession.sparkContext
    slices = _with_end(item_slices(benchmark, n, item_col, item_text, slice_windows))
    schema = "doc_id long, n_words long, items array<string>, spans array<struct<first:int,end:int>>"

    def scan(grams):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g = grams.value
            number = g.vocabulary.get
            for batch in in_parts(batches):
                out = {"doc_id": [], "n_words": [], "items": [], "spans": []}
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                    ws = words(text or b"")
                    numbers = np.fromiter((number(w, 0) for w in ws), np.int64, len(ws))
                    found = g.hits(numbers)
                    hit = np.zeros(len(ws) + 2, np.int8)
                    for p, m, _ in found:
                        hit[p + 1:p + 1 + m] = 1
                    edge = np.flatnonzero(np.diff(hit))
                    out["doc_id"].append(doc_id)
                    out["n_words"].append(len(ws))
                    owners = {id(f[2]): f[2] for f in found}.values()
                    out["items"].append(sorted({str(g.items[k]) for ks in owners for k in ks if g.items[k] is not None}))
                    out["spans"].append([{"first": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()),
                    "items": pa.array(out["items"], pa.list_(pa.string())),
                    "spans": pa.array(out["spans"], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))})

        return run

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    part, only = next(slices)
    if only:
        hits = rows.mapInArrow(scan(sc.broadcast(Grams.of(part, n))), schema)
    else:
        # one stored pass of all documents per slice, with one slice's windows at a time;
        # a document's passes meet by its id and a hash of its text
        passes, turns = None, 0
        for own, _ in itertools.chain([(part, False)], slices):
            grams = sc.broadcast(Grams.of(own, n))
            one = stored(_with_text_key(rows, scan(grams), schema), "slice_hits")
            grams.unpersist()
            passes, turns = one if passes is None else passes.unionByName(one), turns + 1
        hits = (passes.groupBy("doc_id", "text_key").agg(
            F.max("n_words").alias("n_words"), (F.count(F.lit(1)) / turns).cast("int").alias("copies"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"))
            .withColumn("spans", _merged(F.sort_array("spans")))
            .select("doc_id", "n_words", F.sort_array("items").alias("items"), "spans",
                    F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["first"]))
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"), "spans")


def _with_text_key(docs: DataFrame, run, schema: str) -> DataFrame:
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            keys = [None if t is None else hashlib.blake2b(t, digest_size=16).digest()
                    for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for out in run([batch]):
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(keys, pa.binary())],
                                                 names=[*out.schema.names, "text_key"])
    return docs.mapInArrow(keyed, schema + ", text_key binary")


def _merged(spans):
    """Sorted (first, end) with overlapping and touching ones joined."""
    none = F.array().cast("array<struct<first:int,end:int>>")

    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["first"]), joined).otherwise(
            F.concat(acc, F.array(s)))
    return F.aggregate(spans, none, step)


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = WINDOW, text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """``docs`` without contamination, all columns kept, in one scan a slice.

    ``mode`` "documents" drops every document with a hit; "spans" cuts the hit
    stretches out of the texts instead.  Every slice sees the texts as they came:
    with several, rows carry the windows found so far, and the last slice cuts."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    sc, at, schema = docs.sparkSession.sparkContext, docs.columns.index(text_col), docs.schema
    spans, carried = mode == "spans", fresh(docs, "_found")
    rows = docs
    for part, last in _with_end(item_slices(benchmark, n, item_col, item_text, slice_windows)):
        grams, first = sc.broadcast(Grams.of(part, n)), rows is docs

        def run(batches: Iterator[pa.RecordBatch], grams=grams, first=first, last=last) -> Iterator[pa.RecordBatch]:
            g = grams.value
            number = g.vocabulary.get
            for batch in in_parts(batches):
                before = [[]] * batch.num_rows if first or not spans else batch.column(len(schema)).to_pylist()
                if spans and not first:
                    batch = batch.select(range(len(schema)))
                keep, texts, windows = [], [], []
                for text, old in zip(batch.column(at).cast(pa.binary()).to_pylist(), before):
                    ws = words(text or b"")
                    found = [(p, m) for p, m, _ in g.hits(np.fromiter((number(w, 0) for w in ws), np.int64, len(ws)))]
                    keep.append(not found or spans)
                    if spans:
                        found += [(p["at"], p["words"]) for p in old]
                        windows.append([{"at": p, "words": m} for p, m in found])
                        texts.append(_cut(text, ws, found) if found and last else text)
                if spans and last:
                    column = pa.array(texts, pa.binary()).cast(pa.string())
                    batch = batch.set_column(at, batch.schema.field(at), column.cast(batch.schema.field(at).type))
                elif spans:
                    batch = batch.append_column(carried, pa.array(windows, pa.list_(pa.struct(
                        [("at", pa.int32()), ("words", pa.int32())]))))
                yield batch.filter(pa.array(keep, pa.bool_()))

        if last:
            return rows.mapInArrow(run, schema)
        out = T.StructType(schema.fields + [T.StructField(carried, _FOUND)]) if spans else schema
        rows = stored(rows.mapInArrow(run, out), "slice_rows")
        grams.unpersist()


def _cut(text: bytes, ws: list[bytes], found: list) -> bytes:
    """``text`` without the hit words and what stands between them."""
    spread, starts, at = text.translate(_SPLIT), [], 0
    for w in ws:
        at = spread.index(w, at)
        starts.append(at)
        at += len(w)
    hit = np.zeros(len(ws) + 2, np.int8)
    for p, m in found:
        hit[p + 1:p + 1 + m] = 1
    edge = np.flatnonzero(np.diff(hit)).tolist()
    out, at = [], 0
    for a, b in zip(edge[::2], edge[1::2]):
        out.append(text[at:starts[a]])
        at = starts[b - 1] + len(ws[b - 1])
    return b"".join([*out, text[at:]])
