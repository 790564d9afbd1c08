"""Vector code compression: a small codebook for each part of the vectors, distances by
per-dimension value dictionaries.

Components become integers, floor(``SCALE`` * x).  A block of vectors keeps, for every
dimension, the distinct integers of the block (its dictionary) and a code per vector.
Squared differences of every dictionary value to all codebook entries are tabulated
once a dimension; a vector's distances in a part are then rows gathered from these
tables by its codes and added up over the part's dimensions.  The nearest entry is the
least distance, ties to the lower index.  Codebooks start from the vectors of the
smallest ids and follow ``ROUNDS`` rounds of assignment and componentwise
floor(sum / count); an entry without vectors stays.  All arithmetic is on integers
(32 or 64 bit where the largest possible distance fits, Python's beyond that).

Scale: blocks are stored once, in dictionary form, and read by every round; a block has
at most ``BLOCK_VALUES`` components.  Codebooks (entries x dimensions) are all that is
broadcast, and their sums, added up by Spark per (dimension, entry), all that
comes to the driver.  The error per label is joined by broadcast for labels that hold a
share of the vectors and by shuffle for the others (``share_join``).

Defined results for odd input: a null vector and one with a null or non-finite component
is dropped, so is a vector of another length than that of the smallest kept id;
components beyond +-2**52 after scaling count as +-2**52, errors beyond a long as the
largest long; null ids come after all others when the codebooks start; repeated rows
count each; parts of a length that 4 does not divide begin at floor(length * part / 4);
fewer than 256 kept vectors give as many entries; no vectors give no rows; further columns
are passed through, result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climark.llm.common import share_join, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_VALUES = 1 << 20
LONGEST = 1 << 52          # scaled components are kept within this
_MAX = 2 ** 63 - 1


def valid(vector: Column) -> Column:
    """True for a vector without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | ~(F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """(rows, dims) int64 of valid vectors of one length."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * SCALE), -LONGEST, LONGEST).astype(np.int64)


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (k, dimensions) int64: row e holds entry e of every part."""
    entries: np.ndarray
    parts: int = PARTS

    @property
    def bounds(self) -> list[tuple[int, int]]:
        d = self.entries.shape[1]
        cut = [d * p // self.parts for p in range(self.parts + 1)]
        return list(zip(cut[:-1], cut[1:]))

    def digest(self) -> str:
        """SHA-256 of all components by part, entry, position, comma-joined."""
        order = np.concatenate([self.entries[:, a:b].reshape(-1) for a, b in self.bounds])
        return hashlib.sha256(",".join(map(str, order.tolist())).encode()).hexdigest()


@dataclass
class Block:
    """Vectors in dictionary form: the distinct integers of every dimension, and the
    position of each vector's integer among them."""
    values: list[np.ndarray]
    codes: np.ndarray               # (dims, rows) int32

    @classmethod
    def of(cls, matrix: np.ndarray) -> "Block":
        values, codes = [], np.empty(matrix.shape[::-1], np.int32)
        for j in range(matrix.shape[1]):
            found, codes[j] = np.unique(matrix[:, j], return_inverse=True)
            values.append(found)
        return cls(values, codes)

    @property
    def rows(self) -> int:
        return self.codes.shape[1]

    def nearest(self, books: Codebooks) -> tuple[np.ndarray, list]:
        """Entry of every vector in each part (parts, rows) and the distances, one array
        a part (int64, or Python integers where they may not fit)."""
        best, least = np.empty((books.parts, self.rows), np.int64), []
        for p, (a, b) in enumerate(books.bounds):
            top = sum((max(int(v[-1]), int(e.max())) - min(int(v[0]), int(e.min()))) ** 2
                      for v, e in ((self.values[j], books.entries[:, j]) for j in range(a, b)))
            kind = np.int32 if top < 2 ** 31 else np.int64 if top < 2 ** 63 else object
            total = np.zeros((self.rows, len(books.entries)), kind)
            for j in range(a, b):
                table = (self.values[j].astype(kind)[:, None] - books.entries[:, j].astype(kind)[None, :]) ** 2
                total += table[self.codes[j]]
            best[p] = total.argmin(axis=1)
            own = total[np.arange(self.rows), best[p]]
            least.append(own if kind is object else own.astype(np.int64))
        return best, least

    def sums(self, best: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
        """Vectors (parts, k) and componentwise sums (k, dims; exact) by entry."""
        k = len(books.entries)
        counts = np.array([np.bincount(x, minlength=k) for x in best])
        sums = np.zeros(books.entries.shape, object)
        for p, (a, b) in enumerate(books.bounds):
            order = np.argsort(best[p], kind="stable")
            used = np.flatnonzero(counts[p])
            starts = (np.cumsum(counts[p]) - counts[p])[used]
            for j in range(a, b):
                column = self.values[j][self.codes[j]][order]
                wide = self.rows * max(abs(int(column.max())), abs(int(column.min()))) >= 2 ** 63
                sums[used, j] = np.add.reduceat(column.astype(object) if wide else column, starts)
        return counts, sums

    def packed(self) -> dict:
        sizes = [len(v) for v in self.values]
        return {"rows": self.rows, "sizes": sizes, "values": np.concatenate(self.values).tobytes() if sizes else b"",
                "codes": self.codes.tobytes()}

    @classmethod
    def unpacked(cls, rows: int, sizes: list[int], values: bytes, codes: bytes) -> "Block":
        flat = np.frombuffer(values, np.int64)
        return cls(np.split(flat, np.cumsum(sizes)[:-1]) if sizes else [],
                   np.frombuffer(codes, np.int32).reshape(len(sizes), rows))


_BLOCK = "rows int, sizes array<int>, values binary, codes binary"


def _slices(rows: int, dims: int) -> Iterator[slice]:
    step = max(1, BLOCK_VALUES // max(dims, 1))
    return (slice(i, min(i + step, rows)) for i in range(0, rows, step))


def blocks_of(vectors: DataFrame, vector_col: str, dims: int) -> DataFrame:
    """The valid vectors in dictionary form, a block a row."""
    rows = vectors.select(F.col(f"`{vector_col}`")).filter(_kept(vector_col, dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rows", pa.int32()), ("sizes", pa.list_(pa.int32())), ("values", pa.binary()),
                            ("codes", pa.binary())])
        held, n = [], 0
        step = max(1, BLOCK_VALUES // max(dims, 1))
        for batch in batches:
            for cut in _slices(batch.num_rows, dims):
                held.append(integers(batch.column(0)[cut], dims))
                n += len(held[-1])
                if n >= step:
                    yield pa.RecordBatch.from_pylist([Block.of(np.concatenate(held)).packed()], schema)
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_pylist([Block.of(np.concatenate(held)).packed()], schema)

    return rows.mapInArrow(run, _BLOCK)


def _kept(vector_col: str, dims: int) -> Column:
    vector = F.col(f"`{vector_col}`")
    return valid(vector) & (F.size(vector) == dims)


def first_entries(vectors: DataFrame, id_col: str, vector_col: str, entries: int = ENTRIES,
                  parts: int = PARTS) -> Codebooks | None:
    """Codebooks of the vectors with the smallest ids; None without vectors."""
    found = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v")).filter(
        valid(F.col("v")))
    first = found.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return None
    dims = len(first[0]["v"])
    same = found.filter(F.size("v") == dims).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    column = pa.array([r["v"] for r in same], pa.list_(pa.float64()))
    return Codebooks(integers(column, dims), parts)


def learn(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", entries: int = ENTRIES,
          rounds: int = ROUNDS, parts: int = PARTS) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all valid vectors; None without vectors."""
    books = first_entries(vectors, id_col, vector_col, entries, parts)
    if books is None or not rounds:
        return books
    blocks = stored(blocks_of(vectors, vector_col, books.entries.shape[1]), "vector_blocks")
    for _ in range(rounds):
        books = _moved(blocks, books)
    return books


def _moved(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one assignment of all blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        counts = np.zeros((own.parts, len(own.entries)), np.int64)
        sums = np.zeros(own.entries.shape, object)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.unpacked(**row)
                n, s = block.sums(block.nearest(own)[0], own)
                counts += n
                sums += s
        for p, (a, b) in enumerate(own.bounds):
            used = np.flatnonzero(counts[p])
            for j in range(a, b):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), j, np.int32)), pa.array(used.astype(np.int32)),
                     pa.array(counts[p][used]), pa.array([str(s) for s in sums[used, j]])],
                    names=["dim", "entry", "n", "total"])

    found = blocks.mapInArrow(tally, "dim int, entry int, n long, total string").groupBy("dim", "entry").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    entries = books.entries.copy()
    for dim, entry, n, total in found.collect():
        entries[entry, dim] = int(total) // n
    shared.destroy()
    return Codebooks(entries, books.parts)


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding") -> DataFrame:
    """The valid rows of ``vectors``, the vector replaced by code (two hex digits a part) and
    error (the squared distances to the entries, added up)."""
    dims = books.entries.shape[1]
    kept = [c for c in vectors.columns if c.lower() not in ("code", "error", vector_col.lower())]
    rows = vectors.filter(_kept(vector_col, dims)).select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{vector_col}`").alias("vector"))
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * shared.value.parts
        for batch in batches:
            for cut in _slices(batch.num_rows, dims):
                piece = batch.slice(cut.start, cut.stop - cut.start)
                best, least = Block.of(integers(piece.column(1), dims)).nearest(shared.value)
                text = best.T.astype(np.uint8).tobytes().hex()
                errors = [min(sum(map(int, own)), _MAX) for own in zip(*least)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([text[i:i + width] for i in range(0, len(text), width)], pa.string()),
                     pa.array(errors, pa.int64())], names=["row", "code", "error"])

    coded = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("code", T.StringType()),
                                               T.StructField("error", T.LongType())]))
    return coded.select(*[F.col(f"row.`{c}`") for c in kept], "code", "error")


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` (stored) with label_error: error added up over equal labels, nulls together."""
    coded = coded.drop("label_error")
    totals = coded.groupBy(F.col(f"`{label_col}`").alias("_label")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MAX)).cast("long").alias("label_error"))
    return share_join(coded, stored(totals, "label_totals"), [(label_col, "_label")], "_n").drop("_label", "_n")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """The valid rows of ``vectors`` without the vector, with code, error, label_error and
    codebooks_sha256."""
    vectors = vectors.drop("code", "error", "label_error", "codebooks_sha256")
    books = learn(vectors, id_col, vector_col)
    rows = encode(vectors.limit(0) if books is None else vectors,
                  books or Codebooks(np.zeros((1, 0), np.int64)), vector_col)
    coded = stored(rows, "vector_codes")
    return with_label_error(coded, label_col).withColumn(
        "codebooks_sha256", F.lit(books.digest() if books else None).cast("string"))
