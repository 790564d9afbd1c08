"""Line dedup: lines that many documents share stay in one document only.

Texts are split at newlines; a line's key is the line without white space at its
ends and with A-Z lower-cased.  Every key of at least ``min_chars`` code points
becomes a 128-bit hash with the document and the line's position; documents are
counted per hash; where ``min_docs`` or more documents hold a key, its lines go
from all of them but the one of the largest id.  The positions to drop are grouped
by document, and the text is put together again from the lines that stay.

Scale: texts are read twice and shuffled once (with the positions to drop); the
first shuffles hold hashes, ids and positions only.  Documents are counted by
(hash, document) first, so a line of a third of all documents is counted in many
tasks.  The keys to drop are joined with the lines by broadcast where they are few
(``BROADCAST_KEYS``); beyond that, only the most frequent keys are broadcast, of
which there are at most ``BROADCAST_KEYS`` because each holds at least that share
of the occurrences, and all others, then bounded, are joined by a shuffle.

Defined results for odd input: a null or empty text is one empty line and stays as
it is (null stays null in ``kept_text``); a null id counts as one document smaller
than every other; repeated rows of a document count as one document and each
loses the same lines; an empty table gives an empty table; further columns are
passed through, result columns replace input columns of the same name.  The text
is hashed to 128 bits, so two different keys are taken for one with a chance of
about n**2 / 2**129 for n keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climark.llm.common import share_join, stored

MIN_DOCS = 3
MIN_CHARS = 20
BROADCAST_KEYS = 200_000    # 24 bytes each: some 5 MB of data, 20 MB as a hash relation
BLOCK = 65_536              # rows of one Arrow batch of line hashes

SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(position, key) of the lines of ``text`` (UTF-8) whose key is long enough."""
    for at, line in enumerate(text.translate(_LOWER).split(b"\n")):
        key = line.strip(SPACE)
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            yield at, key


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, text_hash, pos, h1, h2) of every line that is long enough to count."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).filter(F.length("text") >= min_chars)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_of, places, digests = [], [], []
            for row, text in enumerate(batch.column(2)):
                for at, key in line_keys(text.as_py().encode(), min_chars):
                    rows_of.append(row)
                    places.append(at)
                    digests.append(xxhash.xxh3_128_digest(key))
                if len(places) >= BLOCK:
                    yield _block(batch, rows_of, places, digests)
                    rows_of, places, digests = [], [], []
            if places:
                yield _block(batch, rows_of, places, digests)

    return rows.mapInArrow(hashes, T.StructType([
        T.StructField("doc", rows.schema["doc"].dataType), T.StructField("text_hash", T.LongType()),
        T.StructField("pos", T.IntegerType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())]))


def _block(batch: pa.RecordBatch, rows_of: list, places: list, digests: list) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    at = pa.array(rows_of, pa.int32())
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(1).take(at), pa.array(places, pa.int32()),
         pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))],
        names=["doc", "text_hash", "pos", "h1", "h2"])


def shared_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper, n) of the keys that at least ``min_docs`` documents hold: the
    largest id and the number of occurrences."""
    by_doc = lines.groupBy("h1", "h2", "doc").agg(F.count(F.lit(1)).alias("n"))
    return by_doc.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"), F.sum("n").alias("n")).filter(
        F.col("docs") >= min_docs).drop("docs")


def lost_lines(lines: DataFrame, keys: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of ``lines`` whose key is in ``keys`` and whose document is not its keeper."""
    found = share_join(lines, keys.withColumnsRenamed({"h1": "key1", "h2": "key2"}), [("h1", "key1"), ("h2", "key2")],
                       "n", broadcast_keys)
    return found.filter(~F.col("doc").eqNullSafe(F.col("keeper"))).select("doc", "text_hash", "pos")


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with its text (last column but one) without the lines at the positions in
    the last column."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 2).cast(pa.large_string())
        lost = batch.column(batch.num_columns - 1)
        kept = []
        for text, gone in zip(texts, lost):
            if not gone.is_valid:
                kept.append(text.as_py())
                continue
            drop = set(gone.as_py())
            kept.append("\n".join(line for at, line in enumerate(text.as_py().split("\n")) if at not in drop))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(kept, pa.string())],
                                         names=batch.schema.names[:-1])


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                      min_chars: int = MIN_CHARS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` with n_lines (before dropping), n_dropped (long) and kept_text."""
    names = ("n_lines", "n_dropped", "kept_text")
    lines = stored(hashed_lines(docs, id_col, text_col, min_chars), "line_hashes")
    keys = stored(shared_keys(lines, min_docs), "line_keys")
    lost = lost_lines(lines, keys, broadcast_keys).groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("lost"))

    kept = [c for c in docs.columns if c.lower() not in names]
    text = F.col(f"`{text_col}`").cast("string")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{id_col}`").alias("own"),
                      F.xxhash64(F.col(f"`{text_col}`")).alias("own_hash"), text.alias("text"))
    both = row.join(lost, F.col("own").eqNullSafe(F.col("doc")) & (F.col("own_hash") == F.col("text_hash")), "left")
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1, F.lit(1)).cast("long")
    n_dropped = F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long")
    judged = both.select("row", n_lines.alias("n_lines"), n_dropped.alias("n_dropped"),
                         F.col("text").alias("kept_text"), "lost")
    out = judged.mapInArrow(_rest, judged.drop("lost").schema)
    return out.select(*[F.col(f"row.`{c}`") for c in kept], *names)
