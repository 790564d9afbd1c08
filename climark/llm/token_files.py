"""Token-id files: whole texts as ids, range-coded in ascending doc_id order.

``write_token_files`` sorts the documents by range partitioning (ties of
doc_id by text), encodes each with a tokenizer file, appends the end id and
writes one Parquet file per range.  A row of a file is a *frame*: whole
documents, at most about ``FRAME_IDS`` ids unless one document is longer, as

    magic "IDF1", number of documents, number of blocks (u32 each)
    doc_id (i64), id-is-null flag (u8) and length in ids (i64) of each document
    byte length of each block (u32), then the blocks of ``range_coder``

next to its place (part, frame), its number of documents and ids and the
number of ids before it in its part.  ``read_token_files`` decodes frames one
by one; the ids before a part come from one sum per part (as many rows as
files), never from one task over all frames.

Defined results for odd input: a null text counts as empty, so it has the end
id only; a null doc_id sorts first and stays null; repeated rows are written
each; an empty table gives no frames and no rows; further columns are ignored.
A lost task writes the same file again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.llm.range_coder import BLOCK, decode_blocks, encode_blocks
from climark.llm.vocab_encode import Encoder, with_encoder

FRAME_IDS = 2048 * BLOCK
FRAME = "part int, frame int, n_docs long, n_ids long, ids_before long, data binary"
_HEAD = struct.Struct("<4sII")


def _frame(docs: list[tuple], chunks: list[bytes]) -> bytes:
    ids = np.frombuffer(b"".join(chunks), "<u4")
    blocks = encode_blocks(ids)
    return b"".join([
        _HEAD.pack(b"IDF1", len(docs), len(blocks)),
        np.array([d if d is not None else 0 for d, _ in docs], "<i8").tobytes(),
        np.array([d is None for d, _ in docs], "u1").tobytes(),
        np.array([n for _, n in docs], "<i8").tobytes(),
        np.array([len(b) for b in blocks], "<u4").tobytes(), *blocks])


def read_frame(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a frame."""
    magic, n, m = _HEAD.unpack_from(data)
    if magic != b"IDF1":
        raise ValueError("not a frame of token ids")
    at = _HEAD.size
    ids = np.frombuffer(data, "<i8", n, at).tolist()
    null = np.frombuffer(data, "u1", n, at + 8 * n)
    lengths = np.frombuffer(data, "<i8", n, at + 9 * n)
    sizes = np.frombuffer(data, "<u4", m, at + 17 * n)
    ends = np.cumsum(sizes, dtype=np.int64) + at + 17 * n + 4 * m
    tokens = decode_blocks([data[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())])
    return [None if z else d for d, z in zip(ids, null)], lengths, tokens


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as token-id files below ``path``."""
    def frames(enc: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        directory, chunks, held, before, frame = [], [], 0, 0, 0

        def flush():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "frame": pa.array([frame], pa.int32()),
                "n_docs": pa.array([len(directory)], pa.int64()), "n_ids": pa.array([held], pa.int64()),
                "ids_before": pa.array([before], pa.int64()), "data": pa.array([_frame(directory, chunks)], pa.binary())})

        for batch in batches:
            for doc_id, coded in zip(batch.column(0).to_pylist(), enc.encode_each(batch.column(1))):
                coded += end
                n = len(coded) // 4
                if directory and held + n > FRAME_IDS:
                    yield flush()
                    before, frame, held, directory, chunks = before + held, frame + 1, 0, [], []
                directory.append((doc_id, n))
                chunks.append(coded)
                held += n
        if directory:
            yield flush()

    tie = F.xxhash64("_text")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    (rows.repartitionByRange(F.col("_id").asc_nulls_first(), tie)
     .sortWithinPartitions(F.col("_id").asc_nulls_first(), tie, "_text")
     .mapInArrow(with_encoder(tokenizer, frames), FRAME).write.parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (crc32 of its ids as little-endian unsigned 32-bit
    integers)."""
    files = spark.read.schema(FRAME).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(*batch.columns):
                part, before = part.as_py(), before.as_py()
                doc_ids, lengths, ids = read_frame(data.as_py())
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for n, e in zip(lengths.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "part": pa.array([part] * len(doc_ids), pa.int32()),
                    "inside": pa.array(before + ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    # one row per file: the sums and their running total are bounded by the number of files
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    begin, total = [], 0
    for row in sorted(parts, key=lambda r: r["part"]):
        begin.append((row["part"], total))
        total += row["n"]
    found = files.select("part", "ids_before", "data").mapInArrow(
        documents, "doc_id long, part int, inside long, n_tokens long, ids_crc32 long")
    return (found.join(F.broadcast(spark.createDataFrame(begin, "part int, ids long")), "part")
            .select("doc_id", (F.col("inside") + F.col("ids")).alias("start"), "n_tokens", "ids_crc32"))
