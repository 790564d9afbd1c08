"""Best-fit packing of documents into sequences of bounded length.

Every text is encoded whole and gets the end id; documents longer than a
sequence are cut into pieces, others stay whole.  Only the histogram of piece
lengths (at most ``capacity`` rows) goes to the driver, where bin completion
turns it into patterns.  Pieces then find their place by themselves: a piece's
rank among pieces of its length says which bin of which pattern it fills.

Ranks need no global sort: a task numbers the pieces of each length it writes,
and one running total per (length, task) makes the numbers global.  Pieces are
stored once in the shared folder, so a repeated task cannot number them anew.

Defined results for odd input: a null text counts as empty, one piece with the
end id only; a null doc_id is kept; repeated rows are packed each; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from climark.llm.bin_completion import MAX_NODES, Pattern, pack
from climark.llm.common import in_parts, stored
from climark.llm.vocab_encode import Encoder, with_encoder

CAPACITY = 2048
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents; ``with_ids`` adds their ids as little-endian u32."""
    def pieces(enc: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], "<u4").tobytes()
        for batch in in_parts(batches):
            out: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    n = len(own) // 4
                    for column, value in zip(out, (doc_id, k, at // 4, n, zlib.crc32(own), task, seen[n], own)):
                        column.append(value)
                    seen[n] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"]
            m = 7 + with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:m], kinds)], names=names[:m])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(with_encoder(tokenizer, pieces), PIECE + ", ids binary" * with_ids)


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which bins: sorted by (length, first rank)."""
    taken: Counter = Counter()
    rows, base = [], 0
    for pattern, bins in patterns:
        at = 0
        for n in pattern:
            rows.append((n, taken[n], base, at))
            taken[n] += bins
            at += n
        base += bins
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(len(rows), 4)
    return {"key": (table[:, 0] << 48) | table[:, 1], "rank": table[:, 1], "bin": table[:, 2], "offset": table[:, 3]}


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False,
                   max_nodes: int = MAX_NODES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = stored(cut_documents(docs, tokenizer, capacity, end_id, with_ids, id_col, text_col), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(places(pack(counts, capacity, max_nodes)))
    before = W.Window.partitionBy("length").orderBy("task").rowsBetween(W.Window.unboundedPreceding, -1)
    bases = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(bases, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"),
        *(["ids"] if with_ids else []))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            at = np.searchsorted(p["key"], (length << 48) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(p["bin"][at] + rank - p["rank"][at]), pa.array(p["offset"][at]),
                 *batch.columns[6:]], names=[*batch.schema.names[:5], "sequence_id", "offset", *batch.schema.names[6:]])

    return ranked.mapInArrow(place, PLACED + ", ids binary" * with_ids)
