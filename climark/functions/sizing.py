"""Size-checked broadcast.

A side is broadcast only after it has been measured below a bound in bytes;
otherwise the join is left to a shuffle join, where AQE's skew-join splitting
handles hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 8 << 20
STRING_BYTES = 64  # counted for a string, array or struct cell


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row as the bound counts them."""
    fixed = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    return 8 + sum(fixed.get(k, STRING_BYTES if k == "string" or "<" in k else 8) for k in kinds)


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` as a broadcast side if it has at most ``max_bytes``, else ``df``
    itself, left to a shuffle join.  The rows that decide this (no more than the
    bound allows) are kept as a literal relation: they are not computed again
    and nothing stays in the cache."""
    most = max(1, max_bytes // row_bytes(df))
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
