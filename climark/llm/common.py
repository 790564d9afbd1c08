"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.session import scratch_path


PART_ROWS = 256        # rows of a batch that a task works on at once


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once per row.

    Catalyst inlines a named expression into every place that uses it, also
    into a lambda that runs per array element; binding it as a lambda
    variable keeps it to one evaluation."""
    return F.transform(F.array(value), body)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = name
    while out.lower() in taken:
        out = f"_{out}"
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the
    lineage; survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join: broadcast if it has at most ``rows`` rows (counted, and
    no further than that), else left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def share_join(rows: DataFrame, facts: DataFrame, on: list[tuple[str, str]], weight: str,
               limit: int = 200_000) -> DataFrame:
    """Inner join (nulls equal) of ``rows`` with ``facts``, a stored table of one row a key
    whose column ``weight`` says how many of ``rows`` have the key.  Keys that hold at
    least 1/``limit`` of them, at most ``limit`` keys, are broadcast; the others, bounded
    in turn, meet in a shuffle.  ``on`` has pairs of column names, different on both sides."""
    size = facts.agg(F.count(F.lit(1)).alias("keys"), F.sum(weight).alias("rows")).first()
    least = 0 if size["keys"] <= limit else -(-size["rows"] // limit)
    same = functools.reduce(Column.__and__, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in on])
    found = rows.join(F.broadcast(facts.filter(F.col(weight) >= least)), same)
    return found if not least else found.unionByName(rows.join(facts.filter(F.col(weight) < least), same))


def in_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``PART_ROWS`` rows; at the end, Arrow's spare memory
    goes back, as idle workers stay beside those of later stages."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)
    pa.default_memory_pool().release_unused()


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold kept from training: crc32(doc_id as text) mod folds = 0.
    A null id counts as the empty string (crc32 0), so it is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0
