"""Registry of named queries: Spark plan builder + optional DuckDB oracle SQL.

Every query reads the driver's tables through ``Tables`` (so its work grows
with them) and returns a lazy DataFrame.  Computed columns carry the same
aliases in the Spark plan and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from climark.plans.oracle_sql import q
from climark.sources.bridge import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
SURVEY_ID: dict[str, str] = {}


def register(name: str, survey_id: str, sql: str | None = None, materialize: bool = False):
    """Register ``fn(tables) -> DataFrame`` under ``name``.

    ``materialize``: multi-pass queries checkpoint the bridged daily table
    once (stations x days rows) instead of re-running the lineitem join per
    pass; single-pass queries stay fully lazy so filters reach the scans."""
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir, materialize=materialize))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        SURVEY_ID[name] = survey_id
        if sql is not None:
            ORACLE[name] = q(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from climark.plans import queries_core, queries_ml, queries_seq, queries_stream  # noqa: F401
