"""Joins and table-integrity operators: duplicate detection, insert guard,
station attach/lookups and constraint checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.functions.sizing import bounded_broadcast
from climark.schemas import MAX_NAME_LENGTH, TARGETS


def _time_bounded(old: DataFrame, new: DataFrame, time_col: str) -> DataFrame:
    """Restrict the stored side to the batch's time range (a 1-row aggregate),
    so the filter is pushed into the stored table's scan."""
    # bounds travel as strings and are cast back to the column's own type,
    # so no session/process time zone can shift them
    lo, hi = new.agg(F.min(time_col).cast("string"), F.max(time_col).cast("string")).first()
    if lo is None:
        return old.limit(0)
    dt = new.schema[time_col].dataType
    return old.where(F.col(time_col).between(F.lit(lo).cast(dt), F.lit(hi).cast(dt)))


def _digest(df: DataFrame, cols: list[str]) -> list:
    """Two 64-bit hashes of a row in which a null differs from every value."""
    parts = [x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(k), *parts).alias(f"_d{k}") for k in (1, 2)]


def _all_column_match(new: DataFrame, old: DataFrame, ignore: str | None, how: str,
                      restrict_time: bool) -> DataFrame:
    """Rows of ``new`` with (``left_semi``) or without (``left_anti``) an equal stored row.

    Rows meet by a 128-bit digest.  The batch's digests are broadcast where they are
    small by measure, so the stored side is filtered where it is read; otherwise two
    columns of it are shuffled.  The batch then meets the digests found, which are no more
    than its own."""
    cols = [c for c in new.columns if c != ignore]
    o = old.select(*cols)
    if restrict_time and "time" in cols:
        o = _time_bounded(o, new, "time")
    o = o.select(*[F.col(f"`{c}`").cast(new.schema[c].dataType).alias(c) for c in cols])
    key = ["_d1", "_d2"]
    own = new.select("*", *_digest(new, cols))
    found = o.select(*_digest(o, cols)).join(bounded_broadcast(own.select(*key).distinct()), key, "left_semi").distinct()
    return own.join(found, key, how).select(*[F.col(f"`{c}`") for c in new.columns])


def find_duplicates(new: DataFrame, old: DataFrame, ignore: str | None = None,
                    restrict_time: bool = True) -> DataFrame:
    """Rows of ``new`` equal, on every column (null-safe, optionally minus
    ``ignore``), to some stored row.  Same key with another value is *not* a
    duplicate."""
    return _all_column_match(new, old, ignore, "left_semi", restrict_time)


def insert_guard(new: DataFrame, old: DataFrame, mode: str = "insert_new", ignore: str | None = None,
                 restrict_time: bool = True) -> DataFrame:
    """Rows of ``new`` to append.

    ``insert_new``   - anti-join: only rows not already stored.
    ``reject_batch`` - the whole batch, unless any row is already stored
                       (then nothing); the existence test is a LIMIT 1 probe.
    """
    if mode == "insert_new":
        return _all_column_match(new, old, ignore, "left_anti", restrict_time)
    if mode == "reject_batch":
        has_dup = not find_duplicates(new, old, ignore, restrict_time).isEmpty()
        return new.limit(0) if has_dup else new
    raise ValueError(f"unknown mode {mode!r}")


def attach_station(df: DataFrame, stations: DataFrame, key: str = "id_ciudad") -> DataFrame:
    """Fact rows enriched with the station's name and coordinates."""
    s = stations.select(F.col("id").alias(key), "ciudad", "latitud", "longitud")
    return df.join(bounded_broadcast(s), key)


def station_id_by_name(names: DataFrame, stations: DataFrame, name_col: str = "name") -> DataFrame:
    """Exact name match, first (lowest) id, null when unknown."""
    ids = stations.groupBy(F.col("ciudad").alias(name_col)).agg(F.min("id").alias("id"))
    return names.join(bounded_broadcast(ids), name_col, "left")


def station_name_by_id(ids: DataFrame, stations: DataFrame, id_col: str = "id") -> DataFrame:
    """Name of each id (filtering the station table on its own key), null when unknown."""
    names = stations.groupBy(F.col("id").alias(id_col)).agg(F.min("ciudad").alias("ciudad"))
    return ids.join(bounded_broadcast(names), id_col, "left")


CHECKS = [("ciudades", "pk_id"), ("ciudades", "unique_ciudad"), ("ciudades", "not_null"), ("ciudades", "varchar_40"),
          ("clima", "fk_id_ciudad"), ("clima", "not_null"), ("clima", "key_id_ciudad_time"), ("predic", "fk_id"),
          ("predic", "pk_id_time"), ("predic", "not_null"), ("predic", "unsigned")]


def constraint_violations(ciudades: DataFrame, clima: DataFrame, predic: DataFrame) -> DataFrame:
    """Primary key, unique, foreign key, not-null, unsigned and length checks
    as one report (table_name, check_name, violations).

    One grouped pass a fact table, by its key, answers all of its checks; the foreign
    keys of both meet the stations in one join of the grouped rows."""
    def nulls(cols):
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])

    def grouped(table: str, df: DataFrame, station: str, required: list[str], negative) -> DataFrame:
        return df.groupBy(F.col(station).alias("_station"), "time").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(nulls(required)).alias("empty"), F.count_if(negative).alias("below")) \
            .select(F.lit(table).alias("table_name"), "_station", "n", "empty", "below")

    values = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in (("id", "id"), ("name", "ciudad"))]
    first = F.col("kind") == "id"
    own = ciudades.select(nulls(["id", "ciudad", "latitud", "longitud"]).alias("_empty"),
                          (F.length("ciudad") > MAX_NAME_LENGTH).alias("_long"), F.inline(F.array(*values)))
    own = own.groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(first & F.col("_empty")).alias("empty"),
        F.count_if(first & F.col("_long")).alias("long")).agg(
        F.count_if(first & (F.col("n") > 1)).alias("pk_id"), F.count_if(~first & (F.col("n") > 1)).alias("unique_ciudad"),
        F.sum("empty").alias("not_null"), F.sum("long").alias("varchar_40"))

    facts = grouped("clima", clima, "id_ciudad", ["id_ciudad", "time"], F.lit(False)).unionByName(grouped(
        "predic", predic, "id", ["id", "time", *TARGETS], reduce(lambda a, b: a | b, [F.col(c) < 0 for c in TARGETS])))
    known = ciudades.select(F.col("id").alias("_station")).distinct().withColumn("_known", F.lit(True))
    whole = facts.join(known, "_station", "left").groupBy("table_name").agg(
        F.sum(F.when(F.col("_known").isNull(), F.col("n")).otherwise(0)).alias("orphans"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.sum("empty").alias("empty"), F.sum("below").alias("below"))

    def names(pairs: dict):
        return F.inline(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(c).alias("violations"))
                                  for k, c in pairs.items()]))

    counts = reduce(DataFrame.unionByName, [
        own.select(F.lit("ciudades").alias("table_name"), names({c: c for c in ("pk_id", "unique_ciudad", "not_null", "varchar_40")})),
        whole.select("table_name", F.inline(F.filter(F.array(*[
            F.struct(F.when(F.col("table_name") == table, F.lit(check)).alias("check_name"), F.col(c).alias("violations"))
            for table, check, c in (("clima", "fk_id_ciudad", "orphans"), ("clima", "not_null", "empty"),
                                    ("clima", "key_id_ciudad_time", "repeated"), ("predic", "fk_id", "orphans"),
                                    ("predic", "pk_id_time", "repeated"), ("predic", "not_null", "empty"),
                                    ("predic", "unsigned", "below"))]), lambda x: x["check_name"].isNotNull())))])
    every = ciudades.sparkSession.createDataFrame(CHECKS, "table_name string, check_name string")   # empty tables too
    return every.join(counts, ["table_name", "check_name"], "left").select(
        "table_name", "check_name", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))
