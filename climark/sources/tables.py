"""Station tables: bootstrap, scans, appends with the duplicate guard,
dimension seeding/registration and the landing-zone read.

Tables are parquet folders partitioned by station; appends only ever add files
(single writer per table).  An append has a batch id and two records beside the
table: ``begun`` before its files are written and ``done`` (with the rows and a digest
of them) after.  A repeated run that finds ``done`` appends nothing; one that finds
only ``begun`` adds what the broken run did not get to store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.functions.sizing import bounded_broadcast
from climark.operators.cleaning import fill_missing_zero
from climark.operators.integrity import insert_guard
from climark.schemas import FIRST_UPDATE_DATE, SEED_STATION, STATION_KEY, TABLES

PARTITION = {"clima": "id_ciudad", "predic": "id"}


def bootstrap_tables(spark: SparkSession, base: str) -> dict[str, str]:
    """Create the three tables (empty, with their schemas) when absent."""
    paths = {}
    for name, schema in TABLES.items():
        path = f"{base.rstrip('/')}/{name}"
        w = spark.createDataFrame([], schema).write.mode("ignore")  # the writer asks the path's own file system
        if name in PARTITION:
            w = w.partitionBy(PARTITION[name])
        w.parquet(path)
        paths[name] = path
    return paths


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{base.rstrip('/')}/{name}").select(*TABLES[name].names)


def scan_station(df: DataFrame, table: str, station_id: int) -> DataFrame:
    """Rows of one station, filtered on the table's own station key."""
    return df.where(F.col(STATION_KEY[table]) == F.lit(station_id))


def ddl(database: str, base: str) -> list[str]:
    """The statements that create the three tables in a catalog, each only if absent."""
    out = [f"CREATE SCHEMA IF NOT EXISTS {database} LOCATION '{base.rstrip('/')}'"]
    for name, schema in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
        parted = f" PARTITIONED BY ({PARTITION[name]})" if name in PARTITION else ""
        out.append(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{parted} "
                   f"LOCATION '{base.rstrip('/')}/{name}' "
                   f"TBLPROPERTIES ('required' = '{','.join(f.name for f in schema if not f.nullable)}')")
    return out


def bootstrap_catalog(spark: SparkSession, base: str, database: str) -> None:
    """Create schema and tables in the session's catalog over the folders of
    ``bootstrap_tables``; a second run changes nothing."""
    bootstrap_tables(spark, base)
    for statement in ddl(database, base):
        spark.sql(statement)


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name, data_type, required, partition) as the catalog has them;
    ``required`` by the table's property, since file tables keep no NOT NULL."""
    rows = []
    for name in sorted(t.name for t in spark.catalog.listTables(database)):
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").collect()}
        required = properties.get("required", "").split(",")
        rows += [(name, c.name, c.dataType, c.name in required, c.isPartition)
                 for c in spark.catalog.listColumns(f"{database}.{name}")]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, required boolean, "
                                       "partition boolean")


def _records(spark: SparkSession, base: str, name: str) -> str:
    return f"{base.rstrip('/')}/commits/{name}"


RECORD = "batch_id string, state string, rows long, digest long"


def _note(spark: SparkSession, base: str, name: str, *record) -> None:
    spark.createDataFrame([record], RECORD).coalesce(1).write.mode("append").parquet(_records(spark, base, name))


def commits(spark: SparkSession, base: str, name: str) -> DataFrame:
    """(batch_id, state, rows, digest) of the appends to a table; empty before the first."""
    path = _records(spark, base, name)
    spark.createDataFrame([], RECORD).write.mode("ignore").parquet(path)
    return spark.read.schema(RECORD).parquet(path)


def append_rows(spark: SparkSession, base: str, name: str, batch: DataFrame, mode: str = "insert_new",
                ignore: str | None = None, batch_id: str | None = None) -> int:
    """Fill nulls with 0, drop rows already stored (``insert_new``) or the whole batch if
    any is stored (``reject_batch``) or nothing (``as_judged``), append.  Returns the rows
    appended by this run; a ``batch_id`` that is done appends nothing."""
    batch_id = batch_id or uuid.uuid4().hex
    states = {r["state"] for r in commits(spark, base, name).where(F.col("batch_id") == batch_id).collect()}
    if "done" in states:
        return 0
    if "begun" in states:
        mode = "insert_new"     # judged before; what is stored of it came from the broken run
    rows = fill_missing_zero(batch.select(*TABLES[name].names))
    if mode != "as_judged":
        rows = insert_guard(rows, read_table(spark, base, name), mode=mode, ignore=ignore)
    staged = rows.checkpoint(eager=True)  # one slice for all that follows
    facts = staged.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*staged.columns)).alias("digest")).first()
    _note(spark, base, name, batch_id, "begun", facts["rows"], facts["digest"])
    if facts["rows"]:
        w = staged.write.mode("append")
        if name in PARTITION:
            w = w.partitionBy(PARTITION[name])
        w.parquet(f"{base.rstrip('/')}/{name}")
    _note(spark, base, name, batch_id, "done", facts["rows"], facts["digest"])
    return facts["rows"]


def seed_dimension(stations: DataFrame, seeds: DataFrame) -> DataFrame:
    """INSERT IGNORE: seed rows whose id or name already exists are skipped."""
    s = seeds.join(stations.select("id"), "id", "left_anti") \
        .join(stations.select("ciudad"), "ciudad", "left_anti")
    return stations.unionByName(s.select(*stations.columns))


def seed_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([SEED_STATION], "id int, ciudad string, latitud double, longitud double")


def station_coverage(landing: DataFrame, stations: DataFrame, start: str, end: str,
                     key: str = "id_ciudad") -> DataFrame:
    """Per station: rows, first and last day inside [start, end] and a
    ``covered`` flag (any row at all)."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    agg = landing.where(F.col("time").between(lo, hi)).groupBy(F.col(key).alias("id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
    return stations.select("id", "ciudad").join(agg, "id", "left").select(
        "id", "ciudad", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "first_time", "last_time",
        (F.coalesce("n_rows", F.lit(0)) > 0).alias("covered"))


def register_stations(stations: DataFrame, candidates: DataFrame, covered: DataFrame | None = None) -> DataFrame:
    """Append new stations: candidates (ciudad, latitud, longitud) that are
    covered and not yet known get ids max(id)+1, max(id)+2, ... in name
    order.  Returns the full station table after registration."""
    c = candidates.join(stations.select("ciudad"), "ciudad", "left_anti").groupBy("ciudad").agg(
        F.min(F.struct("latitud", "longitud")).alias("_at")).select("ciudad", "_at.latitud", "_at.longitud")
    if covered is not None:
        c = c.join(covered.select("ciudad"), "ciudad", "left_semi")
    base = stations.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]  # one scalar
    # New-station batches are requests, bounded by the candidate list; the
    # ordinal uses a name-prefix bucket + per-bucket offsets (no single task
    # ever holds all names).
    from climark.operators.sequences import sequence_index
    idx = sequence_index(c, [], ["ciudad"], F.substring("ciudad", 1, 2), name="_k")
    new = idx.select(
        (F.lit(base) + F.col("_k") + 1).cast("int").alias("id"), "ciudad",
        F.col("latitud").cast("double"), F.col("longitud").cast("double"))
    return stations.unionByName(new)


def ensure_coordinates(names: DataFrame, stations: DataFrame, candidates: DataFrame,
                       covered: DataFrame | None = None) -> DataFrame:
    """Coordinates for each requested name; unknown names are registered
    from ``candidates`` first.  (name, id, latitud, longitud, registered)."""
    known = stations.select("ciudad")
    after = register_stations(stations, candidates.join(names.withColumnRenamed("name", "ciudad"), "ciudad",
                                                        "left_semi"), covered)
    out = names.join(after.withColumnRenamed("ciudad", "name"), "name", "left")
    flag = names.join(known.withColumnRenamed("ciudad", "name").withColumn("_known", F.lit(True)), "name", "left")
    return out.join(flag, "name").select("name", "id", "latitud", "longitud",
                                         F.col("_known").isNull().alias("registered"))


def update_range(stored: DataFrame, stations: DataFrame, as_of: str,
                 first_date: str = FIRST_UPDATE_DATE, key: str = "id_ciudad") -> DataFrame:
    """Per station: the day range to fetch, [last stored + 1 day or
    ``first_date``, ``as_of``], and ``skip`` when nothing is due."""
    last = stored.groupBy(F.col(key).alias("id")).agg(F.max("time").alias("last_time"))
    asof = F.lit(as_of).cast("timestamp_ntz")
    start = F.coalesce(F.col("last_time") + F.expr("INTERVAL 1 DAY"), F.lit(first_date).cast("timestamp_ntz"))
    return stations.select("id").join(last, "id", "left").select(
        "id", "last_time", start.alias("fetch_start"), asof.alias("fetch_end"),
        (F.col("last_time").isNotNull() & (F.col("last_time") >= asof)).alias("skip"))


def landing_fetch(landing: DataFrame, ranges: DataFrame, stations: DataFrame, key: str = "id_ciudad") -> DataFrame:
    """All stations' due rows in one job: landing rows inside each station's
    [fetch_start, fetch_end] range (broadcast range table, one row per
    station), station id attached through the station table."""
    r = bounded_broadcast(ranges.where(~F.col("skip")).select(F.col("id").alias(key), "fetch_start", "fetch_end"))
    due = landing.join(r, key).where(F.col("time").between(F.col("fetch_start"), F.col("fetch_end")))
    known = bounded_broadcast(stations.select(F.col("id").alias(key)))
    return due.join(known, key, "left_semi").select(*landing.columns)


def latest_by_station(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.max("time").alias("last_time"))


__all__ = ["bootstrap_tables", "bootstrap_catalog", "catalog_columns", "commits", "read_table", "scan_station", "append_rows", "seed_dimension", "seed_rows",
           "station_coverage", "register_stations", "ensure_coordinates", "update_range", "landing_fetch",
           "latest_by_station"]
