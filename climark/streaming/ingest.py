"""Streaming forms of the daily update.

``stream_ingest_observations`` (I01): landing files -> stateful judgement by (station,
month) -> ``foreachBatch`` append.  The state store keeps a hash of the values of every day that
is stored; a micro-batch looks up the months that its rows touch and never reads
the stored table.  A row of a day without a hash is new, one with the same values is a
repeat, one with other values contradicts the stored day and goes to the reject
table.  Days may arrive in any order: a station whose history comes last is
stored whole, so there is no event-time watermark; what is kept is 8 bytes a stored day, in
RocksDB on the executors and in the checkpoint, not in memory.

The table's own files are a second source of the same stream, so rows that other
jobs stored before or between runs reach the state too, each file once.

A micro-batch that is run again after a failure gives the same verdicts, and its append
has the same batch id: a done append is not repeated, a broken one is completed.

``stream_daily_forecast`` (I02): the same stream, and after each append the
stations with new rows get their missed days forecast and appended to
the forecast table (key (station, day) never overwritten).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from climark.operators.cleaning import fill_missing_zero
from climark.schemas import MEASURES, OBSERVATIONS
from climark.sources.tables import append_rows, read_table

LANDING_SCHEMA = OBSERVATIONS

REJECTS = "rechazos"
DAY_KEY = ["id_ciudad", "time"]
DAYS = 31
NEW, REFUSED = "new", "refused"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_JUDGED = T.StructType([*OBSERVATIONS.fields, T.StructField("verdict", T.StringType())])


def _judge(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Verdicts on the delivered rows of one station and month; the state is a hash a day
    (0: no row)."""
    known = np.frombuffer(state.get[0], np.int64).copy() if state.exists else np.zeros(DAYS, np.int64)
    rows = pd.concat(list(parts))
    rows["_hash"] = rows["_hash"].where(rows["_hash"] != 0, 1)
    day = rows["time"].dt.day - 1
    for at, value in zip(day[rows["_stored"]], rows["_hash"][rows["_stored"]]):
        known[at] = known[at] or value
    rows, day = rows[~rows["_stored"]], day[~rows["_stored"]]
    rows = rows.assign(_day=day).sort_values(["_day", *MEASURES]).drop_duplicates(["_day", "_hash"])
    verdicts = []
    for at, value in zip(rows["_day"], rows["_hash"]):
        verdicts.append(NEW if known[at] == 0 else None if known[at] == value else REFUSED)
        known[at] = known[at] or value
    state.update((known.tobytes(),))
    out = rows.assign(verdict=verdicts)
    yield out[out["verdict"].notna()][[*OBSERVATIONS.names, "verdict"]]


def judged(deliveries: DataFrame) -> DataFrame:
    """New and refused rows (``verdict``) of a stream of ``OBSERVATIONS`` with ``_stored``
    (true for rows of the table)."""
    rows = fill_missing_zero(deliveries, MEASURES).withColumn("_hash", F.xxhash64(*MEASURES)).withColumn(
        "_month", F.date_trunc("month", "time").cast("timestamp_ntz"))
    return rows.groupBy("id_ciudad", "_month").applyInPandasWithState(
        _judge, _JUDGED, "days binary", "append", GroupStateTimeout.NoTimeout)


def stream_ingest_observations(spark: SparkSession, source_dir: str, tables_base: str, checkpoint: str,
                               files_per_trigger: int = 1,
                               on_batch: Callable[[DataFrame, str], None] | None = None) -> None:
    """Drain the landing folder into the observation table (trigger availableNow).
    ``on_batch(new rows, batch id)`` follows each append."""
    base = tables_base.rstrip("/")
    landed = spark.readStream.schema(LANDING_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    held = spark.readStream.schema(LANDING_SCHEMA).parquet(f"{base}/clima").select(*OBSERVATIONS.names)
    both = landed.withColumn("_stored", F.lit(False)).unionByName(held.withColumn("_stored", F.lit(True)))

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{checkpoint}#{epoch_id}"
        batch = batch.persist()
        try:
            refused = batch.where(F.col("verdict") == REFUSED).drop("verdict")
            if not refused.isEmpty():
                refused.write.mode("overwrite").parquet(f"{base}/{REJECTS}/batch={epoch_id}")
            new = batch.where(F.col("verdict") == NEW).drop("verdict")
            append_rows(spark, base, "clima", new, mode="as_judged", batch_id=batch_id)
            if on_batch is not None:
                on_batch(new, batch_id)
        finally:
            batch.unpersist()

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = judged(both).writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)


def stream_daily_forecast(spark: SparkSession, source_dir: str, tables_base: str, checkpoint: str,
                          forecast_fn: Callable[[DataFrame, DataFrame, DataFrame], DataFrame],
                          files_per_trigger: int = 1) -> None:
    """Ingest as above; after each batch, forecast the stations with new rows.

    ``forecast_fn(observations, forecasts, touched_stations)`` returns new
    forecast rows (id, time, tmax, tmin, tavg) for those stations."""
    def after(new_rows: DataFrame, batch_id: str) -> None:
        touched = new_rows.select(F.col("id_ciudad").alias("id")).distinct()
        obs = read_table(spark, tables_base, "clima").join(
            touched.withColumnRenamed("id", "id_ciudad"), "id_ciudad", "left_semi")
        new = forecast_fn(obs, read_table(spark, tables_base, "predic"), touched)
        append_rows(spark, tables_base, "predic", new, mode="insert_new", batch_id=batch_id)

    stream_ingest_observations(spark, source_dir, tables_base, checkpoint, files_per_trigger, on_batch=after)
