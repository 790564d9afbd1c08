"""Streaming queries: each lands the bridged observations as file
deliveries under the shared checkpoint dir, drains them with Structured
Streaming (trigger availableNow) and returns the resulting table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.functions.calendar import prepare_features
from climark.operators import sequences as sq
from climark.plans.catalog import register
from climark.plans.queries_core import stored, ts
from climark.plans.queries_ml import MONTHLY_SQL, model_forecaster, persistence, serving_model, station_tables
from climark.schemas import REDUCED_FEATURES, WINDOW_T
from climark.session import scratch_path
from climark.sources import tables as tb
from climark.sources.bridge import FORECAST_END, Tables
from climark.streaming.ingest import stream_daily_forecast, stream_ingest_observations


@register("stream_ingest_observations", "I01", "SELECT * FROM clima", materialize=True)
def q_stream_ingest(t: Tables):
    """Yearly deliveries (each December re-sent with the next year) drained
    into the observation table; the last station's whole history arrives after
    all the others'."""
    spark = t.spark
    base = scratch_path(spark, "stream-ingest")
    resent = t.landing.where(F.month("time") == 12)  # each December is delivered again next year
    deliveries = t.landing.withColumn("_d", F.year("time")) \
        .unionByName(resent.withColumn("_d", F.year("time") + 1))
    last = t.ciudades.agg(F.max("id")).first()[0]  # one scalar
    deliveries = deliveries.withColumn("_d", F.when(F.col("id_ciudad") == last, F.lit(9999)).otherwise(F.col("_d")))
    _land_with(deliveries, f"{base}/landing")
    tables = f"{base}/tables"
    tb.bootstrap_tables(spark, tables)
    stream_ingest_observations(spark, f"{base}/landing", tables, f"{base}/_checkpoint")
    return tb.read_table(spark, tables, "clima")


def _land_with(deliveries: DataFrame, folder: str) -> None:
    for (p,) in deliveries.select("_d").distinct().orderBy("_d").collect():  # bounded: delivery periods
        # one file per delivery (a landing drop), consumed as one micro-batch
        deliveries.where(F.col("_d") == p).drop("_d").coalesce(1).write.mode("append").parquet(folder)


def _streamed_forecasts(t: Tables, forecaster) -> DataFrame:
    """Monthly deliveries after the stored period; each micro-batch is appended, then its
    stations' missed days are forecast and appended."""
    spark, base = t.spark, scratch_path(t.spark, "stream-forecast")
    tables = station_tables(t, stored(t), t.predic)
    later = t.landing.where(F.col("time") > ts(FORECAST_END))
    _land_with(later.withColumn("_d", F.date_trunc("month", "time")), f"{base}/landing")
    stations = t.ciudades

    def forecast_fn(obs: DataFrame, fc: DataFrame, touched: DataFrame) -> DataFrame:
        behind = sq.days_behind(obs, fc, stations.join(touched, "id", "left_semi"))
        win = sq.catchup_windows(prepare_features(obs), behind, REDUCED_FEATURES, WINDOW_T)
        return forecaster(win).join(fc.select("id", "time"), ["id", "time"], "left_anti")

    stream_daily_forecast(spark, f"{base}/landing", tables, f"{base}/_checkpoint", forecast_fn)
    return tb.read_table(spark, tables, "predic")


@register("stream_daily_forecast", "I02", materialize=True)
def q_stream_daily_forecast(t: Tables):
    """The forecast table after the stream, by the stored serving model."""
    return _streamed_forecasts(t, model_forecaster(serving_model(t)))


@register("stream_daily_forecast_persistence", "I02", MONTHLY_SQL, materialize=True)
def q_stream_daily_forecast_persistence(t: Tables):
    """The forecast table after the stream, by the forecaster that repeats the last day."""
    return _streamed_forecasts(t, persistence)
