"""Climatologies: monthly and (day, season) means, dense grid, forward fill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climark.functions.numeric import r6
from climark.schemas import SEASONS, TARGETS


def monthly_climatology(df: DataFrame, by: tuple[str, ...] = ("id_ciudad",),
                        measures: tuple[str, ...] = tuple(TARGETS)) -> DataFrame:
    """Mean of each measure by station and month (partial aggregation map-side)."""
    return df.groupBy(*by, F.month("time").cast("int").alias("mes")) \
        .agg(*[r6(F.avg(m)).alias(m) for m in measures])


def season_day_climatology(df: DataFrame, by: tuple[str, ...] = ("id_ciudad",),
                           measures: tuple[str, ...] = tuple(TARGETS)) -> DataFrame:
    """Mean of each measure by station, day of month and season."""
    return df.groupBy(*by, "dia", "estacion").agg(*[r6(F.avg(m)).alias(m) for m in measures])


def dense_grid_fill(agg: DataFrame, by: tuple[str, ...] = ("id_ciudad",)) -> DataFrame:
    """Reindex per-station (day, season) aggregates onto the full 124-row grid.

    The station list comes from the aggregate itself; each station's grid is
    generated locally (explode of a fixed 124-element array), so no cross join
    of large inputs is planned and the join is an equi-join on
    (station, day, season)."""
    seasons = F.array(*[F.lit(s) for s in SEASONS])
    stations = agg.select(*by).distinct()
    grid = stations.select(*by, F.explode(F.sequence(F.lit(1), F.lit(31))).alias("dia")) \
        .select(*by, F.col("dia").cast("int").alias("dia"), F.posexplode(seasons).alias("season_ord", "estacion")) \
        .withColumn("season_ord", F.col("season_ord").cast("int"))
    return grid.join(agg, [*by, "dia", "estacion"], "left")


def forward_fill(df: DataFrame, cols: list[str], partition: list[str], order: list[str]) -> DataFrame:
    """Last non-null value in ``order`` within ``partition``."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def season_day_profile(feat: DataFrame, by: tuple[str, ...] = ("id_ciudad",),
                       within_season: bool = False) -> DataFrame:
    """(day, season) means on the dense grid, holes forward-filled in
    (day, season) order - so a hole takes the previous season's value of the
    same day - or, with ``within_season``, from the previous day of the same
    season.  Each station's frame has 124 rows, so the window is bounded."""
    grid = dense_grid_fill(season_day_climatology(feat, by), by)
    part = list(by) + (["estacion"] if within_season else [])
    order = ["dia"] if within_season else ["dia", "season_ord"]
    out = forward_fill(grid, list(TARGETS), part, order)
    return out.select(*by, "dia", "estacion", "season_ord", *TARGETS)


def temperature_band(feat: DataFrame, by: tuple[str, ...] = ("id_ciudad",)) -> DataFrame:
    """Envelope of the climatologies: over the year (max of monthly tmax
    means, min of monthly tmin means) and per season (from the day/season
    profile)."""
    monthly = monthly_climatology(feat, by).groupBy(*by).agg(
        F.lit("all").alias("scope"), F.max("tmax").alias("band_high"), F.min("tmin").alias("band_low"))
    prof = season_day_profile(feat, by).groupBy(*by, F.col("estacion").alias("scope")).agg(
        F.max("tmax").alias("band_high"), F.min("tmin").alias("band_low"))
    return monthly.unionByName(prof)


__all__ = ["monthly_climatology", "season_day_climatology", "dense_grid_fill",
           "forward_fill", "season_day_profile", "temperature_band"]
