"""Projections, filters and cleaning steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climark.functions.sizing import bounded_broadcast
from climark.schemas import FULL_FEATURES, REDUCED_FEATURES

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def fill_missing_zero(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Null -> 0 in every numeric column (what the store does on insert)."""
    cols = subset or numeric_columns(df)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def missing_cell_counts(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """(column, filled) - how many cells ``fill_missing_zero`` would fill."""
    cols = subset or numeric_columns(df)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "filled")


def feature_subset(df: DataFrame, which: str = "reduced", keep: tuple[str, ...] = ("id_ciudad", "time")) -> DataFrame:
    feats = {"full": FULL_FEATURES, "reduced": REDUCED_FEATURES}[which]
    return df.select(*keep, *feats)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any non-null value (one aggregate pass, 1-row result)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def drop_all_zero_columns(df: DataFrame, also_drop: tuple[str, ...] = ("id_ciudad", "estacion")) -> DataFrame:
    """Keep columns holding any value != 0 (null counts as != 0, non-numerics
    are always kept), then drop the key and season label."""
    num = numeric_columns(df)
    flags = df.agg(*[F.bool_or(F.col(c).isNull() | (F.col(c) != 0)).alias(c) for c in num]).first().asDict()
    keep = [c for c in df.columns if (c not in num or flags[c]) and c not in also_drop]
    return df.select(*keep)


def replace_low_outlier(df: DataFrame, column: str = "tmin", lower: float = 10.0,
                        by: tuple[str, ...] = ("id_ciudad",), fit_on=None) -> DataFrame:
    """Values below ``lower`` become the group's mean of the *uncorrected*
    column (over all rows, or over ``fit_on`` rows when given)."""
    src = df if fit_on is None else df.where(fit_on)
    means = src.groupBy(*by).agg(F.avg(column).alias("_mean"))
    out = df.join(bounded_broadcast(means), list(by), "left")
    return out.withColumn(column, F.when(F.col(column) < lower, F.col("_mean")).otherwise(F.col(column))) \
        .drop("_mean").select(*df.columns)


def split_expr(time_col: str, cut_train: str, cut_val: str):
    t = F.col(time_col)
    return (F.when(t <= F.lit(cut_train).cast("timestamp_ntz"), F.lit("train"))
            .when(t <= F.lit(cut_val).cast("timestamp_ntz"), F.lit("val"))
            .otherwise(F.lit("test")))


def temporal_split(df: DataFrame, cut_train: str, cut_val: str, time_col: str = "time") -> DataFrame:
    """train: time <= cut_train; val: (cut_train, cut_val]; test: later."""
    return df.withColumn("split", split_expr(time_col, cut_train, cut_val))


def unsigned_guard(df: DataFrame, cols: tuple[str, ...] = ("tmax", "tmin", "tavg")) -> DataFrame:
    """Rows that satisfy NOT NULL and >= 0 on ``cols``."""
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & (F.col(c) >= 0)
        cond = ok if cond is None else cond & ok
    return df.where(cond)


def unsigned_violations(df: DataFrame, cols: tuple[str, ...] = ("tmax", "tmin", "tavg")) -> DataFrame:
    """(column, n_null, n_negative) violation counters."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__null") for c in cols],
                  *[F.count_if(F.col(c) < 0).alias(f"{c}__neg") for c in cols])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__null").cast("long").alias("n_null"),
                     F.col(f"{c}__neg").cast("long").alias("n_negative")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))
