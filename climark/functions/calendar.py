"""Calendar features: month, day, season label and one-hot indicators.

One projection builds every derived column, so training and serving share
exactly the same expressions (same season list, same column order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climark.schemas import MONTH_COLUMNS, SEASON_COLUMNS, SEASON_MONTHS, SEASONS


def parse_time(df: DataFrame, src: str, dst: str | None = None, fmt: str = "yyyy-MM-dd",
               strict: bool = True) -> DataFrame:
    """String -> wall-clock timestamp (timestamp_ntz, no session-time-zone
    shift).  ``strict`` raises on bad input (ANSI); otherwise a bad string
    becomes null.  The coercing path parses the day (``try_to_date``) and the
    time of day separately, so no instant is ever resolved in a zone (a
    midnight skipped by a DST change stays midnight)."""
    if strict:
        out = F.to_timestamp_ntz(F.col(src), F.lit(fmt))
    else:
        d = F.try_to_date(F.col(src), fmt)
        out = F.when(d.isNotNull(), F.to_timestamp_ntz(F.col(src), F.lit(fmt)))
    return df.withColumn(dst or src, out)


def season_expr(month: Column) -> Column:
    expr = None
    for name in SEASONS:
        cond = month.isin(SEASON_MONTHS[name])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr  # months outside 1..12 -> null


def season_order_expr(season: Column) -> Column:
    """Position of a season in the serving list (0..3)."""
    expr = None
    for i, name in enumerate(SEASONS):
        expr = F.when(season == name, F.lit(i)) if expr is None else expr.when(season == name, F.lit(i))
    return expr


def calendar_fields(df: DataFrame, time_col: str = "time") -> DataFrame:
    return df.withColumns({
        "mes": F.month(time_col).cast("int"),
        "dia": F.dayofmonth(time_col).cast("int"),
    })


def season_label(df: DataFrame, month_col: str = "mes") -> DataFrame:
    return df.withColumn("estacion", season_expr(F.col(month_col)))


def season_onehot(df: DataFrame, season_col: str = "estacion") -> DataFrame:
    """Indicators over the fixed season list (absent season -> 0)."""
    return df.withColumns({s: (F.col(season_col) == s).cast("int") for s in SEASON_COLUMNS}) \
        .fillna(0, subset=SEASON_COLUMNS)


def month_onehot(df: DataFrame, month_col: str = "mes") -> DataFrame:
    return df.withColumns({c: (F.col(month_col) == int(c.split("_")[1])).cast("int") for c in MONTH_COLUMNS}) \
        .fillna(0, subset=MONTH_COLUMNS)


def prepare_features(df: DataFrame, months: bool = True, seasons: bool = True,
                     time_col: str = "time") -> DataFrame:
    """Calendar fields, season label and indicators in a single projection."""
    mes = F.month(time_col).cast("int")
    cols = {"mes": mes, "dia": F.dayofmonth(time_col).cast("int"), "estacion": season_expr(mes)}
    if seasons:
        cols.update({s: F.coalesce((season_expr(mes) == s).cast("int"), F.lit(0)) for s in SEASON_COLUMNS})
    if months:
        cols.update({c: F.coalesce((mes == int(c.split("_")[1])).cast("int"), F.lit(0)) for c in MONTH_COLUMNS})
    return df.withColumns(cols)


def next_day(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c + F.expr("INTERVAL 1 DAY")


def epoch_micros(col: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (timestamp_ntz) value,
    computed from its date and time-of-day fields, so no session time zone
    applies (``timestampdiff`` resolves a midnight skipped by a DST change
    through the zone)."""
    c = F.col(col) if isinstance(col, str) else col
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("double")
    secs = (F.hour(c) * 3600 + F.minute(c) * 60).cast("double") + F.date_part(F.lit("SECOND"), c).cast("double")
    return days * F.lit(86400000000.0) + secs * F.lit(1000000.0)
