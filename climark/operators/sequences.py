"""Row-ordered sequences: dense per-series indexes, sliding windows for
supervised learning, last/catch-up windows, flattening.

Windows count *rows*, not days (as the reference does).  Nothing here puts a
whole series into one task:

* ``sequence_index`` numbers rows within a series with a two-level prefix
  sum: counts per (series, bucket) - a tiny table - give each bucket's
  offset, and ``row_number`` runs only inside a bucket (e.g. a month).
* ``rolling_arrays`` cuts every series into fixed chunks of ``chunk`` rows
  and copies the last ``T`` rows of each chunk into the next (a halo), so a
  sliding frame of T rows is evaluated chunk by chunk; a series holding a
  third of all rows still spreads over many tasks.  Amplification is T/chunk.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 4096


def sequence_index(df: DataFrame, keys: list[str], order: list[str], bucket, name: str = "_i",
                   total: str | None = None) -> DataFrame:
    """Add a 0-based row index ``name`` within each ``keys`` series in
    ``order``; ``bucket`` must be non-decreasing in ``order`` (e.g. month of
    the time column).  With ``total``, also the series length."""
    d = df.withColumn("_b", bucket)
    counts = d.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_b")
    offs = counts.withColumn("_off", F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    offs = offs.withColumn("_off", F.coalesce("_off", F.lit(0)))
    if total:
        offs = offs.withColumn(total, F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding,
                                                                         Window.unboundedFollowing)))
    offs = offs.drop("_cnt")
    rn = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)) - 1
    out = d.withColumn("_rn", rn).join(offs, [*keys, "_b"])
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("long")).drop("_b", "_rn", "_off")


def month_bucket(time_col: str = "time"):
    return F.trunc(F.to_date(time_col), "month")  # a date: no session zone comes in


def rolling_arrays(idx: DataFrame, keys: list[str], payload: list[str], lo: int, hi: int,
                   index: str = "_i", out: str = "seq", chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """For each row, the array of ``struct(payload)`` over rows
    [i+lo, i+hi] of its series (lo <= hi <= 0), evaluated per chunk with a
    halo of -lo rows from the previous chunk."""
    halo = -lo
    if halo >= chunk:
        raise ValueError("chunk must exceed the window length")
    ch = F.floor(F.col(index) / chunk)
    # one pass: every row goes to its chunk; the last ``halo`` rows of a
    # chunk are also copied into the next one (no union, no second scan)
    targets = F.when(F.pmod(F.col(index), F.lit(chunk)) >= chunk - halo, F.array(ch, ch + 1)) \
        .otherwise(F.array(ch))
    u = idx.withColumn("_ch", F.explode(targets)).withColumn("_own", F.col("_ch") == ch)
    w = Window.partitionBy(*keys, "_ch").orderBy(index).rowsBetween(lo, hi)
    item = F.struct(*[F.col(c) for c in payload])
    return u.withColumn(out, F.collect_list(item).over(w)).where("_own").drop("_ch", "_own")


def supervised_windows(df: DataFrame, features: list[str], targets: list[str], T: int,
                       keys: tuple[str, ...] = ("id_ciudad", "split"), time_col: str = "time",
                       chunk: int = DEFAULT_CHUNK, target_prefix: str = "") -> DataFrame:
    """X = rows i-T..i-1, y = row i, for i >= T within each series (windows
    never cross a key boundary, so the first T rows of every split get no
    window and N = len - T).  Targets are read from ``target_prefix + t``
    (e.g. unscaled copies kept next to scaled features)."""
    cols = [F.col(f"`{c}`").cast("double").alias(c) for c in features]
    base = df.select(*keys, time_col, *cols,
                     *[F.col(f"{target_prefix}{t}").cast("double").alias(f"y_{t}") for t in targets])
    idx = sequence_index(base, list(keys), [time_col], month_bucket(time_col))
    win = rolling_arrays(idx, list(keys), [time_col, *features], -T, -1, chunk=chunk)
    return win.where(F.col("_i") >= T).select(
        *keys, F.col(time_col).alias("target_time"), F.col("_i").alias("row_index"), "seq",
        *[f"y_{t}" for t in targets])


def windows_long(win: DataFrame, keys: list[str], features: list[str], time_col: str = "time",
                 extra: list[str] = ()) -> DataFrame:
    """One row per (window, step) with the step's time and feature values."""
    ex = win.select(*keys, *extra, F.posexplode("seq").alias("step", "_s"))
    return ex.select(*keys, *extra, F.col("step").cast("int").alias("step"),
                     F.col(f"_s.{time_col}").alias(time_col), *[F.col(f"_s.`{c}`").alias(c) for c in features])


def flatten_window(win: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """(T, D) window -> T*D dense vector, step-major (row t, feature d at t*D+d)."""
    flat = F.flatten(F.transform("seq", lambda s: F.array(*[s[c] for c in features])))
    return win.withColumn(out, array_to_vector(flat))


def last_window(df: DataFrame, features: list[str], T: int, key: str = "id_ciudad",
                time_col: str = "time") -> DataFrame:
    """The last T rows of every station (long form, step 0..T-1)."""
    base = df.select(key, time_col, *[F.col(c).cast("double").alias(c) for c in features])
    idx = sequence_index(base, [key], [time_col], month_bucket(time_col), total="_n")
    return idx.where(F.col("_i") >= F.col("_n") - T).select(
        key, (F.col("_i") - (F.col("_n") - T)).cast("int").alias("step"), time_col, *features)


def days_behind(stored: DataFrame, forecasts: DataFrame, stations: DataFrame) -> DataFrame:
    """Per station: last observation, last forecast and the day difference.
    A station without forecasts is a cold start: it is treated as 0 days
    behind (only the day after the last observation is forecast)."""
    lo = stored.groupBy(F.col("id_ciudad").alias("id")).agg(F.max("time").alias("last_obs"))
    lf = forecasts.groupBy("id").agg(F.max("time").alias("last_fc"))
    j = stations.select("id").join(lo, "id", "left").join(lf, "id", "left")
    d = F.datediff(F.to_date("last_obs"), F.to_date("last_fc"))
    return j.select("id", "last_obs", "last_fc",
                    F.when(F.col("last_fc").isNull() & F.col("last_obs").isNotNull(), F.lit(0))
                    .otherwise(d).cast("int").alias("days_behind"))


def catchup_windows(df: DataFrame, behind: DataFrame, features: list[str], T: int,
                    key: str = "id_ciudad", time_col: str = "time", chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The d+1 overlapping windows for the d days a station is behind: the
    windows ending at its last d+1 rows (complete windows only).  Each window
    forecasts the day after its last row.  Stations ahead (d < 0) get none."""
    from climark.functions.sizing import bounded_broadcast
    base = df.select(key, time_col, *[F.col(c).cast("double").alias(c) for c in features])
    idx = sequence_index(base, [key], [time_col], month_bucket(time_col), total="_n")
    d = bounded_broadcast(behind.select(F.col("id").alias(key), F.col("days_behind").alias("_d"))
                          .where(F.col("_d") >= 0))
    # only a station's last T + d rows can be in a window: the rest goes before any window is built
    idx = idx.join(d, key).where(F.col("_i") >= F.col("_n") - T - F.col("_d"))
    win = rolling_arrays(idx, [key], [time_col, *features], -(T - 1), 0, chunk=chunk)
    ends = win.where((F.col("_i") >= F.col("_n") - 1 - F.col("_d")) & (F.col("_i") >= T - 1))
    return ends.select(key, F.col(time_col).alias("window_end"),
                       (F.col(time_col) + F.expr("INTERVAL 1 DAY")).alias("forecast_time"), "seq")


def serving_windows(df: DataFrame, features: list[str], T: int, key: str = "id_ciudad",
                    time_col: str = "time") -> DataFrame:
    """The window ending at each station's last row (complete windows only);
    it forecasts the following day.  The T last rows of a station are taken before
    anything is shuffled: every task keeps no more of a station than that."""
    base = df.select(key, time_col, *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    latest = Window.partitionBy(key).orderBy(F.desc(time_col))
    last = base.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= T)
    win = last.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(time_col, *features))).alias("seq"))
    end = F.element_at("seq", -1)[time_col]
    return win.where(F.size("seq") == T).select(
        key, end.alias("window_end"), (end + F.expr("INTERVAL 1 DAY")).alias("forecast_time"), "seq")
