"""Descriptive statistics, correlations, box-plot figures, histograms, KDE.

Wide single-pass aggregates are preferred over unpivot-then-aggregate: every
statistic of every column is one aggregate expression, partially aggregated
map-side, and the (small) per-group result is unpivoted afterwards.
Percentiles are exact at every size: values are counted, the counts are summed
over value ranges, ranges that hold no wanted order statistic are left, the others
are cut again between their own least and greatest value until each has at most
``ORDERED`` distinct values, and only these are ordered; so no task orders a
whole group, wherever its values lie.  ``approx=True`` asks for
``percentile_approx`` instead.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climark.functions.calendar import epoch_micros
from climark.functions.numeric import r6
from climark.functions.sizing import bounded_broadcast
from climark.operators.cleaning import numeric_columns

QUARTILES = [0.25, 0.5, 0.75]
RANGES = 1024      # value ranges that a range is cut into
ORDERED = 65_536   # most distinct values of a range that is ordered


def _holds(rank, first, n):
    return (rank >= first) & (rank < first + n)


def _bucket(v, lo, hi):
    """A number of ``RANGES`` that never falls as ``v`` grows from ``lo`` to ``hi``: by distance, or by
    exponent where the ends have one sign and differ by more than a factor of four; apart by
    sign.  So a few cuts reach any doubles: one for the sign, one for the exponent, then by distance."""
    def scale(x):
        return F.signum(x) * F.log2(F.abs(x))

    one_sign = (lo > 0) | (hi < 0)
    wide = one_sign & (F.greatest(F.abs(lo), F.abs(hi)) / 4 > F.least(F.abs(lo), F.abs(hi)))
    even = (v / 2 - lo / 2) / (hi / 2 - lo / 2)          # halved: the distance of two doubles may be none
    by_exponent = (scale(v) - scale(lo)) / (scale(hi) - scale(lo))
    return F.floor(F.when(wide, by_exponent).otherwise(even) * RANGES) * 3 + F.signum(v).cast("long") + 1


def _refined(inside: DataFrame, g: list[str], ps: list[float], ordered: int) -> DataFrame:
    """``inside`` (g, _n, _off, _v, _c) with every range of more than ``ordered`` values cut into
    ``RANGES``, and without the ranges that hold no wanted rank.  A range is known by ``_off``,
    the number of rows below it."""
    span = inside.groupBy(*g, "_off").agg(F.count(F.lit(1)).alias("_k"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    bucket = F.when(F.col("_k") > ordered, _bucket(F.col("_v"), F.col("_lo"), F.col("_hi"))).otherwise(0)
    cut = inside.join(span, [*g, "_off"]).withColumn("_b", bucket.cast("long"))
    w = Window.partitionBy(*g, "_off").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy(*g, "_off", "_b").agg(F.sum("_c").alias("_bc"), F.first("_n").alias("_n"))
    parts = parts.withColumn("_start", F.col("_off") + F.coalesce(F.sum("_bc").over(w), F.lit(0)))
    hit = F.lit(False)
    for p in ps:
        x = F.lit(p) * (F.col("_n") - 1)
        hit = hit | _holds(F.floor(x), F.col("_start"), F.col("_bc")) | _holds(F.ceil(x), F.col("_start"), F.col("_bc"))
    return cut.join(parts.where(hit).select(*g, "_off", "_b", "_start"), [*g, "_off", "_b"]).select(
        *g, "_n", F.col("_start").alias("_off"), "_v", "_c")


def ranked_ranges(df: DataFrame, cols: list[str], by: list[str], ps: list[float], ordered: int = ORDERED) -> DataFrame:
    """(by..., column_name, _n, _off, _v, _c): the counted values of the ranges that hold a wanted
    order statistic, none of more than ``ordered`` values; ``_off`` rows lie below a range."""
    g = [*by, "column_name"]
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                      F.col(c).cast("double").alias("_v")) for c in cols])))
    vc = long.where(F.col("_v").isNotNull()).groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    size = vc.groupBy(*g).agg(F.sum("_c").alias("_n"))
    inside = vc.join(size, g).select(*g, "_n", F.lit(0).cast("long").alias("_off"), "_v", "_c")
    while True:
        inside = _refined(inside, g, ps, ordered).checkpoint(eager=True)
        most = inside.groupBy(*g, "_off").count().agg(F.max("count")).first()[0]        # one number
        if (most or 0) <= ordered:
            return inside


def exact_quantiles(df: DataFrame, cols: list[str], by: list[str], ps: list[float], ordered: int = ORDERED) -> DataFrame:
    """(by..., column_name, q): linear-interpolated quantiles of the non-null
    values of each group and column."""
    g = [*by, "column_name"]
    inside = ranked_ranges(df, cols, by, ps, ordered)
    pos = {k: F.lit(p) * (F.col("_n") - 1) for k, p in enumerate(ps)}
    order = Window.partitionBy(*g, "_off").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_first", F.col("_off") + F.coalesce(F.sum("_c").over(order), F.lit(0)))
    picked = inside.groupBy(*g).agg(F.first("_n").alias("_n"), *[
        F.max(F.when(_holds(f(x), F.col("_first"), F.col("_c")), F.col("_v"))).alias(f"_{n}{k}")
        for k, x in pos.items() for n, f in (("f", F.floor), ("e", F.ceil))])
    q = [F.when(F.floor(x) == F.ceil(x), F.col(f"_f{k}")).otherwise(
        (F.ceil(x) - x) * F.col(f"_f{k}") + (x - F.floor(x)) * F.col(f"_e{k}")) for k, x in pos.items()]
    return picked.select(*g, F.array(*q).alias("q"))


def quantiles(df: DataFrame, cols: list[str], by: list[str], ps: list[float], approx: bool) -> DataFrame:
    """(by..., <column>__q for each column): arrays of quantiles, one row per group."""
    if approx:
        return df.groupBy(*by).agg(*[
            F.percentile_approx(F.col(c).cast("double"), ps, 100000).alias(f"{c}__q") for c in cols])
    return exact_quantiles(df, cols, by, ps).groupBy(*by).agg(*[
        F.max(F.when(F.col("column_name") == c, F.col("q"))).alias(f"{c}__q") for c in cols])


def _long(wide: DataFrame, by: list[str], cols: list[str], fields: dict[str, callable]) -> DataFrame:
    """Turn per-column wide statistics into rows (by..., column, stats...)."""
    rows = [F.struct(F.lit(c).alias("column_name"), *[fn(c).alias(k) for k, fn in fields.items()]) for c in cols]
    return wide.select(*by, F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, cols: list[str], by: tuple[str, ...] = ("id_ciudad",),
                     approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per group and column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.groupBy(*by).agg(*aggs).join(quantiles(df, cols, list(by), QUARTILES, approx), list(by), "left")
    return _long(wide, list(by), cols, {
        "n": lambda c: F.col(f"{c}__count").cast("long"),
        "mean": lambda c: r6(f"{c}__mean"),
        "std": lambda c: r6(f"{c}__std"),
        "vmin": lambda c: F.col(f"{c}__min"),
        "q25": lambda c: r6(F.col(f"{c}__q")[0]),
        "q50": lambda c: r6(F.col(f"{c}__q")[1]),
        "q75": lambda c: r6(F.col(f"{c}__q")[2]),
        "vmax": lambda c: F.col(f"{c}__max"),
    })


def describe_time(df: DataFrame, col: str = "time", by: tuple[str, ...] = ("id_ciudad",),
                  approx: bool = False) -> DataFrame:
    """count, mean, min, quartiles, max of a timestamp column per group.

    Statistics are taken on epoch days (exact for day-resolution values) and
    turned back into wall-clock timestamps, floored to the microsecond."""
    days = epoch_micros(F.col(f"`{col}`").cast("timestamp_ntz")) / F.lit(86400000000.0)
    base = df.select(*by, days.alias("_d"), F.col(col).alias("_t"))
    st = base.groupBy(*by).agg(F.count("_t").alias("n"), F.avg("_d").alias("_mean"), F.min("_t").alias("vmin"),
                               F.max("_t").alias("vmax"))
    st = st.join(quantiles(base, ["_d"], list(by), QUARTILES, approx).withColumnRenamed("_d__q", "_q"), list(by), "left")

    def back(x):
        micros = F.floor(x * F.lit(86400000000.0)).cast("long")
        return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

    return st.select(*by, F.col("n").cast("long").alias("n"), back(F.col("_mean")).alias("mean"), "vmin",
                     back(F.col("_q")[0]).alias("q25"), back(F.col("_q")[1]).alias("q50"),
                     back(F.col("_q")[2]).alias("q75"), "vmax")


PANDAS_DTYPE = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "float64",
                "FloatType": "float32", "StringType": "object", "TimestampNTZType": "datetime64[ns]",
                "TimestampType": "datetime64[ns, UTC]", "DateType": "object", "BooleanType": "bool"}


def profile_columns(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows, non_null) - one aggregate pass."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(f.name).alias("column_name"),
                     F.lit(PANDAS_DTYPE.get(type(f.dataType).__name__, f.dataType.simpleString())).alias("dtype"),
                     F.col("__rows").cast("long").alias("n_rows"),
                     F.col(f"`{f.name}`").cast("long").alias("non_null"))
            for f in df.schema.fields]
    return wide.select(F.inline(F.array(*rows)))


def mean_abs_dev_median(df: DataFrame, cols: list[str], by: tuple[str, ...] = ("id_ciudad",),
                        approx: bool = False) -> DataFrame:
    """mean(|x - median(x)|) per group and column (two passes: medians, then
    the deviation aggregate against the broadcast per-group medians)."""
    med = quantiles(df, cols, list(by), [0.5], approx).select(
        *by, *[F.col(f"{c}__q")[0].alias(f"{c}__med") for c in cols])
    j = df.join(bounded_broadcast(med), list(by))
    wide = j.groupBy(*by).agg(*[F.avg(F.abs(F.col(c) - F.col(f"{c}__med"))).alias(c) for c in cols])
    return _long(wide, list(by), cols, {"mad": lambda c: r6(c)})


def correlation_matrix(df: DataFrame, cols: list[str], by: tuple[str, ...] = ("id_ciudad",),
                       digits: int = 2) -> DataFrame:
    """Pearson correlation of every column pair per group, rounded; a
    constant column gives null instead of a division error.  Timestamps are
    used as epoch microseconds.

    Two passes, numerically stable: (1) per-group means and population
    stds; (2) each row is exploded by its first index only, and the products
    with all columns are summed per (group, first index) with partial
    aggregation, so only groups x columns rows of sums are shuffled."""
    num = {}
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        # epoch microseconds of the wall-clock value, independent of the session time zone
        num[c] = epoch_micros(F.col(f"`{c}`").cast("timestamp_ntz")) if dt.startswith("timestamp") \
            else F.col(f"`{c}`").cast("double")
    k = len(cols)
    base = df.select(*by, F.array(*[num[c] for c in cols]).alias("_x"))
    stats = base.groupBy(*by).agg(
        F.array(*[F.avg(F.col("_x")[i]) for i in range(k)]).alias("_m"),
        F.array(*[F.stddev_pop(F.col("_x")[i]) for i in range(k)]).alias("_s"),
        F.count(F.lit(1)).alias("_n"))
    stats = bounded_broadcast(stats)
    z = F.array(*[F.col("_x")[i] - F.col("_m")[i] for i in range(k)])  # plain codegen, no lambda
    ex = base.join(stats, list(by)).select(*by, z.alias("_z")).select(*by, "_z", F.posexplode("_z").alias("a", "_za"))
    wide = ex.groupBy(*by, "a").agg(*[F.sum(F.col("_za") * F.col("_z")[b]).alias(f"_s{b}") for b in range(k)])
    sums = wide.select(*by, "a", F.inline(F.array(*[F.struct(F.lit(b).alias("b"), F.col(f"_s{b}").alias("_sp"))
                                                    for b in range(k)]))).where(F.col("b") >= F.col("a"))
    names = F.array(*[F.lit(c) for c in cols])
    j = sums.join(stats, list(by))
    den = F.col("_s")[F.col("a")] * F.col("_s")[F.col("b")]
    corr = F.round(F.when(den > 0, F.col("_sp") / F.col("_n") / den), digits) + F.lit(0.0)  # -0.0 -> 0.0
    both = F.array(F.struct(names[F.col("a")].alias("col_a"), names[F.col("b")].alias("col_b")),
                   F.struct(names[F.col("b")].alias("col_a"), names[F.col("a")].alias("col_b")))
    out = j.select(*by, corr.alias("corr"), F.when(F.col("a") == F.col("b"), F.slice(both, 1, 1))
                   .otherwise(both).alias("_ab"))
    return out.select(*by, F.inline("_ab"), "corr")


def boxplot_stats(df: DataFrame, cols: list[str], by: tuple[str, ...] = ("id_ciudad",),
                  whis: float = 1.5, approx: bool = False) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the 1.5 IQR fences) and
    outlier counts.  Pass 1: quartiles per group; pass 2: conditional min/max/
    count against the broadcast quartiles."""
    q = quantiles(df, cols, list(by), QUARTILES, approx)
    j = df.join(bounded_broadcast(q), list(by))
    aggs = []
    for c in cols:
        q1, q3 = F.col(f"{c}__q")[0], F.col(f"{c}__q")[2]
        lo, hi = q1 - F.lit(whis) * (q3 - q1), q3 + F.lit(whis) * (q3 - q1)
        x = F.col(c).cast("double")
        aggs += [F.first(F.col(f"{c}__q")).alias(f"{c}__qq"),
                 F.min(F.when(x >= lo, x)).alias(f"{c}__wlo"),
                 F.max(F.when(x <= hi, x)).alias(f"{c}__whi"),
                 F.count_if((x < lo) | (x > hi)).alias(f"{c}__out")]
    wide = j.groupBy(*by).agg(*aggs)
    return _long(wide, list(by), cols, {
        "q1": lambda c: r6(F.col(f"{c}__qq")[0]),
        "median": lambda c: r6(F.col(f"{c}__qq")[1]),
        "q3": lambda c: r6(F.col(f"{c}__qq")[2]),
        "whisker_low": lambda c: F.col(f"{c}__wlo"),
        "whisker_high": lambda c: F.col(f"{c}__whi"),
        "n_outliers": lambda c: F.col(f"{c}__out").cast("long"),
    })


def histogram_fixed_bins(df: DataFrame, value: str, by: tuple[str, ...], bins: int = 20) -> DataFrame:
    """Equal-width histogram between each group's min and max with the last
    bin closed (numpy semantics; a zero range widens to +-0.5).  Every bin is
    reported, empty ones with 0."""
    rng = df.groupBy(*by).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx")).select(
        *by,
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi"))
    rng = bounded_broadcast(rng)
    b = F.least(F.floor((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(bins))),
                F.lit(bins - 1)).cast("int")
    counts = df.join(rng, list(by)).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*by, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return grid.join(counts, [*by, "bin"], "left").select(
        *by, "bin",
        r6(F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        r6(F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def histogram_auto_bins(df: DataFrame, cols: list[str], by: tuple[str, ...] = ("id_ciudad",),
                        approx: bool = False) -> DataFrame:
    """Histogram per group and column with numpy's 'auto' bin count (the
    larger of Sturges and Freedman-Diaconis), last bin closed.  Bin counts
    differ per (group, column), so the bin grid is generated per group from
    its own count (explode of a bounded sequence)."""
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                      F.col(c).cast("double").alias("value")) for c in cols])))
    g = [*by, "column_name"]
    st = long.groupBy(*g).agg(F.count("value").alias("_n"), F.min("value").alias("_mn"),
                              F.max("value").alias("_mx"))
    q = quantiles(long.withColumnRenamed("column_name", "_measure"), ["value"], [*by, "_measure"], [0.25, 0.75], approx)
    st = st.join(q.withColumnRenamed("_measure", "column_name").withColumnRenamed("value__q", "_q"), g, "left")
    st = st.select(*g, "_n",
                   F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
                   F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi"),
                   (F.col("_q")[1] - F.col("_q")[0]).alias("_iqr"))
    st = st.withColumn("_nb", auto_bin_count(F.col("_n"), F.col("_iqr"), F.col("_hi") - F.col("_lo")))
    st = bounded_broadcast(st)
    b = F.least(F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_nb")),
                F.col("_nb") - 1).cast("int")
    counts = long.join(st, g).groupBy(*g, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = st.select(*g, "_lo", "_hi", "_nb", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_nb")
    return grid.join(counts, [*g, "bin"], "left").select(
        *g, F.col("_nb").alias("n_bins"), F.col("bin").cast("int").alias("bin"),
        r6(F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        r6(F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def auto_bin_count(n, iqr, span):
    """numpy 'auto' rule: the larger of Sturges and Freedman-Diaconis counts."""
    sturges = F.ceil(F.log2(n.cast("double")) + 1)
    fd_width = 2.0 * iqr * F.pow(n.cast("double"), -1.0 / 3.0)
    fd = F.when(fd_width > 0, F.ceil(span / fd_width))
    return F.greatest(sturges, F.coalesce(fd, sturges)).cast("int")


def kde_curve(df: DataFrame, value: str, by: tuple[str, ...], gridsize: int = 200, cut: float = 3.0,
              reach: float = 8.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth std_samp * n^-1/5) on ``gridsize`` points
    spanning [min - cut*bw, max + cut*bw].

    Values are first collapsed to (value, count) pairs; a pair counts at the grid points
    within ``reach`` bandwidths only (16 bandwidths of points, fewer of the grid's the more rows
    there are), inside the map stage, and only per-task partial sums (gridsize per group)
    are shuffled.  What is left out is below exp(-reach**2 / 2) / (bw * sqrt(2 pi)) of a
    density: 1.3e-14 / (bw * 2.5) at 8."""
    st = df.groupBy(*by).agg(F.count(value).alias("_n"), F.stddev_samp(value).alias("_sd"),
                             F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    st = st.withColumn("_bw", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))) \
        .withColumn("_lo", F.col("_mn") - F.lit(cut) * F.col("_bw")) \
        .withColumn("_step", (F.col("_mx") + F.lit(cut) * F.col("_bw") - F.col("_lo")) / F.lit(float(gridsize - 1)))
    st = bounded_broadcast(st.where(F.col("_bw") > 0))
    grid = st.select(*by, "_n", "_bw", (F.lit(math.sqrt(2 * math.pi)) * F.col("_n") * F.col("_bw")).alias("_norm"), "_lo",
                     "_step", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("g"))
    vc = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    first = F.ceil((F.col("_v") - F.lit(reach) * F.col("_bw") - F.col("_lo")) / F.col("_step"))
    last = F.floor((F.col("_v") + F.lit(reach) * F.col("_bw") - F.col("_lo")) / F.col("_step"))
    near = F.sequence(F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.lit(gridsize - 1)).cast("int"))
    pts = vc.join(st, list(by)).select(*by, "_v", "_c", "_bw", "_lo", "_step", F.explode(near).alias("g"))
    z = (F.col("_lo") + F.col("g") * F.col("_step") - F.col("_v")) / F.col("_bw")
    dens = pts.groupBy(*by, "g").agg(F.sum(F.col("_c") * F.exp(-0.5 * z * z)).alias("_s"))
    return grid.join(dens, [*by, "g"], "left").select(
        *by, F.col("g").cast("int").alias("g"), r6(F.col("_lo") + F.col("g") * F.col("_step")).alias("x"),
        r6(F.coalesce("_s", F.lit(0.0)) / F.col("_norm")).alias("density"))


def kde_curves(df: DataFrame, cols: list[str], by: tuple[str, ...] = ("id_ciudad",), gridsize: int = 200) -> DataFrame:
    """``kde_curve`` of several measures: (by..., column_name, g, x, density)."""
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
                                             for c in cols])))
    return kde_curve(long, "value", (*by, "column_name"), gridsize)


def scatter_series(df: DataFrame, cols: list[str], keys: tuple[str, ...] = ("id_ciudad", "time")) -> DataFrame:
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(list(keys), cols, "measure", "value")


__all__ = ["describe_numeric", "describe_time", "profile_columns", "mean_abs_dev_median", "correlation_matrix",
           "boxplot_stats", "histogram_fixed_bins", "histogram_auto_bins", "kde_curve", "kde_curves", "scatter_series", "numeric_columns",
           "auto_bin_count"]
