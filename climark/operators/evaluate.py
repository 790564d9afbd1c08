"""Forecast evaluation: baselines, regression metrics, model comparison,
pinned ordering and training-history helpers.

Errors are always ``real - pred``.  Overall figures follow the reference:
RMSE and MAE over all (window, target) cells, R^2 as the plain mean of the
per-target R^2, MAPE without a zero guard in the reference - here a zero
actual is skipped (``try_divide``) instead of raising under ANSI mode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climark.functions.numeric import float_div, r6, safe_corr
from climark.functions.sizing import bounded_broadcast
from climark.schemas import TARGETS

SPLITS = [("train", "Train"), ("val", "Val"), ("test", "Test")]
METRICS = ["RMSE", "MAE", "MAPE", "Max Error", "Error Std"]


def predictions_long(df: DataFrame, model: str, keys: list[str], targets: list[str] = TARGETS,
                     pred_prefix: str = "pred_", real_prefix: str = "y_") -> DataFrame:
    """Wide (y_t, pred_t) columns -> (model, keys..., target, real, pred)."""
    rows = [F.struct(F.lit(t).alias("target"), F.col(f"{real_prefix}{t}").alias("real"),
                     F.col(f"{pred_prefix}{t}").alias("pred")) for t in targets]
    return df.select(F.lit(model).alias("model"), *keys, F.inline(F.array(*rows)))


def baseline_predictions(win: DataFrame, clim: DataFrame, T: int, keys: list[str],
                         targets: list[str] = TARGETS) -> DataFrame:
    """Deterministic forecasters on supervised windows: persistence (last row
    of the window), window mean, and the station's train-split monthly mean
    for the target month.  Returns the long prediction table."""
    last = F.element_at("seq", -1)
    pers = win.withColumns({f"pred_{t}": last[t] for t in targets})
    def seq_sum(t):
        return F.aggregate("seq", F.lit(0.0), lambda acc, s: acc + s[t])

    mean = win.withColumns({f"pred_{t}": seq_sum(t) / F.lit(float(T)) for t in targets})
    c = clim.select("id_ciudad", "mes", *[F.col(t).alias(f"pred_{t}") for t in targets])
    cl = win.withColumn("mes", F.month("target_time").cast("int")).join(bounded_broadcast(c), ["id_ciudad", "mes"],
                                                                       "left")
    parts = [predictions_long(pers, "Persistence", keys, targets),
             predictions_long(mean, "Window Mean", keys, targets),
             predictions_long(cl, "Climatology", keys, targets)]
    return reduce(DataFrame.unionByName, parts)


def regression_metrics(pairs: DataFrame, by: list[str] = ("target",)) -> DataFrame:
    """Per target: n, MAE, RMSE, R^2 = 1 - SSE/SST, Pearson r, max/min error."""
    e = F.col("real") - F.col("pred")
    sst = F.var_pop("real") * F.count("real")
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.avg(F.abs(e))).alias("mae"),
        r6(F.sqrt(F.avg(e * e))).alias("rmse"),
        r6(F.lit(1.0) - F.try_divide(F.sum(e * e), sst)).alias("r2"),
        r6(safe_corr("real", "pred")).alias("r"),
        F.max(e).alias("max_error"),
        F.min(e).alias("min_error"))


def overall_metrics(pairs: DataFrame) -> DataFrame:
    """All cells together: RMSE, MAE, max |error|, population error std, and
    R^2 as the mean of per-target R^2."""
    e = F.col("real") - F.col("pred")
    cells = pairs.agg(r6(F.sqrt(F.avg(e * e))).alias("rmse"), r6(F.avg(F.abs(e))).alias("mae"),
                      F.max(F.abs(e)).alias("max_abs_error"), r6(F.stddev_pop(e)).alias("error_std"))
    per = pairs.groupBy("target").agg(
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop("real") * F.count("real"))).alias("r2"))
    r2 = per.agg(r6(F.avg("r2")).alias("r2"))
    return cells.crossJoin(F.broadcast(r2))  # one row each


def model_comparison(preds: DataFrame, model_order: list[str], pinned: str | None = None) -> DataFrame:
    """One row per model with {Train, Val, Test} x {RMSE, MAE, MAPE, Max Error,
    Error Std} over all cells, 3 dp, plus ``rank`` (pinned model first, then
    the given order).  One conditional aggregate pass, no pivot shuffle."""
    e = F.col("real") - F.col("pred")
    aggs = []
    for key, label in SPLITS:
        on = F.col("split") == key
        ee = F.when(on, e)
        aggs += [F.round(F.sqrt(F.avg(ee * ee)), 3).alias(f"{label} RMSE"),
                 F.round(F.avg(F.abs(ee)), 3).alias(f"{label} MAE"),
                 F.round(F.avg(F.abs(F.try_divide(ee, F.col("real")))) * 100, 3).alias(f"{label} MAPE"),
                 F.round(F.max(F.abs(ee)), 3).alias(f"{label} Max Error"),
                 F.round(F.stddev_pop(ee), 3).alias(f"{label} Error Std")]
    out = preds.groupBy(F.col("model").alias("Modelo")).agg(*aggs)
    return pin_first(out, "Modelo", model_order, pinned)


def pin_first(df: DataFrame, name_col: str, order: list[str], pinned: str | None) -> DataFrame:
    """``rank`` column: the pinned name first, the rest in ``order``.  The
    frame has one row per model (bounded), so a global window is fine."""
    ordv = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(name_col))
    key = F.when(F.col(name_col) == F.lit(pinned), 0).otherwise(1) if pinned else F.lit(1)
    w = Window.orderBy(key, ordv)
    return df.withColumn("rank", F.row_number().over(w).cast("int"))


# --- training history ---------------------------------------------------------

def best_iteration(hist: DataFrame, metric: str = "val_loss") -> DataFrame:
    """Row with the lowest ``metric``, first iteration on ties."""
    return hist.agg(F.min_by(F.struct(*hist.columns), F.struct(metric, "iteration")).alias("_r")).select("_r.*")


def final_iteration(hist: DataFrame) -> DataFrame:
    return hist.agg(F.max_by(F.struct(*hist.columns), "iteration").alias("_r")).select("_r.*")


def history_slice(hist: DataFrame, start: int, end: int | None) -> DataFrame:
    """Iterations in [start, end) flagged first/last of the slice."""
    s = hist.where(F.col("iteration") >= start)
    if end is not None:
        s = s.where(F.col("iteration") < end)
    b = s.agg(F.min("iteration").alias("_lo"), F.max("iteration").alias("_hi"))
    return s.crossJoin(F.broadcast(b)).select(  # b is one row
        *hist.columns, (F.col("iteration") == F.col("_lo")).alias("is_first"),
        (F.col("iteration") == F.col("_hi")).alias("is_last"))


def progress_every_k(hist: DataFrame, k: int = 50) -> DataFrame:
    return hist.where((F.col("iteration") + 1) % k == 0)


def window_sweep_history(win: DataFrame, T: int, targets: list[str] = TARGETS,
                         train: str = "train", val: str = "val") -> DataFrame:
    """A deterministic "training history" over a hyper-parameter path:
    iteration k-1 forecasts each target as the mean of the last k rows of
    its window (k = 1..T).  Per iteration: loss (MSE over all cells), MAE,
    RMSE and mean per-target R^2 on the train and val splits.  Each window
    is expanded over the T lengths inside the map stage and aggregated.
    A target that is constant in a split (a station's daily maximum in large tables)
    has an R^2 of -inf, or NaN if it is forecast without error."""
    def tail_mean(t):
        part = F.slice("seq", -F.col("k"), F.col("k"))
        return F.aggregate(part, F.lit(0.0), lambda acc, s: acc + s[t]) / F.col("k")

    ks = win.where(F.col("split").isin(train, val)).select(
        "split", *[f"y_{t}" for t in targets], "seq", F.explode(F.sequence(F.lit(1), F.lit(T))).alias("k"))
    cells = ks.select("split", "k", F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"y_{t}").alias("real"), tail_mean(t).alias("pred"))
        for t in targets])))
    e = F.col("real") - F.col("pred")
    per = cells.groupBy("split", "k", "target").agg(
        F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"), F.count(F.lit(1)).alias("n"),
        F.var_pop("real").alias("v"))
    per = per.withColumn("r2", F.lit(1.0) - float_div("sse", F.col("v") * F.col("n")))
    it = per.groupBy("split", "k").agg((F.sum("sse") / F.sum("n")).alias("loss"),
                                       (F.sum("sae") / F.sum("n")).alias("mae"), F.avg("r2").alias("r2"))
    aggs = []
    for name, pre in ((train, ""), (val, "val_")):
        on = F.col("split") == name
        aggs += [F.max(F.when(on, F.col("loss"))).alias(f"{pre}loss"), F.max(F.when(on, F.col("mae"))).alias(f"{pre}mae"),
                 F.max(F.when(on, F.sqrt("loss"))).alias(f"{pre}rmse"), F.max(F.when(on, F.col("r2"))).alias(f"{pre}r2")]
    out = it.groupBy("k").agg(*aggs)
    cols = ["loss", "val_loss", "mae", "val_mae", "rmse", "val_rmse", "r2", "val_r2"]
    return out.select((F.col("k") - 1).cast("int").alias("iteration"), *[r6(c).alias(c) for c in cols])
