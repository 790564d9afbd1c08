"""Queries for sequences, scaling, evaluation and the update workflow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.functions.numeric import r6
from climark.operators import cleaning as cl
from climark.operators import evaluate as ev
from climark.operators import scaling as sc
from climark.operators import sequences as sq
from climark.operators.integrity import insert_guard
from climark.plans.catalog import register
from climark.plans.queries_core import (ALL_EQ, FVA_SQL, OUTLIER, STORED_SQL, feat, forecast_pairs, sfeat,
                                        stored)
from climark.schemas import REDUCED_FEATURES, TARGETS, WINDOW_T
from climark.sources import tables as tb
from climark.sources.bridge import AS_OF, Tables

T = WINDOW_T
MODELS = ["Persistence", "Window Mean", "Climatology"]
PINNED = "Persistence"


def q2(c: str) -> str:
    return f'"{c}"'


def fcols(prefix: str = "", digits: int | None = None) -> str:
    if digits is None:
        return ", ".join(f"CAST({prefix}{q2(c)} AS DOUBLE) AS {q2(c)}" for c in REDUCED_FEATURES)
    return ", ".join(f"round(CAST({prefix}{q2(c)} AS DOUBLE), {digits}) AS {q2(c)}" for c in REDUCED_FEATURES)


def training_frame(t: Tables) -> DataFrame:
    """Features + split with the low-outlier fix (station mean of the raw column)."""
    return cl.replace_low_outlier(sfeat(t), *OUTLIER)


TF_SQL = f"""mu AS (SELECT id_ciudad AS mid, avg({OUTLIER[0]}) AS mu FROM clima GROUP BY id_ciudad),
tf AS (SELECT * EXCLUDE (mid, mu) REPLACE (CASE WHEN {OUTLIER[0]} < {OUTLIER[1]} THEN mu ELSE {OUTLIER[0]} END
                                           AS {OUTLIER[0]})
       FROM sfeat JOIN mu ON sfeat.id_ciudad = mu.mid)"""


def windows(t: Tables) -> DataFrame:
    return sq.supervised_windows(training_frame(t), REDUCED_FEATURES, TARGETS, T)


# --- E. windows -------------------------------------------------------------------

@register("supervised_windows", "E01", f""", {TF_SQL},
idx AS (SELECT *, row_number() OVER (PARTITION BY id_ciudad, split ORDER BY time) - 1 AS i FROM tf)
SELECT t.id_ciudad, t.split, t.time AS target_time, CAST(s.i - t.i + {T} AS INTEGER) AS step, s.time AS time,
       {fcols('s.', 6)}, round(t.tmax, 6) AS y_tmax, round(t.tmin, 6) AS y_tmin, round(t.tavg, 6) AS y_tavg
FROM idx t JOIN idx s ON s.id_ciudad = t.id_ciudad AND s.split = t.split AND s.i >= t.i - {T} AND s.i < t.i
WHERE t.i >= {T}""", materialize=True)
def q_supervised_windows(t: Tables):
    """T-row windows -> next-row targets within each (station, split), long form."""
    win = windows(t)
    out = sq.windows_long(win, ["id_ciudad", "split"], REDUCED_FEATURES,
                          extra=["target_time", "y_tmax", "y_tmin", "y_tavg"])
    # the outlier fix writes a mean (order-dependent last bits): compare at 6 dp
    return out.withColumns({c: r6(F.col(f"`{c}`")) for c in [*REDUCED_FEATURES, "y_tmax", "y_tmin", "y_tavg"]})


@register("last_window", "E02", f"""
, idx AS (SELECT *, row_number() OVER (PARTITION BY id_ciudad ORDER BY time) - 1 AS i,
                 count(*) OVER (PARTITION BY id_ciudad) AS n FROM feat)
SELECT id_ciudad, CAST(i - (n - {T}) AS INTEGER) AS step, time, {fcols()} FROM idx WHERE i >= n - {T}""", materialize=True)
def q_last_window(t: Tables):
    """Last T rows of every station (serving input)."""
    return sq.last_window(feat(t), REDUCED_FEATURES, T)


BEHIND_SQL = """lo AS (SELECT id_ciudad AS id, max(time) AS last_obs FROM clima GROUP BY id_ciudad),
lf AS (SELECT id, max(time) AS last_fc FROM predic GROUP BY id),
beh AS (SELECT c.id, lo.last_obs, lf.last_fc,
               CAST(CASE WHEN lf.last_fc IS NULL AND lo.last_obs IS NOT NULL THEN 0
                         ELSE date_diff('day', CAST(lf.last_fc AS DATE), CAST(lo.last_obs AS DATE)) END AS INTEGER)
               AS days_behind
        FROM ciudades c LEFT JOIN lo ON c.id = lo.id LEFT JOIN lf ON c.id = lf.id)"""


@register("days_behind", "E06", f", {BEHIND_SQL} SELECT * FROM beh")
def q_days_behind(t: Tables):
    return sq.days_behind(t.clima, t.predic, t.ciudades)


@register("catchup_windows", "E03", f""", {BEHIND_SQL},
idx AS (SELECT *, row_number() OVER (PARTITION BY id_ciudad ORDER BY time) - 1 AS i,
               count(*) OVER (PARTITION BY id_ciudad) AS n FROM feat),
ends AS (SELECT idx.id_ciudad, idx.i AS e, idx.time AS window_end FROM idx JOIN beh ON idx.id_ciudad = beh.id
         WHERE beh.days_behind >= 0 AND idx.i >= idx.n - 1 - beh.days_behind AND idx.i >= {T - 1})
SELECT e.id_ciudad, e.window_end, e.window_end + INTERVAL 1 DAY AS forecast_time,
       CAST(s.i - (e.e - {T - 1}) AS INTEGER) AS step, s.time, {fcols('s.')}
FROM ends e JOIN idx s ON s.id_ciudad = e.id_ciudad AND s.i BETWEEN e.e - {T - 1} AND e.e""", materialize=True)
def q_catchup_windows(t: Tables):
    """The d+1 windows for the d days each station's forecasts are behind."""
    behind = sq.days_behind(t.clima, t.predic, t.ciudades)
    win = sq.catchup_windows(feat(t), behind, REDUCED_FEATURES, T)
    return sq.windows_long(win, ["id_ciudad"], REDUCED_FEATURES, extra=["window_end", "forecast_time"])


@register("next_day", "E07",
          "SELECT id_ciudad, max(time) + INTERVAL 1 DAY AS next_time FROM clima GROUP BY id_ciudad")
def q_next_day(t: Tables):
    """The day each station's next forecast is for."""
    return t.clima.groupBy("id_ciudad").agg((F.max("time") + F.expr("INTERVAL 1 DAY")).alias("next_time"))


@register("update_range", "E08", f", {STORED_SQL} SELECT * FROM ranges")
def q_update_range(t: Tables):
    """Per station: days to fetch and whether the update can be skipped."""
    return tb.update_range(stored(t), t.ciudades, AS_OF)


# --- L. scaling and evaluation -----------------------------------------------------

def _scaler_sql():
    parts = []
    for i, c in enumerate(REDUCED_FEATURES):
        x = f"CAST({q2(c)} AS DOUBLE)"
        parts.append(f"SELECT {i} AS idx, '{c}' AS feature, round(avg({x}), 6) AS mean, "
                     f"round(CASE WHEN stddev_pop({x}) = 0 THEN 1.0 ELSE stddev_pop({x}) END, 6) AS std "
                     f"FROM tf WHERE split = 'train'")
    return f", {TF_SQL} " + " UNION ALL ".join(parts)


def fitted_scaler(t: Tables, features: list[str] = REDUCED_FEATURES, frame: DataFrame | None = None) -> DataFrame:
    return sc.fit_scaler(training_frame(t) if frame is None else frame, features, F.col("split") == "train")


@register("fit_scaler", "L01", _scaler_sql(), materialize=True)
def q_fit_scaler(t: Tables):
    """Mean and population std per feature on train rows (std 0 -> 1)."""
    return fitted_scaler(t).select("idx", "feature", r6("mean").alias("mean"), r6("std").alias("std"))


def _apply_sql():
    stats = ", ".join(
        f"avg(CAST({q2(c)} AS DOUBLE)) AS \"m_{c}\", CASE WHEN stddev_pop(CAST({q2(c)} AS DOUBLE)) = 0 THEN 1.0 "
        f"ELSE stddev_pop(CAST({q2(c)} AS DOUBLE)) END AS \"s_{c}\"" for c in REDUCED_FEATURES)
    sel = ", ".join(f"round((CAST(tf.{q2(c)} AS DOUBLE) - sc.\"m_{c}\") / sc.\"s_{c}\", 6) AS {q2(c)}"
                    for c in REDUCED_FEATURES)
    return (f", {TF_SQL}, sc AS (SELECT {stats} FROM tf WHERE split = 'train') "
            f"SELECT tf.id_ciudad, tf.time, tf.split, {sel} FROM tf, sc")


@register("apply_scaler", "L02", _apply_sql(), materialize=True)
def q_apply_scaler(t: Tables):
    """Every split scaled with the train-fitted parameters (one projection)."""
    frame = training_frame(t)
    out = sc.apply_scaler(frame, sc.scaler_params(fitted_scaler(t, frame=frame)))
    return out.select("id_ciudad", "time", "split", *[r6(F.col(f"`{c}`")).alias(c) for c in REDUCED_FEATURES])


@register("regression_metrics", "L09", f""", {FVA_SQL}
SELECT target, count(*) AS n, round(avg(abs(real - pred)), 6) AS mae,
       round(sqrt(avg((real - pred) * (real - pred))), 6) AS rmse,
       round(1.0 - sum((real - pred) * (real - pred)) / (var_pop(real) * count(real)), 6) AS r2,
       round(CASE WHEN stddev_pop(real) * stddev_pop(pred) > 0
                  THEN covar_pop(real, pred) / (stddev_pop(real) * stddev_pop(pred)) END, 6) AS r,
       max(real - pred) AS max_error, min(real - pred) AS min_error
FROM fva GROUP BY target""")
def q_regression_metrics(t: Tables):
    """Per-target MAE, RMSE, R^2, r and extreme errors of stored forecasts."""
    return ev.regression_metrics(forecast_pairs(t))


@register("overall_metrics", "L09", f""", {FVA_SQL},
e AS (SELECT target, real, real - pred AS e FROM fva)
SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, max(abs(e)) AS max_abs_error,
       round(stddev_pop(e), 6) AS error_std,
       (SELECT round(avg(r2), 6) FROM (SELECT 1.0 - sum(e * e) / (var_pop(real) * count(real)) AS r2
                                       FROM e GROUP BY target)) AS r2
FROM e""", materialize=True)
def q_overall_metrics(t: Tables):
    """All-cell RMSE/MAE/max/std and the mean per-target R^2."""
    return ev.overall_metrics(forecast_pairs(t))


def baseline_preds(t: Tables) -> DataFrame:
    tf = training_frame(t)
    clim = tf.where(F.col("split") == "train").groupBy("id_ciudad", "mes").agg(*[F.avg(x).alias(x) for x in TARGETS])
    return ev.baseline_predictions(windows(t), clim, T, ["split", "id_ciudad", "target_time"])


def _comparison_sql():
    lagc = ", ".join(f"lag({x}) OVER (PARTITION BY id_ciudad, split ORDER BY time) AS p_{x}" for x in TARGETS)
    avgc = ", ".join(f"avg({x}) OVER (PARTITION BY id_ciudad, split ORDER BY time ROWS BETWEEN {T} PRECEDING "
                     f"AND 1 PRECEDING) AS m_{x}" for x in TARGETS)
    branches = []
    for model, pfx in [("Persistence", "p_"), ("Window Mean", "m_"), ("Climatology", "c_")]:
        for x in TARGETS:
            branches.append(f"SELECT '{model}' AS model, split, '{x}' AS target, {x} AS real, {pfx}{x} AS pred FROM wp")
    aggs = []
    for key, label in ev.SPLITS:
        ee = f"CASE WHEN split = '{key}' THEN real - pred END"
        aggs += [f"round(sqrt(avg(({ee}) * ({ee}))), 3) AS \"{label} RMSE\"",
                 f"round(avg(abs({ee})), 3) AS \"{label} MAE\"",
                 f"round(avg(abs(({ee}) / real)) * 100, 3) AS \"{label} MAPE\"",
                 f"round(max(abs({ee})), 3) AS \"{label} Max Error\"",
                 f"round(stddev_pop({ee}), 3) AS \"{label} Error Std\""]
    order = ", ".join(f"'{m}'" for m in MODELS)
    return f""", {TF_SQL},
w AS (SELECT id_ciudad, split, time, mes, tmax, tmin, tavg,
             row_number() OVER (PARTITION BY id_ciudad, split ORDER BY time) - 1 AS i, {lagc}, {avgc} FROM tf),
cm AS (SELECT id_ciudad, mes, avg(tmax) AS c_tmax, avg(tmin) AS c_tmin, avg(tavg) AS c_tavg FROM tf
       WHERE split = 'train' GROUP BY id_ciudad, mes),
wp AS (SELECT w.*, cm.c_tmax, cm.c_tmin, cm.c_tavg FROM w LEFT JOIN cm ON w.id_ciudad = cm.id_ciudad
       AND w.mes = cm.mes WHERE w.i >= {T}),
preds AS ({' UNION ALL '.join(branches)}),
cmp AS (SELECT model AS "Modelo", {', '.join(aggs)} FROM preds GROUP BY model)
SELECT *, CAST(row_number() OVER (ORDER BY CASE WHEN "Modelo" = '{PINNED}' THEN 0 ELSE 1 END,
                                  list_position([{order}], "Modelo")) AS INTEGER) AS rank FROM cmp"""


COMPARISON_SQL = _comparison_sql()


@register("model_comparison", "L10", COMPARISON_SQL, materialize=True)
def q_model_comparison(t: Tables):
    """5 metrics x 3 splits per deterministic forecaster, 3 dp, pinned first."""
    return ev.model_comparison(baseline_preds(t), MODELS, PINNED)


@register("pin_first", "F06", COMPARISON_SQL.replace('SELECT *, CAST(row_number()', 'SELECT "Modelo", CAST(row_number()'), materialize=True)
def q_pin_first(t: Tables):
    """Display order of the comparison: pinned model first, then list order."""
    return ev.model_comparison(baseline_preds(t), MODELS, PINNED).select("Modelo", "rank")


# --- deterministic history (window-length sweep) and its history operators ---

SWEEP_SLICE = (10, 20)
SWEEP_EVERY = 5


def sweep(t: Tables) -> DataFrame:
    return ev.window_sweep_history(windows(t), T)


def _sweep_sql():
    preds = ", ".join(f"avg(s.{x}) AS p_{x}, any_value(t.{x}) AS r_{x}" for x in TARGETS)
    cells = " UNION ALL ".join(f"SELECT split, k, '{x}' AS target, r_{x} AS real, p_{x} AS pred FROM pr"
                               for x in TARGETS)
    return f""", {TF_SQL},
idx AS (SELECT id_ciudad, split, time, tmax, tmin, tavg,
               row_number() OVER (PARTITION BY id_ciudad, split ORDER BY time) - 1 AS i FROM tf
        WHERE split IN ('train', 'val')),
ks AS (SELECT range AS k FROM range(1, {T + 1})),
pr AS (SELECT t.split, ks.k, {preds} FROM idx t CROSS JOIN ks
       JOIN idx s ON s.id_ciudad = t.id_ciudad AND s.split = t.split AND s.i >= t.i - ks.k AND s.i < t.i
       WHERE t.i >= {T} GROUP BY t.id_ciudad, t.split, t.i, ks.k),
cells AS ({cells}),
per AS (SELECT split, k, target, sum((real - pred) * (real - pred)) AS sse, sum(abs(real - pred)) AS sae,
               count(*) AS n, var_pop(real) AS v FROM cells GROUP BY split, k, target),
it AS (SELECT split, k, sum(sse) / sum(n) AS loss, sum(sae) / sum(n) AS mae, avg(1.0 - sse / (v * n)) AS r2
       FROM per GROUP BY split, k),
hist AS (
  SELECT CAST(k - 1 AS INTEGER) AS iteration,
         round(max(CASE WHEN split = 'train' THEN loss END), 6) AS loss,
         round(max(CASE WHEN split = 'val' THEN loss END), 6) AS val_loss,
         round(max(CASE WHEN split = 'train' THEN mae END), 6) AS mae,
         round(max(CASE WHEN split = 'val' THEN mae END), 6) AS val_mae,
         round(max(CASE WHEN split = 'train' THEN sqrt(loss) END), 6) AS rmse,
         round(max(CASE WHEN split = 'val' THEN sqrt(loss) END), 6) AS val_rmse,
         round(max(CASE WHEN split = 'train' THEN r2 END), 6) AS r2,
         round(max(CASE WHEN split = 'val' THEN r2 END), 6) AS val_r2
  FROM it GROUP BY k)"""


SWEEP_SQL = _sweep_sql()


@register("window_sweep_history", "L13", SWEEP_SQL + " SELECT * FROM hist", materialize=True)
def q_window_sweep_history(t: Tables):
    """Deterministic history: trailing k-row mean forecaster, k = 1..T."""
    return sweep(t)


@register("best_window_length", "F03", SWEEP_SQL + """
SELECT * FROM hist ORDER BY val_loss, iteration LIMIT 1""", materialize=True)
def q_best_window_length(t: Tables):
    """Sweep iteration with the lowest val_loss (first on ties)."""
    return ev.best_iteration(sweep(t))


@register("final_window_length", "F04", SWEEP_SQL + """
SELECT * FROM hist ORDER BY iteration DESC LIMIT 1""", materialize=True)
def q_final_window_length(t: Tables):
    return ev.final_iteration(sweep(t))


@register("sweep_slice", "F07", SWEEP_SQL + f"""
, sl AS (SELECT * FROM hist WHERE iteration >= {SWEEP_SLICE[0]} AND iteration < {SWEEP_SLICE[1]})
SELECT *, iteration = (SELECT min(iteration) FROM sl) AS is_first, iteration = (SELECT max(iteration) FROM sl) AS is_last
FROM sl""", materialize=True)
def q_sweep_slice(t: Tables):
    return ev.history_slice(sweep(t), *SWEEP_SLICE)


@register("sweep_progress", "L14", SWEEP_SQL + f"""
SELECT * FROM hist WHERE (iteration + 1) % {SWEEP_EVERY} = 0""", materialize=True)
def q_sweep_progress(t: Tables):
    return ev.progress_every_k(sweep(t), SWEEP_EVERY)
