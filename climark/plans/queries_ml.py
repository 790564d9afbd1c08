"""Forecasting queries: fitting, prediction, next-day forecasts, training
history, permutation importance and the daily workflow.

Learners have no SQL equivalent; their queries are checked by row counts and unit
tests, and the work around them (windows, serving, appends, the permutation) by the same
operators with forecasters that SQL can express (persistence, a straight line).  The
serving model and the training history are fitted once in a session, stored under the
shared scratch folder, and read by every query that needs them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climark.functions.calendar import prepare_features
from climark.functions.numeric import r6, round_half_even
from climark.operators import evaluate as ev
from climark.operators import scaling as sc
from climark.operators import sequences as sq
from climark.operators.forecast import (CANDIDATES, LeastSquares, MultiTarget, ServingModel, coefficients_long,
                                        importances_long)
from climark.operators.importance import donor_keys, permutation_importance
from climark.plans.catalog import register
from climark.plans.queries_core import ALL_EQ, BATCH_SQL, STORED_SQL, feat, old_and_batch, stored
from climark.plans.queries_seq import T, TF_SQL, fitted_scaler, training_frame, windows
from climark.schemas import FULL_FEATURES, REDUCED_FEATURES, TABLES, TARGETS
from climark.session import scratch_path
from climark.sources import tables as tb
from climark.sources.bridge import AS_OF, Tables

KEYS = ["split", "id_ciudad", "target_time"]
ML_MODELS = list(CANDIDATES)
SERVING_MODEL = "Elastic Net"
HISTORY_SLICE = (40, 50)
PROGRESS_EVERY = 10


def term_names(features: list[str]) -> list[str]:
    return [f"{f}@t{s}" for s in range(T) for f in features]


class MLData:
    """Scaled, windowed, flattened training data of one ``Tables``.

    The candidates use all 25 features; the serving model uses the 18 of the
    reduced set.  The vector frame is checkpointed, because every target's fit
    reads it again; nothing stays in the cache."""

    def __init__(self, t: Tables, features: list[str] = FULL_FEATURES):
        self.t, self.features = t, features
        frame = training_frame(t)
        self.params = sc.scaler_params(fitted_scaler(t, features, frame))
        tf = frame.withColumns({f"__y_{x}": F.col(x) for x in TARGETS})
        win = sq.supervised_windows(sc.apply_scaler(tf, self.params), features, TARGETS, T, target_prefix="__y_")
        self.windows = win
        # few bytes but much work a row: as many partitions as the cluster has cores at least
        cores = max(t.spark.sparkContext.defaultParallelism, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = win.repartition(cores, "id_ciudad", "target_time")
        self.vec = sq.flatten_window(dealt, features).drop("seq").checkpoint(eager=True)

    def split(self, name: str) -> DataFrame:
        return self.vec.where(F.col("split") == name)

    def fit(self, model: str):
        return CANDIDATES[model](self.split("train"))

    def serving(self, df: DataFrame) -> DataFrame:
        """Scale a serving frame with the train-fitted parameters."""
        return sc.apply_scaler(df, self.params)


_KEPT: dict[tuple, str] = {}


def _once(t: Tables, what: str, make) -> str:
    """Folder of something stored once for this session and these tables; ``make(path)`` stores it."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, t.level, what)
    if key not in _KEPT:
        path = scratch_path(t.spark, what)
        make(path)
        _KEPT[key] = path
    return _KEPT[key]


def serving_model(t: Tables) -> ServingModel:
    """The stored serving model, loaded; fitted and stored where this session has none yet."""
    def fit(path: str) -> None:
        d = MLData(t, REDUCED_FEATURES)
        ServingModel(SERVING_MODEL, d.fit(SERVING_MODEL), d.params, T).save(t.spark, path)

    return ServingModel.load(t.spark, _once(t, "serving-model", fit), SERVING_MODEL, REDUCED_FEATURES, T)


def predictions(d: MLData, model: str) -> DataFrame:
    return ev.predictions_long(d.fit(model).transform(d.vec), model, KEYS)


def _terms(t: Tables, rows, value: str) -> DataFrame:
    return t.spark.createDataFrame(rows, f"target string, term string, {value} double")


@register("fit_linear", "L03", materialize=True)
def q_fit_linear(t: Tables):
    """Ordinary least squares per target: (target, term, coefficient)."""
    return _terms(t, coefficients_long(MLData(t).fit("Linear Regression"), term_names(FULL_FEATURES)), "coefficient")


@register("fit_elastic_net", "L03", materialize=True)
def q_fit_elastic_net(t: Tables):
    """Elastic net (alpha 0.1, l1 ratio 0.5) per target: coefficients."""
    return _terms(t, coefficients_long(MLData(t).fit("Elastic Net"), term_names(FULL_FEATURES)), "coefficient")


@register("fit_decision_tree", "L04", materialize=True)
def q_fit_decision_tree(t: Tables):
    """Depth-5 regression trees per target: feature importances."""
    return _terms(t, importances_long(MLData(t).fit("Decision Tree"), term_names(FULL_FEATURES)), "importance")


def _by_term(rows: DataFrame) -> DataFrame:
    """(target, feature number, importance) -> (target, term, importance), 0 for terms without one."""
    terms = rows.sparkSession.createDataFrame(list(enumerate(term_names(FULL_FEATURES))), "feature int, term string")
    every = F.broadcast(terms.withColumn("target", F.explode(F.array(*map(F.lit, TARGETS)))))
    return every.join(rows, ["target", "feature"], "left").select(
        "target", "term", F.coalesce("importance", F.lit(0.0)).alias("importance"))


@register("fit_random_forest", "L04", materialize=True)
def q_fit_random_forest(t: Tables):
    """100-tree forests of unlimited depth per target: feature importances."""
    return _by_term(MLData(t).fit("Random Forest").importances())


@register("fit_gradient_boosting", "L05", materialize=True)
def q_fit_gradient_boosting(t: Tables):
    """50-round depth-3 boosting per target: feature importances."""
    return _by_term(t.spark.createDataFrame(MLData(t).fit("Gradient Boosting").importances(),
                                            "target string, feature int, importance double"))


@register("multi_output", "L06", materialize=True)
def q_multi_output(t: Tables):
    """Three regressors on one window vector, outputs side by side."""
    d = MLData(t, REDUCED_FEATURES)
    return serving_model(t).model.transform(d.vec).select(*KEYS, *[f"y_{x}" for x in TARGETS],
                                                          *[f"pred_{x}" for x in TARGETS])


@register("predict_splits", "L07", materialize=True)
def q_predict_splits(t: Tables):
    """Long predictions (model, split, station, day, target, real, pred)."""
    return ev.predictions_long(serving_model(t).model.transform(MLData(t, REDUCED_FEATURES).vec), SERVING_MODEL, KEYS)


_BY_LAST_SQL = f""", {TF_SQL},
w AS (SELECT id_ciudad, split, time AS target_time, row_number() OVER p - 1 AS i,
             {', '.join(f"round({x}, 6) AS y_{x}, round(lag({x}) OVER p, 6) AS pred_{x}" for x in TARGETS)}
      FROM tf WINDOW p AS (PARTITION BY id_ciudad, split ORDER BY time))"""


def _by_last(t: Tables) -> DataFrame:
    """Windows with the forecasts of the forecaster that repeats the last day."""
    last = F.element_at("seq", -1)
    return windows(t).select(*KEYS, *[r6(f"y_{x}").alias(f"y_{x}") for x in TARGETS],
                             *[r6(last[x]).alias(f"pred_{x}") for x in TARGETS])


@register("multi_output_persistence", "L06", f"{_BY_LAST_SQL} SELECT * EXCLUDE (i) FROM w WHERE i >= {T}", materialize=True)
def q_multi_output_persistence(t: Tables):
    """``multi_output`` with the forecaster that repeats the last day."""
    return _by_last(t)


@register("predict_splits_persistence", "L07", _BY_LAST_SQL + " UNION ALL ".join(
    f" SELECT 'Persistence' AS model, split, id_ciudad, target_time, '{x}' AS target, y_{x} AS real, pred_{x} AS pred "
    f"FROM w WHERE i >= {T}" for x in TARGETS), materialize=True)
def q_predict_splits_persistence(t: Tables):
    """``predict_splits`` with the forecaster that repeats the last day."""
    return ev.predictions_long(_by_last(t), "Persistence", KEYS)


@register("model_comparison_ml", "L10", materialize=True)
def q_model_comparison_ml(t: Tables):
    """The comparison table for the Spark ML candidates, serving model first."""
    d = MLData(t)
    preds = reduce(DataFrame.unionByName, [predictions(d, m) for m in ML_MODELS])
    return ev.model_comparison(preds, ML_MODELS, SERVING_MODEL)


def rounded_forecasts(out: DataFrame) -> DataFrame:
    """Forecast rows (id, time, tmax, tmin, tavg), 1 dp, halves to even.  Every
    forecast is kept; ``cleaning.unsigned_violations`` reports those that a store of
    unsigned values would refuse."""
    return out.select(F.col("id_ciudad").cast("int").alias("id"), F.col("forecast_time").alias("time"),
                      *[round_half_even(f"pred_{x}", 1).alias(x) for x in TARGETS])


def model_forecaster(m: ServingModel):
    """Windows of unscaled features -> forecast rows of a stored model."""
    at = {f: (mean, std) for f, mean, std in m.scaler}

    def forecast(win: DataFrame) -> DataFrame:
        scaled = F.transform("seq", lambda s: F.struct(*[((s[f] - F.lit(at[f][0])) / F.lit(at[f][1])).alias(f)
                                                         for f in m.features]))
        return rounded_forecasts(m.model.transform(sq.flatten_window(win.withColumn("seq", scaled), m.features)))

    return forecast


def persistence(win: DataFrame) -> DataFrame:
    """Forecast rows that repeat the window's last day."""
    last = F.element_at("seq", -1)
    return rounded_forecasts(win.withColumns({f"pred_{x}": last[x] for x in TARGETS}))


@register("forecast_next_day", "L08", materialize=True)
def q_forecast_next_day(t: Tables):
    """Every station's forecast for the day after its last observation, by the stored model."""
    return model_forecaster(serving_model(t))(sq.serving_windows(feat(t), REDUCED_FEATURES, T))


def _importance(t: Tables, path: str) -> None:
    d = MLData(t, REDUCED_FEATURES)
    val = d.windows.where(F.col("split") == "val")
    permutation_importance(val, serving_model(t).model, REDUCED_FEATURES, ["id_ciudad", "target_time"], TARGETS) \
        .write.parquet(path)


@register("permutation_importance", "L11", materialize=True)
def q_permutation_importance(t: Tables):
    """Importance of each feature (whole window permuted) on val windows."""
    return t.spark.read.parquet(_once(t, "importance", lambda path: _importance(t, path)))


@register("sort_importance", "F05", materialize=True)
def q_sort_importance(t: Tables):
    """Importances in descending order with their rank (one row per feature)."""
    imp = q_permutation_importance(t)
    return imp.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("Importancia"), "Variable")))


@register("permuted_join", "C07", f""", {TF_SQL},
w AS (SELECT id_ciudad, time AS target_time, row_number() OVER (PARTITION BY id_ciudad, split ORDER BY time) - 1 AS i, split FROM tf)
SELECT f.feature, w.id_ciudad, w.target_time, 1::BIGINT AS received, 1::BIGINT AS given
FROM w, (SELECT unnest([{', '.join(f"'{f}'" for f in REDUCED_FEATURES)}]) AS feature) f WHERE w.split = 'val' AND w.i >= {T}""",
          materialize=True)
def q_permuted_join(t: Tables):
    """How often each val window receives and gives each feature: once."""
    keys = ["id_ciudad", "target_time"]
    win = windows(t).where(F.col("split") == "val")
    pairs = donor_keys(win, REDUCED_FEATURES, keys)
    got = pairs.groupBy("feature", *keys).agg(F.count(F.lit(1)).alias("received"))
    gave = pairs.groupBy("feature", *[F.col(f"_d_{k}").alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("given"))
    return got.join(gave, ["feature", *keys], "full")


def history(t: Tables) -> DataFrame:
    """The stored history of the boosted models, fitted once in a session."""
    def fit(path: str) -> None:
        d = MLData(t)
        d.fit("Gradient Boosting").history(d.vec).write.parquet(path)

    return t.spark.read.parquet(_once(t, "history", fit))


@register("training_history", "L13", materialize=True)
def q_training_history(t: Tables):
    """Per-iteration train/val loss, MAE, RMSE, R^2 of the boosted models."""
    return history(t)


@register("best_iteration", "F03", materialize=True)
def q_best_iteration(t: Tables):
    return ev.best_iteration(history(t))


@register("final_iteration", "F04", materialize=True)
def q_final_iteration(t: Tables):
    return ev.final_iteration(history(t))


@register("history_slice", "F07", materialize=True)
def q_history_slice(t: Tables):
    return ev.history_slice(history(t), *HISTORY_SLICE)


@register("progress_every_k", "L14", materialize=True)
def q_progress_every_k(t: Tables):
    return ev.progress_every_k(history(t), PROGRESS_EVERY)


def station_tables(t: Tables, observations: DataFrame, forecasts: DataFrame) -> str:
    """A folder of bootstrapped tables that hold the given rows."""
    base = scratch_path(t.spark, "stations")
    tb.bootstrap_tables(t.spark, base)
    tb.append_rows(t.spark, base, "clima", observations, batch_id="initial")
    tb.append_rows(t.spark, base, "predic", forecasts, batch_id="initial")
    return base


def append_forecasts(t: Tables, base: str, forecaster, batch_id: str) -> int:
    """Score every missed day of all stations in one job and append the forecasts of days
    that have none (key (station, day): a day already forecast is not replaced)."""
    observations, forecasts = (tb.read_table(t.spark, base, n) for n in ("clima", "predic"))
    behind = sq.days_behind(observations, forecasts, t.ciudades)
    new = forecaster(sq.catchup_windows(prepare_features(observations), behind, REDUCED_FEATURES, T))
    new = new.join(forecasts.select("id", "time"), ["id", "time"], "left_anti")
    return tb.append_rows(t.spark, base, "predic", new, batch_id=batch_id)


def append_observations(t: Tables, base: str, batch_id: str) -> int:
    """update_range -> landing_fetch -> append for all stations."""
    ranges = tb.update_range(tb.read_table(t.spark, base, "clima"), t.ciudades, AS_OF)
    return tb.append_rows(t.spark, base, "clima", tb.landing_fetch(t.landing, ranges, t.ciudades), batch_id=batch_id)


def run_daily(t: Tables, base: str, forecaster, day: str) -> None:
    """The daily run: store what was delivered, then forecast and store every missed day.  A
    run that is repeated for the same day adds nothing."""
    append_observations(t, base, f"observations-{day}")
    append_forecasts(t, base, forecaster, f"forecasts-{day}")


@register("append_rows", "A03", f""", {BATCH_SQL}
SELECT * FROM old UNION ALL
SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM old o WHERE {ALL_EQ})""", materialize=True)
def q_append_rows(t: Tables):
    """The stored table after a re-delivered batch was appended to it (null->0, rows already
    stored are skipped), and after the same run once more."""
    old, batch = old_and_batch(t)
    base = scratch_path(t.spark, "append")
    tb.bootstrap_tables(t.spark, base)
    tb.append_rows(t.spark, base, "clima", old, batch_id="initial")
    for _ in range(2):
        tb.append_rows(t.spark, base, "clima", batch, batch_id="redelivery")
    return tb.read_table(t.spark, base, "clima")


@register("update_observations", "K01", f""", {STORED_SQL},
fetched AS (SELECT c.* FROM clima c JOIN ranges r ON c.id_ciudad = r.id
            WHERE NOT r.skip AND c.time BETWEEN r.fetch_start AND r.fetch_end)
SELECT * FROM stored UNION ALL
SELECT * FROM fetched b WHERE NOT EXISTS (SELECT 1 FROM stored o WHERE {ALL_EQ})""", materialize=True)
def q_update_observations(t: Tables):
    """The stored observations after the update ran twice."""
    base = station_tables(t, stored(t), t.predic)
    for run in ("first", "second"):
        append_observations(t, base, run)
    return tb.read_table(t.spark, base, "clima")


@register("process_forecasts", "K03", materialize=True)
def q_process_forecasts(t: Tables):
    """The stored forecasts after all missed days were forecast by the stored model, twice."""
    base = station_tables(t, t.clima, t.predic)
    for run in ("first", "second"):
        append_forecasts(t, base, model_forecaster(serving_model(t)), run)
    return tb.read_table(t.spark, base, "predic")


@register("run_daily", "K02", materialize=True)
def q_run_daily(t: Tables):
    """The stored forecasts after two daily runs by the stored model."""
    base = station_tables(t, stored(t), t.predic)
    for _ in range(2):
        run_daily(t, base, model_forecaster(serving_model(t)), AS_OF)
    return tb.read_table(t.spark, base, "predic")


_LAST_SQL = """, x AS (SELECT *, row_number() OVER (PARTITION BY id_ciudad ORDER BY time) - 1 AS i,
                             count(*) OVER (PARTITION BY id_ciudad) AS n FROM clima)"""
_REPEAT_SQL = """SELECT x.id_ciudad AS id, x.time + INTERVAL 1 DAY AS time, round_even(x.tmax, 1) AS tmax,
       round_even(x.tmin, 1) AS tmin, round_even(x.tavg, 1) AS tavg FROM x"""
MISSED_SQL = f"""{_LAST_SQL},
lo AS (SELECT id_ciudad AS id, max(time) AS last_obs FROM clima GROUP BY 1),
lf AS (SELECT id, max(time) AS last_fc FROM predic GROUP BY id),
b AS (SELECT lo.id, CASE WHEN last_fc IS NULL THEN 0 ELSE date_diff('day', last_fc, last_obs) END AS d
      FROM ciudades c JOIN lo ON c.id = lo.id LEFT JOIN lf ON lf.id = lo.id),
new AS ({_REPEAT_SQL} JOIN b ON b.id = x.id_ciudad
        WHERE b.d >= 0 AND i >= n - 1 - d AND i >= {T} - 1
          AND NOT EXISTS (SELECT 1 FROM predic p WHERE p.id = x.id_ciudad AND p.time = x.time + INTERVAL 1 DAY))
SELECT * FROM predic UNION ALL SELECT * FROM new"""


#: The same month by month: each delivery's stations catch up from their last forecast.
MONTHLY_SQL = f"""{_LAST_SQL},
lf AS (SELECT id, max(time) AS last_fc FROM predic GROUP BY id),
m AS (SELECT id_ciudad, date_trunc('month', time) AS mon, max(i) AS e, max(time) AS last_obs FROM x
      WHERE time > {{FORECAST_END}} GROUP BY 1, 2),
b AS (SELECT m.*, date_diff('day', coalesce(lag(m.last_obs) OVER (PARTITION BY m.id_ciudad ORDER BY mon) + INTERVAL 1 DAY,
                                            lf.last_fc, m.last_obs), m.last_obs) AS d
      FROM m LEFT JOIN lf ON lf.id = m.id_ciudad),
new AS ({_REPEAT_SQL} JOIN b ON b.id_ciudad = x.id_ciudad
        WHERE b.d >= 0 AND i BETWEEN b.e - b.d AND b.e AND i >= {T} - 1
          AND NOT EXISTS (SELECT 1 FROM predic p WHERE p.id = x.id_ciudad AND p.time = x.time + INTERVAL 1 DAY))
SELECT * FROM predic UNION ALL SELECT DISTINCT * FROM new"""


@register("forecast_next_day_persistence", "L08", f"{_LAST_SQL} {_REPEAT_SQL} WHERE i = n - 1 AND n >= {T}",
          materialize=True)
def q_forecast_next_day_persistence(t: Tables):
    """``forecast_next_day`` with the forecaster that repeats the last day."""
    return persistence(sq.serving_windows(feat(t), REDUCED_FEATURES, T))


@register("process_forecasts_persistence", "K03", MISSED_SQL, materialize=True)
def q_process_forecasts_persistence(t: Tables):
    """``process_forecasts`` with the forecaster that repeats the last day."""
    base = station_tables(t, t.clima, t.predic)
    for run in ("first", "second"):
        append_forecasts(t, base, persistence, run)
    return tb.read_table(t.spark, base, "predic")


@register("run_daily_persistence", "K02", MISSED_SQL, materialize=True)
def q_run_daily_persistence(t: Tables):
    """``run_daily`` with the forecaster that repeats the last day: the update brings the
    observations up to date first, so the forecasts are those of the whole table."""
    base = station_tables(t, stored(t), t.predic)
    for _ in range(2):
        run_daily(t, base, persistence, AS_OF)
    return tb.read_table(t.spark, base, "predic")


@register("catalog_tables", "A04", f"""
, cols AS ({' UNION ALL '.join(
    f"SELECT '{n}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
    f"{str(not f.nullable).lower()} AS required, {str(tb.PARTITION.get(n) == f.name).lower()} AS partition, "
    f"(SELECT count({f.name}) FROM {n}) AS stored" for n, schema in TABLES.items() for f in schema)})
SELECT * FROM cols""", materialize=True)
def q_catalog_tables(t: Tables):
    """The tables that two bootstrap runs leave in the catalog: every column with its type,
    whether it is required, and how many values are stored in it."""
    spark, base = t.spark, scratch_path(t.spark, "catalog")
    database = "climark_" + base.rsplit("-", 1)[-1]
    tb.bootstrap_catalog(spark, base, database)
    for name in TABLES:
        tb.append_rows(spark, base, name, t.table(name), batch_id="initial")
    tb.bootstrap_catalog(spark, base, database)
    columns = tb.catalog_columns(spark, database)
    counts = []
    for name in TABLES:
        if name in tb.PARTITION:
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
        else:
            spark.catalog.refreshTable(f"{database}.{name}")
        held = spark.table(f"{database}.{name}")
        counts.append(held.agg(*[F.count(c).alias(c) for c in held.columns]).unpivot([], held.columns, "column_name", "stored")
                      .withColumn("table_name", F.lit(name)))
    return columns.join(reduce(DataFrame.unionByName, counts), ["table_name", "column_name"])


def _two_value_rows(t: Tables) -> DataFrame:
    """Train pairs of a day and the next: its tmax and tavg, and the next day's tmax."""
    frame = training_frame(t).where(F.col("split") == "train")
    win = sq.supervised_windows(frame, ["tmax", "tavg"], ["tmax"], 1)
    return win.select(F.element_at("seq", 1).alias("d"), "y_tmax").select(
        F.col("d.tmax").alias("a"), F.col("d.tavg").alias("b"), F.col("y_tmax").alias("y"))


@register("fit_linear_two_features", "L03", f""", {TF_SQL},
p AS (SELECT tmax AS a, tavg AS b, lead(tmax) OVER (PARTITION BY id_ciudad ORDER BY time) AS y FROM tf WHERE split = 'train'),
m AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS cy,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM p WHERE y IS NOT NULL),
w AS (SELECT *, (ay * bb - cy * ab) / (aa * bb - ab * ab) AS wa, (cy * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m)
SELECT 'tmax' AS term, round(wa, 6) AS coefficient FROM w UNION ALL SELECT 'tavg', round(wb, 6) FROM w
UNION ALL SELECT 'intercept', round(my - wa * ma - wb * mb, 6) FROM w""", materialize=True)
def q_fit_linear_two_features(t: Tables):
    """Least squares of tomorrow's tmax on today's tmax and tavg (T = 1): the normal equations' solution."""
    from pyspark.ml.functions import array_to_vector
    model = LeastSquares().setLabelCol("y").fit(_two_value_rows(t).withColumn("features", array_to_vector(F.array("a", "b"))))
    a, b = (float(v) for v in model.coefficients)
    rows = t.spark.createDataFrame([("tmax", a), ("tavg", b), ("intercept", float(model.intercept))], "term string, c double")
    return rows.select("term", r6("c").alias("coefficient"))


__all__ = ["MLData", "model_forecaster", "persistence", "serving_model"]
