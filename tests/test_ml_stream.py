"""Spark ML wrapper, permutation importance, flattening and streaming."""

import datetime as dt

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from climark.operators import sequences as sq
from climark.operators.forecast import CANDIDATES, MultiTarget
from climark.operators.importance import permutation_importance
from climark.schemas import TARGETS
from climark.session import scratch_path
from climark.sources import tables as tb
from climark.streaming.ingest import stream_ingest_observations

FEATS = ["tmax", "tmin", "tavg"]


def windows(spark, n=120, T=4):
    rows, t = [], dt.datetime(2020, 1, 1)
    for i in range(n):
        rows.append((1, t, float(20 + (i * 7) % 11), float(10 + (i * 3) % 5), float(15 + (i * 5) % 7)))
        t += dt.timedelta(days=1)
    df = spark.createDataFrame(rows, "id_ciudad int, time timestamp_ntz, tmax double, tmin double, tavg double") \
        .withColumn("split", F.lit("train"))
    return sq.supervised_windows(df, FEATS, TARGETS, T)


def test_flatten_is_step_major(spark):
    w = sq.flatten_window(windows(spark), FEATS).first()
    flat = list(w.features.toArray())
    assert flat == [s[c] for s in w.seq for c in FEATS]


def test_multitarget_save_load_roundtrip(spark):
    w = sq.flatten_window(windows(spark), FEATS)
    mt = CANDIDATES["Linear Regression"](w)
    path = scratch_path(spark, "model-test")
    mt.save(path)
    back = MultiTarget.load(path, LinearRegressionModel)
    a = mt.transform(w).select(*[f"pred_{t}" for t in TARGETS]).collect()
    b = back.transform(w).select(*[f"pred_{t}" for t in TARGETS]).collect()
    assert a == b


def test_comparison_has_every_candidate():
    from climark.plans.queries_ml import ML_MODELS
    assert ML_MODELS == list(CANDIDATES) and "Random Forest" in ML_MODELS


def test_permutation_importance_sums_to_one(spark):
    win = windows(spark)
    mt = CANDIDATES["Linear Regression"](sq.flatten_window(win, FEATS))
    imp = permutation_importance(win, mt, FEATS, ["id_ciudad", "target_time"], TARGETS).collect()
    assert len(imp) == 3
    assert abs(sum(r.Importancia for r in imp) - 1.0) < 1e-9
    assert all(r.Importancia >= 0 for r in imp)


def test_importance_of_a_linear_model_is_the_closed_form(spark):
    """mean |sum over steps of w (donor - own)| per feature, from the same permutation."""
    import numpy as np
    from climark.operators.importance import permuted_join
    win = windows(spark, n=200)
    mt = CANDIDATES["Linear Regression"](sq.flatten_window(win, FEATS))
    imp = {r.Variable: r.Importancia for r in permutation_importance(win, mt, FEATS, ["id_ciudad", "target_time"], TARGETS).collect()}
    pairs = permuted_join(win, FEATS, ["id_ciudad", "target_time"]).collect()
    want = {}
    for f in FEATS:
        own = [r for r in pairs if r.feature == f]
        change = np.array([r.perm_x for r in own]) - np.array([r.x for r in own])
        want[f] = np.mean([np.abs(change @ m.coefficients.toArray()) for m in mt.models.values()])
    for f in FEATS:
        assert abs(imp[f] - want[f] / sum(want.values())) < 1e-9


def test_importance_where_the_model_follows_no_feature(spark):
    """Constant targets shrink every coefficient to 0: NaN for each feature, not an error."""
    win = windows(spark).withColumns({f"y_{t}": F.lit(50.0) for t in TARGETS})
    mt = CANDIDATES["Elastic Net"](sq.flatten_window(win, FEATS))
    imp = permutation_importance(win, mt, FEATS, ["id_ciudad", "target_time"], TARGETS).collect()
    assert sorted(r.Variable for r in imp) == sorted(FEATS) and all(r.Importancia != r.Importancia for r in imp)


def test_stream_knows_rows_that_other_jobs_stored(spark):
    """The state learns the stored days from the table's files, not from a join with the table."""
    base = scratch_path(spark, "stream-known")

    def rows(first, n, tmax=30.0):
        return spark.createDataFrame([(1, dt.datetime(2020, 1, 1) + dt.timedelta(days=d), tmax, 20.0, 25.0, 0.0, 0.0, 10, 1.0,
                                       0.0, 1000.0, 0.0) for d in range(first, first + n)], tb.TABLES["clima"]).coalesce(1)

    tb.bootstrap_tables(spark, f"{base}/tables")
    tb.append_rows(spark, f"{base}/tables", "clima", rows(0, 40), batch_id="initial")
    rows(30, 40).write.mode("append").parquet(f"{base}/landing")
    stream_ingest_observations(spark, f"{base}/landing", f"{base}/tables", f"{base}/_ck")
    assert tb.read_table(spark, f"{base}/tables", "clima").count() == 70
    tb.append_rows(spark, f"{base}/tables", "clima", rows(70, 10), batch_id="between")     # between two runs
    rows(60, 30).write.mode("append").parquet(f"{base}/landing")
    rows(0, 2, tmax=31.0).write.mode("append").parquet(f"{base}/landing")                    # contradicts stored days
    stream_ingest_observations(spark, f"{base}/landing", f"{base}/tables", f"{base}/_ck")
    table = tb.read_table(spark, f"{base}/tables", "clima")
    assert table.count() == 90 == table.select("time").distinct().count()
    assert spark.read.parquet(f"{base}/tables/rechazos").count() == 2
    states = tb.commits(spark, f"{base}/tables", "clima").groupBy("batch_id").agg(F.collect_set("state").alias("s")).collect()
    assert all(sorted(r.s) == ["begun", "done"] for r in states)


def test_stream_ingest_dedups_and_is_idempotent(spark):
    base = scratch_path(spark, "stream-test")
    rows = [(1, dt.datetime(2020, 1, d), 30.0, 20.0, 25.0, None, None, 10, 1.0, None, 1000.0, None)
            for d in range(1, 11)]
    schema = tb.TABLES["clima"]
    df = spark.createDataFrame(rows, schema)
    df.write.mode("append").parquet(f"{base}/landing")
    df.where(F.dayofmonth("time") > 7).write.mode("append").parquet(f"{base}/landing")  # re-delivery
    tb.bootstrap_tables(spark, f"{base}/tables")
    stream_ingest_observations(spark, f"{base}/landing", f"{base}/tables", f"{base}/_ck")
    assert tb.read_table(spark, f"{base}/tables", "clima").count() == 10
    # restarting from the same checkpoint appends nothing
    stream_ingest_observations(spark, f"{base}/landing", f"{base}/tables", f"{base}/_ck")
    assert tb.read_table(spark, f"{base}/tables", "clima").count() == 10


def test_permuted_join_is_a_bijection_per_feature(spark):
    from climark.operators.importance import permuted_join
    win = windows(spark, n=300)
    pj = permuted_join(win, FEATS, ["id_ciudad", "target_time"], seed=7).collect()
    for d, f in enumerate(FEATS):
        rows = [r for r in pj if r.feature == f]
        assert sorted(r.x[d::3] for r in rows) == sorted(r.perm_x[d::3] for r in rows)  # each window used exactly once
        assert sum(r.x[d::3] != r.perm_x[d::3] for r in rows) > len(rows) / 2
        assert all(r.x[k::3] == r.perm_x[k::3] for r in rows for k in range(3) if k != d)


def test_elastic_net_minimises_the_stated_objective(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from climark.operators.forecast import elastic_net
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 6))
    y = X @ np.array([3.0, -2, 0.5, 0, 0, 1]) + rng.normal(size=400) + 4
    alpha, ratio, w, b = 0.3, 0.5, np.zeros(6), 0.0
    for _ in range(500):  # coordinate descent
        b = (y - X @ w).mean()
        for j in range(6):
            r = y - b - X @ w + X[:, j] * w[j]
            z, n2 = X[:, j] @ r / 400, (X[:, j] ** 2).mean()
            w[j] = np.sign(z) * max(abs(z) - alpha * ratio, 0) / (n2 + alpha * (1 - ratio))
    df = spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(X, y)], "x array<double>, y double")
    m = elastic_net(alpha, ratio, float(y.std(ddof=1))).setLabelCol("y").fit(df.withColumn("features", array_to_vector("x")))
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-3) and abs(m.intercept - b) < 1e-3


def test_stream_stores_a_back_fill_and_reports_contradictions(spark):
    base = scratch_path(spark, "stream-backfill")
    schema = tb.TABLES["clima"]

    def rows(station, year, n):
        return [(station, dt.datetime(year, 1, 1) + dt.timedelta(days=d), 30.0, 20.0, 25.0, 0.0, 0.0, 10, 1.0, 0.0, 1000.0, 0.0)
                for d in range(n)]

    other = [(2, dt.datetime(2018, 1, 1), 99.0, 20.0, 25.0, 0.0, 0.0, 10, 1.0, 0.0, 1000.0, 0.0)]
    tb.bootstrap_tables(spark, f"{base}/tables")
    for k, part in enumerate((rows(1, 2023, 60), rows(1, 2023, 90), rows(2, 2018, 1500), other)):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/landing")
        stream_ingest_observations(spark, f"{base}/landing", f"{base}/tables", f"{base}/_ck")
    got = {r.id_ciudad: r["count"] for r in tb.read_table(spark, f"{base}/tables", "clima").groupBy("id_ciudad").count().collect()}
    assert got == {1: 90, 2: 1500}
    assert [r.tmax for r in spark.read.parquet(f"{base}/tables/rechazos").collect()] == [99.0]


def test_stream_daily_forecast_appends_for_touched_stations(spark):
    from climark.streaming.ingest import stream_daily_forecast
    base = scratch_path(spark, "stream-fc-test")
    schema = tb.TABLES["clima"]
    rows = [(s, dt.datetime(2020, 1, d), 30.0, 20.0, 25.0, 0.0, 0.0, 10, 1.0, 0.0, 1000.0, 0.0)
            for s in (1, 2) for d in range(1, 6)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/landing")  # one delivery
    tb.bootstrap_tables(spark, f"{base}/tables")

    def persistence(obs, fc, touched):  # next day = last observation, 1 dp
        last = obs.groupBy("id_ciudad").agg(F.max_by(F.struct("time", "tmax", "tmin", "tavg"), "time").alias("r"))
        return last.select(F.col("id_ciudad").alias("id"), (F.col("r.time") + F.expr("INTERVAL 1 DAY")).alias("time"),
                           F.col("r.tmax").alias("tmax"), F.col("r.tmin").alias("tmin"), F.col("r.tavg").alias("tavg"))

    stream_daily_forecast(spark, f"{base}/landing", f"{base}/tables", f"{base}/_ck", persistence)
    fc = tb.read_table(spark, f"{base}/tables", "predic").collect()
    got = sorted((r.id, r.time) for r in fc)
    assert got == [(1, dt.datetime(2020, 1, 6)), (2, dt.datetime(2020, 1, 6))], got
