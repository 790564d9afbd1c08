"""Unit tests on hand-made frames for the semantics register (Q1-Q23)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from climark.functions.calendar import prepare_features
from climark.operators import cleaning as cl
from climark.operators import climatology as clim
from climark.operators import evaluate as ev
from climark.operators import integrity as ig
from climark.operators import profile as pf
from climark.operators import scaling as sc
from climark.operators import sequences as sq
from climark.schemas import SEASON_COLUMNS
from climark.sources import tables as tb


def day(y, m, d):
    return dt.datetime(y, m, d)


OBS = "id_ciudad int, time timestamp_ntz, tmax double, tmin double, tavg double"


def series(spark, n, start=day(2020, 1, 1), station=1, gap_every=None):
    rows, t = [], start
    for i in range(n):
        rows.append((station, t, float(20 + i % 7), float(10 + i % 5), float(15 + i % 3)))
        t += dt.timedelta(days=2 if gap_every and i % gap_every == 0 else 1)
    return spark.createDataFrame(rows, OBS)


def test_season_indicators_serving_window_inside_one_month(spark):
    # Q5/Q6: a window entirely in July must have Invierno = 1 at serving time
    df = prepare_features(series(spark, 20, day(2021, 7, 1)))
    r = df.agg(*[F.sum(c).alias(c) for c in SEASON_COLUMNS]).first().asDict()
    assert r == {"Invierno": 20, "Otoño": 0, "Primavera": 0, "Verano": 0}
    assert df.where(F.col("mes_7") != 1).count() == 0


def test_onehot_sums_to_one(spark):
    df = prepare_features(series(spark, 400))
    bad = df.where(sum(F.col(f"`{c}`") for c in SEASON_COLUMNS) != 1).count()
    bad += df.where(sum(F.col(f"mes_{m}") for m in range(1, 13)) != 1).count()
    assert bad == 0


def test_duplicates_null_safe_and_value_sensitive(spark):
    # Q4: same key + different value is not a duplicate; null cells match
    schema = "id_ciudad int, time timestamp_ntz, tmax double, snow double"
    old = spark.createDataFrame([(1, day(2020, 1, 1), 30.0, None), (1, day(2020, 1, 2), 31.0, 0.0)], schema)
    new = spark.createDataFrame([(1, day(2020, 1, 1), 30.0, None), (1, day(2020, 1, 2), 99.0, 0.0),
                                 (1, day(2020, 1, 3), 32.0, 0.0)], schema)
    assert [r.time.day for r in ig.find_duplicates(new, old).collect()] == [1]
    assert sorted(r.time.day for r in ig.insert_guard(new, old, "insert_new").collect()) == [2, 3]
    # Q3: reject_batch refuses the whole batch
    assert ig.insert_guard(new, old, "reject_batch").count() == 0
    clean = new.where(F.col("time") > day(2020, 1, 2))
    assert ig.insert_guard(clean, old, "reject_batch").count() == 1


def test_insert_twice_equals_once(spark, tmp_path):
    base = str(tmp_path / "t")
    tb.bootstrap_tables(spark, base)
    batch = series(spark, 30).withColumns({c: F.lit(None).cast("double") for c in
                                           ["prcp", "snow", "wspd", "wpgt", "pres", "tsun"]}) \
        .withColumn("wdir", F.lit(None).cast("int"))
    assert tb.append_rows(spark, base, "clima", batch) == 30
    assert tb.append_rows(spark, base, "clima", batch) == 0
    stored = tb.read_table(spark, base, "clima")
    assert stored.count() == 30
    assert stored.where(F.col("snow").isNull()).count() == 0  # Q20: null -> 0 on insert


def test_windows_len_minus_T_per_split(spark):
    # Q12: windows never cross a split; N = len - T (0 when len <= T)
    df = series(spark, 70, gap_every=5)
    df = cl.temporal_split(df, "2020-02-10", "2020-02-20")
    n = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    win = sq.supervised_windows(df, ["tmax", "tmin"], ["tavg"], 5, chunk=7)
    got = {r.split: r["count"] for r in win.groupBy("split").count().collect()}
    assert got == {k: max(v - 5, 0) for k, v in n.items() if v > 5}
    # window content equals the naive definition (halo chunks of 7 rows)
    rows = sorted(df.where("split = 'train'").collect(), key=lambda r: r.time)
    w = {r.target_time: r for r in win.where("split = 'train'").collect()}
    for i in range(5, len(rows)):
        seq = w[rows[i].time].seq
        assert [s.time for s in seq] == [r.time for r in rows[i - 5:i]]
        assert w[rows[i].time].y_tavg == rows[i].tavg


def test_sequence_index_is_dense_and_ordered(spark):
    df = series(spark, 200, gap_every=3).unionByName(series(spark, 50, station=2))
    idx = sq.sequence_index(df, ["id_ciudad"], ["time"], sq.month_bucket(), total="_n")
    for sid, n in ((1, 200), (2, 50)):
        rows = sorted(idx.where(F.col("id_ciudad") == sid).collect(), key=lambda r: r.time)
        assert [r._i for r in rows] == list(range(n))
        assert {r._n for r in rows} == {n}


def test_scaler_population_std_and_constant_column(spark):
    # Q13: population std, zero variance -> divisor 1
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    p = {f: (m, s) for f, m, s in sc.scaler_params(sc.fit_scaler(df, ["a", "b"]))}
    assert p == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    out = sc.apply_scaler(df, sc.scaler_params(sc.fit_scaler(df, ["a", "b"]))).collect()
    assert [(r.a, r.b) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_constant_column_correlation_is_null(spark):
    # §4.3: ANSI corr would raise on a constant column
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 2.0), (1, 3.0, 2.0)], "id_ciudad int, x double, c double")
    m = {(r.col_a, r.col_b): r.corr for r in pf.correlation_matrix(df, ["x", "c"]).collect()}
    assert m[("x", "x")] == 1.0 and m[("x", "c")] is None


def test_mape_skips_zero_actual(spark):
    # Q15
    preds = spark.createDataFrame([("m", "train", 0.0, 1.0), ("m", "train", 2.0, 1.0)],
                                  "model string, split string, real double, pred double")
    r = ev.model_comparison(preds, ["m"], None).first()
    assert r["Train MAPE"] == 50.0 and r["Train MAE"] == 1.0


def test_window_sweep_of_constant_targets(spark):
    """R^2 against a constant: NaN without an error, -inf with one, as in the SQL; the rest stays."""
    rows = [("train", i, float(i % 3), 1.0, float(i % 5)) for i in range(12)]
    rows += [("val", i, float(i % 4), 1.0, 50.0 if i >= 3 else 49.0) for i in range(12)]
    df = spark.createDataFrame([(1, s, day(2020 + 10 * (s == "val"), 1, 1 + i), *y) for s, i, *y in rows],
                               "id_ciudad int, split string, time timestamp_ntz, tmax double, tmin double, tavg double")

    def swept(t):
        win = sq.supervised_windows(df, [t], [t], 3)
        return {r.iteration: r for r in ev.window_sweep_history(win, 3, [t]).collect()}

    same, near, free = swept("tmin"), swept("tavg"), swept("tmax")
    assert sorted(same) == [0, 1, 2]
    assert all(r.r2 != r.r2 and r.val_r2 != r.val_r2 and r.loss == r.val_loss == 0 for r in same.values())
    assert all(r.val_r2 == float("-inf") and r.r2 == r.r2 and r.val_loss > 0 for r in near.values())
    assert all(abs(r.val_r2) < 10 for r in free.values())
    assert ev.best_iteration(ev.window_sweep_history(sq.supervised_windows(df, ["tmin"], ["tmin"], 3), 3, ["tmin"])) \
        .first().iteration == 0


def test_catchup_windows_rows_and_cold_start(spark):
    # Q18/Q19: d days behind -> d+1 windows ending at the last d+1 rows;
    # no forecasts yet -> only the day after the last observation
    obs = series(spark, 40).unionByName(series(spark, 40, station=2)).unionByName(series(spark, 40, station=3))
    fc = spark.createDataFrame([(1, day(2020, 2, 6)), (2, day(2020, 3, 1))], "id int, time timestamp_ntz")
    stations = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    behind = {r.id: r.days_behind for r in sq.days_behind(obs, fc, stations).collect()}
    assert behind == {1: 3, 2: -21, 3: 0}
    win = sq.catchup_windows(obs, sq.days_behind(obs, fc, stations), ["tmax"], 5, chunk=8)
    got = {}
    for r in win.collect():
        got.setdefault(r.id_ciudad, []).append(r.forecast_time)
        assert len(r.seq) == 5 and r.seq[-1].time == r.window_end
    assert sorted(got[1]) == [day(2020, 2, 7), day(2020, 2, 8), day(2020, 2, 9), day(2020, 2, 10)]
    assert 2 not in got and got[3] == [day(2020, 2, 10)]


def test_update_range_skip_rules(spark):
    # Q21: start at last + 1 day or the first date; skip when last >= as_of
    obs = spark.createDataFrame([(1, day(2024, 1, 10)), (2, day(2024, 2, 1))], "id_ciudad int, time timestamp_ntz")
    st = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    r = {x.id: x for x in tb.update_range(obs, st, "2024-02-01").collect()}
    assert r[1].fetch_start == day(2024, 1, 11) and not r[1].skip
    assert r[2].skip
    assert r[3].fetch_start == day(2018, 1, 1) and not r[3].skip


def test_register_ids_follow_max(spark):
    # Q22: ids max+1.. in name order, known names ignored
    st = spark.createDataFrame([(4, "A", 0.0, 0.0)], "id int, ciudad string, latitud double, longitud double")
    cand = spark.createDataFrame([("C", 1.0, 1.0), ("B", 2.0, 2.0), ("A", 9.0, 9.0)],
                                 "ciudad string, latitud double, longitud double")
    out = {r.ciudad: r.id for r in tb.register_stations(st, cand).collect()}
    assert out == {"A": 4, "B": 5, "C": 6}


def test_forward_fill_takes_previous_season_same_day(spark):
    # Q10: a hole at (31, Otoño) takes (31, Verano)
    rows = [(1, d, s, float(d), 0.0, 0.0) for d in range(1, 32)
            for s in ["Verano", "Otoño", "Invierno", "Primavera"] if not (d == 31 and s == "Otoño")]
    agg = spark.createDataFrame(rows, "id_ciudad int, dia int, estacion string, tmax double, tmin double, tavg double")
    grid = clim.dense_grid_fill(agg)
    out = clim.forward_fill(grid, ["tmax"], ["id_ciudad"], ["dia", "season_ord"])
    r = out.where("dia = 31 and estacion = 'Otoño'").first()
    assert r.tmax == 31.0
    assert grid.count() == 124


def test_outlier_uses_uncorrected_mean(spark):
    # Q8: low values replaced by the mean of the raw column
    df = spark.createDataFrame([(1, 5.0), (1, 20.0), (1, 20.0)], "id_ciudad int, tmin double")
    out = sorted(r.tmin for r in cl.replace_low_outlier(df, "tmin", 10.0).collect())
    assert out == [15.0, 20.0, 20.0]


def test_drop_all_null_and_zero_columns(spark):
    df = spark.createDataFrame([(1, 0.0, None, "x"), (2, 0.0, None, "y")], "id_ciudad int, z double, n double, s string")
    assert cl.drop_all_null_columns(df).columns == ["id_ciudad", "z", "s"]
    # null counts as != 0 (pandas), strings are kept, the key is dropped
    assert cl.drop_all_zero_columns(df, ("id_ciudad",)).columns == ["n", "s"]


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [0, 1, 2, 3, 4]], "g string, v double")
    h = {r.bin: r.n for r in pf.histogram_fixed_bins(df, "v", ("g",), 4).collect()}
    assert h == {0: 1, 1: 1, 2: 1, 3: 2}


@pytest.mark.parametrize("n", [1, 3])
def test_box_whiskers_inside_fences(spark, n):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0] * n
    df = spark.createDataFrame([(1, v) for v in vals], "id_ciudad int, x double")
    r = pf.boxplot_stats(df, ["x"]).first()
    assert r.whisker_high == 4.0 and r.n_outliers == n


def test_exact_quantiles_over_many_ranges_ties_and_nulls(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    groups = {1: rng.normal(size=5001), 2: rng.integers(0, 7, 300).astype(float), 3: np.array([2.5]),
              4: np.concatenate([np.full(900, 1e9), rng.random(7)])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(1, None), (3, None)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for r in pf.exact_quantiles(df, ["x"], ["g"], ps).collect():
        assert np.allclose(r.q, np.quantile(groups[r.g], ps), rtol=1e-12), r


def test_quantiles_of_far_values_order_no_large_range(spark):
    import numpy as np
    rng = np.random.default_rng(8)
    groups = {1: np.append(rng.normal(size=6000), 1e12), 2: np.append(rng.normal(size=900), [-1.7e308, 1.7e308]),
              3: np.repeat(rng.normal(size=40), 50), 4: 2.0 ** rng.integers(-900, 900, 3000)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g int, x double")
    ps = [0.25, 0.5, 0.75]
    inside = pf.ranked_ranges(df, ["x"], ["g"], ps, ordered=200)
    assert inside.groupBy("g", "_off").count().agg(F.max("count")).first()[0] <= 200
    for r in pf.exact_quantiles(df, ["x"], ["g"], ps, ordered=200).collect():
        assert np.allclose(r.q, np.quantile(groups[r.g], ps), rtol=1e-12), r


def test_density_counts_every_value_that_matters(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    values = np.append(rng.normal(size=3000), [40.0, -55.0])
    df = spark.createDataFrame([(1, float(v)) for v in values] + [(1, None), (2, 5.0), (2, 5.0)], "id_ciudad int, x double")
    rows = {(r.id_ciudad, r.g): r for r in pf.kde_curves(df, ["x"]).collect()}
    assert len(rows) == 200 and {k[0] for k in rows} == {1}        # no bandwidth, no curve
    bw = values.std(ddof=1) * len(values) ** -0.2
    for g in range(200):
        x = values.min() - 3 * bw + g * (np.ptp(values) + 6 * bw) / 199
        want = np.exp(-0.5 * ((x - values) / bw) ** 2).sum() / (len(values) * bw * np.sqrt(2 * np.pi))
        assert abs(rows[1, g].density - want) < 1e-6 and abs(rows[1, g].x - x) < 1e-6


def test_a_broken_append_is_completed_and_a_done_one_not_repeated(spark):
    from climark.session import scratch_path
    base = scratch_path(spark, "commits")
    tb.bootstrap_tables(spark, base)
    full = series(spark, 20).withColumns({c: F.lit(0.0) for c in ["prcp", "snow", "wspd", "wpgt", "pres", "tsun"]}) \
        .withColumn("wdir", F.lit(1))
    half = full.where(F.col("time") < day(2020, 1, 11))
    assert tb.append_rows(spark, base, "clima", half, batch_id="a", mode="reject_batch") == 10
    # a run that died after it wrote half of batch b: its files are there, its done record is not
    spark.createDataFrame([("b", "begun", 20, 0)], tb.RECORD).write.mode("append").parquet(f"{base}/commits/clima")
    assert tb.append_rows(spark, base, "clima", full, batch_id="b", mode="reject_batch") == 10
    for batch_id in ("a", "b"):
        assert tb.append_rows(spark, base, "clima", series(spark, 3, start=day(2021, 1, 1)), batch_id=batch_id) == 0
    assert tb.append_rows(spark, base, "clima", full, batch_id="c", mode="reject_batch") == 0
    assert tb.read_table(spark, base, "clima").count() == 20
    done = {r.batch_id: r["rows"] for r in tb.commits(spark, base, "clima").where("state = 'done'").collect()}
    assert done == {"a": 10, "b": 10, "c": 0}


def test_catalog_bootstrap_twice_changes_nothing(spark):
    from climark.session import scratch_path
    base = scratch_path(spark, "ddl")
    for _ in range(2):
        tb.bootstrap_catalog(spark, base, "climark_ddl_test")
        spark.sql("INSERT INTO climark_ddl_test.ciudades VALUES (1, 'Piura', -5.0, -80.0)")
    assert spark.table("climark_ddl_test.ciudades").count() == 2
    columns = {(r.table_name, r.column_name): (r.data_type, r.required, r.partition)
               for r in tb.catalog_columns(spark, "climark_ddl_test").collect()}
    assert len(columns) == 21 and columns["clima", "id_ciudad"] == ("int", True, True)
    assert columns["clima", "tmax"] == ("double", False, False) and columns["predic", "time"] == ("timestamp_ntz", True, False)


def test_serving_windows_keep_T_rows_a_task(spark):
    obs = series(spark, 60, gap_every=4).unionByName(series(spark, 4, station=2))
    win = sq.serving_windows(obs, ["tmax", "tmin"], 5)
    rows = win.collect()
    assert [r.id_ciudad for r in rows] == [1] and len(rows[0].seq) == 5
    last = sorted(obs.where("id_ciudad = 1").collect(), key=lambda r: r.time)[-5:]
    assert [(s.time, s.tmax, s.tmin) for s in rows[0].seq] == [(r.time, r.tmax, r.tmin) for r in last]
    assert "WindowGroupLimit" in win._jdf.queryExecution().executedPlan().toString()


def test_percentiles_exact_and_approx_on_request(spark):
    df = spark.createDataFrame([(1, float(x)) for x in range(101)], "id_ciudad int, x double")
    exact = pf.describe_numeric(df, ["x"], approx=False).first()
    approx = pf.describe_numeric(df, ["x"], approx=True).first()
    assert (exact.q25, exact.q50, exact.q75) == (25.0, 50.0, 75.0)
    assert abs(approx.q50 - 50.0) <= 1.0


def test_duplicate_range_bounds_ignore_session_time_zone(spark):
    schema = "id_ciudad int, time timestamp_ntz, tmax double"
    old = spark.createDataFrame([(1, day(2001, 11, 4), 30.0), (1, day(2001, 11, 1), 31.0)], schema)
    new = spark.createDataFrame([(1, day(2001, 11, 1), 31.0), (1, day(2001, 11, 4), 30.0)], schema)
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert ig.find_duplicates(new, old).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_epoch_micros_ignores_dst_gaps(spark):
    from climark.functions.calendar import epoch_micros
    df = spark.createDataFrame([(day(1995, 10, 15),), (dt.datetime(1999, 1, 15, 10, 11, 12, 345678),)],
                               "t timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # 1995-10-15 00:00 is a DST gap
        got = [r.e for r in df.select(epoch_micros("t").alias("e")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == [813715200000000.0, 916395072345678.0]
