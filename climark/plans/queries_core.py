"""Queries over the bridged station tables: scans, projections, joins,
integrity checks, aggregations, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.functions.calendar import parse_time, prepare_features
from climark.functions.numeric import r6, round_half_even
from climark.operators import cleaning as cl
from climark.operators import climatology as clim
from climark.operators import integrity as ig
from climark.operators import profile as pf
from climark.plans.catalog import register
from climark.schemas import FULL_FEATURES, MEASURES, MONTH_COLUMNS, REDUCED_FEATURES, SEASON_COLUMNS, TARGETS
from climark.sources import tables as tb
from climark.sources.bridge import AS_OF, CUT_TRAIN, CUT_VAL, FORECAST_END, Tables

STATION = 3                       # station of the single-station scan
BATCH_FROM = "2000-03-31"         # a re-delivered batch overlapping the stored table by one quarter
COVERAGE = ("1998-01-01", "1998-01-02")
OUTLIER = ("tavg", 20.0)          # tmin < 10 holds for almost every bridged day; tavg < 20 is the rare case
PROFILED = ["tmax", "tmin", "tavg", "pres"]
BINS = 20


def qi(c: str) -> str:
    return f'"{c}"'


def cols_sql(cols) -> str:
    return ", ".join(qi(c) for c in cols)


def feat(t: Tables) -> DataFrame:
    return prepare_features(t.clima)


def sfeat(t: Tables) -> DataFrame:
    return cl.temporal_split(feat(t), CUT_TRAIN, CUT_VAL)


def ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def forecast_pairs(t: Tables) -> DataFrame:
    """C04: forecasts paired with observations of the same station and day,
    one row per target (id, time, target, real, pred, error)."""
    p = t.predic.alias("p")
    c = t.clima.alias("c")
    j = p.join(c, (F.col("p.id") == F.col("c.id_ciudad")) & (F.col("p.time") == F.col("c.time")))
    rows = [F.struct(F.lit(x).alias("target"), F.col(f"c.{x}").alias("real"), F.col(f"p.{x}").alias("pred"))
            for x in TARGETS]
    return j.select(F.col("p.id").alias("id"), F.col("p.time").alias("time"), F.inline(F.array(*rows))) \
        .withColumn("error", F.col("real") - F.col("pred"))


FVA_SQL = """fva AS (
  SELECT p.id, p.time, 'tmax' AS target, c.tmax AS real, p.tmax AS pred, c.tmax - p.tmax AS error
  FROM predic p JOIN clima c ON c.id_ciudad = p.id AND c.time = p.time
  UNION ALL
  SELECT p.id, p.time, 'tmin', c.tmin, p.tmin, c.tmin - p.tmin
  FROM predic p JOIN clima c ON c.id_ciudad = p.id AND c.time = p.time
  UNION ALL
  SELECT p.id, p.time, 'tavg', c.tavg, p.tavg, c.tavg - p.tavg
  FROM predic p JOIN clima c ON c.id_ciudad = p.id AND c.time = p.time)"""


# --- A. scans, sources, sinks ------------------------------------------------

@register("scan_table", "A01", "SELECT * FROM clima")
def q_scan_table(t: Tables):
    """Whole observation table."""
    return t.clima


@register("scan_station", "A02", f"SELECT * FROM clima WHERE id_ciudad = {STATION}")
def q_scan_station(t: Tables):
    """One station's rows, filtered on the table's own station key."""
    return tb.scan_station(t.clima, "clima", STATION)


ALL_EQ = " AND ".join(f"o.{c} IS NOT DISTINCT FROM b.{c}" for c in ["id_ciudad", "time", *MEASURES])
BATCH_SQL = f"""old AS (SELECT * FROM clima WHERE time <= {{CUT_VAL}}),
batch AS (SELECT * FROM clima WHERE time > TIMESTAMP '{BATCH_FROM} 00:00:00'),
dups AS (SELECT b.* FROM batch b WHERE EXISTS (SELECT 1 FROM old o WHERE {ALL_EQ}))"""


def old_and_batch(t: Tables):
    old = t.clima.where(F.col("time") <= ts(CUT_VAL))
    batch = cl.fill_missing_zero(t.landing.where(F.col("time") > ts(BATCH_FROM)))
    return old, batch


STORED_SQL = f"""stored AS (SELECT * FROM clima WHERE time <= {{FORECAST_END}}),
lastobs AS (SELECT id_ciudad AS id, max(time) AS last_time FROM stored GROUP BY id_ciudad),
ranges AS (
  SELECT c.id, l.last_time,
         coalesce(l.last_time + INTERVAL 1 DAY, TIMESTAMP '2018-01-01 00:00:00') AS fetch_start,
         {{AS_OF}} AS fetch_end, (l.last_time IS NOT NULL AND l.last_time >= {{AS_OF}}) AS skip
  FROM ciudades c LEFT JOIN lastobs l ON c.id = l.id)"""


def stored(t: Tables) -> DataFrame:
    return t.clima.where(F.col("time") <= ts(FORECAST_END))


@register("landing_fetch", "A05", f""", {STORED_SQL}
SELECT landing.* FROM landing JOIN ranges r ON landing.id_ciudad = r.id
WHERE NOT r.skip AND landing.time BETWEEN r.fetch_start AND r.fetch_end
  AND landing.id_ciudad IN (SELECT id FROM ciudades)""")
def q_landing_fetch(t: Tables):
    """Every station's due days read from the landing data in one job."""
    ranges = tb.update_range(stored(t), t.ciudades, AS_OF)
    return tb.landing_fetch(t.landing, ranges, t.ciudades)


@register("station_coverage", "A06", f"""
, cov AS (SELECT id_ciudad AS id, count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time
  FROM landing WHERE time BETWEEN TIMESTAMP '{COVERAGE[0]} 00:00:00' AND TIMESTAMP '{COVERAGE[1]} 00:00:00'
  GROUP BY id_ciudad)
SELECT c.id, c.ciudad, coalesce(v.n_rows, 0) AS n_rows, v.first_time, v.last_time,
       coalesce(v.n_rows, 0) > 0 AS covered
FROM ciudades c LEFT JOIN cov v ON c.id = v.id""")
def q_station_coverage(t: Tables):
    """Does each station have data in a probe range?"""
    return tb.station_coverage(t.landing, t.ciudades, *COVERAGE)


@register("seed_dimension", "A07", """
, seeds AS (
  SELECT 1 AS id, 'Piura' AS ciudad, CAST(-5.1833 AS DOUBLE) AS latitud, CAST(-80.6 AS DOUBLE) AS longitud
  UNION ALL SELECT CAST(max(id) + 1 AS INTEGER), 'Piura', CAST(-5.1833 AS DOUBLE), CAST(-80.6 AS DOUBLE) FROM ciudades
  UNION ALL SELECT CAST(max(id) + 2 AS INTEGER), min(ciudad), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM ciudades)
SELECT * FROM ciudades UNION ALL
SELECT * FROM seeds s
WHERE s.id NOT IN (SELECT id FROM ciudades) AND s.ciudad NOT IN (SELECT ciudad FROM ciudades)""")
def q_seed_dimension(t: Tables):
    """INSERT IGNORE of seed stations: a known id, a new station, a known name."""
    def seed(ahead: int, name, lat: float, lon: float) -> DataFrame:
        return t.ciudades.agg((F.max("id") + ahead).cast("int").alias("id"), name.alias("ciudad"),
                              F.lit(lat).alias("latitud"), F.lit(lon).alias("longitud"))
    seeds = tb.seed_rows(t.spark).unionByName(seed(1, F.lit("Piura"), -5.1833, -80.6)).unionByName(
        seed(2, F.min("ciudad"), 0.0, 0.0))
    return tb.seed_dimension(t.ciudades, seeds)


def nation_candidates(t: Tables) -> DataFrame:
    k = (F.col("n_nationkey") + 1).cast("double")
    return t.raw("nation").select(F.col("n_name").alias("ciudad"),
                                  (F.pmod(k * 11.0, 120.0) - 60.0).alias("latitud"),
                                  (F.pmod(k * 29.0, 360.0) - 180.0).alias("longitud"),
                                  "n_nationkey")


def nation_covered(t: Tables) -> DataFrame:
    """Candidates with any shipment in the probe range (the source answers)."""
    li = t.raw("lineitem").where(F.col("l_shipdate").between(ts(COVERAGE[0]), ts(COVERAGE[1])))
    sup = t.raw("supplier").select("s_suppkey", "s_nationkey")
    nk = li.join(sup, li.l_suppkey == sup.s_suppkey).select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return nation_candidates(t).join(nk, "n_nationkey", "left_semi").select("ciudad")


CAND_SQL = f"""cand AS (
  SELECT n_name AS ciudad, n_nationkey,
         (CAST(n_nationkey + 1 AS DOUBLE) * 11.0::DOUBLE) % 120.0::DOUBLE - 60.0::DOUBLE AS latitud,
         (CAST(n_nationkey + 1 AS DOUBLE) * 29.0::DOUBLE) % 360.0::DOUBLE - 180.0::DOUBLE AS longitud
  FROM nation),
covn AS (SELECT DISTINCT s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
         WHERE l_shipdate BETWEEN TIMESTAMP '{COVERAGE[0]} 00:00:00' AND TIMESTAMP '{COVERAGE[1]} 00:00:00'),
newst AS (SELECT ciudad, latitud, longitud FROM cand
          WHERE n_nationkey IN (SELECT s_nationkey FROM covn) AND ciudad NOT IN (SELECT ciudad FROM ciudades)),
after AS (
  SELECT * FROM ciudades UNION ALL
  SELECT CAST((SELECT coalesce(max(id), 0) FROM ciudades) + row_number() OVER (ORDER BY ciudad) AS INTEGER),
         ciudad, latitud, longitud FROM newst)"""


@register("register_station", "A08", f", {CAND_SQL} SELECT * FROM after")
def q_register_station(t: Tables):
    """Covered, unknown candidate stations appended with ids max+1, max+2, ..."""
    cand = nation_candidates(t).drop("n_nationkey")
    return tb.register_stations(t.ciudades, cand, nation_covered(t))


NAMES_SQL = "names AS (SELECT r_name AS name FROM region UNION SELECT n_name FROM nation)"


def names(t: Tables) -> DataFrame:
    return t.raw("region").select(F.col("r_name").alias("name")) \
        .union(t.raw("nation").select(F.col("n_name").alias("name"))).distinct()


@register("ensure_coordinates", "A09", f""", {CAND_SQL}, {NAMES_SQL}
SELECT n.name, a.id, a.latitud, a.longitud,
       (n.name NOT IN (SELECT ciudad FROM ciudades) AND a.id IS NOT NULL) AS registered
FROM names n LEFT JOIN after a ON a.ciudad = n.name""")
def q_ensure_coordinates(t: Tables):
    """Coordinates per requested name; unknown names registered first."""
    cand = nation_candidates(t).drop("n_nationkey")
    out = tb.ensure_coordinates(names(t), t.ciudades, cand, nation_covered(t))
    return out.withColumn("registered", F.col("registered") & F.col("id").isNotNull())


# --- B. projections, filters, predicates --------------------------------------

@register("parse_time", "B01", """
, s AS (SELECT id_ciudad, time, strftime(time, '%Y-%m-%d') AS time_str,
               strftime(time, '%Y-%m-') || lpad(CAST(day(time) + 1 AS VARCHAR), 2, '0') AS next_str FROM clima)
SELECT id_ciudad, time, time_str, next_str, strptime(time_str, '%Y-%m-%d') AS parsed,
       try_strptime(next_str, '%Y-%m-%d') AS next_parsed FROM s""")
def q_parse_time(t: Tables):
    """Strict parse of ISO days; coercing parse of 'day + 1' strings (invalid
    days such as the 32nd become null)."""
    s = t.clima.select(
        "id_ciudad", "time", F.date_format("time", "yyyy-MM-dd").alias("time_str"),
        F.concat(F.date_format("time", "yyyy-MM-"),
                 F.lpad((F.dayofmonth("time") + 1).cast("string"), 2, "0")).alias("next_str"))
    s = parse_time(s, "time_str", "parsed", strict=True)
    return parse_time(s, "next_str", "next_parsed", strict=False)


@register("calendar_fields", "B02", "SELECT id_ciudad, time, mes, dia FROM cal")
def q_calendar_fields(t: Tables):
    return feat(t).select("id_ciudad", "time", "mes", "dia")


@register("season_label", "B03", "SELECT id_ciudad, time, mes, dia, estacion FROM feat")
def q_season_label(t: Tables):
    return feat(t).select("id_ciudad", "time", "mes", "dia", "estacion")


@register("season_onehot", "B04", f"SELECT id_ciudad, time, estacion, {cols_sql(SEASON_COLUMNS)} FROM feat")
def q_season_onehot(t: Tables):
    return feat(t).select("id_ciudad", "time", "estacion", *SEASON_COLUMNS)


@register("month_onehot", "B05", f"SELECT id_ciudad, time, mes, {cols_sql(MONTH_COLUMNS)} FROM feat")
def q_month_onehot(t: Tables):
    return feat(t).select("id_ciudad", "time", "mes", *MONTH_COLUMNS)


@register("prepare_features", "B06", "SELECT * FROM feat")
def q_prepare_features(t: Tables):
    """All calendar features in one projection (also covers column concat, G02)."""
    return feat(t)


@register("feature_subset_full", "B07", f"SELECT id_ciudad, time, {cols_sql(FULL_FEATURES)} FROM feat")
def q_feature_subset_full(t: Tables):
    return cl.feature_subset(feat(t), "full")


@register("feature_subset_reduced", "B07", f"SELECT id_ciudad, time, {cols_sql(REDUCED_FEATURES)} FROM feat")
def q_feature_subset_reduced(t: Tables):
    return cl.feature_subset(feat(t), "reduced")


@register("drop_all_null_columns", "B08",
          "SELECT id_ciudad, time, tmax, tmin, tavg, prcp, wdir, wspd, pres FROM landing")
def q_drop_all_null_columns(t: Tables):
    """Raw landing rows without the never-delivered columns."""
    return cl.drop_all_null_columns(t.landing)


ZERO_KEPT = ["time", "tmax", "tmin", "tavg", "prcp", "wdir", "wspd", "pres", "mes", "dia",
             *SEASON_COLUMNS, *MONTH_COLUMNS]


@register("drop_all_zero_columns", "B09", f"SELECT {cols_sql(ZERO_KEPT)} FROM feat")
def q_drop_all_zero_columns(t: Tables):
    """Features without all-zero columns, key and season label."""
    return cl.drop_all_zero_columns(feat(t))


NUMERIC_LANDING = ["id_ciudad", "tmax", "tmin", "tavg", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun"]


@register("fill_missing_zero", "B10", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS filled FROM landing"
    for c in NUMERIC_LANDING))
def q_fill_missing_zero(t: Tables):
    """Cells the store fills with 0 on insert, per column."""
    return cl.missing_cell_counts(t.landing)


@register("replace_low_outlier", "B11", f"""
, m AS (SELECT id_ciudad, avg({OUTLIER[0]}) AS mu FROM clima GROUP BY id_ciudad)
SELECT c.id_ciudad, c.time, round(c.{OUTLIER[0]}, 6) AS {OUTLIER[0]}_raw,
       round(CASE WHEN c.{OUTLIER[0]} < {OUTLIER[1]} THEN m.mu ELSE c.{OUTLIER[0]} END, 6) AS {OUTLIER[0]}
FROM clima c JOIN m ON c.id_ciudad = m.id_ciudad""", materialize=True)
def q_replace_low_outlier(t: Tables):
    """Values below the bound replaced by the station mean of the raw column."""
    col, lower = OUTLIER
    base = t.clima.select("id_ciudad", "time", F.col(col).alias(f"{col}_raw"), col)
    out = cl.replace_low_outlier(base, col, lower)
    return out.select("id_ciudad", "time", r6(f"{col}_raw").alias(f"{col}_raw"), r6(col).alias(col))


@register("temporal_split", "B12", "SELECT id_ciudad, time, split FROM sfeat")
def q_temporal_split(t: Tables):
    return sfeat(t).select("id_ciudad", "time", "split")


@register("station_id_by_name", "B13", f""", {NAMES_SQL}
SELECT n.name, i.id FROM names n LEFT JOIN (SELECT ciudad, min(id) AS id FROM ciudades GROUP BY ciudad) i
ON n.name = i.ciudad""")
def q_station_id_by_name(t: Tables):
    return ig.station_id_by_name(names(t), t.ciudades)


@register("station_name_by_id", "B14", """
, ids AS (SELECT DISTINCT CAST(n_nationkey + 1 AS INTEGER) AS id FROM nation)
SELECT ids.id, s.ciudad FROM ids LEFT JOIN (SELECT id, min(ciudad) AS ciudad FROM ciudades GROUP BY id) s
ON ids.id = s.id""")
def q_station_name_by_id(t: Tables):
    ids = t.raw("nation").select((F.col("n_nationkey") + 1).cast("int").alias("id")).distinct()
    return ig.station_name_by_id(ids, t.ciudades)


@register("round_values", "B15", """
SELECT id_ciudad, time, round_even(tavg, 1) AS tavg_1dp, round_even(pres, 3) AS pres_3dp, round_even(wspd, 2) AS wspd_2dp
FROM clima""")
def q_round_values(t: Tables):
    """Forecast (1 dp), metric (3 dp) and correlation (2 dp) rounding, halves to even."""
    return t.clima.select("id_ciudad", "time", round_half_even("tavg", 1).alias("tavg_1dp"),
                          round_half_even("pres", 3).alias("pres_3dp"), round_half_even("wspd", 2).alias("wspd_2dp"))


@register("unsigned_guard", "B16", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"count(*) FILTER (WHERE {c} < 0) AS n_negative FROM predic" for c in TARGETS))
def q_unsigned_guard(t: Tables):
    """NOT NULL / >= 0 violations of the forecast table."""
    return cl.unsigned_violations(t.predic)


@register("unsigned_guard_accepted", "B16", """
SELECT id, time, tmax, tmin - 5.0 AS tmin, tavg FROM predic WHERE tmin - 5.0 >= 0 AND tmax >= 0 AND tavg >= 0""")
def q_unsigned_guard_accepted(t: Tables):
    """Rows that a store of unsigned values takes, of forecasts moved down by 5 degrees."""
    return cl.unsigned_guard(t.predic.withColumn("tmin", F.col("tmin") - 5.0))


# --- C. joins and integrity ----------------------------------------------------

@register("find_duplicates", "C01", f", {BATCH_SQL} SELECT * FROM dups")
def q_find_duplicates(t: Tables):
    """Batch rows already stored (all-column, null-safe equality)."""
    old, batch = old_and_batch(t)
    return ig.find_duplicates(batch, old)


@register("insert_guard", "C02", f""", {BATCH_SQL}
SELECT * FROM old UNION ALL SELECT * FROM batch WHERE NOT EXISTS (SELECT 1 FROM dups)""")
def q_insert_guard(t: Tables):
    """reject_batch: an overlapping batch is refused as a whole."""
    old, batch = old_and_batch(t)
    return old.unionByName(ig.insert_guard(batch, old, "reject_batch"))


@register("attach_station", "C03", """
SELECT c.id_ciudad, c.time, c.tmax, c.tmin, c.tavg, s.ciudad, s.latitud, s.longitud
FROM clima c JOIN ciudades s ON c.id_ciudad = s.id""")
def q_attach_station(t: Tables):
    return ig.attach_station(t.clima.select("id_ciudad", "time", "tmax", "tmin", "tavg"), t.ciudades)


@register("forecast_vs_actual", "C04", f", {FVA_SQL} SELECT * FROM fva")
def q_forecast_vs_actual(t: Tables):
    return forecast_pairs(t)


def _viol(table, check, body):
    return f"SELECT '{table}' AS table_name, '{check}' AS check_name, CAST(({body}) AS BIGINT) AS violations"


CONSTRAINT_SQL = " UNION ALL ".join([
    _viol("ciudades", "pk_id", "SELECT count(*) FROM (SELECT id FROM ciudades GROUP BY id HAVING count(*) > 1)"),
    _viol("ciudades", "unique_ciudad",
          "SELECT count(*) FROM (SELECT ciudad FROM ciudades GROUP BY ciudad HAVING count(*) > 1)"),
    _viol("ciudades", "not_null", "SELECT count(*) FROM ciudades WHERE id IS NULL OR ciudad IS NULL "
          "OR latitud IS NULL OR longitud IS NULL"),
    _viol("ciudades", "varchar_40", "SELECT count(*) FROM ciudades WHERE length(ciudad) > 40"),
    _viol("clima", "fk_id_ciudad", "SELECT count(*) FROM clima WHERE id_ciudad NOT IN (SELECT id FROM ciudades) "
          "OR id_ciudad IS NULL"),
    _viol("clima", "not_null", "SELECT count(*) FROM clima WHERE id_ciudad IS NULL OR time IS NULL"),
    _viol("clima", "key_id_ciudad_time",
          "SELECT count(*) FROM (SELECT 1 FROM clima GROUP BY id_ciudad, time HAVING count(*) > 1)"),
    _viol("predic", "fk_id", "SELECT count(*) FROM predic WHERE id NOT IN (SELECT id FROM ciudades) OR id IS NULL"),
    _viol("predic", "pk_id_time", "SELECT count(*) FROM (SELECT 1 FROM predic GROUP BY id, time HAVING count(*) > 1)"),
    _viol("predic", "not_null", "SELECT count(*) FROM predic WHERE id IS NULL OR time IS NULL OR tmax IS NULL "
          "OR tmin IS NULL OR tavg IS NULL"),
    _viol("predic", "unsigned", "SELECT count(*) FROM predic WHERE tmax < 0 OR tmin < 0 OR tavg < 0"),
])


# the stored tables hold no violation: copies with some of each kind are checked beside them
DAMAGED_SQL = """, xc AS (SELECT * FROM ciudades UNION ALL SELECT id, repeat(ciudad, 9), latitud, NULL FROM ciudades WHERE id <= 2
                 UNION ALL SELECT id + 500, ciudad, latitud, longitud FROM ciudades WHERE id = 3),
xm AS (SELECT id_ciudad, time FROM clima UNION ALL SELECT id_ciudad, time FROM clima WHERE day(time) = 1
       UNION ALL SELECT id_ciudad + 1000, time FROM clima WHERE day(time) = 2
       UNION ALL SELECT NULL, time FROM clima WHERE day(time) = 3),
xp AS (SELECT id, time, tmax, tmin - 5.0 AS tmin, tavg FROM predic
       UNION ALL SELECT id, time, tmax, tmin, tavg FROM predic WHERE day(time) = 1
       UNION ALL SELECT id + 1000, time, tmax, tmin, tavg FROM predic WHERE day(time) = 2
       UNION ALL SELECT id, time + INTERVAL 9999 DAY, tmax, tmin, NULL FROM predic WHERE day(time) = 3) """


def _damaged_sql(sql: str) -> str:
    for stored_name, copy in (("ciudades", "xc"), ("clima", "xm"), ("predic", "xp")):
        sql = sql.replace(f"FROM {stored_name} ", f"FROM {copy} ").replace(f"FROM {stored_name})", f"FROM {copy})")
    return sql.replace("FROM ciudades", "FROM xc").replace("FROM clima", "FROM xm").replace("FROM predic", "FROM xp")


def damaged(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Copies of the stored tables with violations of every constraint."""
    c, m, p = t.ciudades, t.clima.select("id_ciudad", "time"), t.predic.select("id", "time", "tmax", "tmin", "tavg")

    def on(df, d):
        return df.where(F.dayofmonth("time") == d)
    c = c.unionByName(c.where("id <= 2").withColumns({"ciudad": F.repeat("ciudad", 9), "longitud": F.lit(None).cast("double")})
                      ).unionByName(c.where("id = 3").withColumn("id", F.col("id") + 500))
    m = m.unionByName(on(m, 1)).unionByName(on(m, 2).withColumn("id_ciudad", F.col("id_ciudad") + 1000)).unionByName(
        on(m, 3).withColumn("id_ciudad", F.lit(None).cast("int")))
    p = p.withColumn("tmin", F.col("tmin") - 5.0).unionByName(on(p, 1)).unionByName(
        on(p, 2).withColumn("id", F.col("id") + 1000)).unionByName(
        on(p, 3).withColumns({"time": F.col("time") + F.expr("INTERVAL 9999 DAY"), "tavg": F.lit(None).cast("double")}))
    return c, m, p


@register("constraint_violations", "C05", CONSTRAINT_SQL)
def q_constraint_violations(t: Tables):
    return ig.constraint_violations(t.ciudades, t.clima, t.predic)


@register("constraint_violations_found", "C05", DAMAGED_SQL + _damaged_sql(CONSTRAINT_SQL), materialize=True)
def q_constraint_violations_found(t: Tables):
    """The same report over copies of the tables with violations of each kind."""
    return ig.constraint_violations(*damaged(t))


SEASON_GRID_SQL = """seasons AS (SELECT * FROM (VALUES ('Verano', 0), ('Otoño', 1), ('Invierno', 2), ('Primavera', 3))
                   s(estacion, season_ord)),
sd AS (SELECT id_ciudad, dia, estacion, round(avg(tmax), 6) AS tmax, round(avg(tmin), 6) AS tmin,
              round(avg(tavg), 6) AS tavg FROM feat GROUP BY id_ciudad, dia, estacion),
grid AS (SELECT g.id_ciudad, CAST(d.dia AS INTEGER) AS dia, s.estacion, CAST(s.season_ord AS INTEGER) AS season_ord
         FROM (SELECT DISTINCT id_ciudad FROM sd) g, (SELECT range AS dia FROM range(1, 32)) d, seasons s),
dense AS (SELECT grid.*, sd.tmax, sd.tmin, sd.tavg FROM grid LEFT JOIN sd
          ON grid.id_ciudad = sd.id_ciudad AND grid.dia = sd.dia AND grid.estacion = sd.estacion)"""


@register("dense_grid_fill", "C06", f", {SEASON_GRID_SQL} SELECT * FROM dense")
def q_dense_grid_fill(t: Tables):
    """(day, season) means reindexed on the full 31 x 4 grid (covers G03)."""
    out = clim.dense_grid_fill(clim.season_day_climatology(feat(t)))
    return out.select("id_ciudad", "dia", "estacion", "season_ord", "tmax", "tmin", "tavg")


# --- D. aggregations ------------------------------------------------------------

@register("latest_observation", "D01", """
SELECT c.id, c.ciudad, l.last_time FROM ciudades c
LEFT JOIN (SELECT id_ciudad, max(time) AS last_time FROM clima GROUP BY id_ciudad) l ON c.id = l.id_ciudad""")
def q_latest_observation(t: Tables):
    last = tb.latest_by_station(t.clima, "id_ciudad").withColumnRenamed("id_ciudad", "id")
    return t.ciudades.select("id", "ciudad").join(last, "id", "left")


@register("latest_forecast", "D02", """
SELECT c.id, coalesce(l.last_time, {AS_OF}) AS last_forecast, l.last_time IS NOT NULL AS has_forecast
FROM ciudades c LEFT JOIN (SELECT id, max(time) AS last_time FROM predic GROUP BY id) l ON c.id = l.id""")
def q_latest_forecast(t: Tables):
    """Last forecast day per station; stations without any get ``as_of``."""
    last = tb.latest_by_station(t.predic, "id")
    return t.ciudades.select("id").join(last, "id", "left").select(
        "id", F.coalesce("last_time", ts(AS_OF)).alias("last_forecast"),
        F.col("last_time").isNotNull().alias("has_forecast"))


@register("monthly_climatology", "D03", """
SELECT id_ciudad, mes, round(avg(tmax), 6) AS tmax, round(avg(tmin), 6) AS tmin, round(avg(tavg), 6) AS tavg
FROM feat GROUP BY id_ciudad, mes""")
def q_monthly_climatology(t: Tables):
    """Mean tmax/tmin/tavg by station and month (flagship)."""
    return clim.monthly_climatology(t.clima)


@register("season_day_climatology", "D04", f", {SEASON_GRID_SQL} SELECT * FROM sd")
def q_season_day_climatology(t: Tables):
    return clim.season_day_climatology(feat(t))


FFILL = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in TARGETS)


@register("season_day_profile", "D05", f""", {SEASON_GRID_SQL}
SELECT id_ciudad, dia, estacion, season_ord, {FFILL} FROM dense
WINDOW w AS (PARTITION BY id_ciudad ORDER BY dia, season_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_season_day_profile(t: Tables):
    """Dense (day, season) profile, holes forward-filled in (day, season) order."""
    return clim.season_day_profile(feat(t))


def _describe_sql(cols):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT id_ciudad, '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS vmin, "
            f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
            f"round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS vmax "
            f"FROM clima GROUP BY id_ciudad")
    return " UNION ALL ".join(parts)


@register("describe_numeric", "D06", _describe_sql(MEASURES), materialize=True)
def q_describe_numeric(t: Tables):
    return pf.describe_numeric(t.clima, MEASURES)


@register("describe_time", "D06", """
, d AS (SELECT id_ciudad, time, CAST(epoch_us(time) AS DOUBLE) / 86400000000.0 AS dd FROM clima),
s AS (SELECT id_ciudad, count(time) AS n, avg(dd) AS m, min(time) AS vmin, max(time) AS vmax,
             quantile_cont(dd, 0.25) AS a, quantile_cont(dd, 0.5) AS b, quantile_cont(dd, 0.75) AS c
      FROM d GROUP BY id_ciudad)
SELECT id_ciudad, n, make_timestamp(CAST(floor(m * 86400000000.0) AS BIGINT)) AS mean, vmin,
       make_timestamp(CAST(floor(a * 86400000000.0) AS BIGINT)) AS q25,
       make_timestamp(CAST(floor(b * 86400000000.0) AS BIGINT)) AS q50,
       make_timestamp(CAST(floor(c * 86400000000.0) AS BIGINT)) AS q75, vmax FROM s""", materialize=True)
def q_describe_time(t: Tables):
    """The datetime part of describe(): count, mean, min, quartiles, max of ``time``."""
    return pf.describe_time(t.clima)


LANDING_TYPES = [("id_ciudad", "int32"), ("time", "datetime64[ns]")] + \
    [(c, "int32" if c == "wdir" else "float64") for c in MEASURES]


@register("profile_columns", "D07", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{d}' AS dtype, count(*) AS n_rows, count({c}) AS non_null FROM landing"
    for c, d in LANDING_TYPES))
def q_profile_columns(t: Tables):
    return pf.profile_columns(t.landing)


def corrected(t: Tables):
    """Stored observations after the low-outlier fix (6 dp, as engines sum means
    in different orders)."""
    return cl.replace_low_outlier(t.clima, *OUTLIER).withColumn(OUTLIER[0], r6(OUTLIER[0]))


FIXED_SQL = f"""mu0 AS (SELECT id_ciudad AS mid, avg({OUTLIER[0]}) AS mu FROM clima GROUP BY id_ciudad),
fixed AS (SELECT * EXCLUDE (mid, mu) REPLACE (round(CASE WHEN {OUTLIER[0]} < {OUTLIER[1]} THEN mu ELSE {OUTLIER[0]} END, 6)
                                              AS {OUTLIER[0]}) FROM clima JOIN mu0 ON id_ciudad = mid)"""


def _mad_sql(cols):
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in cols)
    parts = [f"SELECT c.id_ciudad, '{c}' AS column_name, round(avg(abs(c.{c} - m.m_{c})), 6) AS mad "
             f"FROM fixed c JOIN med m ON c.id_ciudad = m.id_ciudad GROUP BY c.id_ciudad" for c in cols]
    return f", {FIXED_SQL}, med AS (SELECT id_ciudad, {meds} FROM fixed GROUP BY id_ciudad) " + " UNION ALL ".join(parts)


@register("mean_abs_dev_median", "D08", _mad_sql(MEASURES), materialize=True)
def q_mean_abs_dev_median(t: Tables):
    return pf.mean_abs_dev_median(corrected(t), MEASURES)


FIXED_FEAT_SQL = FIXED_SQL.replace("FROM clima JOIN mu0", "FROM feat JOIN mu0")


def _corr_sql(cols):
    def v(c):
        return "CAST(epoch_us(time) AS DOUBLE)" if c == "time" else f"CAST({qi(c)} AS DOUBLE)"
    sel, names = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            x, y = v(a), v(b)
            sel.append(f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) > 0 THEN covar_pop({x}, {y}) / "
                       f"(stddev_pop({x}) * stddev_pop({y})) END AS \"{a}__{b}\"")
            names.append((a, b))
    unions = []
    for a, b in names:
        unions.append(f"SELECT id_ciudad, '{a}' AS col_a, '{b}' AS col_b, round(\"{a}__{b}\", 2) + 0.0::DOUBLE AS corr FROM w")
        if a != b:
            unions.append(f"SELECT id_ciudad, '{b}' AS col_a, '{a}' AS col_b, "
                          f"round(\"{a}__{b}\", 2) + 0.0::DOUBLE AS corr FROM w")
    return f", {FIXED_FEAT_SQL}, w AS (SELECT id_ciudad, {', '.join(sel)} FROM fixed GROUP BY id_ciudad) " + " UNION ALL ".join(unions)


@register("correlation_matrix", "D09", _corr_sql(ZERO_KEPT), materialize=True)
def q_correlation_matrix(t: Tables):
    """Pearson matrix (2 dp) of the columns left after dropping all-zero ones,
    time included as epoch; per station."""
    f = cl.replace_low_outlier(feat(t), *OUTLIER).withColumn(OUTLIER[0], r6(OUTLIER[0]))
    kept = cl.drop_all_zero_columns(f).columns
    return pf.correlation_matrix(f, kept)


def _box_sql(cols):
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.5) AS q2_{c}, "
                   f"quantile_cont({c}, 0.75) AS q3_{c}" for c in cols)
    parts = []
    for c in cols:
        lo = f"(q.q1_{c} - 1.5 * (q.q3_{c} - q.q1_{c}))"
        hi = f"(q.q3_{c} + 1.5 * (q.q3_{c} - q.q1_{c}))"
        parts.append(
            f"SELECT c.id_ciudad, '{c}' AS column_name, round(any_value(q.q1_{c}), 6) AS q1, "
            f"round(any_value(q.q2_{c}), 6) AS median, round(any_value(q.q3_{c}), 6) AS q3, "
            f"min(CASE WHEN c.{c} >= {lo} THEN c.{c} END) AS whisker_low, "
            f"max(CASE WHEN c.{c} <= {hi} THEN c.{c} END) AS whisker_high, "
            f"count(*) FILTER (WHERE c.{c} < {lo} OR c.{c} > {hi}) AS n_outliers "
            f"FROM clima c JOIN q ON c.id_ciudad = q.id_ciudad GROUP BY c.id_ciudad")
    return f", q AS (SELECT id_ciudad, {qs} FROM clima GROUP BY id_ciudad) " + " UNION ALL ".join(parts)


@register("boxplot_stats", "D10", _box_sql(PROFILED), materialize=True)
def q_boxplot_stats(t: Tables):
    return pf.boxplot_stats(t.clima, PROFILED)


@register("histogram_fixed_bins", "D11", f""", {FVA_SQL},
rng AS (SELECT target, CASE WHEN max(error) > min(error) THEN min(error) ELSE min(error) - 0.5 END AS lo,
               CASE WHEN max(error) > min(error) THEN max(error) ELSE max(error) + 0.5 END AS hi
        FROM fva GROUP BY target),
cnt AS (SELECT f.target, CAST(least(floor((f.error - r.lo) / (r.hi - r.lo) * {float(BINS)}), {BINS - 1}) AS INTEGER) AS bin,
               count(*) AS n FROM fva f JOIN rng r ON f.target = r.target GROUP BY 1, 2)
SELECT r.target, CAST(b.bin AS INTEGER) AS bin, round(r.lo + b.bin * ((r.hi - r.lo) / {float(BINS)}), 6) AS bin_lo,
       round(r.lo + (b.bin + 1) * ((r.hi - r.lo) / {float(BINS)}), 6) AS bin_hi, coalesce(c.n, 0) AS n
FROM rng r CROSS JOIN (SELECT range AS bin FROM range(0, {BINS})) b
LEFT JOIN cnt c ON c.target = r.target AND c.bin = b.bin""", materialize=True)
def q_histogram_fixed_bins(t: Tables):
    """20-bin histogram of forecast errors per target."""
    return pf.histogram_fixed_bins(forecast_pairs(t), "error", ("target",), BINS)


def _auto_hist_sql(cols):
    long = " UNION ALL ".join(f"SELECT id_ciudad, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM fixed"
                              for c in cols)
    return f""", {FIXED_SQL}, long AS ({long}),
st0 AS (SELECT id_ciudad, column_name, count(value) AS n, min(value) AS mn, max(value) AS mx,
               quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM long GROUP BY 1, 2),
st1 AS (SELECT id_ciudad, column_name, n, iqr, CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS lo,
               CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END AS hi FROM st0),
st AS (SELECT *, CAST(greatest(ceil(log2(CAST(n AS DOUBLE)) + 1),
                      coalesce(CASE WHEN 2.0 * iqr * pow(CAST(n AS DOUBLE), -1.0 / 3.0) > 0
                                    THEN ceil((hi - lo) / (2.0 * iqr * pow(CAST(n AS DOUBLE), -1.0 / 3.0))) END,
                               ceil(log2(CAST(n AS DOUBLE)) + 1))) AS INTEGER) AS nb FROM st1),
cnt AS (SELECT l.id_ciudad, l.column_name,
               CAST(least(floor((l.value - s.lo) / (s.hi - s.lo) * s.nb), s.nb - 1) AS INTEGER) AS bin,
               count(*) AS n FROM long l JOIN st s ON l.id_ciudad = s.id_ciudad AND l.column_name = s.column_name
        GROUP BY 1, 2, 3)
SELECT s.id_ciudad, s.column_name, s.nb AS n_bins, CAST(b.bin AS INTEGER) AS bin,
       round(s.lo + b.bin * ((s.hi - s.lo) / s.nb), 6) AS bin_lo,
       round(s.lo + (b.bin + 1) * ((s.hi - s.lo) / s.nb), 6) AS bin_hi, coalesce(c.n, 0) AS n
FROM st s, LATERAL (SELECT unnest(range(0, s.nb)) AS bin) b
LEFT JOIN cnt c ON c.id_ciudad = s.id_ciudad AND c.column_name = s.column_name AND c.bin = b.bin"""


@register("histogram_auto_bins", "D11", _auto_hist_sql(PROFILED), materialize=True)
def q_histogram_auto_bins(t: Tables):
    """Per-station histograms of tmax/tmin/tavg/pres with numpy 'auto' bins."""
    return pf.histogram_auto_bins(corrected(t), PROFILED)


@register("kde_curve", "D12", f""", {FVA_SQL},
st AS (SELECT target, count(error) AS n, stddev_samp(error) * pow(CAST(count(error) AS DOUBLE), -0.2) AS bw,
              min(error) AS mn, max(error) AS mx FROM fva GROUP BY target),
st2 AS (SELECT *, mn - 3.0 * bw AS lo, (mx + 3.0 * bw - (mn - 3.0 * bw)) / 199.0 AS step FROM st),
vc AS (SELECT target, error AS v, count(*) AS c FROM fva GROUP BY target, error),
g AS (SELECT range AS g FROM range(0, 200))
SELECT s.target, CAST(g.g AS INTEGER) AS g, round(any_value(s.lo + g.g * s.step), 6) AS x,
       round(sum(vc.c * exp(-0.5 * ((s.lo + g.g * s.step - vc.v) / s.bw) * ((s.lo + g.g * s.step - vc.v) / s.bw)))
             / (any_value(s.n) * any_value(s.bw) * sqrt(2 * pi())), 6) AS density
FROM st2 s JOIN vc ON vc.target = s.target CROSS JOIN g GROUP BY s.target, g.g""", materialize=True)
def q_kde_curve(t: Tables):
    """Gaussian KDE of forecast errors per target (Scott bandwidth, 200 points)."""
    return pf.kde_curve(forecast_pairs(t), "error", ("target",))


@register("kde_curves", "D12", f"""
, v AS (SELECT id_ciudad, unnest(['{"', '".join(PROFILED)}']) AS column_name, unnest([{", ".join(PROFILED)}]) AS value FROM clima),
st AS (SELECT id_ciudad, column_name, count(value) AS n, stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), -0.2) AS bw,
              min(value) AS mn, max(value) AS mx FROM v GROUP BY 1, 2),
st2 AS (SELECT *, mn - 3.0 * bw AS lo, (mx + 3.0 * bw - (mn - 3.0 * bw)) / 199.0 AS step FROM st),
vc AS (SELECT id_ciudad, column_name, value, count(*) AS c FROM v GROUP BY 1, 2, 3),
g AS (SELECT range AS g FROM range(0, 200))
SELECT s.id_ciudad, s.column_name, CAST(g.g AS INTEGER) AS g, round(any_value(s.lo + g.g * s.step), 6) AS x,
       round(sum(vc.c * exp(-0.5 * ((s.lo + g.g * s.step - vc.value) / s.bw) * ((s.lo + g.g * s.step - vc.value) / s.bw)))
             / (any_value(s.n) * any_value(s.bw) * sqrt(2 * pi())), 6) AS density
FROM st2 s JOIN vc ON vc.id_ciudad = s.id_ciudad AND vc.column_name = s.column_name CROSS JOIN g
GROUP BY s.id_ciudad, s.column_name, g.g""", materialize=True)
def q_kde_curves(t: Tables):
    """Densities of the four profiled measures per station (Scott bandwidth, 200 points)."""
    return pf.kde_curves(t.clima, PROFILED)


@register("max_id_next", "D13", "SELECT CAST(coalesce(max(id), 0) + 1 AS INTEGER) AS next_id FROM ciudades")
def q_max_id_next(t: Tables):
    return t.ciudades.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).cast("int").alias("next_id"))


@register("split_counts", "D14", """
SELECT id_ciudad, split, count(*) AS n_rows, greatest(count(*) - 25, 0) AS n_windows FROM sfeat
GROUP BY id_ciudad, split""")
def q_split_counts(t: Tables):
    """Rows per station and split, and the N = len - T windows they yield."""
    from climark.schemas import WINDOW_T
    return sfeat(t).groupBy("id_ciudad", "split").agg(F.count(F.lit(1)).alias("n_rows")) \
        .withColumn("n_windows", F.greatest(F.col("n_rows") - WINDOW_T, F.lit(0)))


@register("temperature_band", "D15", f""", {SEASON_GRID_SQL},
prof AS (SELECT id_ciudad, dia, estacion, season_ord, {FFILL} FROM dense
         WINDOW w AS (PARTITION BY id_ciudad ORDER BY dia, season_ord
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
mon AS (SELECT id_ciudad, mes, round(avg(tmax), 6) AS tmax, round(avg(tmin), 6) AS tmin FROM feat
        GROUP BY id_ciudad, mes)
SELECT id_ciudad, 'all' AS scope, max(tmax) AS band_high, min(tmin) AS band_low FROM mon GROUP BY id_ciudad
UNION ALL
SELECT id_ciudad, estacion, max(tmax), min(tmin) FROM prof GROUP BY id_ciudad, estacion""")
def q_temperature_band(t: Tables):
    return clim.temperature_band(feat(t))


@register("regression_line", "D16", f""", {FVA_SQL}
SELECT target, round(regr_slope(pred, real), 6) AS slope, round(regr_intercept(pred, real), 6) AS intercept,
       min(real) AS real_min, max(real) AS real_max FROM fva GROUP BY target""", materialize=True)
def q_regression_line(t: Tables):
    """OLS line of forecast on observation per target, plus the identity range."""
    return forecast_pairs(t).groupBy("target").agg(
        r6(F.regr_slope("pred", "real")).alias("slope"), r6(F.regr_intercept("pred", "real")).alias("intercept"),
        F.min("real").alias("real_min"), F.max("real").alias("real_max"))


@register("scatter_series", "D17", " UNION ALL ".join(
    f"SELECT id_ciudad, time, '{c}' AS measure, CAST({c} AS DOUBLE) AS value FROM clima" for c in PROFILED))
def q_scatter_series(t: Tables):
    return pf.scatter_series(t.clima, PROFILED)


# --- E. windows over (day, season) ----------------------------------------------

@register("forward_fill", "E05", f""", {SEASON_GRID_SQL}
SELECT id_ciudad, dia, estacion, season_ord, {FFILL} FROM dense
WINDOW w AS (PARTITION BY id_ciudad, estacion ORDER BY dia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_forward_fill(t: Tables):
    """Dense (day, season) profile filled from the previous day of the same season."""
    return clim.season_day_profile(feat(t), within_season=True)


# --- F. sort, limit, top-k -------------------------------------------------------

@register("head_n", "F01", "SELECT * FROM clima ORDER BY time, id_ciudad LIMIT 5")
def q_head_n(t: Tables):
    """First 5 rows in (time, station) order: a distributed top-k."""
    return t.clima.orderBy("time", "id_ciudad").limit(5)


@register("latest_row", "F02", """
SELECT id, time, tmax, tmin, tavg FROM predic
QUALIFY row_number() OVER (PARTITION BY id ORDER BY time DESC) = 1""")
def q_latest_row(t: Tables):
    """Full latest forecast row per station (max_by, no sort)."""
    return latest_rows(t.predic)


def latest_rows(df: DataFrame, key: str = "id") -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), "time").alias("_r")).select(key, "_r.*")


# --- G. set operations ----------------------------------------------------------------

CATCHUP_FC_SQL = """newfc AS (
  SELECT id_ciudad AS id, time + INTERVAL 1 DAY AS time, round(tmax, 1) AS tmax, round(tmin, 1) AS tmin,
         round(tavg, 1) AS tavg FROM clima WHERE time > {FORECAST_END}),
allfc AS (SELECT * FROM predic UNION ALL SELECT * FROM newfc)"""


def caught_up_forecasts(t: Tables) -> DataFrame:
    new = t.clima.where(F.col("time") > ts(FORECAST_END)).select(
        F.col("id_ciudad").alias("id"), (F.col("time") + F.expr("INTERVAL 1 DAY")).alias("time"),
        *[F.round(x, 1).alias(x) for x in TARGETS])
    return t.predic.unionByName(new)


@register("concat_rows", "G01", f", {CATCHUP_FC_SQL} SELECT * FROM allfc")
def q_concat_rows(t: Tables):
    """Stored forecasts stacked with the newly appended catch-up batch."""
    return caught_up_forecasts(t)


@register("show_next_forecast", "K04", f""", {CATCHUP_FC_SQL}
SELECT id, time, tmax, tmin, tavg FROM allfc QUALIFY row_number() OVER (PARTITION BY id ORDER BY time DESC) = 1""")
def q_show_next_forecast(t: Tables):
    """Latest forecast row per station after the catch-up batch."""
    return latest_rows(caught_up_forecasts(t))


__all__ = ["forecast_pairs", "feat", "sfeat", "stored"]
