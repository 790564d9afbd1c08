"""DuckDB SQL that mirrors the bridge views, used as the correctness oracle.

Each registered query's SQL is ``PREFIX`` + its body; the body may use the
views ``landing``, ``clima``, ``ciudades``, ``predic``, ``feat`` (clima plus
calendar features) and ``sfeat`` (feat plus the train/val/test split).
"""

from __future__ import annotations

from climark.sources.bridge import AS_OF, CUT_TRAIN, CUT_VAL, FORECAST_END

SEASON_CASE = ("CASE WHEN m IN (12, 1, 2) THEN 'Verano' WHEN m IN (3, 4, 5) THEN 'Otoño' "
               "WHEN m IN (6, 7, 8) THEN 'Invierno' WHEN m IN (9, 10, 11) THEN 'Primavera' END")


def season_case(month_sql: str) -> str:
    return SEASON_CASE.replace("m IN", f"{month_sql} IN")


def ts(s: str) -> str:
    return f"TIMESTAMP '{s} 00:00:00'"


_MONTHS = ",\n       ".join(f"CAST(mes = {m} AS INTEGER) AS mes_{m}" for m in range(1, 13))

PREFIX = f"""
WITH geo AS (
  SELECT n_nationkey, CAST(r_regionkey + 1 AS INTEGER) AS id_ciudad
  FROM nation JOIN region ON n_regionkey = r_regionkey),
sup AS (SELECT s_suppkey, id_ciudad FROM supplier JOIN geo ON s_nationkey = n_nationkey),
agg AS (
  SELECT id_ciudad, l_shipdate AS time, max(l_quantity) AS tmax, min(l_quantity) AS tmin,
         avg(l_quantity) AS tavg, CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS prcp,
         count(*) AS n, CAST(sum(CAST(l_tax AS DECIMAL(12,2))) AS DOUBLE) AS tax,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price
  FROM lineitem JOIN sup ON l_suppkey = s_suppkey GROUP BY id_ciudad, l_shipdate),
landing AS (
  SELECT id_ciudad, time, tmax, tmin, tavg, prcp, CAST(NULL AS DOUBLE) AS snow,
         CAST(n AS INTEGER) AS wdir, tax / n AS wspd, CAST(NULL AS DOUBLE) AS wpgt,
         price / n AS pres, CAST(NULL AS DOUBLE) AS tsun FROM agg),
clima AS (
  SELECT id_ciudad, time, coalesce(tmax, 0.0) AS tmax, coalesce(tmin, 0.0) AS tmin,
         coalesce(tavg, 0.0) AS tavg, coalesce(prcp, 0.0) AS prcp, coalesce(snow, 0.0) AS snow,
         coalesce(wdir, 0) AS wdir, coalesce(wspd, 0.0) AS wspd, coalesce(wpgt, 0.0) AS wpgt,
         coalesce(pres, 0.0) AS pres, coalesce(tsun, 0.0) AS tsun FROM landing),
ciudades AS (
  SELECT CAST(r_regionkey + 1 AS INTEGER) AS id, r_name AS ciudad,
         (CAST(r_regionkey + 1 AS DOUBLE) * 37.0::DOUBLE) % 120.0::DOUBLE - 60.0::DOUBLE AS latitud,
         (CAST(r_regionkey + 1 AS DOUBLE) * 73.0::DOUBLE) % 360.0::DOUBLE - 180.0::DOUBLE AS longitud
  FROM region),
predic AS (
  SELECT id_ciudad AS id, time + INTERVAL 1 DAY AS time, round(tmax, 1) AS tmax,
         round(tmin, 1) AS tmin, round(tavg, 1) AS tavg
  FROM clima WHERE time > {ts(CUT_VAL)} AND time <= {ts(FORECAST_END)}),
cal AS (
  SELECT *, CAST(month(time) AS INTEGER) AS mes, CAST(day(time) AS INTEGER) AS dia FROM clima),
feat AS (
  SELECT *, {season_case('mes')} AS estacion,
       CAST(mes IN (6, 7, 8) AS INTEGER) AS "Invierno",
       CAST(mes IN (3, 4, 5) AS INTEGER) AS "Otoño",
       CAST(mes IN (9, 10, 11) AS INTEGER) AS "Primavera",
       CAST(mes IN (12, 1, 2) AS INTEGER) AS "Verano",
       {_MONTHS}
  FROM cal),
sfeat AS (
  SELECT *, CASE WHEN time <= {ts(CUT_TRAIN)} THEN 'train' WHEN time <= {ts(CUT_VAL)} THEN 'val'
                 ELSE 'test' END AS split FROM feat)
"""

CONSTANTS = {"CUT_TRAIN": ts(CUT_TRAIN), "CUT_VAL": ts(CUT_VAL), "FORECAST_END": ts(FORECAST_END),
             "AS_OF": ts(AS_OF)}


def q(body: str) -> str:
    """Full oracle query text for a body using the prefix views."""
    for k, v in CONSTANTS.items():
        body = body.replace("{" + k + "}", v)
    return PREFIX + body
