"""Table schemas and the fixed values that must equal the reference's."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for the same results) -------
# Season names, in the order used when serving forecasts.
SEASONS = ["Verano", "Otoño", "Invierno", "Primavera"]
# Months of each season (southern hemisphere).
SEASON_MONTHS = {
    "Verano": [12, 1, 2],
    "Otoño": [3, 4, 5],
    "Invierno": [6, 7, 8],
    "Primavera": [9, 10, 11],
}
# Measured columns of the observation table, in table order.
MEASURES = ["tmax", "tmin", "tavg", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun"]
# Extra columns dropped from the reduced (18) feature set.
REDUCED_DROP = ["Primavera", "mes_7", "mes_8", "mes_9", "mes_10", "mes_11", "mes_12"]
# Forecast targets.
TARGETS = ["tmax", "tmin", "tavg"]
# Default window length, first-update date, seed station and split cut-offs.
WINDOW_T = 25
FIRST_UPDATE_DATE = "2018-01-01"
SEED_STATION = (1, "Piura", -5.1833, -80.6)
MAX_NAME_LENGTH = 40
# -------------------------------------------------------------------------

# Training one-hot columns come out alphabetically (Invierno, Otoño,
# Primavera, Verano); one constant list is used for training and serving.
SEASON_COLUMNS = sorted(SEASONS)
MONTH_COLUMNS = [f"mes_{m}" for m in range(1, 13)]

BASE_FEATURES = ["tmax", "tmin", "tavg", "prcp", "wdir", "wspd", "pres", "mes", "dia"]
FULL_FEATURES = BASE_FEATURES + SEASON_COLUMNS + MONTH_COLUMNS
REDUCED_FEATURES = [c for c in FULL_FEATURES if c not in REDUCED_DROP]

STATIONS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("ciudad", T.StringType(), False),
    T.StructField("latitud", T.DoubleType(), False),
    T.StructField("longitud", T.DoubleType(), False),
])

OBSERVATIONS = T.StructType(
    [T.StructField("id_ciudad", T.IntegerType(), False),
     T.StructField("time", T.TimestampNTZType(), False)]
    + [T.StructField(c, T.IntegerType() if c == "wdir" else T.DoubleType(), True) for c in MEASURES]
)

FORECASTS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("time", T.TimestampNTZType(), False),
    T.StructField("tmax", T.DoubleType(), False),
    T.StructField("tmin", T.DoubleType(), False),
    T.StructField("tavg", T.DoubleType(), False),
])

TABLES = {"ciudades": STATIONS, "clima": OBSERVATIONS, "predic": FORECASTS}
KEYS = {"ciudades": ["id"], "clima": ["id_ciudad", "time"], "predic": ["id", "time"]}
STATION_KEY = {"ciudades": "id", "clima": "id_ciudad", "predic": "id"}
