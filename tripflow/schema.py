"""Schemas and category code tables for trip records."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Raw trip file schema: fixed column order, as published in the quarterly CSV feed.
RAW_TRIP_SCHEMA = StructType(
    [
        StructField("trip_id", IntegerType(), True),
        StructField("duration", IntegerType(), True),
        StructField("start_time", StringType(), True),
        StructField("end_time", StringType(), True),
        StructField("start_station", IntegerType(), True),
        StructField("start_lat", DoubleType(), True),
        StructField("start_lon", DoubleType(), True),
        StructField("end_station", IntegerType(), True),
        StructField("end_lat", DoubleType(), True),
        StructField("end_lon", DoubleType(), True),
        StructField("bike_id", IntegerType(), True),
        StructField("plan_duration", IntegerType(), True),
        StructField("trip_route_category", StringType(), True),
        StructField("passholder_type", StringType(), True),
        StructField("bike_type", StringType(), True),
    ]
)

# Enriched trip table (one row per cleaned trip), partitioned by ``ptd`` (year string).
ENRICHED_TRIP_SCHEMA = StructType(
    [
        StructField("trip_id", IntegerType(), True),
        StructField("duration", IntegerType(), True),
        StructField("start_station", IntegerType(), True),
        StructField("start_lat", DoubleType(), True),
        StructField("start_lon", DoubleType(), True),
        StructField("end_station", IntegerType(), True),
        StructField("end_lat", DoubleType(), True),
        StructField("end_lon", DoubleType(), True),
        StructField("bike_id", IntegerType(), True),
        StructField("plan_duration", IntegerType(), True),
        StructField("trip_route_type", IntegerType(), True),
        StructField("passholder_type", IntegerType(), True),
        StructField("bike_type", IntegerType(), True),
        StructField("distance", FloatType(), True),
        StructField("distance_cal", FloatType(), True),
        StructField("city_name", StringType(), True),
        StructField("used_date", StringType(), True),
        StructField("used_hour", IntegerType(), True),
        StructField("season", IntegerType(), True),
        StructField("holiday", IntegerType(), True),
        StructField("workingday", IntegerType(), True),
        StructField("start_datetime", TimestampNTZType(), True),
        StructField("end_datetime", TimestampNTZType(), True),
        StructField("start_hour", StringType(), True),
        StructField("ptd", StringType(), True),
    ]
)

ENRICHED_COLUMNS = [f.name for f in ENRICHED_TRIP_SCHEMA.fields]

# --- Fixed values: category code tables of the trip feed (label -> code). -------------
# Encoding is case-sensitive; a label not listed maps to NULL.
ROUTE_CODES = {"One Way": 1, "Round Trip": 2}
PASSHOLDER_CODES = {"Walk-up": 1, "One Day Pass": 2, "Monthly Pass": 3, "Annual Pass": 4}
BIKE_TYPE_CODES = {"standard": 1, "electric": 2, "smart": 3}
SEASON_CODES = {"winter": 1, "spring": 2, "summer": 3, "autumn": 4}
FLAG_CODES = {"no": 0, "yes": 1}
# Plan durations in days: 0 walk-up, 1 day pass, 30 monthly, 365 annual.
PLAN_DAY, PLAN_MONTH, PLAN_YEAR = 1, 30, 365
# Columns of the statistics reports.
STATS_COLUMNS = ["duration", "plan_duration", "trip_route_type", "passholder_type", "bike_type", "distance",
                 "season", "holiday", "workingday"]
DESCRIBE_COLUMNS = ["duration", "start_lat", "start_lon", "end_lat", "end_lon", "plan_duration", "trip_route_type",
                    "passholder_type", "bike_type", "distance", "season", "holiday", "workingday"]
# --- end of fixed values ----------------------------------------------------------------

# Raw column -> (enriched column, code table) for the three encoded categories.
TRIP_CATEGORY_ENCODINGS = {
    "trip_route_category": ("trip_route_type", ROUTE_CODES),
    "passholder_type": ("passholder_type", PASSHOLDER_CODES),
    "bike_type": ("bike_type", BIKE_TYPE_CODES),
}

# Enriched column -> code table, for decoding codes back to labels.
TRIP_CATEGORY_DECODINGS = {
    "trip_route_type": ROUTE_CODES,
    "passholder_type": PASSHOLDER_CODES,
    "bike_type": BIKE_TYPE_CODES,
    "season": SEASON_CODES,
    "holiday": FLAG_CODES,
    "workingday": FLAG_CODES,
}
