"""Schemas and fixed values of the on-time data model.

Every layer of the model is a flat table of scalar columns:

* raw rows:      18 nullable strings, bound by header name (``RAW_SCHEMA``);
* clean rows:    typed, enriched; written as Parquet under ``year=/month=``;
* staging rows:  renamed, keyed, filtered to operated past flights;
* fact rows:     staging joined to the carrier dimension;
* reports:       one row per carrier and one row per month.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source data's conventions and the
# reports' labels for results to match; they are listed plainly, in order.
# ---------------------------------------------------------------------------

# Raw CSV header names, in file order.
RAW_COLUMNS = [
    "FlightDate",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Origin",
    "Dest",
    "DepDelay",
    "ArrDelay",
    "Cancelled",
    "CancellationCode",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
    "ActualElapsedTime",
    "Distance",
    "DepTime",
    "ArrTime",
]

# Delay buckets of arrival delay, upper bounds inclusive; null falls to the last.
BUCKET_ON_TIME = "On time"
BUCKET_MINOR = "Minor (1-15 min)"
BUCKET_MODERATE = "Moderate (16-60 min)"
BUCKET_SEVERE = "Severe (1-3 hrs)"
BUCKET_EXTREME = "Extreme (>3 hrs)"
DELAY_BUCKETS = [BUCKET_ON_TIME, BUCKET_MINOR, BUCKET_MODERATE, BUCKET_SEVERE, BUCKET_EXTREME]
BUCKET_BOUNDS = [0, 15, 60, 180]

# A flight counts as delayed when arrival delay exceeds this many minutes.
DELAYED_AFTER_MIN = 15

# Delays beyond this many minutes (either sign) are data errors.
OUTLIER_LIMIT_MIN = 1440

# Primary-cause labels, in tie-break order, and the fall-through label.
CAUSE_CARRIER = "Carrier"
CAUSE_WEATHER = "Weather"
CAUSE_NAS = "NAS"
CAUSE_LATE_AIRCRAFT = "Late Aircraft"
CAUSE_SECURITY = "Security"
CAUSE_UNKNOWN = "Unknown"

# Report cause columns and their display labels, in display order.
CAUSE_REPORT_COLUMNS = [
    ("avg_carrier_delay", "Carrier"),
    ("avg_weather_delay", "Weather"),
    ("avg_nas_delay", "NAS"),
    ("avg_late_aircraft_delay", "Late Aircraft"),
]

# Severity bands of a carrier's average arrival delay (minutes, strict >).
SEVERITY_HIGH_ABOVE = 20
SEVERITY_MEDIUM_ABOVE = 10

# Separator in the route label and the surrogate-key hashing conventions.
ROUTE_SEPARATOR = " → "
KEY_SEPARATOR = "-"
KEY_NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"

# Carrier dimension: IATA code and airline name, 17 rows.
CARRIERS = [
    ("AA", "American Airlines"),
    ("AS", "Alaska Airlines"),
    ("B6", "JetBlue Airways"),
    ("DL", "Delta Air Lines"),
    ("F9", "Frontier Airlines"),
    ("G4", "Allegiant Air"),
    ("HA", "Hawaiian Airlines"),
    ("NK", "Spirit Airlines"),
    ("OH", "PSA Airlines"),
    ("OO", "SkyWest Airlines"),
    ("QX", "Horizon Air"),
    ("UA", "United Airlines"),
    ("WN", "Southwest Airlines"),
    ("YV", "Mesa Airlines"),
    ("YX", "Republic Airways"),
    ("9E", "Endeavor Air"),
    ("MQ", "Envoy Air"),
]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

DELAY_CAUSE_COLUMNS = [
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
]

FLOAT_COLUMNS = [
    "dep_delay",
    "arr_delay",
    "cancelled",
    *DELAY_CAUSE_COLUMNS,
    "actual_elapsed_time",
    "distance",
]

CLEAN_SCHEMA = StructType(
    [
        StructField("fl_date", DateType(), True),
        StructField("mkt_carrier", StringType(), True),
        StructField("mkt_carrier_fl_num", IntegerType(), True),
        StructField("origin", StringType(), True),
        StructField("dest", StringType(), True),
        StructField("dep_time", StringType(), True),
        StructField("arr_time", StringType(), True),
        StructField("cancellation_code", StringType(), True),
        *[StructField(c, FloatType(), True) for c in FLOAT_COLUMNS],
        StructField("total_delay", DoubleType(), True),
        StructField("is_delayed", BooleanType(), True),
        StructField("delay_bucket", StringType(), True),
        StructField("primary_delay_cause", StringType(), True),
        StructField("year", IntegerType(), True),
        StructField("month", IntegerType(), True),
    ]
)

# Columns the warehouse staging table holds (the clean rows without the two
# time-of-day strings). Partition columns come back from directory names.
STAGING_SOURCE_SCHEMA = StructType(
    [f for f in CLEAN_SCHEMA.fields if f.name not in ("dep_time", "arr_time")]
)

STAGING_SCHEMA = StructType(
    [
        StructField("flight_id", StringType(), True),
        StructField("fl_date", DateType(), True),
        StructField("carrier_code", StringType(), True),
        StructField("flight_number", IntegerType(), True),
        StructField("origin_airport", StringType(), True),
        StructField("dest_airport", StringType(), True),
        StructField("dep_delay", FloatType(), True),
        StructField("arr_delay", FloatType(), True),
        *[StructField(c, FloatType(), True) for c in DELAY_CAUSE_COLUMNS],
        StructField("actual_elapsed_time", FloatType(), True),
        StructField("distance", FloatType(), True),
        StructField("total_delay", DoubleType(), True),
        StructField("is_delayed", BooleanType(), True),
        StructField("delay_bucket", StringType(), True),
        StructField("primary_delay_cause", StringType(), True),
        StructField("flight_year", LongType(), True),
        StructField("flight_month", LongType(), True),
        StructField("cancelled", DoubleType(), True),
        StructField("cancellation_code", StringType(), True),
    ]
)

FACT_COLUMNS = [
    "flight_id",
    "fl_date",
    "flight_year",
    "flight_month",
    "year_month",
    "carrier_code",
    "carrier_name",
    "origin_airport",
    "dest_airport",
    "route",
    "distance",
    "dep_delay",
    "arr_delay",
    *DELAY_CAUSE_COLUMNS,
    "total_delay",
    "is_delayed",
    "delay_bucket",
    "primary_delay_cause",
    "actual_elapsed_time",
]

