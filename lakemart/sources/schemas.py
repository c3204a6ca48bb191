"""Declared schemas (fixed values) and schema comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _fields(kind, *names: str) -> list[StructField]:
    return [StructField(n, kind(), True) for n in names]


# Columns both taxi colours share, in the order of their files.
TRIP_COMMON = StructType([
    StructField("VendorID", LongType(), True),
    StructField("PULocationID", LongType(), True),
    StructField("trip_distance", DoubleType(), True),
    StructField("store_and_fwd_flag", StringType(), True),
    StructField("DOLocationID", LongType(), True),
    StructField("fare_amount", DoubleType(), True),
    StructField("extra", DoubleType(), True),
    StructField("mta_tax", DoubleType(), True),
    StructField("tip_amount", DoubleType(), True),
    StructField("tolls_amount", DoubleType(), True),
    StructField("improvement_surcharge", DoubleType(), True),
    StructField("total_amount", DoubleType(), True),
    StructField("congestion_surcharge", DoubleType(), True),
    StructField("trip_type", DoubleType(), True),
])


def trip_schema(colour: str, times=TimestampNTZType) -> StructType:
    """Raw trips of one colour: the two differ in the prefix of their times and the name of a fee.

    The one type all files are cast to: passengers are doubles, as some files hold them so. Read files with
    :func:`lakemart.sources.files.scan_drifted`, by their own types.
    """
    prefix, fee = {"yellow": ("tpep", "airport_fee"), "green": ("lpep", "ehail_fee")}[colour]
    return StructType([
        *_fields(LongType, "RatecodeID", "payment_type"),
        *_fields(DoubleType, "passenger_count"),
        *_fields(times, f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"),
        *_fields(DoubleType, fee),
        *TRIP_COMMON,
    ])


def trip_renames(colour: str) -> dict[str, str]:
    """Raw column names of one colour -> the names both share after unifying."""
    prefix, fee = {"yellow": ("tpep", "airport_fee"), "green": ("lpep", "ehail_fee")}[colour]
    return {f"{prefix}_pickup_datetime": "pickup_datetime", f"{prefix}_dropoff_datetime": "dropoff_datetime",
            fee: "fee"}


# Columns of the zone lookup and of the two event streams.
ZONE_LOOKUP = StructType([*_fields(LongType, "LocationID"), *_fields(StringType, "Borough", "Zone", "service_zone")])

TRANSACTIONS = StructType([
    *_fields(StringType, "transaction_id", "user_id"),
    *_fields(FloatType, "amount"),
    *_fields(StringType, "merchant", "currency"),
    *_fields(TimestampType, "timestamp"),
    *_fields(BooleanType, "is_fraud"),
])

USER_ACTIVITY = StructType([
    *_fields(StringType, "event_id", "user_id", "event_type", "device", "browser"),
    *_fields(TimestampType, "timestamp"),
])

# Type maps for cleaning the raw sports tables; unlisted columns are text.
PLAYER_TYPES = {"player_id": "int", "club_team_id": "int", "league_id": "int", "value_eur": "numeric",
                "wage_eur": "numeric", "overall": "int", "potential": "int", "age": "int"}
COACH_TYPES = {"coach_id": "int", "nationality_id": "int", "dob": "date"}
TEAM_TYPES = {"team_id": "int", "league_id": "int", "nationality_id": "int", "coach_id": "int"}

# Columns of the unified trip table of the warehouse plan, in its order.
ALL_TRIPS_COLUMNS = (
    "pickup_zone", "passenger_count", "congestion_surcharge", "tolls_amount", "tip_amount", "mta_tax", "fee",
    "dropoff_datetime", "improvement_surcharge", "do_location_id", "pickup_datetime", "vendor_id",
    "store_and_fwd_flag", "extra", "fare_amount", "total_amount", "payment_type", "trip_distance", "dropoff_zone",
    "ratecode_id", "pu_location_id",
)


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fields that only one frame has or whose types differ: ``(name, left_type, right_type)``.

    Compares metadata only; neither frame is read.
    """
    a, b = ({f.name: f.dataType.simpleString() for f in df.schema} for df in (left, right))
    rows = [(n, a.get(n), b.get(n)) for n in sorted(a.keys() | b.keys()) if a.get(n) != b.get(n)]
    return left.sparkSession.createDataFrame(rows, "name string, left_type string, right_type string")
