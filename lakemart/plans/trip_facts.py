"""Stage tables, deduplicated trips and trip facts per hour and per day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import date_of, duration_minutes, hour_of
from lakemart.operators.aggregates import finish_trip_facts, trip_totals
from lakemart.operators.columns import add_columns, cast_columns, rename_columns, snake_case_columns
from lakemart.operators.filters import filter_consistent_trips, filter_sql
from lakemart.operators.joins import join_dimensions_inner, join_zones
from lakemart.operators.quality import Check, checked
from lakemart.operators.ranking import dedup_row_number
from lakemart.operators.unions import union_tagged
from lakemart.sources.files import scan_csv, scan_drifted
from lakemart.sources.schemas import trip_schema
from lakemart.sources.sinks import keep_inline, keep_tables

# Columns of the trips table.
TRIP_COLUMNS = (
    "vendor_id", "pu_location_id", "do_location_id", "ratecode_id", "payment_type", "passenger_count",
    "total_amount", "fare_amount", "fee", "extra", "trip_distance", "trip_duration_minutes", "pickup_datetime",
    "dropoff_datetime", "trip_type", "store_and_fwd_flag", "pickup_hour",
)

TRIP_CHECKS = (
    Check("locations", "unique", "location_id"),
    *[Check("locations", "not_null", c) for c in ("borough", "zone", "service_zone")],
    *[Check("trips", "not_null", c) for c in ("pickup_datetime", "dropoff_datetime", "total_amount")],
    *[Check("trips", "expression", e) for e in (
        "trip_duration_minutes > 0", "passenger_count BETWEEN 1 AND 6", "dropoff_datetime > pickup_datetime")],
)


def taxi_clean(raw: DataFrame, max_total: float = 500, passengers: tuple[int, int] = (0, 6)) -> DataFrame:
    """Plausible trips of one colour under snake-case names, with hour and minutes; raw file names of times are unified."""
    times = {c: c.split("_", 1)[1] for c in raw.columns if c.lower().startswith(("tpep_", "lpep_"))}
    plausible = filter_sql(
        rename_columns(raw, times),
        "trip_distance > 0 AND total_amount > 0 AND total_amount <= :most AND passenger_count BETWEEN :fewest AND :full",
        most=max_total, fewest=passengers[0], full=passengers[1])
    return add_columns(snake_case_columns(plausible), {
        "pickup_hour": hour_of("pickup_datetime"),
        "trip_duration_minutes": duration_minutes("pickup_datetime", "dropoff_datetime"),
    })


def taxi_stage(clean: DataFrame, zones: DataFrame, zone_key: str = "LocationID", payload: str = "Borough") -> DataFrame:
    """Clean trips of one colour with the boroughs of their zones."""
    return join_zones(clean, zones, payload, zone_key)


def locations(zones: DataFrame) -> DataFrame:
    return cast_columns(zones, {"location_id": "int"}).select("location_id", "borough", "zone", "service_zone")


def trips(green_clean: DataFrame, yellow_clean: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Deduplicated consistent trips of both colours, from the clean ones: no borough is read here.

    Tests on the columns that identify a trip come before the deduplication, which they cannot change.
    """
    sides = {}
    for colour, clean in (("green", green_clean), ("yellow", yellow_clean)):
        forward = clean.filter("dropoff_datetime > pickup_datetime AND trip_duration_minutes > 0")
        sides[colour] = dedup_row_number(forward, tie_break)
    return filter_consistent_trips(union_tagged(
        sides, "taxi_type", {"yellow": {"airport_fee": "fee"}, "green": {"ehail_fee": "fee"}}, TRIP_COLUMNS))


def trip_facts(trip_rows: DataFrame, location_rows: DataFrame, grain: Column, name: str) -> DataFrame:
    """Totals per grain and zone pair, for trips whose two zones are known.

    Trips are summed per zone pair before they meet the zones, so the joins see one row per group and
    task rather than every trip, whatever the size of the zone table.
    """
    totals = trip_totals(trip_rows, grain.alias(name))
    known = join_dimensions_inner(totals, location_rows, "location_id", ["pu_location_id", "do_location_id"])
    return finish_trip_facts(known, name)


def fact_trip_summary_daily(trip_rows: DataFrame, location_rows: DataFrame) -> DataFrame:
    return trip_facts(trip_rows, location_rows, date_of("pickup_datetime"), "pickup_date")


def fact_trip_summary_hourly(trip_rows: DataFrame, location_rows: DataFrame) -> DataFrame:
    return trip_facts(trip_rows, location_rows, F.col("pickup_hour"), "pickup_hour")


def trip_tables(green_raw: DataFrame, yellow_raw: DataFrame, zones: DataFrame, tie_break: Sequence[Column | str] = (),
                zone_key: str = "LocationID", payload: str = "Borough",
                keep: Callable[[str, DataFrame], DataFrame] = keep_inline) -> dict[str, DataFrame]:
    """Every model of the chain by name, from raw trips; ``keep`` decides how models are kept."""
    out = {f"{colour}_taxi_clean": keep(f"{colour}_taxi_clean", taxi_clean(raw))
           for colour, raw in (("green", green_raw), ("yellow", yellow_raw))}
    for colour in ("green", "yellow"):
        # A view: the boroughs are for readers of the stage only.
        out[f"{colour}_taxi_stage"] = taxi_stage(out[f"{colour}_taxi_clean"], zones, zone_key, payload)
    out["locations"] = keep("locations", locations(snake_case_columns(zones)))
    out["trips"] = keep("trips", trips(out["green_taxi_clean"], out["yellow_taxi_clean"], tie_break))
    out["fact_trip_summary_daily"] = fact_trip_summary_daily(out["trips"], out["locations"])
    out["fact_trip_summary_hourly"] = fact_trip_summary_hourly(out["trips"], out["locations"])
    return out


def run_trip_facts(spark: SparkSession, yellow_paths: Sequence[str], green_paths: Sequence[str], zone_csv: str,
                   layer: str, tie_break: Sequence[Column | str] = (), strict: bool = True) -> dict[str, DataFrame]:
    """From files to the tables of ``layer``, each model written once; ends with the data checks.

    ``strict`` raises on violations, after the tables are written; otherwise ``checks`` holds the report.
    """
    keep = keep_tables(layer)
    yellow, green = (scan_drifted(spark, paths, trip_schema(colour))
                     for colour, paths in (("yellow", yellow_paths), ("green", green_paths)))
    tables = trip_tables(green, yellow, scan_csv(spark, zone_csv), tie_break, keep=keep)
    tables |= {n: keep(n, tables[n]) for n in ("green_taxi_stage", "yellow_taxi_stage", "fact_trip_summary_daily",
                                               "fact_trip_summary_hourly")}
    return checked(tables, TRIP_CHECKS, strict)
