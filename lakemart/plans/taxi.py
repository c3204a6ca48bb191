"""Zone reports over taxi trips of both colours."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import day_of_week, duration_minutes, hour_of
from lakemart.operators.aggregates import merge_zone_days, merge_zone_summary, zone_totals
from lakemart.operators.columns import add_columns, rename_columns, snake_case_columns
from lakemart.operators.filters import filter_anomalies
from lakemart.operators.joins import join_zones
from lakemart.operators.unions import union_tagged
from lakemart.sources.files import scan_csv, scan_drifted
from lakemart.sources.schemas import trip_renames, trip_schema
from lakemart.sources.sinks import write_report


def unify_trips(yellow: DataFrame, green: DataFrame) -> DataFrame:
    """Both colours under one set of snake-case names, tagged with ``taxi_type``.

    ``yellow`` and ``green`` have the raw column names of their files.
    """
    parts = {}
    for colour, raw in (("yellow", yellow), ("green", green)):
        parts[colour] = snake_case_columns(rename_columns(raw, trip_renames(colour)))
    return union_tagged(parts, "taxi_type")


def prepare_trips(trips: DataFrame) -> DataFrame:
    """Add hour, weekday and duration, then drop anomalous trips."""
    return filter_anomalies(add_columns(trips, {
        "pickup_hour": hour_of("pickup_datetime"),
        "pickup_day_of_week": day_of_week("pickup_datetime"),
        "duration_min": duration_minutes("pickup_datetime", "dropoff_datetime"),
    }))


def trip_zone_totals(trips: DataFrame, zones: DataFrame, zone_key: str = "LocationID",
                     payload: str = "Zone") -> DataFrame:
    """What both zone reports need, per weekday and pair of zones, with the zone names.

    Trips are summed by zone ids first: the trips are read once for both reports, never shuffled as
    rows, and the lookups meet at most one row per weekday and pair.
    """
    totals = zone_totals(prepare_trips(trips), ["pickup_day_of_week", "pu_location_id", "do_location_id"])
    return join_zones(totals, zones, payload, zone_key)


def zone_reports(totals: DataFrame) -> dict[str, DataFrame]:
    """Zone summary and weekday statistics."""
    return {"zone_statistic": merge_zone_summary(totals), "zone_days_statistic": merge_zone_days(totals)}


def run_zone_reports(spark: SparkSession, yellow_folders: list[str], green_folders: list[str], zone_csv: str,
                     out: str, run_date: date) -> dict[str, str]:
    """From files to one Parquet folder per report, ``out/<report>/<run date>``."""
    yellow, green = (scan_drifted(spark, folders, trip_schema(colour))
                     for colour, folders in (("yellow", yellow_folders), ("green", green_folders)))
    totals = trip_zone_totals(unify_trips(yellow, green), scan_csv(spark, zone_csv)).persist()
    paths = {}
    try:
        for name, report in zone_reports(totals).items():
            paths[name] = f"{out}/{name}/{run_date.isoformat()}"
            write_report(report, paths[name])
    finally:
        totals.unpersist()
    return paths


def trips_per_day(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.to_date("pickup_datetime").alias("pickup_date")).agg(F.count("*").alias("total_trips"))
