"""The warehouse chain: enrich, classify, aggregate, and one table of all trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakemart.functions.scalars import hour_of, trip_category
from lakemart.operators.aggregates import hourly_stats, zone_averages
from lakemart.operators.changes import all_inserted, log_changes, save_hourly_stats, table_changes
from lakemart.operators.columns import add_columns, conform, rename_columns, snake_case_columns
from lakemart.operators.filters import filter_valid_trips
from lakemart.operators.joins import join_zones
from lakemart.operators.unions import union_tagged
from lakemart.sources.files import scan_csv, scan_drifted
from lakemart.sources.schemas import ALL_TRIPS_COLUMNS, trip_renames, trip_schema
from lakemart.sources.sinks import keep_tables, save_table


def enriched(trips: DataFrame, zones: DataFrame, zone_key: str = "location_id", payload: str = "zone") -> DataFrame:
    """Every trip with the names of its two zones."""
    return join_zones(trips, zones, payload, zone_key)


def preprocessed(enriched_trips: DataFrame) -> DataFrame:
    """Valid trips with their distance class and pick-up hour."""
    return add_columns(filter_valid_trips(enriched_trips), {
        "trip_category": trip_category("trip_distance"),
        "pickup_hour": hour_of("pickup_datetime"),
    })


def zone_aggregated(preprocessed_trips: DataFrame) -> DataFrame:
    return zone_averages(preprocessed_trips)


def zone_hourly_stats(preprocessed_trips: DataFrame, at=None) -> DataFrame:
    return hourly_stats(preprocessed_trips, at)


def all_trips(yellow_enriched: DataFrame, green_enriched: DataFrame) -> DataFrame:
    """Both enriched colours in one table; columns only one side has are NULL on the other."""
    return union_tagged({"YELLOW": yellow_enriched, "GREEN": green_enriched}, "taxi_color",
                        columns=ALL_TRIPS_COLUMNS)


def run_warehouse(spark: SparkSession, yellow_paths: Sequence[str], green_paths: Sequence[str], zone_csv: str, layer: str,
                  position, at=None) -> dict[str, DataFrame]:
    """From files to the tables of ``layer``: per colour enriched, preprocessed, averaged and hourly figures; all trips.

    Each run adds its hourly figures to their history, under its time ``at``, and what changed in all trips since the run
    before to ``all_trips_changes``, under the caller's ``position``; both replace what an earlier try of the same run left.
    The other tables are replaced.
    """
    keep = keep_tables(layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    zones = scan_csv(spark, zone_csv)
    out: dict[str, DataFrame] = {}
    for colour, paths in (("yellow", yellow_paths), ("green", green_paths)):
        raw = scan_drifted(spark, paths, trip_schema(colour))
        trips = snake_case_columns(rename_columns(raw, trip_renames(colour)))
        out[f"{colour}_enriched"] = keep(f"{colour}_enriched", enriched(trips, zones, "LocationID", "Zone"))
        ready = keep(f"{colour}_preprocessed", preprocessed(out[f"{colour}_enriched"]))
        out[f"{colour}_preprocessed"] = ready
        out[f"{colour}_zone_aggregated"] = keep(f"{colour}_zone_aggregated", zone_aggregated(ready))
        save_hourly_stats(ready, f"{layer}.{colour}_hourly_stats", at)
        out[f"{colour}_hourly_stats"] = spark.table(f"{layer}.{colour}_hourly_stats")
    both = all_trips(out["yellow_enriched"], out["green_enriched"])
    known = spark.catalog.tableExists(f"{layer}.all_trips")
    changes = table_changes(conform(spark.table(f"{layer}.all_trips"), both.schema), both) if known else all_inserted(both)
    log_changes(changes, f"{layer}.all_trips_changes", position)
    save_table(both, f"{layer}.all_trips")
    return out | {n: spark.table(f"{layer}.{n}") for n in ("all_trips", "all_trips_changes")}
