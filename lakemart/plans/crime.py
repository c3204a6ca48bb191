"""Crimes, arrests and crime codes: raw rows, typed rows, dimensions, facts, daily figures."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import scalars as s
from lakemart.operators import aggregates
from lakemart.operators.columns import cast_columns, provenance_columns, rename_by_copy, snake_case_columns
from lakemart.operators.filters import filter_flag, filter_nonblank, filter_required, filter_valid_date
from lakemart.operators.joins import join_key_and_day, join_multi_key, join_using
from lakemart.operators.quality import Check, checked
from lakemart.operators.ranking import drop_duplicates, first_per_key
from lakemart.session import settings, small_splits
from lakemart.sources.files import scan_csv, scan_recursive
from lakemart.sources.increments import (
    append_new_keys, as_they_are, bucket_count, buckets_for, consume_files, consumed_path, deal_by_key)
from lakemart.sources.sinks import bronze_append, bronze_overwrite, keep_inline, keep_tables

# Raw crime columns and the names they get.
CRIME_NAMES = {
    "ID": "crime_id", "Case Number": "case_number", "Date": "crime_datetime", "Block": "block", "IUCR": "iucr_code",
    "Primary Type": "primary_type", "Description": "description", "Location Description": "location_description",
    "Arrest": "is_arrest", "Domestic": "is_domestic", "Beat": "beat_id", "Ward": "ward_id",
    "Community Area": "community_area_id", "FBI Code": "fbi_code", "X Coordinate": "x_coordinate",
    "Y Coordinate": "y_coordinate", "Latitude": "latitude", "Longitude": "longitude",
    "Location": "location_geo_point", "District": "district_id",
}
# Raw arrest columns and the names they get; other columns are not used.
ARREST_NAMES = {
    "CB_NO": "arrest_id", "CASE NUMBER": "case_number", "ARREST DATE": "arrest_date", "RACE": "arrestee_race",
    "CHARGE 1 STATUTE": "charge_one_statue", "CHARGE 1 DESCRIPTION": "charge_one_description",
    "CHARGE 1 TYPE": "charge_one_type",
}
# Columns of the code table.
CODE_COLUMNS = ("iucr_code", "primary_description", "secondary_description", "index_code")
# Types of the crime columns, columns that make a place, and the bounds of the checks below.
CRIME_TYPES = {
    **dict.fromkeys(("is_arrest", "is_domestic"), "boolean"),
    **dict.fromkeys(("latitude", "longitude", "x_coordinate", "y_coordinate"), "double"),
    **dict.fromkeys(("beat_id", "district_id", "ward_id", "community_area_id"), "int"),
}
PLACE = ("block", "latitude", "longitude", "x_coordinate", "y_coordinate")

CRIME_CHECKS = (
    *[Check(t, k, "arrest_id") for t in ("stg_arrests", "fact_arrests") for k in ("unique", "not_null")],
    *[Check(t, "accepted_values", "charge_one_type", tuple(sorted((*s.CHARGE_TYPES.values(), "other"))))
      for t in ("stg_arrests", "fact_arrests")],
    *[Check("stg_crimes", k, "crime_id") for k in ("unique", "not_null")],
    *[Check("stg_crimes", "not_null", c) for c in ("crime_date", "iucr_code", "primary_type")],
    Check("stg_crimes", "relationships", "iucr_code", parent="stg_ucr_codes", parent_column="iucr_code"),
    Check("stg_crimes", "expression", "latitude BETWEEN 41.6 AND 42.1"),
    Check("stg_crimes", "expression", "longitude BETWEEN -87.95 AND -87.5"),
    *[Check(t, k, "iucr_code") for t in ("stg_ucr_codes", "dim_crime_type") for k in ("unique", "not_null")],
    *[Check(t, "not_null", "primary_description") for t in ("stg_ucr_codes", "dim_crime_type")],
    *[Check("dim_location", k, "location_key") for k in ("unique", "not_null")],
    *[Check("dim_location", "not_null", c) for c in ("latitude", "longitude")],
    *[Check("fact_crimes", k, "crime_id") for k in ("unique", "not_null")],
    *[Check("fact_crimes", "not_null", c) for c in ("crime_date", "location_key", "iucr_code")],
    Check("fact_crimes", "relationships", "location_key", parent="dim_location", parent_column="location_key"),
    Check("fact_crimes", "relationships", "iucr_code", parent="dim_crime_type", parent_column="iucr_code"),
    Check("fact_arrests", "not_null", "arrest_date"),
    Check("fact_arrests", "relationships", "iucr_code", parent="dim_crime_type", parent_column="iucr_code"),
    *[Check("agg_daily_crimes", "not_null", c) for c in ("crime_date", "total_crimes")],
    Check("agg_daily_crimes", "expression", "total_crimes >= crimes_with_arrest"),
)


# --- bronze: raw rows -------------------------------------------------------------------------


def load_bronze(spark: SparkSession, crimes: Sequence[str] | str, arrests: Sequence[str] | str,
                codes: Sequence[str] | str, out: str, load_time=None) -> None:
    """CSV files to Parquet below ``out``: crimes and arrests are appended, codes replaced.

    Crimes are read as text like the rest, which saves the pass that guesses types; the next layer casts.
    """
    with small_splits(spark):
        for name, paths in (("crimes", crimes), ("arrests", arrests)):
            bronze_append(provenance_columns(scan_csv(spark, paths), load_time), f"{out}/{name}")
    bronze_overwrite(provenance_columns(scan_csv(spark, codes), load_time, source_file=False), f"{out}/iucr")


# --- silver: typed rows -----------------------------------------------------------------------


def silver_crimes(raw: DataFrame, deal: Callable[[DataFrame], DataFrame] = as_they_are) -> DataFrame:
    """Typed crimes that have a place, a code and a type; one row per id: the earliest, unreadable dates last.

    ``deal`` may bring the typed rows together by id, such as :func:`deal_by_key`; else Spark shuffles them.
    """
    typed = cast_columns(rename_by_copy(raw, CRIME_NAMES), CRIME_TYPES).withColumns({
        "crime_datetime": s.parse_us_timestamp("crime_datetime"),
        "location_description": s.coalesce_default("location_description", "Unknown"),
    })
    located = deal(filter_required(typed, ["latitude", "longitude", "iucr_code", "primary_type"]))
    rest = [c for c in located.columns if c not in ("crime_id", "crime_datetime")]
    return drop_duplicates(located, ["crime_id"], [F.asc_nulls_last("crime_datetime"), *rest])


def silver_arrests(raw: DataFrame, deal: Callable[[DataFrame], DataFrame] = as_they_are) -> DataFrame:
    """Typed arrests with a case number; one row per id: the earliest, so a copy with an unreadable date never wins."""
    typed = rename_by_copy(raw, ARREST_NAMES).withColumns({
        "arrest_date": s.parse_us_timestamp("arrest_date"),
        "charge_one_type": s.charge_type("charge_one_type"),
    })
    named = deal(filter_nonblank(typed, "case_number"))
    rest = [c for c in named.columns if c not in ("arrest_id", "arrest_date")]
    return drop_duplicates(named, ["arrest_id"], [F.asc_nulls_last("arrest_date"), *rest])


def silver_ucr_codes(raw: DataFrame) -> DataFrame:
    """Active codes, one row each."""
    named = snake_case_columns(raw.withColumnRenamed("IUCR", "iucr_code"), "spaced", squeeze=True)
    filled = filter_flag(named, "active").withColumns(
        {c: s.coalesce_default(c, "Unknown") for c in ("primary_description", "secondary_description")})
    return drop_duplicates(filled.select(*CODE_COLUMNS), ["iucr_code"], CODE_COLUMNS[1:])


# --- gold: stage, dimensions, facts -----------------------------------------------------------


def stg_ucr_codes(silver: DataFrame) -> DataFrame:
    return silver.select(*[s.upper_trim(c).alias(c) for c in CODE_COLUMNS])


def stg_crimes(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Crimes with the parts of their time; codes are normalised on the code side only."""
    time = "crime_datetime"
    return join_using(silver, codes, "iucr_code").withColumns({
        "crime_date": s.date_of(time), "crime_hour": s.hour_of(time),
        "crime_day_of_week": s.day_of_week(time, sunday=0), "crime_month": s.month_of(time),
        "crime_year": s.year_of(time),
    })


def stg_arrests(silver: DataFrame) -> DataFrame:
    return filter_valid_date(silver, "arrest_date")


def dim_location(crimes: DataFrame) -> DataFrame:
    """One row per place, described by its crime with the smallest id."""
    first = first_per_key(crimes, PLACE, ["crime_id"])
    return first.select(
        s.surrogate_key(*PLACE).alias("location_key"), "block", "location_description", *PLACE[1:],
        "beat_id", "district_id", "ward_id", "community_area_id",
        s.full_text("block", "location_description").alias("location_full_text"))


def dim_crime_type(codes: DataFrame) -> DataFrame:
    return first_per_key(codes, ["iucr_code"], CODE_COLUMNS[1:])


def fact_crimes(crimes: DataFrame, places: DataFrame, types: DataFrame, salts: int = 1) -> DataFrame:
    """Crimes with their place key and code columns.

    Places are distinct by five columns but joined on three, so a crime can meet several; the code
    columns come from the code table and are NULL on a miss.
    """
    slim = crimes.select(
        "crime_id", "case_number", "crime_datetime", "crime_date", "crime_hour", "crime_day_of_week", "crime_month",
        "crime_year", *[s.coalesce_default(c, False).alias(c) for c in ("is_arrest", "is_domestic")],
        "primary_type", "fbi_code", F.col("iucr_code").alias("_code"), "block", "latitude", "longitude")
    placed = join_multi_key(slim, places.select("location_key", "block", "latitude", "longitude"),
                            ["block", "latitude", "longitude"], salts=salts).drop("block", "latitude", "longitude")
    return placed.join(types, placed["_code"] == types["iucr_code"], "left").drop("_code")


def fact_arrests(arrests: DataFrame, crimes: DataFrame, types: DataFrame) -> DataFrame:
    """Arrests with the code columns of the crimes of the same case and day."""
    with_code = join_key_and_day(arrests, crimes, "case_number", "arrest_date", "crime_date", {"iucr_code": "_code"})
    return with_code.join(types, with_code["_code"] == types["iucr_code"], "left").drop("_code")


def agg_daily_crimes(crimes: DataFrame, places: DataFrame) -> DataFrame:
    """Joined before they are counted: place keys are long and a place has few crimes a day, so counts per place would be
    about as many rows to shuffle as the crimes, and would be shuffled once more by area."""
    area = places.select("location_key", "district_id", "community_area_id")
    slim = crimes.select("location_key", "crime_date", "primary_type", "is_arrest", "is_domestic")
    return aggregates.daily_crimes(join_using(slim, area, "location_key"))


def gold_tables(crimes: DataFrame, arrests: DataFrame, codes: DataFrame,
                keep: Callable[[str, DataFrame], DataFrame] = keep_inline) -> dict[str, DataFrame]:
    """Every gold model by name, from the three silver tables; ``keep`` decides how models are kept."""
    out: dict[str, DataFrame] = {}

    def add(name: str, build: Callable[..., DataFrame], *inputs: DataFrame | str) -> None:
        out[name] = keep(name, build(*[out[i] if isinstance(i, str) else i for i in inputs]))

    add("stg_ucr_codes", stg_ucr_codes, codes)
    add("stg_crimes", stg_crimes, crimes, "stg_ucr_codes")
    add("stg_arrests", stg_arrests, arrests)
    add("dim_location", dim_location, "stg_crimes")
    add("dim_crime_type", dim_crime_type, "stg_ucr_codes")
    add("fact_crimes", fact_crimes, "stg_crimes", "dim_location", "dim_crime_type")
    add("fact_arrests", fact_arrests, "stg_arrests", "fact_crimes", "dim_crime_type")
    add("agg_daily_crimes", agg_daily_crimes, "fact_crimes", "dim_location")
    return out


def run_crime(spark: SparkSession, bronze: str, silver_layer: str = "silver", gold_layer: str = "gold",
              strict: bool = False, buckets: int | None = None) -> dict[str, DataFrame]:
    """From the bronze folders to the gold tables, each model written once; ends with the data checks.

    Crimes and arrests are added to their silver tables: every bronze file is read once, whenever it was committed and
    whatever its load time, and ids that are there already are left out; a run that breaks off is taken up again without
    loss or repeats. Silver is bucketed by id, into ``buckets`` or as many as the
    size of the first bronze files asks for. Codes and gold tables are replaced. ``strict`` raises on violations, after
    the tables are written; otherwise ``checks`` holds the report.
    """
    keep = keep_tables(silver_layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {silver_layer}")
    crimes, arrests = (
        _consume_bronze(spark, f"{bronze}/{folder}", f"{silver_layer}.silver_{folder}", build, key, buckets)
        for folder, build, key in (("crimes", silver_crimes, "crime_id"), ("arrests", silver_arrests, "arrest_id")))
    codes = keep("silver_ucr_codes", silver_ucr_codes(scan_recursive(spark, f"{bronze}/iucr")))
    # Both sides of the arrests' join are written in buckets by its first column, on which they then meet without a shuffle.
    number = bucket_count(spark, f"{silver_layer}.silver_arrests") or buckets or 8
    dealt = dict.fromkeys(("stg_arrests", "fact_crimes"), (number, "case_number"))
    with small_splits(spark), settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
        tables = gold_tables(crimes, arrests, codes, keep_tables(gold_layer, dealt))
    return checked(tables, CRIME_CHECKS, strict)


def _consume_bronze(spark: SparkSession, folder: str, name: str, build: Callable[..., DataFrame], key: str,
                    buckets: int | None = None) -> DataFrame:
    """Add the typed rows of the bronze files that the silver table has not seen, with the newest load time among them."""
    consume_files(spark, folder, consumed_path(spark, name), bronze_taker(folder, name, build, key, buckets))
    return spark.table(name).drop("load_timestamp", "increment")


def bronze_taker(folder: str, name: str, build: Callable[..., DataFrame], key: str,
                 buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """What :func:`consume_files` is to do with the raw rows of an increment: add their typed rows to a silver table.

    They are dealt into the table's buckets as they are read, and then meet their copies and the known ids without a shuffle.
    """
    def take(raw: DataFrame, number: int) -> None:
        spark, arriving = raw.sparkSession, f"{name}_arriving_{uuid.uuid4().hex}"
        known = bucket_count(spark, name) if spark.catalog.tableExists(name) else None
        dealt = known or buckets or buckets_for(spark, folder)
        newest = raw.agg(F.max("load_timestamp")).first()[0]
        try:
            rows = build(raw, lambda typed: deal_by_key(typed, arriving, key, dealt))
            append_new_keys(rows.withColumn("load_timestamp", F.lit(newest)), name, key, number, dealt)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {arriving}")

    return take
