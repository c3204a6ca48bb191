"""One row per key, sorting and limiting.

"First per key" is ``row_number() = 1``: Spark then keeps only the first row of each key in every map
task before the shuffle (``WindowGroupLimit``), so copies of one key do not pile up in a reducer.
Orders must end in a unique column, or the kept row is arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.columns import quoted


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1,
                  rank: str = "rn") -> DataFrame:
    """The first ``n`` rows of each key, with their rank."""
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return top_per_group(df, keys, order, rank="_rn").drop("_rn")


# Fixed value: columns that identify one taxi trip.
TRIP_IDENTITY = ("vendor_id", "pu_location_id", "do_location_id", "pickup_datetime", "dropoff_datetime")


def dedup_row_number(df: DataFrame, tie_break: Sequence[Column | str] = (),
                     keys: Sequence[str] = TRIP_IDENTITY) -> DataFrame:
    """One row per trip, keeping the row number (always 1) as column ``rn``."""
    return top_per_group(df, keys, list(tie_break) or [quoted(keys[0])])


def latest_per_key(df: DataFrame, key: str, updated: str, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Newest row per key; an unknown update time counts as newest."""
    return first_per_key(df, [key], [F.desc_nulls_first(updated), *tie_break])


def distinct_on_columns(df: DataFrame, keys: Sequence[str], tie_break: Sequence[Column | str]) -> DataFrame:
    """One row per combination of the key columns."""
    return first_per_key(df, keys, tie_break)


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: any row, or with ``order`` the first one."""
    return first_per_key(df, keys, order) if order else df.dropDuplicates(list(keys))


def sorted_output(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order)


def limit_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows; with an order Spark takes the top ``n`` of each task and merges those."""
    return (df.orderBy(*order) if order else df).limit(n)
