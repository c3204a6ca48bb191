"""Row filters. Plain column comparisons are kept apart from computed ones so that Spark can push
them into the Parquet scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalars import trimmed_length

# Fixed value: merchants the fraud rule watches.
WATCHED_MERCHANTS = ("Amazon", "Paypal")

def filter_anomalies(df: DataFrame, min_distance: float = 0.1, min_total: float = 2, min_minutes: float = 1,
                     minutes: str = "duration_min") -> DataFrame:
    """Drop trips that are too short, too cheap or too quick; NULL measures go too."""
    return df.filter((F.col("trip_distance") >= min_distance) & (F.col("total_amount") >= min_total)
                     & (F.col(minutes) >= min_minutes))


def filter_valid_trips(df: DataFrame, passengers: tuple[int, int] = (1, 6)) -> DataFrame:
    return df.filter((F.col("trip_distance") > 0) & (F.col("total_amount") > 0)
                     & F.col("passenger_count").between(*passengers))


def filter_sql(df: DataFrame, condition: str, **args) -> DataFrame:
    """Rows that meet a condition given as SQL text, whose ``:name`` parameters come from ``args``."""
    return df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {condition}", args, rows=df)


def filter_consistent_trips(df: DataFrame, passengers: tuple[int, int] = (1, 6)) -> DataFrame:
    return df.filter(F.col("passenger_count").between(*passengers)
                     & (F.col("dropoff_datetime") > F.col("pickup_datetime"))
                     & (F.col("trip_duration_minutes") > 0))


def filter_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def filter_nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(trimmed_length(column) > 0)


def filter_flag(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text or boolean flag reads as true."""
    return df.filter(F.col(column).try_cast("boolean"))


def is_suspicious(min_amount: float = 1000, merchants: Sequence[str] = WATCHED_MERCHANTS) -> Column:
    return (F.col("amount") > min_amount) & F.col("merchant").isin(*merchants) & F.col("is_fraud")


def filter_suspicious(df: DataFrame, min_amount: float = 1000,
                      merchants: Sequence[str] = WATCHED_MERCHANTS) -> DataFrame:
    """The fraud rule; stateless, so the same call serves batch and streaming frames."""
    return df.filter(is_suspicious(min_amount, merchants))


def filter_valid_date(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.year(column).isNotNull())


def all_equal(values: Mapping[str, object]) -> Column:
    return reduce(and_, [F.col(c) == F.lit(v) for c, v in values.items()])


def filter_equals_all(df: DataFrame, values: Mapping[str, object], remove: bool = False) -> DataFrame:
    """Rows equal to every given value, or with ``remove`` all the others (unknown counts as unequal)."""
    match = all_equal(values)
    return df.filter(~F.coalesce(match, F.lit(False)) if remove else match)
