"""Aggregations. All combine on the map side, so a hot group reaches its reducer as one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalars import any_row, conditional_count, conditional_share, day_name, run_time
from lakemart.operators.columns import quoted


def zone_summary(trips: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """Per pick-up zone: trips, averages, colour shares in percent, longest trip, smallest tip."""
    return trips.groupBy(zone).agg(
        F.count("*").alias("total_trips"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("trip_distance", "total_amount", "tip_amount")],
        *[conditional_share(F.col("taxi_type") == colour).alias(f"{colour}_share") for colour in ("yellow", "green")],
        F.max("trip_distance").alias("max_trip_distance"),
        F.min("tip_amount").alias("min_tip_amount"),
    )


def zone_days(trips: DataFrame, zone: str = "pickup_zone", high_fare: float = 30) -> DataFrame:
    """Per weekday and zone: trips and the share of fares above ``high_fare``; weekday by name."""
    grouped = trips.groupBy("pickup_day_of_week", zone).agg(
        F.count("*").alias("total_trips"),
        conditional_share(F.col("fare_amount") > high_fare).alias("high_fare_share"),
    )
    return grouped.withColumn("pickup_day_of_week", day_name("pickup_day_of_week"))


# Measures the zone reports average.
_ZONE_SUMS = ("trip_distance", "total_amount", "tip_amount")


def zone_totals(trips: DataFrame, by: Sequence[str], high_fare: float = 30) -> DataFrame:
    """Sums and counts from which :func:`merge_zone_summary` and :func:`merge_zone_days` derive both reports."""
    flags = {"yellow": F.col("taxi_type") == "yellow", "green": F.col("taxi_type") == "green",
             "high_fare": F.col("fare_amount") > high_fare}
    return trips.groupBy(*by).agg(
        F.count("*").alias("trips"),
        *[F.sum(c).alias(f"sum_{c}") for c in _ZONE_SUMS], *[F.count(c).alias(f"n_{c}") for c in _ZONE_SUMS],
        *[F.count_if(c).alias(f"sum_{n}") for n, c in flags.items()], *[F.count(c).alias(f"n_{n}") for n, c in flags.items()],
        F.max("trip_distance").alias("max_trip_distance"), F.min("tip_amount").alias("min_tip_amount"),
    )


def _merged_avg(name: str) -> Column:
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def merge_zone_summary(totals: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """:func:`zone_summary` from finer totals."""
    return totals.groupBy(zone).agg(
        F.sum("trips").alias("total_trips"), *[_merged_avg(c).alias(f"avg_{c}") for c in _ZONE_SUMS],
        *[(_merged_avg(c) * 100).alias(f"{c}_share") for c in ("yellow", "green")],
        F.max("max_trip_distance").alias("max_trip_distance"), F.min("min_tip_amount").alias("min_tip_amount"),
    )


def merge_zone_days(totals: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """:func:`zone_days` from finer totals."""
    grouped = totals.groupBy("pickup_day_of_week", zone).agg(
        F.sum("trips").alias("total_trips"), (_merged_avg("high_fare") * 100).alias("high_fare_share"))
    return grouped.withColumn("pickup_day_of_week", day_name("pickup_day_of_week"))


def zone_averages(trips: DataFrame, zone: str = "pickup_zone", with_count: bool = False,
                  with_total: bool = False) -> DataFrame:
    measures = [F.avg(c).alias(f"avg_{c}") for c in ("trip_distance", "total_amount", "tip_amount")]
    measures += [F.max(c).alias(f"max_{c}") for c in ("trip_distance", "tip_amount")]
    if with_count:
        measures.append(F.count("*").alias("total_trips"))
    if with_total:
        measures.append(F.sum("total_amount").alias("total_amount"))
    return trips.groupBy(zone).agg(*measures)


def hourly_stats(trips: DataFrame, at=None) -> DataFrame:
    """Per known pick-up hour: trips, average distance and amount, and the time of the run."""
    grouped = trips.filter(F.col("pickup_hour").isNotNull()).groupBy("pickup_hour").agg(
        F.count("*").alias("total_trips"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("total_amount").alias("avg_total_amount"),
    )
    return grouped.select(run_time(at).cast("timestamp").alias("ts"), "*")


def team_profiles(players: DataFrame) -> DataFrame:
    """Per club, its name and league; players without a club are left out."""
    return (
        players.filter(F.col("club_team_id").isNotNull())
        .groupBy(F.col("club_team_id").alias("club_id"), "club_name", "league_id")
        .agg(F.sum("value_eur").alias("total_value"), F.avg("overall").alias("avg_overall"),
             F.avg("age").alias("avg_age"), F.sum("potential").alias("total_potential"))
    )


def league_players(players: DataFrame, young_until: int = 23, old_after: int = 85) -> DataFrame:
    """Per league: distinct players, whether it has talents, and averages."""
    talent = (F.col("age") <= young_until) | (F.col("age") > old_after)
    return players.groupBy("league_id", "league_name").agg(
        F.count_distinct("player_id").alias("total_players"),
        any_row(talent).alias("has_talents"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("overall", "potential", "age", "value_eur", "wage_eur")],
    )


def league_teams(teams: DataFrame) -> DataFrame:
    """Average of the team totals per league."""
    return teams.groupBy("league_id").agg(F.avg("total_value").alias("avg_team_cost"),
                                          F.avg("total_potential").alias("avg_team_potential"))


def club_players(players: DataFrame) -> DataFrame:
    """Per club: squad size, averages and totals."""
    return players.groupBy("club_id").agg(*_club_measures())


def _club_measures() -> list[Column]:
    return [F.count_distinct("player_id").alias("player_count"),
            F.avg("overall").alias("avg_overall_players"), F.avg("potential").alias("avg_potential_players"),
            F.sum("value_eur").alias("total_value_players"), F.sum("wage_eur").alias("total_wages"),
            F.avg("age").alias("avg_age_players")]


def max_gap(players: DataFrame) -> DataFrame:
    return players.groupBy("club_id").agg(F.max(F.col("potential") - F.col("overall")).alias("max_overperformance"))


def club_metrics(players: DataFrame) -> DataFrame:
    """Squad totals, largest gap and best player of each club in a single grouping.

    The best player has the highest rating, an unknown rating ranking above all, and of equals the
    smallest id.
    """
    order = F.struct(F.col("overall").isNotNull(), -F.col("overall"), F.col("player_id"))
    best = F.min_by(F.struct("player_id", "overall"), order)
    return (
        players.groupBy("club_id")
        .agg(*_club_measures(), best.alias("best"),
             F.max(F.col("potential") - F.col("overall")).alias("max_overperformance"))
        .withColumns({"best_player_id": F.col("best.player_id"), "best_player_overall": F.col("best.overall")})
        .drop("best")
    )


def trip_totals(trips: DataFrame, grain: Column) -> DataFrame:
    """Sums that :func:`finish_trip_facts` can merge, one row per grain, zone pair and taxi type."""
    return trips.groupBy(grain, "pu_location_id", "do_location_id", "taxi_type").agg(
        *[F.sum(c).alias(c) for c in ("fee", "extra", "total_amount", "trip_distance", "trip_duration_minutes")],
        F.count("trip_duration_minutes").alias("timed"),
        F.count("taxi_type").alias("typed"),
    )


def finish_trip_facts(totals: DataFrame, grain: str) -> DataFrame:
    """Merge the per-type totals; the type with most trips wins, the smallest name among equals."""
    rank = F.when(F.col("typed") > 0, F.struct(-F.col("typed"), F.col("taxi_type")))
    zero, minutes = F.lit(0), F.sum("trip_duration_minutes") / F.sum("timed")
    return totals.groupBy(grain, "pu_location_id", "do_location_id").agg(
        F.coalesce(F.sum("fee"), zero).alias("total_fee"),
        F.coalesce(F.sum("extra"), zero).alias("total_extra"),
        F.coalesce(F.sum("total_amount"), zero).alias("total_amount"),
        F.coalesce(F.sum("trip_distance"), zero).alias("total_trip_distance"),
        F.coalesce(F.when(F.sum("timed") > 0, minutes), zero).alias("avg_trip_duration_minutes"),
        F.coalesce(F.min_by("taxi_type", rank), F.lit("-")).alias("most_trips_by"),
    )


def mode_value(df: DataFrame, by: Sequence[str], column: str, out: str = "mode") -> DataFrame:
    """Most frequent non-NULL value per group, the smallest among equals; NULL if there is none.

    Counted per (group, value) first: a group is never held as one list or map of its values.
    """
    counts = df.groupBy(*by, column).agg(F.count(column).alias("_n"))
    rank = F.when(F.col("_n") > 0, F.struct(-F.col("_n"), quoted(column)))
    return counts.groupBy(*by).agg(F.min_by(quoted(column), rank).alias(out))


def daily_crimes(crimes: DataFrame, by: Sequence[str] = ("district_id", "community_area_id")) -> DataFrame:
    """Per day, type and the ``by`` columns: crimes, those with an arrest, domestic ones."""
    return crimes.groupBy("crime_date", "primary_type", *by).agg(
        F.count("*").alias("total_crimes"),
        conditional_count(F.col("is_arrest")).alias("crimes_with_arrest"),
        conditional_count(F.col("is_domestic")).alias("domestic_crimes"),
    )


def share_by(df: DataFrame, by: Sequence[str], shares: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[conditional_share(c).alias(name) for name, c in shares.items()])


def count_by(df: DataFrame, by: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[conditional_count(c).alias(name) for name, c in counts.items()])


def row_count(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """One row with the number of rows, as a lazy frame."""
    return (df if condition is None else df.filter(condition)).agg(F.count("*").alias("row_count"))


def column_profile(df: DataFrame) -> DataFrame:
    """Non-NULL count of every column, one pass over the data: rows ``(column, non_null, row_count)``."""
    totals = df.agg(F.count("*").alias("_rows"), *[F.count(quoted(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("non_null"))
                      for i, c in enumerate(df.columns)])
    return totals.select(F.inline(pairs), F.col("_rows")).withColumnRenamed("_rows", "row_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*map(quoted, keys)).agg(F.count("*").alias("cnt")).filter("cnt > 1")


def distinct_count(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct(column).alias("distinct_values"))
