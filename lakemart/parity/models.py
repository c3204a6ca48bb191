"""The end-to-end plans, model by model."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import cached_property

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.quality import quality_report
from lakemart.operators.unions import union_by_name
from lakemart.parity.registry import query, rounded
from lakemart.parity.relational import HOURLY_SQL, RUN_TIME, ZONE_DAYS_SQL, ZONE_SUMMARY_SQL
from lakemart.parity.row_level import AGE_SQL, ROLE_SQL, SQL_ID, TRIP_ID
from lakemart.parity.storage import RAW_CSV, raw_taxi_files
from lakemart.parity.views import Tables
from lakemart.plans import crime, players, taxi, trip_facts, warehouse
from lakemart.session import scratch_database, scratch_path, small_splits
from lakemart.sources.increments import consume_files, consumed_path
from lakemart.sources.sinks import PACKED, keep_tables


# --- zone reports -----------------------------------------------------------------------------


def _reports(t: Tables):
    trips = taxi.unify_trips(t.raw_trips("yellow"), t.raw_trips("green"))
    return taxi.zone_reports(taxi.trip_zone_totals(trips, t.zones(), "location_id", "zone"))


@query("report_zone_statistic", ZONE_SUMMARY_SQL)
def _(t: Tables):
    return _reports(t)["zone_statistic"]


@query("report_zone_days", ZONE_DAYS_SQL)
def _(t: Tables):
    return _reports(t)["zone_days_statistic"]


# --- warehouse --------------------------------------------------------------------------------


def _colour(t: Tables, colour: str):
    return t.trips().filter(F.col("taxi_type") == colour).drop("taxi_type")


ENRICHED_SQL = """(SELECT t.*, p.zone AS pickup_zone, d.zone AS dropoff_zone FROM trips t
    LEFT JOIN zone_ids p ON p.location_id = t.pu_location_id LEFT JOIN zone_ids d ON d.location_id = t.do_location_id)"""
VALID_SQL = "trip_distance > 0 AND total_amount > 0 AND passenger_count BETWEEN 1 AND 6"


def _both(t: Tables, build) -> DataFrame:
    """A model of either colour, tagged."""
    sides = [build(warehouse.enriched(_colour(t, c), t.zones())).withColumn("taxi_type", F.lit(c)) for c in ("yellow", "green")]
    return sides[0].unionByName(sides[1])


@query("warehouse_enriched", f"SELECT {SQL_ID}, pickup_zone, dropoff_zone, taxi_type FROM {ENRICHED_SQL}")
def _(t: Tables):
    return _both(t, lambda rows: rows.select(*TRIP_ID, "pickup_zone", "dropoff_zone"))


@query("warehouse_preprocessed", f"""SELECT {SQL_ID}, pickup_zone, hour(pickup_datetime) AS pickup_hour,
    (['Short', 'Medium', 'Long'])[1 + CAST(trip_distance >= 2 AS INT) + CAST(trip_distance > 10 AS INT)] AS trip_category, taxi_type
    FROM {ENRICHED_SQL} WHERE {VALID_SQL}""")
def _(t: Tables):
    return _both(t, lambda rows: warehouse.preprocessed(rows).select(*TRIP_ID, "pickup_zone", "pickup_hour", "trip_category"))


AVERAGED_SQL = f"""SELECT pickup_zone, avg(trip_distance) AS avg_trip_distance, avg(total_amount) AS avg_total_amount,
    avg(tip_amount) AS avg_tip_amount, max(trip_distance) AS max_trip_distance, max(tip_amount) AS max_tip_amount, taxi_type
    FROM {ENRICHED_SQL} WHERE {VALID_SQL} GROUP BY pickup_zone, taxi_type"""


@query("warehouse_zone_aggregated", AVERAGED_SQL)
def _(t: Tables):
    return _both(t, lambda rows: warehouse.zone_aggregated(warehouse.preprocessed(rows)))


def _hourly_sql(colour: str) -> str:
    valid = HOURLY_SQL.replace("FROM prepared", f"FROM prepared WHERE taxi_type = '{colour}' AND {VALID_SQL}")
    return f"SELECT *, '{colour}' AS taxi_type FROM ({valid})"


@query("warehouse_hourly_stats", f"{_hourly_sql('yellow')} UNION ALL {_hourly_sql('green')}")
def _(t: Tables):
    at = F.lit(RUN_TIME).cast("timestamp_ntz")
    return _both(t, lambda rows: warehouse.zone_hourly_stats(warehouse.preprocessed(rows), at))


@query("warehouse_all_trips", f"""SELECT vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime, pu_location_id,
    do_location_id, ratecode_id, payment_type, pickup_zone, dropoff_zone, CASE WHEN taxi_type = 'yellow' THEN fee END AS fee,
    upper(taxi_type) AS taxi_color, total_amount FROM {ENRICHED_SQL}""")
def _(t: Tables):
    sides = []
    for colour in ("yellow", "green"):
        rows = _colour(t, colour).withColumns({c: F.lit(0.0) for c in (
            "congestion_surcharge", "tolls_amount", "mta_tax", "improvement_surcharge")})
        sides.append(warehouse.enriched(rows, t.zones()))
    both = warehouse.all_trips(sides[0], sides[1].drop("fee"))
    return both.select("vendor_id", "pickup_datetime", "pu_location_id", "do_location_id", "ratecode_id", "payment_type",
                       "pickup_zone", "dropoff_zone", "fee", "taxi_color", "total_amount")


def _warehouse(t: Tables) -> dict[str, DataFrame]:
    """Two runs over files; the second one finds the zones as they were and no trip of the first order."""
    root, layer = raw_taxi_files(t), scratch_database(t.spark)
    for position in (1, 2):
        if position == 2:
            t.raw_trips("green").filter("order_key <> 1").write.mode("overwrite").options(**PACKED).parquet(f"{root}/green")
            t.raw_trips("yellow").filter("order_key <> 1").write.mode("overwrite").options(**PACKED).parquet(f"{root}/yellow")
        out = warehouse.run_warehouse(t.spark, [f"{root}/yellow"], [f"{root}/green"], f"{root}/zones", layer, position,
                                      datetime(2024, 5, 1, 11 + position, tzinfo=timezone.utc))
    return out


@query("run_warehouse_zones", AVERAGED_SQL.replace("WHERE ", "WHERE order_key <> 1 AND "))
def _(t: Tables):
    out = _warehouse(t)
    sides = [out[f"{c}_zone_aggregated"].withColumn("taxi_type", F.lit(c)) for c in ("yellow", "green")]
    return sides[0].unionByName(sides[1])


@query("run_warehouse_history", " UNION ALL ".join(
    _hourly_sql(c).replace("WHERE ", "WHERE order_key <> 1 AND " if k else "WHERE ").replace(RUN_TIME, f"2024-05-01 {12 + k}:00:00")
    for k in (0, 1) for c in ("yellow", "green")))
def _(t: Tables):
    out = _warehouse(t)
    sides = [out[f"{c}_hourly_stats"].withColumn("taxi_type", F.lit(c)) for c in ("yellow", "green")]
    return sides[0].unionByName(sides[1])


@query("run_warehouse_trips", f"""SELECT 'trips' AS part, NULL AS position, NULL AS action, vendor_id, pickup_zone, dropoff_zone,
        upper(taxi_type) AS taxi_color, total_amount FROM {ENRICHED_SQL} WHERE order_key <> 1
    UNION ALL SELECT 'changes', 1, 'INSERT', vendor_id, pickup_zone, dropoff_zone, upper(taxi_type), total_amount FROM {ENRICHED_SQL}
    UNION ALL SELECT 'changes', 2, 'DELETE', vendor_id, pickup_zone, dropoff_zone, upper(taxi_type), total_amount
        FROM {ENRICHED_SQL} WHERE order_key = 1""")
def _(t: Tables):
    out = _warehouse(t)
    names = ("vendor_id", "pickup_zone", "dropoff_zone", "taxi_color", "total_amount")
    trips = out["all_trips"].select(F.lit("trips").alias("part"), F.lit(None).cast("int").alias("position"),
                                    F.lit(None).cast("string").alias("action"), *names)
    return trips.unionByName(out["all_trips_changes"].select(F.lit("changes").alias("part"), "position", "action", *names))


# --- trip facts -------------------------------------------------------------------------------


def _raw(t: Tables, colour: str):
    fee = {"yellow": "airport_fee", "green": "fee"}[colour]
    raw = t.trip_copies().filter(F.col("taxi_type") == colour).drop("taxi_type").withColumnsRenamed(
        {"vendor_id": "VendorID", "pu_location_id": "PULocationID", "do_location_id": "DOLocationID", "fee": fee})
    return raw.withColumn("trip_type", F.lit(1.0)) if colour == "yellow" else raw


TIE_BREAK = ("order_key", "part_key", "copy")


class Trips:
    """The trip models, each built when asked for."""

    def __init__(self, t: Tables):
        self.t = t
        self.zones = t.zones()
        self.locations = trip_facts.locations(self.zones)

    def clean(self, colour: str) -> DataFrame:
        return trip_facts.taxi_clean(_raw(self.t, colour))

    def stage(self, colour: str) -> DataFrame:
        return trip_facts.taxi_stage(self.clean(colour), self.zones, "location_id", "borough")

    @cached_property
    def trips(self) -> DataFrame:
        return trip_facts.trips(self.clean("green"), self.clean("yellow"), TIE_BREAK)


STAGE_SQL = """(SELECT t.*, p.borough AS pickup_borough, d.borough AS dropoff_borough, hour(pickup_datetime) AS pickup_hour,
        date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 AS trip_duration_minutes FROM trip_copies t
    LEFT JOIN zone_ids p ON p.location_id = t.pu_location_id LEFT JOIN zone_ids d ON d.location_id = t.do_location_id
    WHERE trip_distance > 0 AND total_amount > 0 AND total_amount <= 500 AND passenger_count BETWEEN 0 AND 6)"""
TRIPS_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY taxi_type, vendor_id, pu_location_id, do_location_id,
        pickup_datetime, dropoff_datetime ORDER BY order_key, part_key, copy) AS rn FROM {STAGE_SQL})
    WHERE rn = 1 AND trip_duration_minutes > 0 AND passenger_count BETWEEN 1 AND 6 AND dropoff_datetime > pickup_datetime)"""


def _fact_sql(grain: str, name: str, source: str = TRIPS_SQL) -> str:
    """Sums of distinct trips; the colour is the one of the larger count, the first of the alphabet if they tie."""
    return f"""SELECT {name}, pu_location_id, do_location_id, coalesce(fees, 0) AS total_fee, coalesce(extras, 0) AS total_extra,
        coalesce(totals, 0) AS total_amount, coalesce(miles, 0) AS total_trip_distance, coalesce(minutes / timed, 0) AS avg_trip_duration_minutes,
        CASE WHEN greens >= yellows THEN 'green' ELSE 'yellow' END AS most_trips_by
    FROM (SELECT {grain} AS {name}, pu_location_id, do_location_id, sum(fee) AS fees, sum(extra) AS extras, sum(total_amount) AS totals,
            sum(trip_distance) AS miles, sum(trip_duration_minutes) AS minutes, count(trip_duration_minutes) AS timed,
            sum(CAST(taxi_type = 'green' AS INT)) AS greens, sum(CAST(taxi_type = 'yellow' AS INT)) AS yellows
        FROM {source} WHERE pu_location_id IN (FROM known_zones) AND do_location_id IN (FROM known_zones) GROUP BY ALL)"""


@query("taxi_stage", f"""SELECT {SQL_ID}, copy, pickup_borough, dropoff_borough, pickup_hour, trip_duration_minutes, taxi_type
    FROM {STAGE_SQL}""")
def _(t: Tables):
    names = (*TRIP_ID, "copy", "pickup_borough", "dropoff_borough", "pickup_hour", "trip_duration_minutes")
    sides = [Trips(t).stage(c).select(*names).withColumn("taxi_type", F.lit(c)) for c in ("yellow", "green")]
    return sides[0].unionByName(sides[1])


@query("locations", "SELECT location_id, borough, zone, service_zone FROM zone_ids")
def _(t: Tables):
    return Trips(t).locations


@query("trips", f"""SELECT vendor_id, pu_location_id, do_location_id, ratecode_id, payment_type, passenger_count, total_amount, fare_amount,
    fee, extra, trip_distance, trip_duration_minutes, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
    strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime, CASE WHEN taxi_type = 'yellow' THEN 1 END AS trip_type,
    store_and_fwd_flag, pickup_hour, taxi_type FROM {TRIPS_SQL}""")
def _(t: Tables):
    return Trips(t).trips


@query("fact_trip_summary_daily", _fact_sql("strftime(pickup_datetime, '%Y-%m-%d')", "pickup_date"))
def _(t: Tables):
    m = Trips(t)
    return trip_facts.fact_trip_summary_daily(m.trips, m.locations)


@query("fact_trip_summary_hourly", _fact_sql("pickup_hour", "pickup_hour"))
def _(t: Tables):
    m = Trips(t)
    return trip_facts.fact_trip_summary_hourly(m.trips, m.locations)


@query("trip_facts_kept", _fact_sql("pickup_hour", "pickup_hour"))
def _(t: Tables):
    kept = trip_facts.trip_tables(_raw(t, "green"), _raw(t, "yellow"), t.zones(), TIE_BREAK, "location_id", "borough",
                                  keep_tables(scratch_database(t.spark)))
    return kept["fact_trip_summary_hourly"]


def _violations(*lines: str) -> str:
    """Report lines as SQL: ``check|table|column|query`` with one count."""
    return " UNION ALL ".join(
        "SELECT '{}' AS \"check\", '{}' AS \"table\", '{}' AS \"column\", CAST(({}) AS BIGINT) AS violations".format(*line.split("|", 3))
        for line in lines)


def _nulls(table: str, source: str, *columns: str) -> list[str]:
    return [f"not_null|{table}|{c}|SELECT count(*) - count({c}) FROM {source}" for c in columns]


def _repeats(table: str, source: str, column: str) -> str:
    return f"unique|{table}|{column}|SELECT count(*) FROM (SELECT {column} FROM {source} GROUP BY 1 HAVING count({column}) > 1)"


def _false(table: str, source: str, *expressions: str) -> list[str]:
    return [f"expression|{table}|{e}|SELECT count(*) FROM {source} WHERE NOT ({e})" for e in expressions]


def _strays(table: str, source: str, column: str, parent: str, key: str) -> str:
    return (f"relationships|{table}|{column}|SELECT count(*) FROM {source} WHERE {column} IS NOT NULL "
            f"AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)")


def _trip_checks_sql(source: str) -> str:
    return _violations(
        _repeats("locations", "zone_ids", "location_id"), *_nulls("locations", "zone_ids", "borough", "zone", "service_zone"),
        *_nulls("trips", source, "pickup_datetime", "dropoff_datetime", "total_amount"),
        *_false("trips", source, "trip_duration_minutes > 0", "passenger_count BETWEEN 1 AND 6", "dropoff_datetime > pickup_datetime"))


@query("trip_checks", _trip_checks_sql(TRIPS_SQL))
def _(t: Tables):
    m, keep = Trips(t), keep_tables(scratch_database(t.spark))
    return quality_report({"trips": keep("trips", m.trips), "locations": keep("locations", m.locations)}, trip_facts.TRIP_CHECKS)


#: What files have to tell trips of one identity apart.
FILE_ORDER = ("ratecode_id", "extra", "total_amount", "fare_amount", "trip_distance")
RUN_TRIPS_SQL = TRIPS_SQL.replace("trip_copies t", "trips t").replace(
    "order_key, part_key, copy)", ", ".join(f"{c} NULLS FIRST" for c in FILE_ORDER) + ")")


def _trip_run(t: Tables) -> dict[str, DataFrame]:
    root = raw_taxi_files(t)
    return trip_facts.run_trip_facts(t.spark, [f"{root}/yellow"], [f"{root}/green"], f"{root}/zones", scratch_database(t.spark),
                                     FILE_ORDER, strict=False)


@query("run_trip_facts", f"""SELECT taxi_type, vendor_id, pu_location_id, do_location_id, ratecode_id, payment_type,
    strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime, strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
    trip_duration_minutes, total_amount, fee FROM {RUN_TRIPS_SQL}""")
def _(t: Tables):
    return _trip_run(t)["trips"].select("taxi_type", "vendor_id", "pu_location_id", "do_location_id", "ratecode_id", "payment_type",
                                        "pickup_datetime", "dropoff_datetime", "trip_duration_minutes", "total_amount", "fee")


@query("run_trip_facts_daily", _fact_sql("strftime(pickup_datetime, '%Y-%m-%d')", "pickup_date", RUN_TRIPS_SQL))
def _(t: Tables):
    return _trip_run(t)["fact_trip_summary_daily"]


@query("run_trip_facts_hourly", _fact_sql("pickup_hour", "pickup_hour", RUN_TRIPS_SQL))
def _(t: Tables):
    return _trip_run(t)["fact_trip_summary_hourly"]


@query("run_trip_facts_checks", _trip_checks_sql(RUN_TRIPS_SQL))
def _(t: Tables):
    return _trip_run(t)["checks"]


# --- players ----------------------------------------------------------------------------------


class Players:
    """The player models, each built when asked for."""

    def __init__(self, t: Tables):
        self.t = t

    def staged(self, gender: str) -> DataFrame:
        return players.stg_players(self.t.players_male() if gender == "male" else self.t.players_female())

    def players(self, gender: str) -> DataFrame:
        staged = self.staged(gender)
        if gender == "male":
            return players.int_players_male(staged)
        return players.int_players_female(staged, [F.col("row_no").cast("long")])


def _team_sql(source: str) -> str:
    return f"""(SELECT club_team_id AS club_id, club_name, league_id, CAST(sum(value_eur) AS DOUBLE) AS total_value, avg(overall) AS avg_overall,
        avg(age) AS avg_age, CAST(sum(potential) AS BIGINT) AS total_potential FROM {source} WHERE club_team_id IS NOT NULL GROUP BY ALL)"""


def _register_gender(gender: str, source: str) -> None:
    @query(f"int_players_{gender}", f"SELECT player_id, club_team_id, overall, CAST(value_eur AS DOUBLE) AS value_eur, fifa_update_date, gender FROM {source}")
    def _(t: Tables):
        return Players(t).players(gender).select(
            "player_id", "club_team_id", "overall", "value_eur", "fifa_update_date", "gender")

    @query(f"int_team_profiles_{gender}", f"SELECT * REPLACE (round(avg_overall, 4) AS avg_overall, round(avg_age, 4) AS avg_age) FROM {_team_sql(source)}")
    def _(t: Tables):
        return rounded(players.int_team_profiles(Players(t).players(gender)), "avg_overall", "avg_age")

    averages = ("avg_overall", "avg_potential", "avg_age", "avg_value_eur", "avg_wage_eur")

    @query(f"int_league_insights_{gender}", f"""SELECT league_id, league_name, total_players, has_talents, {", ".join(averages)},
            avg_team_cost, avg_team_potential
        FROM (SELECT league_id, league_name, len(list_distinct(list(player_id))) AS total_players,
                coalesce(max(CAST(age NOT BETWEEN 24 AND 85 AS INT)), 0) = 1 AS has_talents,
                {", ".join(f"round(sum({a[4:]}) / count({a[4:]}), 4) AS {a}" for a in averages)} FROM {source} GROUP BY ALL)
        LEFT JOIN (SELECT league_id, round(sum(total_value) / count(*), 4) AS avg_team_cost,
                round(sum(total_potential) / count(*), 4) AS avg_team_potential FROM {_team_sql(source)} GROUP BY ALL) USING (league_id)""")
    def _(t: Tables):
        squad = Players(t).players(gender)
        leagues = players.int_league_insights(squad, players.int_team_profiles(squad))
        return rounded(leagues, *averages, "avg_team_cost", "avg_team_potential")

    @query(f"mart_player_profiles_{gender}", f"""SELECT player_id, overall, potential, potential - overall AS growth_gap, age, height_cm, weight_kg,
        CAST(value_eur AS DOUBLE) AS value_eur, CAST(wage_eur AS DOUBLE) AS wage_eur, release_clause_eur, pace, shooting, passing, dribbling, defending, physic, gender,
        {AGE_SQL} AS age_group, {ROLE_SQL} AS role_classification
        FROM {source}""")
    def _(t: Tables):
        return players.mart_player_profiles(Players(t).players(gender))


_register_gender("male", "male_clean")
_register_gender("female", "female_latest")


DASHBOARD_SQL = " UNION ALL ".join(f"""
    SELECT t.club_id || '_{gender}' AS club_id, t.club_name, t.league_id, coalesce(s.members, 0) AS player_count,
        round(coalesce(s.overall, t.avg_overall), 4) AS avg_overall, round(coalesce(s.potential, t.total_potential), 4) AS avg_potential,
        coalesce(s.worth, t.total_value) AS total_value, coalesce(s.wages, 0) AS total_wages, round(coalesce(s.years, t.avg_age), 4) AS avg_age,
        s.best.id AS best_player_id, s.best.rating AS best_player_overall, s.widest AS max_overperformance
    FROM {_team_sql(source)} t LEFT JOIN (
        SELECT club_team_id, count(DISTINCT player_id) AS members, avg(overall) AS overall, avg(potential) AS potential,
            CAST(sum(value_eur) AS DOUBLE) AS worth, CAST(sum(wage_eur) AS DOUBLE) AS wages, avg(age) AS years, max(potential - overall) AS widest,
            arg_min({{'id': player_id || '_{gender}', 'rating': overall}},
                {{'down': -coalesce(overall, 1000000), 'id': player_id || '_{gender}'}}) AS best
        FROM {source} GROUP BY club_team_id) s ON s.club_team_id = t.club_id"""
    for gender, source in (("male", "male_clean"), ("female", "female_latest")))


@query("mart_team_dashboard", DASHBOARD_SQL)
def _(t: Tables):
    keep = keep_tables(scratch_database(t.spark))
    squads = {g: keep(f"int_players_{g}", Players(t).players(g)) for g in ("male", "female")}
    teams = {g: players.int_team_profiles(squad) for g, squad in squads.items()}
    return rounded(players.mart_team_dashboard(squads, teams), "avg_overall", "avg_potential", "avg_age")


PLAYER_SOURCES = (("male", "male_clean"), ("female", "female_latest"))


def _league_flags(source: str) -> str:
    return f"(SELECT league_id, max(coalesce(CAST(age <= 23 OR age > 85 AS INT), 0)) = 1 AS has_talents FROM {source} GROUP BY ALL)"


PLAYER_CHECKS_SQL = _violations(*[line for g, source in PLAYER_SOURCES for line in (
    _repeats(f"int_players_{g}", source, "player_id"), *_nulls(f"int_players_{g}", source, "player_id", "value_eur", "wage_eur"),
    *_false(f"int_players_{g}", source, "wage_eur <= value_eur"), _repeats(f"int_team_profiles_{g}", _team_sql(source), "club_id"),
    *_nulls(f"int_team_profiles_{g}", _team_sql(source), "club_id", "league_id", "avg_overall"),
    *_false(f"int_team_profiles_{g}", _team_sql(source), "avg_overall BETWEEN 40 AND 100"),
    *_nulls(f"int_league_insights_{g}", _league_flags(source), "has_talents"),
    f"accepted_values|int_league_insights_{g}|has_talents|SELECT count(*) FROM {_league_flags(source)} WHERE has_talents NOT IN (TRUE, FALSE)")],
    "shared_ids|int_players|player_id|SELECT count(*) FROM (SELECT player_id FROM (SELECT player_id FROM male_clean "
    "UNION ALL SELECT player_id FROM female_latest) GROUP BY 1 HAVING count(*) > 1)")


def _player_run(t: Tables) -> dict[str, DataFrame]:
    """From files; teams and coaches are suppliers and customers under other names."""
    root = scratch_path(t.spark, "players")
    people = t.table("customer").select(F.col("c_custkey").alias("Coach ID"), F.col("c_nationkey").alias("nationality_id"),
                                        F.concat(F.lit(" "), "c_name").alias("Long Name"), F.lit("1980-02-03").alias("dob"))
    clubs = t.table("supplier").select(F.col("s_suppkey").alias("Team-ID"), F.col("s_nationkey").alias("league_id"),
                                       F.when(F.col("s_suppkey") % 3 == 0, "n/a").otherwise(F.col("s_name")).alias("team.name"))
    frames = {"male_players": t.players_male(), "female_players": t.players_female(), "male_teams": clubs, "female_teams": clubs,
              "male_coaches": people, "female_coaches": people}
    for name, frame in frames.items():
        frame.write.options(header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{name}")
    return players.run_players(t.spark, {n: f"{root}/{n}" for n in frames}, scratch_database(t.spark),
                               [F.col("row_no").cast("long")], strict=False)


@query("player_checks", PLAYER_CHECKS_SQL)
def _(t: Tables):
    keep = keep_tables(scratch_database(t.spark))
    tables = players.player_tables(t.players_male(), t.players_female(), [F.col("row_no").cast("long")], keep)
    return players.player_report(tables)


@query("run_players_checks", PLAYER_CHECKS_SQL)
def _(t: Tables):
    return _player_run(t)["checks"]


@query("run_players_dashboard", DASHBOARD_SQL)
def _(t: Tables):
    return rounded(_player_run(t)["mart_team_dashboard"], "avg_overall", "avg_potential", "avg_age")


@query("run_players_stages", """SELECT g AS gender, 'team' AS kind, s_suppkey AS id, s_nationkey AS number, CASE WHEN s_suppkey % 3 = 0 THEN 'n/a' ELSE trim(s_name) END AS name
    FROM supplier, (VALUES ('male'), ('female')) x(g)
    UNION ALL SELECT g, 'coach', c_custkey, c_nationkey, trim(c_name) FROM customer, (VALUES ('male'), ('female')) x(g)""")
def _(t: Tables):
    out, parts = _player_run(t), []
    for gender in ("male", "female"):
        for kind, table, names in (("team", "teams", ("team_id", "league_id", "team_name")),
                                   ("coach", "coaches", ("coach_id", "nationality_id", "long_name"))):
            parts.append(out[f"stg_{gender}_{table}"].select(
                F.lit(gender).alias("gender"), F.lit(kind).alias("kind"), F.col(names[0]).cast("long").alias("id"),
                F.col(names[1]).cast("long").alias("number"), F.col(names[2]).alias("name")))
    return union_by_name(*parts)


# --- crimes -----------------------------------------------------------------------------------

DAY = "strftime({0}, '%Y-%m-%d') AS {0}".format
TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}".format


class Crimes:
    """The crime models, each built when asked for; those that several others read are kept."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def keep(self):
        return keep_tables(scratch_database(self.t.spark))

    @cached_property
    def codes(self) -> DataFrame:
        return crime.stg_ucr_codes(crime.silver_ucr_codes(self.t.codes_raw()))

    @cached_property
    def crimes(self) -> DataFrame:
        return crime.stg_crimes(crime.silver_crimes(self.t.crimes_raw()), self.codes)

    @cached_property
    def kept_crimes(self) -> DataFrame:
        return self.keep("stg_crimes", self.crimes)

    @cached_property
    def arrests(self) -> DataFrame:
        return crime.stg_arrests(crime.silver_arrests(self.t.arrests_raw()))

    @cached_property
    def places(self) -> DataFrame:
        return crime.dim_location(self.kept_crimes)

    @cached_property
    def kept_places(self) -> DataFrame:
        return self.keep("dim_location", self.places)

    @cached_property
    def types(self) -> DataFrame:
        return crime.dim_crime_type(self.codes)

    @cached_property
    def facts(self) -> DataFrame:
        return crime.fact_crimes(self.kept_crimes, self.kept_places, self.types)

    @cached_property
    def kept_facts(self) -> DataFrame:
        return self.keep("fact_crimes", self.facts)


@query("silver_crimes", f"SELECT * REPLACE ({TIME('crime_datetime')}) FROM silver_crimes")
def _(t: Tables):
    return crime.silver_crimes(t.crimes_raw())


@query("silver_arrests", f"SELECT * REPLACE ({TIME('arrest_date')}) FROM silver_arrests")
def _(t: Tables):
    return crime.silver_arrests(t.arrests_raw())


@query("silver_ucr_codes", "SELECT * FROM silver_codes")
def _(t: Tables):
    return crime.silver_ucr_codes(t.codes_raw())


@query("stg_ucr_codes", "SELECT * FROM stg_codes")
def _(t: Tables):
    return Crimes(t).codes


@query("stg_crimes", f"SELECT * REPLACE ({TIME('crime_datetime')}, {DAY('crime_date')}) FROM stg_crimes")
def _(t: Tables):
    return Crimes(t).crimes


@query("stg_arrests", f"SELECT * REPLACE ({TIME('arrest_date')}) FROM silver_arrests WHERE arrest_date IS NOT NULL")
def _(t: Tables):
    return Crimes(t).arrests


@query("dim_location", "SELECT * FROM dim_location")
def _(t: Tables):
    return Crimes(t).places


@query("dim_crime_type", "SELECT * FROM dim_crime_type")
def _(t: Tables):
    return Crimes(t).types


@query("fact_crimes", f"SELECT * REPLACE ({TIME('crime_datetime')}, {DAY('crime_date')}) FROM fact_crimes")
def _(t: Tables):
    return Crimes(t).facts


@query("fact_arrests", f"SELECT * REPLACE ({TIME('arrest_date')}) FROM fact_arrests")
def _(t: Tables):
    m = Crimes(t)
    return crime.fact_arrests(m.arrests, m.kept_facts, m.types)


DAILY_SQL = f"""SELECT {DAY('crime_date')}, primary_type, district_id, community_area_id, count(*) AS total_crimes,
    count(*) FILTER (WHERE is_arrest) AS crimes_with_arrest, count(*) FILTER (WHERE is_domestic) AS domestic_crimes
    FROM fact_crimes LEFT JOIN (SELECT location_key AS lk, district_id, community_area_id FROM dim_location) ON lk = location_key
    GROUP BY crime_date, primary_type, district_id, community_area_id"""


@query("agg_daily_crimes", DAILY_SQL)
def _(t: Tables):
    m = Crimes(t)
    return crime.agg_daily_crimes(m.kept_facts, m.kept_places)


CHARGES = "(charge_one_type IN ('felony', 'misdemeanor', 'other'))"
VALID_ARRESTS = "(SELECT * FROM silver_arrests WHERE arrest_date IS NOT NULL)"
CRIME_CHECKS_SQL = _violations(
    *[line for table, source in (("stg_arrests", VALID_ARRESTS), ("fact_arrests", "fact_arrests")) for line in (
        _repeats(table, source, "arrest_id"), *_nulls(table, source, "arrest_id"),
        f"accepted_values|{table}|charge_one_type|SELECT count(*) FROM {source} WHERE NOT {CHARGES}")],
    _repeats("stg_crimes", "stg_crimes", "crime_id"), *_nulls("stg_crimes", "stg_crimes", "crime_id", "crime_date", "iucr_code", "primary_type"),
    _strays("stg_crimes", "stg_crimes", "iucr_code", "stg_codes", "iucr_code"),
    *_false("stg_crimes", "stg_crimes", "latitude BETWEEN 41.6 AND 42.1", "longitude BETWEEN -87.95 AND -87.5"),
    *[line for table, source in (("stg_ucr_codes", "stg_codes"), ("dim_crime_type", "dim_crime_type")) for line in (
        _repeats(table, source, "iucr_code"), *_nulls(table, source, "iucr_code", "primary_description"))],
    _repeats("dim_location", "dim_location", "location_key"), *_nulls("dim_location", "dim_location", "location_key", "latitude", "longitude"),
    _repeats("fact_crimes", "fact_crimes", "crime_id"), *_nulls("fact_crimes", "fact_crimes", "crime_id", "crime_date", "location_key", "iucr_code"),
    _strays("fact_crimes", "fact_crimes", "location_key", "dim_location", "location_key"),
    _strays("fact_crimes", "fact_crimes", "iucr_code", "dim_crime_type", "iucr_code"), *_nulls("fact_arrests", "fact_arrests", "arrest_date"),
    _strays("fact_arrests", "fact_arrests", "iucr_code", "dim_crime_type", "iucr_code"),
    *_nulls("agg_daily_crimes", f"({DAILY_SQL})", "crime_date", "total_crimes"),
    *_false("agg_daily_crimes", f"({DAILY_SQL})", "total_crimes >= crimes_with_arrest"))


@query("crime_checks", CRIME_CHECKS_SQL)
def _(t: Tables):
    keep = keep_tables(scratch_database(t.spark))
    with small_splits(t.spark):
        silver = [keep(name, df) for name, df in (
            ("silver_crimes", crime.silver_crimes(t.crimes_raw())), ("silver_arrests", crime.silver_arrests(t.arrests_raw())),
            ("silver_ucr_codes", crime.silver_ucr_codes(t.codes_raw())))]
    return quality_report(crime.gold_tables(*silver, keep), crime.CRIME_CHECKS)


def _loads(t: Tables, out: str, times: list[datetime]):
    """Bronze loads, one after another: first the even ids of crimes and arrests, then the odd ones with the even again."""
    raw, parts = scratch_path(t.spark, "raw"), ("even", "odd")
    t.codes_raw().write.options(**RAW_CSV).csv(f"{raw}/iucr")
    with small_splits(t.spark):  # a packed text file cannot be cut when it is read
        for name, key, rows in (("crimes", "ID", t.crimes_raw()), ("arrests", "CB_NO", t.arrests_raw())):
            even = F.coalesce(F.col(key).cast("long") % 2 == 0, F.lit(False))
            for part, kept in zip(parts, (even, ~even)):
                rows.filter(kept).write.options(**RAW_CSV).csv(f"{raw}/{name}/{part}")
    for load, at in enumerate(times):
        crimes, arrests = ([f"{raw}/{name}/{part}" for part in (parts if load else parts[:1])] for name in ("crimes", "arrests"))
        crime.load_bronze(t.spark, crimes, arrests, f"{raw}/iucr", out, at)
        yield load


def _crime_run(t: Tables) -> dict[str, DataFrame]:
    """Two loads, each followed by a run; the second is stamped earlier than the first."""
    out, silver, gold = scratch_path(t.spark, "bronze"), scratch_database(t.spark), scratch_database(t.spark)
    for _ in _loads(t, out, [datetime(2024, 5, 1, 12), datetime(2024, 5, 1, 11)]):
        tables = crime.run_crime(t.spark, out, silver, gold)
    return tables


@query("run_crime_exactly_once", f"""SELECT crime_id, {TIME('crime_datetime')}, description, is_arrest, latitude FROM silver_crimes""")
def _(t: Tables):
    """Three loads of one time; the second increment breaks off after its write, before the stream has noted it."""
    out, table = scratch_path(t.spark, "bronze"), f"{scratch_database(t.spark)}.silver_crimes"
    take = crime.bronze_taker(f"{out}/crimes", table, crime.silver_crimes, "crime_id")

    def breaks_off(raw: DataFrame, number: int) -> None:
        take(raw, number)
        raise OSError("the driver is lost here")

    for load in _loads(t, out, [datetime(2024, 5, 1, 12)] * 3):
        if load == 1:
            try:
                consume_files(t.spark, f"{out}/crimes", consumed_path(t.spark, table), breaks_off)
            except StreamingQueryException:
                continue
        consume_files(t.spark, f"{out}/crimes", consumed_path(t.spark, table), take)
    return t.spark.table(table).select("crime_id", "crime_datetime", "description", "is_arrest", "latitude")


@query("run_crime", DAILY_SQL)
def _(t: Tables):
    return _crime_run(t)["agg_daily_crimes"]


@query("run_crime_facts", f"SELECT * REPLACE ({TIME('crime_datetime')}, {DAY('crime_date')}) FROM fact_crimes")
def _(t: Tables):
    return _crime_run(t)["fact_crimes"]


@query("run_crime_arrests", f"SELECT * REPLACE ({TIME('arrest_date')}) FROM fact_arrests")
def _(t: Tables):
    return _crime_run(t)["fact_arrests"]


@query("run_crime_places", "SELECT * FROM dim_location")
def _(t: Tables):
    return _crime_run(t)["dim_location"]


@query("run_crime_checks", CRIME_CHECKS_SQL)
def _(t: Tables):
    return _crime_run(t)["checks"]
