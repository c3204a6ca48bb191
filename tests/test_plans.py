"""The crime, player and trip chains on small planted data."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakemart.operators.quality import QualityError, assert_clean, quality_report
from lakemart.plans import crime, players, taxi, trip_facts, warehouse
from lakemart.sources.sinks import keep_tables
from tests.conftest import rows

CRIME_COLUMNS = list(crime.CRIME_NAMES)


def crime_row(i, **kw):
    base = {"ID": str(i), "Case Number": f"HX{i}", "Date": "01/07/2024 02:05:00 PM", "Block": "001XX W ST", "IUCR": "0110",
            "Primary Type": "THEFT", "Description": "D", "Location Description": "STREET", "Arrest": "true", "Domestic": "False",
            "Beat": "1", "Ward": "2", "Community Area": "3", "FBI Code": "06", "X Coordinate": "1.5", "Y Coordinate": "2.5",
            "Latitude": "41.8", "Longitude": "-87.6", "Location": "(x)", "District": "4"}
    base.update({k.replace("_", " "): v for k, v in kw.items()})
    return tuple(base[c] for c in CRIME_COLUMNS)


def silver(spark, crimes, arrests=(), codes=(("0110", "Theft ", "x", "i", "true"),)):
    c = spark.createDataFrame(list(crimes), ", ".join(f"`{n}` string" for n in CRIME_COLUMNS))
    a = spark.createDataFrame(list(arrests), ", ".join(f"`{n}` string" for n in crime.ARREST_NAMES))
    k = spark.createDataFrame(list(codes), "IUCR string, `PRIMARY DESCRIPTION` string, `SECONDARY DESCRIPTION` string, "
                                           "`INDEX CODE` string, ACTIVE string")
    return crime.silver_crimes(c), crime.silver_arrests(a), crime.silver_ucr_codes(k)


def test_silver_crimes(spark):
    got = silver(spark, [crime_row(1), crime_row(1), crime_row(2, Latitude=None), crime_row(3, IUCR=None),
                         crime_row(4, Date="junk", Arrest="maybe", Beat="x", Location_Description=None)])[0]
    assert rows(got, "crime_id", "crime_datetime", "is_arrest", "beat_id", "location_description") == [
        ("1", datetime(2024, 1, 7, 14, 5), True, 1, "STREET"), ("4", None, None, None, "Unknown")]


def test_silver_arrests_and_codes(spark):
    arrests = [("9", "HX1", "01/07/2024 11:00:00 PM", "R", "S", "D", "F"), ("9", "HX1", "01/07/2024 11:00:00 PM", "R", "S", "D", "F"),
               ("8", " ", "x", "R", "S", "D", "M"), ("7", "HX2", "bad", "R", "S", "D", None)]
    codes = [("0110", None, "b", "i", "true"), ("0110", "a", "b", "i", "true"), ("0120", "a", "b", "i", "false"), (" 01a ", "c", None, "n", "True")]
    _, a, c = silver(spark, [crime_row(1)], arrests, codes)
    assert rows(a, "arrest_id", "charge_one_type") == [("7", "other"), ("9", "felony")]
    assert rows(c) == [(" 01a ", "c", "Unknown", "n"), ("0110", "Unknown", "b", "i")]
    assert rows(crime.stg_ucr_codes(c), "iucr_code", "secondary_description") == [("0110", "B"), ("01A", "UNKNOWN")]
    assert rows(crime.stg_arrests(a), "arrest_id") == [("9",)]


def test_a_broken_copy_never_wins(spark):
    good, bad = "01/07/2024 11:00:00 PM", "soon"
    crimes = [crime_row(1, Date=bad, Description="A"), crime_row(1, Description="Z")]
    arrests = [("9", "HX1", bad, "R", "S", "D", "F"), ("9", "HX1", good, "R", "S", "D", "F")]
    c, a, _ = silver(spark, crimes, arrests)
    assert rows(c, "crime_datetime", "description") == [(datetime(2024, 1, 7, 14, 5), "Z")]
    assert rows(crime.stg_arrests(a), "arrest_id") == [("9",)]


def test_gold(spark):
    crimes = [crime_row(1), crime_row(2, Arrest=None, IUCR="0110 "), crime_row(3, X_Coordinate=None)]
    arrests = [("9", "HX1", "01/07/2024 11:00:00 PM", "R", "S", "D", "F"), ("7", "HX1", "01/08/2024 11:00:00 PM", "R", "S", "D", "M")]
    gold = crime.gold_tables(*silver(spark, crimes, arrests))
    stg = gold["stg_crimes"].filter("crime_id = 1").first()
    assert (stg["crime_date"], stg["crime_hour"], stg["crime_day_of_week"], stg["crime_month"], stg["crime_year"]) == (
        date(2024, 1, 7), 14, 0, 1, 2024)
    # One place has no x coordinate, hence no key; three-column joins meet both places.
    assert sorted(r["location_key"] is None for r in gold["dim_location"].collect()) == [False, True]
    assert gold["fact_crimes"].count() == 6
    assert rows(gold["fact_crimes"].select("crime_id", "iucr_code", "is_arrest").distinct()) == [
        ("1", "0110", True), ("2", None, False), ("3", "0110", True)]
    assert rows(gold["fact_arrests"].select("arrest_id", "iucr_code").distinct()) == [("7", None), ("9", "0110")]
    assert sum(r["total_crimes"] for r in gold["agg_daily_crimes"].collect()) == 6
    found = {(r["table"], r["check"], r["column"]): r["violations"] for r in quality_report(gold, crime.CRIME_CHECKS).collect()}
    assert found["fact_crimes", "unique", "crime_id"] == 3
    assert found["dim_location", "not_null", "location_key"] == 1
    assert found["fact_crimes", "not_null", "iucr_code"] == 2
    assert found["stg_crimes", "expression", "latitude BETWEEN 41.6 AND 42.1"] == 0
    assert len(found) == len(crime.CRIME_CHECKS)


def test_gold_checks_pass_on_clean_data_and_salting_changes_nothing(spark):
    crimes = [crime_row(i, Block=f"B{i % 3}", Latitude=f"41.{7 + i % 3}", X_Coordinate=str(i % 3)) for i in range(12)]
    arrests = [(str(i), f"HX{i}", "01/07/2024 01:00:00 AM", "R", "S", "D", "F") for i in range(5)]
    gold = crime.gold_tables(*silver(spark, crimes, arrests))
    assert_clean(quality_report(gold, crime.CRIME_CHECKS))
    salted = crime.fact_crimes(gold["stg_crimes"], gold["dim_location"], gold["dim_crime_type"], salts=5)
    assert rows(salted) == rows(gold["fact_crimes"])


def test_whole_crime_run_with_kept_tables(spark, folder):
    spark.createDataFrame([crime_row(1), crime_row(2)], CRIME_COLUMNS).write.option("header", True).csv(folder("in", "crimes"))
    spark.createDataFrame([("9", "HX1", "01/07/2024 11:00:00 PM", "R", "S", "D", "F")], list(crime.ARREST_NAMES)).write.option(
        "header", True).csv(folder("in", "arrests"))
    spark.createDataFrame([("0110", "Theft", "x", "i", "true")], ["IUCR", "PRIMARY DESCRIPTION", "SECONDARY DESCRIPTION", "INDEX CODE", "ACTIVE"]
                          ).write.option("header", True).csv(folder("in", "iucr"))
    crime.load_bronze(spark, folder("in", "crimes"), folder("in", "arrests"), folder("in", "iucr"), folder("bronze"))
    out = crime.run_crime(spark, folder("bronze"), "t_silver", "t_gold")
    assert_clean(out["checks"])
    assert spark.table("t_gold.fact_crimes").count() == 2
    assert spark.table("t_gold.agg_daily_crimes").first()["total_crimes"] == 2
    assert spark.table("t_silver.silver_arrests").count() == 1


def test_second_load_is_appended(spark, folder):
    codes = [("0110", "Theft", "x", "i", "true")]
    for load, ids in enumerate(((1, 2), (2, 3))):
        for name, data, columns in (("crimes", [crime_row(i) for i in ids], CRIME_COLUMNS),
                                    ("arrests", [(str(i), f"HX{i}", "01/07/2024 11:00:00 PM", "R", "S", "D", "F") for i in ids], list(crime.ARREST_NAMES)),
                                    ("iucr", codes, ["IUCR", "PRIMARY DESCRIPTION", "SECONDARY DESCRIPTION", "INDEX CODE", "ACTIVE"])):
            spark.createDataFrame(data, columns).write.option("header", True).csv(folder(f"in{load}", name))
        crime.load_bronze(spark, *(folder(f"in{load}", n) for n in ("crimes", "arrests", "iucr")), folder("bronze"), datetime(2024, 5, 1, 12 + load))
        out = crime.run_crime(spark, folder("bronze"), "a_silver", "a_gold", strict=True)
    assert rows(spark.table("a_silver.silver_crimes").groupBy(F.hour("load_timestamp").alias("h")).count(), "count") == [(1,), (2,)]
    assert rows(out["fact_crimes"], "crime_id") == [("1",), ("2",), ("3",)]
    assert rows(out["fact_arrests"], "arrest_id") == [("1",), ("2",), ("3",)]


PLAYER_DDL = ("player_id string, club_team_id string, club_name string, league_id string, league_name string, overall string, "
              "potential string, age string, value_eur string, wage_eur string, player_positions string, fifa_update_date string, "
              "height_cm string, weight_kg string, release_clause_eur string, pace string, shooting string, passing string, "
              "dribbling string, defending string, physic string")


def player(pid, club, overall, potential, age=20, value="100", wage="1", pos="ST", updated="2024-01-01"):
    return (str(pid), club, f"C{club}", "1", "L", overall, potential, str(age), value, wage, pos, updated) + ("1",) * 9


def test_player_chain(spark):
    male = spark.createDataFrame([player(1, "10", "80", "85"), player(2, "10", "-", "70"), player(3, None, "60", "61", age=40)], PLAYER_DDL)
    female = spark.createDataFrame([player(1, "10", "70", "75"), player(1, "10", "71", "75", updated=None),
                                    player(5, "11", "90", "91", age=30, value="n/a")], PLAYER_DDL)
    out = players.player_tables(male, female, keep=keep_tables("t_players"))
    assert rows(out["int_players_female"], "player_id", "overall", "gender") == [(1, 71, "FEMALE"), (5, 90, "FEMALE")]
    assert rows(out["int_team_profiles_male"], "club_id", "avg_overall", "total_potential") == [(10, 80.0, 155)]
    league = out["int_league_insights_male"].first()
    assert (league["total_players"], league["has_talents"], float(league["avg_team_cost"])) == (3, True, 200.0)
    dash = rows(out["mart_team_dashboard"], "club_id", "player_count", "best_player_id", "best_player_overall", "max_overperformance")
    assert dash == [("10_female", 1, "1_female", 71, 4), ("10_male", 2, "2_male", None, 5), ("11_female", 1, "5_female", 90, 1)]
    assert rows(out["mart_player_profiles_male"], "player_id", "growth_gap", "age_group", "role_classification") == [
        (1, 5, "U21", "Poacher"), (2, None, "U21", "Poacher"), (3, 1, "Veteran", "Poacher")]
    report = {(r["table"], r["check"], r["column"]): r["violations"] for r in quality_report(out, players.PLAYER_CHECKS).collect()}
    assert report["int_players_female", "not_null", "value_eur"] == 1
    assert report["int_players_male", "unique", "player_id"] == 0
    with pytest.raises(QualityError):
        assert_clean(quality_report(out, players.PLAYER_CHECKS))


def test_violations_stop_a_run(spark, folder):
    spark.createDataFrame([player(1, "10", "-", "85")], PLAYER_DDL).write.option("header", True).csv(folder("m"))
    spark.createDataFrame([player(1, "10", "80", "85")], PLAYER_DDL).write.option("header", True).csv(folder("f"))
    files = {"male_players": folder("m"), "female_players": folder("f")}
    report = {(r["table"], r["check"]): r["violations"] for r in players.run_players(spark, files, "v_players", strict=False)["checks"].collect()}
    assert report["int_players", "shared_ids"] == 1
    with pytest.raises(QualityError, match="shared_ids"):
        players.run_players(spark, files, "v_players")


def test_coach_and_team_types(spark):
    raw = spark.createDataFrame([("7", "1980-02-03", "Ann", "x")], ["coach_id", "dob", "long_name", "nationality_id"])
    assert rows(players.stg_coaches(raw)) == [(7, date(1980, 2, 3), "Ann", None)]
    assert players.stg_teams(spark.createDataFrame([("1", "a")], ["Team ID", "b"])).dtypes == [("team_id", "int"), ("b", "string")]


def test_trip_chain(spark):
    ddl = ("VendorID long, PULocationID long, DOLocationID long, RatecodeID long, payment_type long, passenger_count double, "
           "total_amount double, fare_amount double, {fee} double, extra double, trip_distance double, pickup_datetime timestamp, "
           "dropoff_datetime timestamp, {more}store_and_fwd_flag string, n int")

    def trip(n, minutes=30, passengers=1.0, **kw):
        v = {"pu": 1, "do": 2, "total": 10.0} | kw
        return (1, v["pu"], v["do"], 1, 1, passengers, v["total"], 8.0, None, 1.0, 2.0, datetime(2024, 1, 1, 9, n),
                datetime(2024, 1, 1, 9 + (n + minutes) // 60, (n + minutes) % 60))

    green = spark.createDataFrame([(*trip(0), "N", 1), (*trip(0), "N", 2), (*trip(1, minutes=0), "N", 3), (*trip(2, passengers=0.0), "N", 4)],
                                  ddl.format(fee="fee", more=""))
    yellow = spark.createDataFrame([(*trip(0), 1.0, "N", 1), (*trip(3, pu=9), 1.0, "N", 2), (*trip(4, total=501.0), 1.0, "N", 3)],
                                   ddl.format(fee="airport_fee", more="trip_type double, "))
    zones = spark.createDataFrame([("1", "B", "One", "s"), ("2", "B", "Two", "s")], ["LocationID", "Borough", "Zone", "service_zone"])
    out = trip_facts.trip_tables(green, yellow, zones, ["n"])
    assert out["trips"].columns == [*trip_facts.TRIP_COLUMNS, "taxi_type"]
    assert rows(out["trips"], "taxi_type", "pu_location_id", "trip_type") == [("green", 1, None), ("yellow", 1, 1.0), ("yellow", 9, 1.0)]
    daily = out["fact_trip_summary_daily"].first().asDict()
    assert daily == {"pickup_date": date(2024, 1, 1), "pu_location_id": 1, "do_location_id": 2, "total_fee": 0.0, "total_extra": 2.0,
                     "total_amount": 20.0, "total_trip_distance": 4.0, "avg_trip_duration_minutes": 30.0, "most_trips_by": "green"}
    assert out["fact_trip_summary_daily"].count() == 1
    assert_clean(quality_report(out, trip_facts.TRIP_CHECKS))


def joins_of(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Join " in line]


def test_trip_facts_read_no_borough(spark):
    from lakemart.parity import models
    from lakemart.parity.views import Tables

    m = models.Trips(Tables(spark, "/root/testdata/sf0.001"))
    assert not any("Outer" in j for j in joins_of(trip_facts.fact_trip_summary_daily(m.trips, m.locations)))


def test_arrest_facts_read_each_table_once(spark):
    from lakemart.parity import QUERIES

    plan = QUERIES["fact_arrests"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("fact_crimes") <= 2 and "orders" not in plan
    assert len([line for line in plan.splitlines() if "Relation" in line]) == 3


def test_key_checks_of_a_table_share_one_grouping(spark):
    from lakemart.operators.quality import Check

    table = spark.range(5).selectExpr("id AS a", "id % 2 AS b")
    checks = [Check("t", "unique", "a"), Check("t", "unique", "b"), Check("t", "not_null", "a")]
    report = quality_report({"t": table}, checks)
    assert rows(report, "column", "check", "violations") == sorted([("a", "not_null", 0), ("a", "unique", 0), ("b", "unique", 2)], key=str)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 5") == 2


def test_shares_add_up_and_lookups_keep_rows(spark):
    trips = spark.range(200).select(
        (F.col("id") % 7).alias("pu_location_id"), (F.col("id") % 5).alias("do_location_id"), F.lit(1.0).alias("trip_distance"),
        F.lit(9.0).alias("total_amount"), F.lit(None).cast("double").alias("tip_amount"), F.lit(40.0).alias("fare_amount"), F.lit(2).alias("passenger_count"),
        F.lit("2024-01-01 08:00:00").cast("timestamp_ntz").alias("pickup_datetime"),
        F.lit("2024-01-01 08:30:00").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.when(F.col("id") % 3 == 0, "yellow").otherwise("green").alias("taxi_type"))
    zones = spark.createDataFrame([("1", "A"), ("2", "B")], ["LocationID", "Zone"])
    summary = taxi.zone_reports(taxi.trip_zone_totals(trips, zones))["zone_statistic"].collect()
    assert sum(r["total_trips"] for r in summary) == 200
    assert all(abs(r["yellow_share"] + r["green_share"] - 100) < 1e-9 for r in summary)
    assert {(r["avg_tip_amount"], r["min_tip_amount"], r["avg_total_amount"]) for r in summary} == {(None, None, 9.0)}
    enriched = warehouse.enriched(trips, zones, "LocationID", "Zone")
    assert warehouse.preprocessed(enriched).count() == 200
