"""Joins, aggregates, ranking, unions and checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import scalars as s
from lakemart.operators import aggregates as agg
from lakemart.operators import changes as chg
from lakemart.operators import columns as cols
from lakemart.operators import joins
from lakemart.operators import quality as qa
from lakemart.operators import ranking as rank
from lakemart.operators import unions
from lakemart.parity.registry import query, rounded
from lakemart.parity.row_level import SQL_ID, TRIP_ID
from lakemart.parity.views import Tables
from lakemart.plans.taxi import prepare_trips, trips_per_day
from lakemart.plans.trip_facts import locations
from lakemart.streaming import events as ev

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {1}".format


def _joined(t: Tables):
    return joins.join_zones(prepare_trips(t.trips()), t.zones())


# --- joins ------------------------------------------------------------------------------------


@query("join_zones", f"SELECT {SQL_ID}, pickup_zone, dropoff_zone FROM joined")
def _(t: Tables):
    return _joined(t).select(*TRIP_ID, "pickup_zone", "dropoff_zone")


@query("join_dimensions_inner", f"""SELECT {SQL_ID} FROM trips JOIN zone_ids p ON p.location_id = pu_location_id
    JOIN zone_ids d ON d.location_id = do_location_id""")
def _(t: Tables):
    return joins.join_dimensions_inner(t.trips(), locations(t.zones()), "location_id",
                                       ["pu_location_id", "do_location_id"]).select(*TRIP_ID)


MULTI_KEY_SQL = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, o.o_orderkey AS order_hit FROM lineitem
    LEFT JOIN (SELECT o_orderkey, o_orderkey % 50 AS b, CAST(o_custkey % 10 AS DOUBLE) AS x FROM orders WHERE o_orderstatus = 'F') o
    ON o.o_orderkey = l_orderkey AND b = l_partkey % 50 AND x = CAST(l_suppkey % 10 AS DOUBLE)"""


def _multi_key(t: Tables, salts: int):
    left = t.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", F.col("l_orderkey").alias("k"),
        (F.col("l_partkey") % 50).alias("b"), (F.col("l_suppkey") % 10).cast("double").alias("x"))
    right = t.table("orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_hit"), F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 50).alias("b"),
        (F.col("o_custkey") % 10).cast("double").alias("x"))
    return joins.join_multi_key(left, right, ["k", "b", "x"], salts=salts).drop("k", "b", "x")


@query("join_multi_key", MULTI_KEY_SQL)
def _(t: Tables):
    return _multi_key(t, 1)


@query("join_multi_key_salted", MULTI_KEY_SQL)
def _(t: Tables):
    return _multi_key(t, 4)


@query("join_using", "SELECT crime_id, iucr_code, primary_description, index_code FROM stg_crimes")
def _(t: Tables):
    from lakemart.plans import crime

    return crime.stg_crimes(crime.silver_crimes(t.crimes_raw()), crime.stg_ucr_codes(crime.silver_ucr_codes(t.codes_raw()))
                            ).select("crime_id", "iucr_code", "primary_description", "index_code")


@query("join_key_and_day", """SELECT a.arrest_id, a.case_number, c.iucr_code AS crime_code FROM silver_arrests a
    LEFT JOIN silver_crimes c ON c.case_number = a.case_number AND CAST(c.crime_datetime AS DATE) = CAST(a.arrest_date AS DATE)""")
def _(t: Tables):
    from lakemart.plans import crime

    return joins.join_key_and_day(crime.silver_arrests(t.arrests_raw()), crime.silver_crimes(t.crimes_raw()), "case_number",
                                  "arrest_date", "crime_datetime", {"iucr_code": "crime_code"}
                                  ).select("arrest_id", "case_number", "crime_code")


@query("join_with_fallback", """SELECT c_custkey, coalesce(n, 0) AS orders, coalesce(top, c_acctbal) AS best, late FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a ON a.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS late FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON b.o_custkey = c_custkey""")
def _(t: Tables):
    orders = t.table("orders").withColumnRenamed("o_custkey", "c_custkey")
    done = orders.filter("o_orderstatus = 'F'").groupBy("c_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    late = orders.filter("o_orderstatus = 'O'").groupBy("c_custkey").agg(F.max("o_orderkey").alias("late"))
    return joins.join_with_fallback(t.table("customer"), [done, late], "c_custkey", {
        "c_custkey": F.col("c_custkey"), "orders": F.coalesce("n", F.lit(0)), "best": F.coalesce("top", "c_acctbal"),
        "late": F.col("late")})


@query("join_group_metrics", """SELECT a.l_suppkey, a.items, b.balance FROM (SELECT l_suppkey, count(*) AS items FROM lineitem GROUP BY 1) a
    LEFT JOIN (SELECT s_suppkey, max(s_acctbal) AS balance FROM supplier WHERE s_acctbal > 0 GROUP BY 1) b ON b.s_suppkey = a.l_suppkey""")
def _(t: Tables):
    items = t.table("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("items"))
    rich = t.table("supplier").filter("s_acctbal > 0").groupBy(F.col("s_suppkey").alias("l_suppkey")).agg(F.max("s_acctbal").alias("balance"))
    return joins.join_group_metrics(items, rich, "l_suppkey")


INTERVAL_SQL = f"""SELECT transaction_id, event_id, t.user_id, {TS('t."timestamp"', 'transaction_time')}, {TS('a."timestamp"', 'activity_time')}
    FROM transactions t JOIN activity a ON a.user_id = t.user_id
    AND a."timestamp" BETWEEN t."timestamp" - INTERVAL 5 MINUTES AND t."timestamp" + INTERVAL 5 MINUTES"""
INTERVAL_OUT = ("transaction_id", "event_id", "user_id", "transaction_time", "activity_time")


@query("interval_join", INTERVAL_SQL)
def _(t: Tables):
    return ev.join_activity(t.transactions(), t.activity()).select(*INTERVAL_OUT)


@query("interval_join_salted", INTERVAL_SQL)
def _(t: Tables):
    return ev.join_activity(t.transactions(), t.activity(), salts=3).select(*INTERVAL_OUT)


@query("interval_join_hot_user", f"""SELECT transaction_id, event_id, t.user_id
    FROM (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN 'busy' ELSE user_id END AS user_id) FROM transactions) t
    JOIN (SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'busy' ELSE user_id END AS user_id) FROM activity) a
    ON a.user_id = t.user_id AND a."timestamp" BETWEEN t."timestamp" - INTERVAL 5 MINUTES AND t."timestamp" + INTERVAL 5 MINUTES""")
def _(t: Tables):
    """A third of all events are one user's; the spans of time that are hot with them are found, not given."""
    def busy(df, key: str):
        return df.withColumn("user_id", F.when(F.col(key).cast("long") % 3 == 0, "busy").otherwise(F.col("user_id")))

    joined = ev.join_activity(busy(t.transactions(), "transaction_id"), busy(t.activity(), "event_id"), hot_share=0.0005)
    return joined.select("transaction_id", "event_id", "user_id")


@query("join_hot_keys", """SELECT l_orderkey, l_linenumber, c_name FROM (
        SELECT *, CASE WHEN l_linenumber = 1 THEN 7 WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey END AS k FROM lineitem)
    LEFT JOIN customer ON c_custkey = k""")
def _(t: Tables):
    """Some key holds a fourth of all rows, and NULL another; nobody says which."""
    k = F.when(F.col("l_linenumber") == 1, 7).when(F.col("l_linenumber") != 2, F.col("l_suppkey"))
    left = t.table("lineitem").select("l_orderkey", "l_linenumber", k.alias("k"))
    right = t.table("customer").select(F.col("c_custkey").cast("int").alias("k"), "c_name")
    return joins.join_multi_key(left, right, ["k"], hot_share=joins.HOT_SHARE).drop("k")


# New rows: a third known, a third changed, a third with a NULL (known but for it), every fifth twice.
NEW_ROWS_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_custkey END AS o_custkey,
        o_totalprice + CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END AS o_totalprice
    FROM (SELECT *, unnest(generate_series(1, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END)) FROM orders)"""


def _new_and_old(t: Tables):
    orders = t.table("orders")
    copies = F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 5 == 0, 2).otherwise(1))
    new = orders.withColumn("c", F.explode(copies)).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 2, F.col("o_custkey")).alias("o_custkey"),
        (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 3 == 1, 1).otherwise(0)).alias("o_totalprice"))
    old = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 2, F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    return new, old


@query("insert_guard_anti", f"""SELECT DISTINCT * FROM ({NEW_ROWS_SQL}) n WHERE o_custkey IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM orders o WHERE o.o_orderkey = n.o_orderkey AND o.o_custkey = n.o_custkey AND o.o_totalprice = n.o_totalprice)
    UNION ALL SELECT * FROM ({NEW_ROWS_SQL}) WHERE o_custkey IS NULL""")
def _(t: Tables):
    return joins.insert_guard_anti(*_new_and_old(t))


@query("insert_guard_null_safe", f"""SELECT DISTINCT * FROM ({NEW_ROWS_SQL}) n WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice FROM orders) o
        WHERE o.o_orderkey = n.o_orderkey AND o.o_custkey IS NOT DISTINCT FROM n.o_custkey AND o.o_totalprice = n.o_totalprice)""")
def _(t: Tables):
    return joins.insert_guard_anti(*_new_and_old(t), null_safe=True)


@query("orphan_rows", f"SELECT {SQL_ID}, pu_location_id FROM trips t WHERE NOT EXISTS (SELECT 1 FROM zone_ids WHERE location_id = t.pu_location_id)")
def _(t: Tables):
    return joins.orphan_rows(t.trips(), "pu_location_id", locations(t.zones()), "location_id").select(*TRIP_ID, "pu_location_id")


# --- aggregates -------------------------------------------------------------------------------

ZONE_SUMMARY_SQL = """SELECT pickup_zone, count(*) AS total_trips, avg(trip_distance) AS avg_trip_distance,
    avg(total_amount) AS avg_total_amount, avg(tip_amount) AS avg_tip_amount,
    avg(CAST(taxi_type = 'yellow' AS INTEGER)) * 100 AS yellow_share, avg(CAST(taxi_type = 'green' AS INTEGER)) * 100 AS green_share,
    max(trip_distance) AS max_trip_distance, min(tip_amount) AS min_tip_amount FROM joined GROUP BY pickup_zone"""


@query("zone_summary", ZONE_SUMMARY_SQL)
def _(t: Tables):
    return agg.zone_summary(_joined(t))


ZONE_DAYS_SQL = """SELECT (['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'])[pickup_day_of_week] AS pickup_day_of_week,
    pickup_zone, count(*) AS total_trips, avg(CAST(fare_amount > 30 AS INTEGER)) * 100 AS high_fare_share
    FROM joined GROUP BY ALL"""


@query("zone_days", ZONE_DAYS_SQL)
def _(t: Tables):
    return agg.zone_days(_joined(t))


@query("zone_averages", """SELECT pickup_zone, avg(trip_distance) AS avg_trip_distance, avg(total_amount) AS avg_total_amount,
    avg(tip_amount) AS avg_tip_amount, max(trip_distance) AS max_trip_distance, max(tip_amount) AS max_tip_amount,
    count(*) AS total_trips, sum(total_amount) AS total_amount FROM joined GROUP BY pickup_zone""")
def _(t: Tables):
    return agg.zone_averages(_joined(t), with_count=True, with_total=True)


RUN_TIME = "2024-05-01 12:00:00"
HOURLY_SQL = f"""SELECT '{RUN_TIME}' AS ts, pickup_hour, count(*) AS total_trips, avg(trip_distance) AS avg_trip_distance,
    avg(total_amount) AS avg_total_amount FROM prepared GROUP BY pickup_hour"""


def _hourly_input(t: Tables):
    return t.trips().withColumn("pickup_hour", s.hour_of("pickup_datetime"))


@query("hourly_stats", HOURLY_SQL)
def _(t: Tables):
    return agg.hourly_stats(_hourly_input(t), F.lit(RUN_TIME).cast("timestamp_ntz"))



def _female(t: Tables):
    from lakemart.plans.players import int_players_female, stg_players

    return int_players_female(stg_players(t.players_female()), [F.col("row_no").cast("long")])


@query("team_profiles", """SELECT club_team_id AS club_id, club_name, league_id, CAST(sum(value_eur) AS DOUBLE) AS total_value,
    round(avg(overall), 4) AS avg_overall, round(avg(age), 4) AS avg_age, CAST(sum(potential) AS BIGINT) AS total_potential
    FROM female_latest WHERE club_team_id IS NOT NULL GROUP BY ALL""")
def _(t: Tables):
    return rounded(agg.team_profiles(_female(t)), "avg_overall", "avg_age")


@query("league_players", f"""SELECT league_id, league_name, len(list_distinct(list(player_id))) AS total_players,
    coalesce(max(CAST(age NOT BETWEEN 24 AND 85 AS INT)), 0) = 1 AS has_talents,
    {", ".join(f"round(sum({c}) / count({c}), 4) AS avg_{c}" for c in ("overall", "potential", "age", "value_eur", "wage_eur"))}
    FROM female_clean GROUP BY ALL""")
def _(t: Tables):
    from lakemart.plans.players import stg_players

    return rounded(agg.league_players(stg_players(t.players_female())),
                   *[f"avg_{c}" for c in ("overall", "potential", "age", "value_eur", "wage_eur")])


@query("league_teams", """SELECT league_id, round(avg(v), 4) AS avg_team_cost, round(avg(p), 4) AS avg_team_potential FROM (
    SELECT club_team_id, club_name, league_id, CAST(sum(value_eur) AS DOUBLE) AS v, sum(potential) AS p FROM female_latest
    WHERE club_team_id IS NOT NULL GROUP BY ALL) GROUP BY league_id""")
def _(t: Tables):
    return rounded(agg.league_teams(agg.team_profiles(_female(t))), "avg_team_cost", "avg_team_potential")


CLUB_SQL = """SELECT {k} AS club_id, len(list_distinct(list(player_id))) AS player_count,
    round(sum(overall) / count(overall), 4) AS avg_overall_players, round(sum(potential) / count(potential), 4) AS avg_potential_players,
    CAST(sum(value_eur) AS DOUBLE) AS total_value_players, CAST(sum(wage_eur) AS DOUBLE) AS total_wages,
    round(sum(age) / count(age), 4) AS avg_age_players FROM female_clean GROUP BY 1"""


def _club_rows(t: Tables):
    from lakemart.plans.players import stg_players

    return stg_players(t.players_female()).withColumnRenamed("club_team_id", "club_id")


@query("club_players", CLUB_SQL.format(k="club_team_id"))
def _(t: Tables):
    return rounded(agg.club_players(_club_rows(t)), "avg_overall_players", "avg_potential_players", "avg_age_players")


@query("max_gap", "SELECT club_team_id AS club_id, max(potential - overall) AS max_overperformance FROM female_clean GROUP BY 1")
def _(t: Tables):
    return agg.max_gap(_club_rows(t))


@query("club_metrics", """SELECT club_id, player_count, best_player_id, best_player_overall, max_overperformance FROM (
        SELECT club_team_id AS club_id, count(DISTINCT player_id) AS player_count, max(potential - overall) AS max_overperformance
        FROM female_clean GROUP BY 1) a
    JOIN (SELECT club_team_id AS best_club, player_id AS best_player_id, overall AS best_player_overall FROM (SELECT *, row_number() OVER (
        PARTITION BY club_team_id ORDER BY overall DESC NULLS FIRST, player_id) AS rn FROM female_clean) WHERE rn = 1) b
    ON a.club_id IS NOT DISTINCT FROM b.best_club""")
def _(t: Tables):
    return agg.club_metrics(_club_rows(t)).select("club_id", "player_count", "best_player_id", "best_player_overall", "max_overperformance")


@query("mode_value", """SELECT pu_location_id, mode() WITHIN GROUP (ORDER BY fee) AS mode FROM trips GROUP BY 1""")
def _(t: Tables):
    return agg.mode_value(t.trips(), ["pu_location_id"], "fee")


@query("daily_crimes", """SELECT strftime(crime_date, '%Y-%m-%d') AS crime_date, primary_type, district_id, community_area_id, count(*) AS total_crimes,
    count(*) FILTER (WHERE is_arrest) AS crimes_with_arrest, count(*) FILTER (WHERE is_domestic) AS domestic_crimes
    FROM stg_crimes GROUP BY crime_date, primary_type, district_id, community_area_id""")
def _(t: Tables):
    from lakemart.plans import crime

    return agg.daily_crimes(crime.stg_crimes(crime.silver_crimes(t.crimes_raw()),
                                             crime.stg_ucr_codes(crime.silver_ucr_codes(t.codes_raw()))))


@query("conditional_share", """SELECT vendor_id, avg(CAST(fee > 4 AS INTEGER)) * 100 AS high_fee_share FROM trips GROUP BY 1""")
def _(t: Tables):
    return agg.share_by(t.trips(), ["vendor_id"], {"high_fee_share": F.col("fee") > 4})


@query("conditional_count", """SELECT vendor_id, count(*) FILTER (WHERE fee > 4) AS high_fees, count(*) FILTER (WHERE passenger_count = 0) AS empty_trips
    FROM trips GROUP BY 1""")
def _(t: Tables):
    return agg.count_by(t.trips(), ["vendor_id"], {"high_fees": F.col("fee") > 4, "empty_trips": F.col("passenger_count") == 0})


@query("row_count", "SELECT count(*) AS row_count FROM anomaly_free WHERE pu_location_id = 7")
def _(t: Tables):
    return agg.row_count(prepare_trips(t.trips()), F.col("pu_location_id") == 7)


@query("column_profile", """SELECT c.name AS "column", CASE c.name WHEN 'passenger_count' THEN p WHEN 'fee' THEN f ELSE n END AS non_null, n AS row_count
    FROM (SELECT count(*) AS n, count(passenger_count) AS p, count(fee) AS f FROM trips),
    (SELECT unnest(['passenger_count', 'fee', 'vendor_id']) AS name) c""")
def _(t: Tables):
    return agg.column_profile(t.trips().select("passenger_count", "fee", "vendor_id"))


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t: Tables):
    return agg.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_count", "SELECT l_suppkey, count(DISTINCT l_partkey) AS distinct_values FROM lineitem GROUP BY 1")
def _(t: Tables):
    return agg.distinct_count(t.table("lineitem"), ["l_suppkey"], "l_partkey")


@query("trips_per_day", """SELECT strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date, count(*) AS total_trips FROM trips GROUP BY 1""")
def _(t: Tables):
    return trips_per_day(t.trips())


# --- ranking ----------------------------------------------------------------------------------


@query("dedup_row_number", f"""SELECT {SQL_ID}, copy, rn FROM (SELECT *, row_number() OVER (
    PARTITION BY vendor_id, pu_location_id, do_location_id, pickup_datetime, dropoff_datetime ORDER BY order_key, part_key, copy) AS rn
    FROM trip_copies) WHERE rn = 1""")
def _(t: Tables):
    return rank.dedup_row_number(t.trip_copies(), ["order_key", "part_key", "copy"]).select(*TRIP_ID, "copy", "rn")


@query("latest_per_key", "SELECT player_id, row_no, fifa_update_date FROM female_latest")
def _(t: Tables):
    return _female(t).select("player_id", F.col("row_no").cast("long").alias("row_no"), "fifa_update_date")


@query("top_per_group", """SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT *, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def _(t: Tables):
    return rank.top_per_group(t.table("orders"), ["o_custkey"], [F.desc_nulls_first("o_totalprice"), "o_orderkey"], 3
                              ).select("o_custkey", "o_orderkey", "o_totalprice", "rn")


@query("distinct_on_columns", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""")
def _(t: Tables):
    return rank.distinct_on_columns(t.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"]
                                    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("drop_duplicates", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_partkey % 3 ORDER BY l_shipdate DESC, l_linenumber, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def _(t: Tables):
    rows = t.table("lineitem").withColumn("third", F.col("l_partkey") % 3)
    kept = rank.drop_duplicates(rows, ["l_orderkey", "third"], [F.desc("l_shipdate"), "l_linenumber", "l_suppkey"])
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("sorted_output", "SELECT o_custkey, o_orderdate::DATE::VARCHAR AS day, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey")
def _(t: Tables):
    return rank.sorted_output(t.table("orders"), "o_custkey", F.desc_nulls_first("o_orderdate"), "o_orderkey").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t: Tables):
    return rank.limit_rows(t.table("orders").select("o_orderkey", "o_totalprice"), 100, F.desc("o_totalprice"), "o_orderkey")


# --- unions -----------------------------------------------------------------------------------


@query("union_by_name", "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def _(t: Tables):
    return unions.union_by_name(
        t.table("customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
        t.table("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")))


@query("union_all_unified", f"SELECT {SQL_ID}, fee, taxi_type FROM trips")
def _(t: Tables):
    from lakemart.plans.taxi import unify_trips

    return unify_trips(t.raw_trips("yellow"), t.raw_trips("green")).select(*TRIP_ID, "fee", "taxi_type")


@query("union_all_null_padded", """SELECT s_suppkey AS id, s_name AS name, NULL AS segment, 'supplier' AS side FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment, 'customer' FROM customer""")
def _(t: Tables):
    return unions.union_tagged(
        {"supplier": t.table("supplier"), "customer": t.table("customer")}, "side",
        {"supplier": {"s_suppkey": "id", "s_name": "name"},
         "customer": {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}}, ["id", "name", "segment"])


@query("union_all_suffixed", """SELECT s_suppkey || '_supplier' AS id, s_acctbal AS balance FROM supplier
    UNION ALL SELECT c_custkey || '_customer', c_acctbal FROM customer""")
def _(t: Tables):
    return unions.union_suffixed({
        "supplier": t.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
        "customer": t.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))}, ["id"])


@query("union_count_check", """SELECT count(*) FILTER (WHERE taxi_type = 'yellow') AS left_rows, count(*) FILTER (WHERE taxi_type = 'green') AS right_rows,
    count(*) AS union_rows, TRUE AS matches FROM trips""")
def _(t: Tables):
    from lakemart.plans.taxi import unify_trips

    yellow, green = t.raw_trips("yellow"), t.raw_trips("green")
    return unions.union_count_check(yellow, green, unify_trips(yellow, green))


# --- checks -----------------------------------------------------------------------------------


@query("check_unique", "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(t: Tables):
    return qa.check_unique(t.table("lineitem"), "l_partkey")


@query("check_not_null", f"SELECT {SQL_ID} FROM trips WHERE fee IS NULL")
def _(t: Tables):
    return qa.check_not_null(t.trips(), "fee").select(*TRIP_ID)


@query("check_accepted_values", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')")
def _(t: Tables):
    return qa.check_accepted_values(t.table("events"), "event_type", ["click", "view", "purchase"]).select("event_id", "event_type")


@query("check_relationships", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def _(t: Tables):
    return qa.check_relationships(t.table("customer"), "c_custkey", t.table("orders").filter("o_totalprice > 300000"), "o_custkey").select("c_custkey")


@query("check_expression", f"SELECT {SQL_ID}, passenger_count FROM prepared WHERE NOT (passenger_count BETWEEN 1 AND 6)")
def _(t: Tables):
    return qa.check_expression(t.trips(), "passenger_count BETWEEN 1 AND 6").select(*TRIP_ID, "passenger_count")


@query("check_expression_strict", f"""SELECT {SQL_ID}, passenger_count FROM trips WHERE passenger_count IS NULL
    OR NOT (passenger_count BETWEEN 1 AND 6)""")
def _(t: Tables):
    return qa.check_expression(t.trips(), "passenger_count BETWEEN 1 AND 6", strict=True).select(*TRIP_ID, "passenger_count")


@query("check_query", """SELECT key AS custkey, count(*) AS cnt FROM (SELECT c_custkey AS key FROM customer UNION ALL SELECT o_custkey FROM orders)
    GROUP BY 1 HAVING count(*) > 1""")
def _(t: Tables):
    return qa.check_shared_ids(t.table("customer").select(F.col("c_custkey").alias("custkey")),
                               t.table("orders").select(F.col("o_custkey").alias("custkey")), "custkey")


REPORT_CHECKS = (
    qa.Check("trips", "not_null", "fee"), qa.Check("trips", "not_null", "vendor_id"),
    qa.Check("trips", "accepted_values", "taxi_type", ("yellow",)),
    qa.Check("trips", "expression", "dropoff_datetime > pickup_datetime"),
    qa.Check("trips", "relationships", "pu_location_id", parent="locations", parent_column="location_id"),
    qa.Check("locations", "unique", "location_id"), qa.Check("trips", "unique", "part_key"),
)


@query("quality_report", """SELECT c AS "check", t AS "table", k AS "column", CAST(v AS BIGINT) AS violations FROM (
    SELECT 'not_null' AS c, 'trips' AS t, 'fee' AS k, count(*) FILTER (WHERE fee IS NULL) AS v FROM trips
    UNION ALL SELECT 'not_null', 'trips', 'vendor_id', 0
    UNION ALL SELECT 'accepted_values', 'trips', 'taxi_type', count(*) FILTER (WHERE taxi_type <> 'yellow') FROM trips
    UNION ALL SELECT 'expression', 'trips', 'dropoff_datetime > pickup_datetime', count(*) FILTER (WHERE NOT dropoff_datetime > pickup_datetime) FROM trips
    UNION ALL SELECT 'relationships', 'trips', 'pu_location_id', count(*) FROM trips t WHERE NOT EXISTS (SELECT 1 FROM zone_ids WHERE location_id = t.pu_location_id)
    UNION ALL SELECT 'unique', 'locations', 'location_id', 0
    UNION ALL SELECT 'unique', 'trips', 'part_key', (SELECT count(*) FROM (SELECT part_key FROM trips GROUP BY 1 HAVING count(*) > 1)))""")
def _(t: Tables):
    return qa.quality_report({"trips": t.trips(), "locations": locations(t.zones())}, REPORT_CHECKS)


# --- row changes ------------------------------------------------------------------------------


@query("delete_rows", f"SELECT {SQL_ID}, fee FROM trips WHERE NOT coalesce(fee > 4, FALSE)")
def _(t: Tables):
    return chg.delete_rows(t.trips(), F.col("fee") > 4).select(*TRIP_ID, "fee")


@query("update_rows", f"SELECT {SQL_ID}, CASE WHEN fee > 4 THEN fee * 2 ELSE fee END AS fee, CASE WHEN fee > 4 THEN 'X' ELSE taxi_type END AS taxi_type FROM trips")
def _(t: Tables):
    return chg.update_rows(t.trips(), F.col("fee") > 4, {"fee": F.col("fee") * 2, "taxi_type": F.lit("X")}).select(*TRIP_ID, "fee", "taxi_type")


@query("insert_rows", "SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer")
def _(t: Tables):
    table = t.table("supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    new = t.table("customer").select(F.col("c_acctbal").alias("S_ACCTBAL"), F.col("c_custkey").alias("s_suppkey"))
    return table.unionByName(cols.conform(new, table.schema, strict=True))


CHANGES_OLD = "SELECT o_orderkey AS id, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0"
CHANGES_NEW = """SELECT o_orderkey AS id, o_custkey, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice
    FROM orders WHERE o_orderkey % 11 <> 0"""


def _two_versions(t: Tables):
    base = t.table("orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_totalprice")
    raised = base.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("id") % 5 == 0, 1).otherwise(0))
    return base.filter("id % 7 <> 0"), raised.filter("id % 11 <> 0")


@query("table_changes", f"""WITH o AS ({CHANGES_OLD}), n AS ({CHANGES_NEW}),
    gone AS (SELECT * FROM o EXCEPT ALL SELECT * FROM n), came AS (SELECT * FROM n EXCEPT ALL SELECT * FROM o)
    SELECT *, 'DELETE' AS action, id IN (SELECT id FROM came) AS is_update FROM gone
    UNION ALL SELECT *, 'INSERT', id IN (SELECT id FROM gone) FROM came""")
def _(t: Tables):
    return chg.table_changes(*_two_versions(t), key=["id"])


@query("table_changes_without_key", """WITH o AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 7 <> 0),
    n AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 11 <> 0)
    SELECT *, 'DELETE' AS action, FALSE AS is_update FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n)
    UNION ALL SELECT *, 'INSERT', FALSE FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o)""")
def _(t: Tables):
    lines = t.table("lineitem")
    old, new = (lines.filter(f"l_partkey % {n} <> 0").select("l_orderkey", "l_linenumber") for n in (7, 11))
    return chg.table_changes(old, new)


# --- windows over events ----------------------------------------------------------------------

WINDOWS_SQL = f"""SELECT user_id, event_type, {TS('window_start', 'window_start')}, {TS('window_start + INTERVAL 10 MINUTES', 'window_end')},
        count(*) AS event_count
    FROM (SELECT *, unnest([time_bucket(INTERVAL 5 MINUTES, "timestamp"), time_bucket(INTERVAL 5 MINUTES, "timestamp") - INTERVAL 5 MINUTES]) AS window_start
        FROM activity) {{}} GROUP BY user_id, event_type, window_start"""


@query("sliding_event_counts", WINDOWS_SQL.format(""))
def _(t: Tables):
    return ev.sliding_event_counts(t.activity())


@query("dedup_events", "SELECT event_id, user_id FROM activity")
def _(t: Tables):
    twice = t.activity().withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return ev.dedup_events(twice).select("event_id", "user_id")
