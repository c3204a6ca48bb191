"""Projections, filters and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import cleaning as c
from lakemart.functions import scalars as s
from lakemart.operators import columns as cols
from lakemart.operators import filters as flt
from lakemart.parity.registry import query
from lakemart.parity.views import Tables, number_text
from lakemart.plans.taxi import prepare_trips
from lakemart.sources.files import scan_parquet, trim_text

TRIP_ID = ("order_key", "part_key", "vendor_id", "pickup_datetime")
SQL_ID = "order_key, part_key, vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime"


def _minutes():
    return s.duration_minutes("pickup_datetime", "dropoff_datetime")


# --- projections ------------------------------------------------------------------------------


@query("scan_parquet", """SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS VARCHAR) AS absent FROM lineitem""")
def _(t: Tables):
    return scan_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet",
                        "l_orderkey long, l_linenumber long, l_quantity double, absent string")


@query("parquet_trim_text", "SELECT p_partkey, trim(p_name) AS p_name, trim(p_type) AS p_type, p_size FROM part")
def _(t: Tables):
    return trim_text(t.table("part").select("p_partkey", F.concat(F.lit(" "), "p_name").alias("p_name"), "p_type", "p_size"))


@query("rename_columns", "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey FROM customer")
def _(t: Tables):
    return cols.rename_columns(t.table("customer").select("c_custkey", "c_name", "c_nationkey"),
                               {"c_custkey": "customer_id", "c_name": "name"})


@query("rename_by_copy", "SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders")
def _(t: Tables):
    return cols.rename_by_copy(t.table("orders"), {"o_orderkey": "id", "o_orderpriority": "priority"})


# Text with decimals or an exponent is no whole number to Spark, where DuckDB would round it.
@query("cast_columns", """SELECT id, TRY_CAST(CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN trim(raw) END AS INTEGER) AS raw
    FROM dirty""")
def _(t: Tables):
    return cols.cast_columns(t.dirty(), {"raw": "int"})


@query("tag_literal", "SELECT n_nationkey, 'yellow' AS colour FROM nation")
def _(t: Tables):
    return cols.tag_literal(t.table("nation").select("n_nationkey"), "colour", "yellow")


@query("snake_case_columns", "SELECT vendor_id, pu_location_id, ratecode_id, trip_distance, taxi_type FROM trips")
def _(t: Tables):
    names = ("VendorID", "PULocationID", "RatecodeID", "trip_distance")
    sides = [cols.snake_case_columns(t.raw_trips(c).select(*names)).withColumn("taxi_type", F.lit(c)) for c in ("yellow", "green")]
    return sides[0].unionByName(sides[1])


@query("snake_case_spaced", "SELECT o_orderkey AS order_key, o_orderstatus AS order_status FROM orders")
def _(t: Tables):
    raw = t.table("orders").select(F.col("o_orderkey").alias("ORDER KEY"), F.col("o_orderstatus").alias("Order  Status"))
    return cols.snake_case_columns(raw, "spaced", squeeze=True)


@query("snake_case_label", "SELECT o_orderkey AS order_key, o_orderstatus AS order_status FROM orders")
def _(t: Tables):
    raw = t.table("orders").select(F.col("o_orderkey").alias("Order-Key"), F.col("o_orderstatus").alias("order/Status"))
    return cols.snake_case_columns(raw, "label")


@query("drop_columns", "SELECT s_suppkey, s_nationkey FROM supplier")
def _(t: Tables):
    return cols.drop_columns(t.table("supplier"), "s_name", "s_acctbal", "no_such_column")


@query("select_columns", "SELECT p_brand, p_partkey, p_size FROM part")
def _(t: Tables):
    return cols.select_columns(t.table("part"), ["p_brand", "p_partkey", "p_size"])


@query("star_plus", "SELECT s_suppkey, s_nationkey, n_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def _(t: Tables):
    nation = t.table("nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return cols.star_plus(t.table("supplier").select("s_suppkey", "s_nationkey"), nation, ["n_name"], ["s_nationkey"])


@query("null_pad", "SELECT s_suppkey, CAST(NULL AS DOUBLE) AS rating FROM supplier")
def _(t: Tables):
    from pyspark.sql.types import DoubleType, StructField, StructType

    return cols.null_pad(t.table("supplier").select("s_suppkey"), StructType([StructField("rating", DoubleType())]))


@query("unify_schema", """SELECT CAST(s_nationkey AS BIGINT) AS nation, s_acctbal AS balance, s_name AS name FROM supplier
    UNION ALL SELECT c_nationkey, c_acctbal, NULL FROM customer""")
def _(t: Tables):
    from pyspark.sql.types import StructType

    target = StructType.fromDDL("nation bigint, balance double, name string")
    a = t.table("supplier").select(F.col("s_nationkey").alias("Nation"), F.col("s_acctbal").alias("balance"),
                                   F.col("s_name").alias("name"))
    b = t.table("customer").select(F.col("c_acctbal").cast("string").alias("balance"), F.col("c_nationkey").alias("nation"))
    return cols.unify_schema([a, b], target)


PLAYER_SQL = """player_id, club_team_id, club_name, league_id, league_name, overall, potential, age,
    CAST(value_eur AS DOUBLE) AS value_eur, CAST(wage_eur AS DOUBLE) AS wage_eur, player_positions, fifa_update_date"""
PLAYER_OUT = ["player_id", "club_team_id", "club_name", "league_id", "league_name", "overall", "potential", "age",
              "value_eur", "wage_eur", "player_positions", "fifa_update_date"]


@query("clean_table", f"SELECT {PLAYER_SQL} FROM female_clean")
def _(t: Tables):
    from lakemart.plans.players import stg_players

    return stg_players(t.players_female()).select(*PLAYER_OUT)


@query("flatten_struct", "SELECT event_id, CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS INTEGER) AS k FROM events")
def _(t: Tables):
    parsed = t.table("events").select(F.struct("event_id", F.from_json("props", "k int").getField("k").alias("k")).alias("data"))
    return cols.flatten_struct(parsed, "data")


@query("add_columns", """SELECT event_id, hour(ts) AS h, dayofweek(ts) + 1 AS dow, floor(value) * 2 AS twice FROM events""")
def _(t: Tables):
    return cols.add_columns(t.table("events"), {
        "h": s.hour_of("ts"), "dow": s.day_of_week("ts"), "twice": F.floor("value").cast("double") * 2,
    }).select("event_id", "h", "dow", "twice")


# --- filters ----------------------------------------------------------------------------------


@query("filter_anomalies", f"SELECT {SQL_ID}, trip_distance, total_amount, duration_min, pickup_hour, pickup_day_of_week FROM anomaly_free")
def _(t: Tables):
    return prepare_trips(t.trips()).select(*TRIP_ID, "trip_distance", "total_amount", "duration_min", "pickup_hour",
                                           "pickup_day_of_week")


@query("filter_valid_trips", f"""SELECT {SQL_ID}, passenger_count FROM trips
    WHERE trip_distance > 0 AND total_amount > 0 AND passenger_count BETWEEN 1 AND 6""")
def _(t: Tables):
    return flt.filter_valid_trips(t.trips()).select(*TRIP_ID, "passenger_count")


@query("filter_sql", f"""SELECT {SQL_ID}, total_amount FROM trips WHERE trip_distance > 0 AND total_amount > 0
    AND total_amount <= 500 AND passenger_count BETWEEN 0 AND 6""")
def _(t: Tables):
    kept = flt.filter_sql(t.trips(), "trip_distance > :least AND total_amount > :least AND total_amount <= :most "
                          "AND passenger_count BETWEEN 0 AND 6", least=0, most=500)
    return kept.select(*TRIP_ID, "total_amount")


@query("filter_consistent_trips", f"""SELECT {SQL_ID}, duration_min AS trip_duration_minutes FROM prepared
    WHERE duration_min > 0 AND passenger_count BETWEEN 1 AND 6 AND dropoff_datetime > pickup_datetime""")
def _(t: Tables):
    return flt.filter_consistent_trips(t.trips().withColumn("trip_duration_minutes", _minutes())).select(
        *TRIP_ID, "trip_duration_minutes")


@query("filter_required", f"SELECT {SQL_ID} FROM trips WHERE passenger_count IS NOT NULL AND fee IS NOT NULL")
def _(t: Tables):
    return flt.filter_required(t.trips(), ["passenger_count", "fee"]).select(*TRIP_ID)


@query("filter_nonblank", "SELECT id, raw FROM dirty WHERE length(trim(raw)) > 0")
def _(t: Tables):
    return flt.filter_nonblank(t.dirty(), "raw")


@query("filter_flag", """SELECT id, raw FROM dirty WHERE lower(trim(raw)) IN ('t', 'true', 'y', 'yes', '1')""")
def _(t: Tables):
    return flt.filter_flag(t.dirty(), "raw")


@query("filter_suspicious", """SELECT transaction_id, user_id, amount, merchant FROM transactions
    WHERE amount > 1000 AND merchant IN ('Amazon', 'Paypal') AND is_fraud""")
def _(t: Tables):
    return flt.filter_suspicious(t.transactions()).select("transaction_id", "user_id", "amount", "merchant")


@query("filter_valid_date", "SELECT arrest_id, case_number FROM silver_arrests WHERE arrest_date IS NOT NULL")
def _(t: Tables):
    from lakemart.plans.crime import silver_arrests, stg_arrests

    return stg_arrests(silver_arrests(t.arrests_raw())).select("arrest_id", "case_number")


@query("filter_equals_all", f"""SELECT {SQL_ID} FROM trips WHERE pu_location_id = 7 AND do_location_id = 11 AND taxi_type = 'green'""")
def _(t: Tables):
    return flt.filter_equals_all(t.trips(), {"pu_location_id": 7, "do_location_id": 11, "taxi_type": "green"}).select(*TRIP_ID)


@query("text_contains_any", "SELECT doc_id, text LIKE '%the%' OR text LIKE '%der%' AS hit FROM documents")
def _(t: Tables):
    return t.table("documents").select("doc_id", s.text_contains_any("text", ["the", "der"]).alias("hit"))


@query("regex_match", "SELECT id, raw, regexp_full_match(raw, '-?[0-9]+(\\.[0-9]+)?') AS hit FROM dirty")
def _(t: Tables):
    return t.dirty().withColumn("hit", s.regex_match("raw", c.NUMBER_SHAPE))


# --- time -------------------------------------------------------------------------------------


@query("time_parts", """SELECT event_id, hour(ts) AS hour_of, dayofweek(ts) + 1 AS dow_from_1, dayofweek(ts) AS dow_from_0,
    month(ts) AS month_of, year(ts) AS year_of, strftime(ts, '%Y-%m-%d') AS date_of, dayname(ts) AS day_name FROM events""")
def _(t: Tables):
    return t.events().select(
        "event_id", s.hour_of("ts").alias("hour_of"), s.day_of_week("ts").alias("dow_from_1"),
        s.day_of_week("ts", sunday=0).alias("dow_from_0"), s.month_of("ts").alias("month_of"),
        s.year_of("ts").alias("year_of"), s.date_of("ts").alias("date_of"),
        s.day_name(s.day_of_week("ts")).alias("day_name"))


TIME_FUNCTIONS = {
    "hour_of": ("hour(ts)", s.hour_of), "day_of_week": ("dayofweek(ts) + 1", s.day_of_week), "month_of": ("month(ts)", s.month_of),
    "year_of": ("year(ts)", s.year_of), "date_of": ("strftime(ts, '%Y-%m-%d')", s.date_of),
    "day_name": ("dayname(ts)", lambda ts: s.day_name(s.day_of_week(ts))),
}


def _register_time(name, sql, function):
    @query(name, f"SELECT event_id, {sql} AS part FROM events")
    def _(t: Tables):
        return t.events().select("event_id", function("ts").alias("part"))


for _name, (_sql, _function) in TIME_FUNCTIONS.items():
    _register_time(_name, _sql, _function)


@query("duration_minutes", f"SELECT {SQL_ID}, duration_min FROM prepared")
def _(t: Tables):
    return t.trips().select(*TRIP_ID, _minutes().alias("duration_min"))


@query("parse_us_timestamp", """SELECT crime_id, strftime(crime_datetime, '%Y-%m-%d %H:%M:%S') AS parsed FROM silver_crimes""")
def _(t: Tables):
    from lakemart.plans.crime import silver_crimes

    return silver_crimes(t.crimes_raw()).select("crime_id", F.col("crime_datetime").alias("parsed"))


@query("interval_shift", """SELECT event_id, strftime(ts - INTERVAL 5 MINUTES, '%Y-%m-%d %H:%M:%S') AS before,
    strftime(ts + INTERVAL 5 MINUTES, '%Y-%m-%d %H:%M:%S') AS after FROM events""")
def _(t: Tables):
    return t.events().select("event_id", s.interval_shift("ts", "-5 MINUTES").alias("before"),
                             s.interval_shift("ts", "5 MINUTES").alias("after"))


# --- classes and text -------------------------------------------------------------------------


@query("trip_category", f"""SELECT {SQL_ID}, CASE WHEN trip_distance < 2 THEN 'Short' WHEN trip_distance <= 10 THEN 'Medium'
    ELSE 'Long' END AS trip_category FROM trips""")
def _(t: Tables):
    return t.trips().select(*TRIP_ID, s.trip_category("trip_distance").alias("trip_category"))


# A mark in a player's positions and the role it stands for; the first row that fits counts.
ROLES = (("RB", "Wingback"), ("LB", "Wingback"), ("ST", "Poacher"), ("CF", "Poacher"), ("CM", "Regista"), ("CDM", "Regista"))
ROLE_SQL = f"""coalesce((SELECT arg_min(role, place) FROM (VALUES {", ".join(f"({k}, '{m}', '{r}')" for k, (m, r) in enumerate(ROLES))})
    marks(place, mark, role) WHERE contains(player_positions, mark)), 'Other')"""
#: Ages count up to the last one of their group; an unknown age is in the last group.
AGE_SQL = "(['U21', 'Prime', 'Veteran'])[1 + coalesce(CAST(age > 20 AS INT) + CAST(age > 28 AS INT), 2)]"


@query("player_classes", f"""SELECT row_no, {AGE_SQL} AS age_group, {ROLE_SQL} AS role, potential - overall AS growth_gap
    FROM female_clean""")
def _(t: Tables):
    from lakemart.plans.players import stg_players

    return stg_players(t.players_female()).select(
        F.col("row_no").cast("long").alias("row_no"), s.age_group("age").alias("age_group"),
        s.role_class("player_positions").alias("role"), s.growth_gap("potential", "overall").alias("growth_gap"))


@query("charge_type", """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'F' THEN 'felony' WHEN 'M' THEN 'misdemeanor' ELSE 'other' END AS by_flag,
    CASE l_linenumber % 4 WHEN 0 THEN 'felony' WHEN 1 THEN 'misdemeanor' ELSE 'other' END AS by_number FROM lineitem""")
def _(t: Tables):
    letter = F.get(F.array(*map(F.lit, ("F", "M", "X"))), F.col("l_linenumber") % 4)
    return t.table("lineitem").select("l_orderkey", "l_linenumber", s.charge_type("l_returnflag").alias("by_flag"),
                                      s.charge_type(letter).alias("by_number"))


@query("coalesce_default", f"""SELECT {SQL_ID}, coalesce(fee, 0) AS fee, coalesce(passenger_count, -1) AS passengers FROM trips""")
def _(t: Tables):
    return t.trips().select(*TRIP_ID, s.coalesce_default("fee", 0.0).alias("fee"),
                            s.coalesce_default("passenger_count", -1).alias("passengers"))


@query("suffix_id", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '_male' AS player_id FROM customer")
def _(t: Tables):
    return t.table("customer").select("c_custkey", s.suffix_id("c_custkey", "_male").alias("player_id"))


@query("concat_ws", "SELECT crime_id, concat_ws(' ', block, community_area_id, location_description) AS full_text FROM silver_crimes")
def _(t: Tables):
    from lakemart.plans.crime import silver_crimes

    return silver_crimes(t.crimes_raw()).select(
        "crime_id", s.full_text("block", F.col("community_area_id").cast("string"), "location_description").alias("full_text"))


@query("surrogate_key", f"""SELECT {SQL_ID}, md5(CAST(vendor_id AS VARCHAR) || {number_text('fee')} || taxi_type) AS key FROM trips""")
def _(t: Tables):
    return t.trips().select(*TRIP_ID, s.surrogate_key("vendor_id", "fee", "taxi_type").alias("key"))


@query("upper_trim", "SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS name FROM part")
def _(t: Tables):
    return t.table("part").select("p_partkey", s.upper_trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"))


@query("text_length", "SELECT doc_id, length(trim(text, ' ')) AS n FROM documents")
def _(t: Tables):
    return t.table("documents").select("doc_id", s.trimmed_length("text").alias("n"))


@query("parse_json", """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) END AS k FROM events""")
def _(t: Tables):
    from pyspark.sql.types import StructType

    broken = t.table("events").withColumn("props", F.when(F.col("event_id") % 10 == 0, "{broken").otherwise(F.col("props")))
    parsed = s.parse_json(s.bytes_to_text(F.col("props").cast("binary")), StructType.fromDDL("k int"))
    return broken.select("event_id", parsed["k"].alias("k"))


@query("casts", """SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS as_int, CAST(o_orderkey AS DOUBLE) AS as_double,
    CAST(o_orderkey AS VARCHAR) AS as_text, o_orderkey % 3 <> 0 AS as_bool, strftime(o_orderdate, '%Y-%m-%d') AS as_date FROM orders""")
def _(t: Tables):
    return t.table("orders").select(
        "o_orderkey", s.cast_to("o_orderkey", "int").alias("as_int"), s.cast_to("o_orderkey", "double").alias("as_double"),
        s.cast_to("o_orderkey", "string").alias("as_text"), s.cast_to(F.col("o_orderkey") % 3, "boolean").alias("as_bool"),
        s.cast_to("o_orderdate", "date").alias("as_date"))


# --- cleaning ---------------------------------------------------------------------------------

# The tokens as SQL text. Below, a cleaned value that is NULL for them.
_TOKENS = "'', 'na', 'n/a', 'null', 'none', '-', '—'"
_KNOWN = f"CASE WHEN lower(trim(raw)) NOT IN ({_TOKENS}) THEN trim(raw) END"


@query("trimmed_or_null", "SELECT id, nullif(trim(raw), '') AS clean FROM dirty")
def _(t: Tables):
    return t.dirty().select("id", c.trimmed_or_null("raw").alias("clean"))


@query("null_token", f"SELECT id, {_KNOWN} AS clean FROM dirty")
def _(t: Tables):
    return t.dirty().select("id", c.null_token("raw").alias("clean"))


@query("clean_int", f"""SELECT id, CASE WHEN regexp_full_match({_KNOWN}, '-?[0-9]+') THEN TRY_CAST({_KNOWN} AS INTEGER) END AS clean FROM dirty""")
def _(t: Tables):
    return t.dirty().select("id", c.clean_int("raw").alias("clean"))


@query("clean_number", f"""SELECT id, CASE WHEN regexp_full_match({_KNOWN}, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({_KNOWN} AS DOUBLE) END AS clean FROM dirty""")
def _(t: Tables):
    return t.dirty().select("id", c.clean_number("raw").alias("clean"))


@query("clean_bool", f"""SELECT id, CASE WHEN lower({_KNOWN}) IN ('true', 't', '1', 'yes', 'y') THEN TRUE
    WHEN lower({_KNOWN}) IN ('false', 'f', '0', 'no', 'n') THEN FALSE END AS clean FROM dirty""")
def _(t: Tables):
    return t.dirty().select("id", c.clean_bool("raw").alias("clean"))


@query("clean_date", f"""SELECT id, strftime(CASE WHEN regexp_full_match({_KNOWN}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_strptime({_KNOWN}, '%Y-%m-%d')
    WHEN regexp_full_match({_KNOWN}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN try_strptime({_KNOWN}, '%m/%d/%Y') END, '%Y-%m-%d') AS clean FROM dirty""")
def _(t: Tables):
    return t.dirty().select("id", c.clean_date("raw").alias("clean"))


@query("clean_timestamp", f"""SELECT id, strftime(CASE
    WHEN regexp_full_match({_KNOWN}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?')
    THEN coalesce(try_strptime(replace({_KNOWN}, 'T', ' '), '%Y-%m-%d %H:%M:%S'), try_strptime(replace({_KNOWN}, 'T', ' '), '%Y-%m-%d %H:%M'))
    END, '%Y-%m-%d %H:%M:%S') AS clean FROM dirty""")
def _(t: Tables):
    return t.dirty().select("id", c.clean_timestamp("raw").alias("clean"))


