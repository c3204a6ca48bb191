"""The given tables seen as trips, zones, players, crimes and events, in Spark and as SQL.

Amounts and distances are multiples of a power of two, so sums of doubles are exact in any order and
results can be compared bit for bit. The tables hold no NULLs or dirty text; views plant them by key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Edge cases of the cleaning functions, dealt out over the rows of `orders`.
EDGE_TEXTS = (
    " 12 ", "-3", "4.0", "1e5", "+1", "99999999999", "", " ", "NA", "n/a", "None", "-", "—", "Yes", "0", "maybe",
    "2024-02-30", "02/29/2024", "2024-01-02T03:04", "2024-01-02 03:04:05", "2024-03-01", " Null ", "-7.25", "F",
)


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _mod(name: str, n: int) -> Column:
    return F.col(name) % n


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _shift(ts: Column, **amounts: Column) -> Column:
    for unit, amount in amounts.items():
        ts = F.timestamp_add(unit, amount.cast("int"), ts)
    return ts


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    # --- taxi ---------------------------------------------------------------------------------

    def trips(self) -> DataFrame:
        """One trip per line item, both colours, unified names."""
        pickup = _shift(F.col("l_shipdate"), MINUTE=_mod("l_orderkey", 1440), SECOND=_mod("l_suppkey", 60))
        dropoff = _shift(pickup, MINUTE=_mod("l_partkey", 90) - 5, SECOND=_mod("l_orderkey", 7) * 15)
        price = F.floor("l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("part_key"),
            F.col("l_suppkey").alias("vendor_id"),
            _mod("l_suppkey", 30).alias("pu_location_id"), _mod("l_partkey", 30).alias("do_location_id"),
            F.col("l_linenumber").cast("bigint").alias("ratecode_id"), _mod("l_orderkey", 4).alias("payment_type"),
            _unless(_mod("l_partkey", 41) == 0, (F.col("l_orderkey") + F.col("l_linenumber")) % 9).alias("passenger_count"),
            (F.floor(F.col("l_quantity") * F.col("l_discount") * 320) / 64).alias("trip_distance"),
            (price / 128 - 16).alias("total_amount"), (price / 256).alias("fare_amount"),
            (F.floor(F.col("l_discount") * 6400) / 64).alias("tip_amount"),
            _unless(_mod("l_orderkey", 5) == 0, F.floor(F.col("l_tax") * 1600) / 16).alias("fee"),
            (F.col("l_linenumber") / 8).alias("extra"),
            pickup.alias("pickup_datetime"), dropoff.alias("dropoff_datetime"),
            F.col("l_returnflag").alias("store_and_fwd_flag"),
            F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green").alias("taxi_type"),
        )

    def trip_copies(self) -> DataFrame:
        """Every third order's trips delivered twice."""
        copies = F.sequence(F.lit(1), F.when(_mod("order_key", 3) == 0, 2).otherwise(1))
        return self.trips().withColumn("copy", F.explode(copies))

    def raw_trips(self, colour: str) -> DataFrame:
        """Trips of one colour under the column names of its files."""
        prefix, fee = {"yellow": ("tpep", "airport_fee"), "green": ("lpep", "ehail_fee")}[colour]
        names = {"vendor_id": "VendorID", "pu_location_id": "PULocationID", "do_location_id": "DOLocationID",
                 "ratecode_id": "RatecodeID", "pickup_datetime": f"{prefix}_pickup_datetime",
                 "dropoff_datetime": f"{prefix}_dropoff_datetime", "fee": fee}
        return self.trips().filter(F.col("taxi_type") == colour).drop("taxi_type").withColumnsRenamed(names)

    def zones(self) -> DataFrame:
        """Zone lookup as read from CSV: all text, one key that is no number, one unknown borough."""
        nation, region = self.table("nation"), self.table("region")
        key = F.when(F.col("n_nationkey") == 24, "n/a").otherwise(_text(F.col("n_nationkey") + 3))
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            key.alias("location_id"), _unless(F.col("n_nationkey") == 7, F.col("r_name")).alias("borough"),
            F.col("n_name").alias("zone"), F.concat(F.lit("S"), _text("n_regionkey")).alias("service_zone"))

    # --- players ------------------------------------------------------------------------------

    @staticmethod
    def _player_columns(key: str, club: Column, row: str, value: Column, positions: Column, updated: Column) -> list[Column]:
        k = F.col(key)
        return [
            _text(k).alias("Player ID"), _text(row).alias("Row-No"),
            _unless(club % 11 == 10, _text(club)).alias("club_team.id"),
            F.concat(F.lit(" Club "), _text(club)).alias("Club Name"), _text(club % 5).alias("League/ID"),
            F.concat(F.lit("League "), _text(club % 5)).alias("league_name"),
            F.when(k % 97 == 0, "-").otherwise(F.concat(F.lit(" "), _text(40 + k % 60), F.lit(" "))).alias("overall"),
            _text(45 + (k * 7) % 55).alias("potential"), _text(16 + k % 30).alias("age"),
            _text(F.floor(value) + 2000).alias("value_eur"), F.concat(_text(k % 3000), F.lit(".50")).alias("wage_eur"),
            positions.alias("player_positions"), updated.alias("fifa_update_date"),
            *[_text(base + k % span).alias(c) for c, base, span in (
                ("height_cm", 150, 50), ("weight_kg", 50, 45), ("release_clause_eur", 1000, 777), ("pace", 30, 70),
                ("shooting", 31, 69), ("passing", 32, 68), ("dribbling", 33, 67), ("defending", 34, 66), ("physic", 35, 65))],
        ]

    @staticmethod
    def _positions(key: str) -> Column:
        marks = F.array(*map(F.lit, ("RB, CB", "ST", "CM, CDM", "GK", "CF, LB", "CAM")))
        return _unless(F.col(key) % 53 == 0, F.get(marks, (F.col(key) % 6).cast("int")))

    def players_male(self) -> DataFrame:
        return self.table("customer").select(*self._player_columns(
            "c_custkey", F.col("c_nationkey"), "c_custkey", F.col("c_acctbal"), self._positions("c_custkey"),
            F.lit("2023-09-22")))

    def players_female(self) -> DataFrame:
        """Several rows per player, told apart by date; some dates are missing."""
        updated = F.when(_mod("o_orderkey", 13) == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        return self.table("orders").select(*self._player_columns(
            "o_custkey", (F.col("o_orderkey") + F.col("o_custkey")) % 25, "o_orderkey", F.col("o_totalprice"),
            self._positions("o_orderkey"), updated))

    def dirty(self) -> DataFrame:
        index = (F.col("o_orderkey") % len(EDGE_TEXTS)).cast("int")
        return self.table("orders").select(F.col("o_orderkey").alias("id"),
                                           F.get(F.array(*map(F.lit, EDGE_TEXTS)), index).alias("raw"))

    # --- crimes -------------------------------------------------------------------------------

    @staticmethod
    def _us_time(day: Column, second: Column) -> Column:
        start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
        return F.date_format(_shift(start, DAY=day % 1461, SECOND=second), "MM/dd/yyyy hh:mm:ss a")

    def crimes_raw(self) -> DataFrame:
        """One or two rows per order, all text, under the file's column names; some first copies have no readable date."""
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        place = c % 500
        copy = F.explode(F.sequence(F.lit(1), F.when(k % 4 == 0, 2).otherwise(1)))
        return self.table("orders").withColumn("copy", copy).select(
            _text(k).alias("ID"), F.concat(F.lit("HX"), _text(k)).alias("Case Number"),
            F.when((k % 101 == 0) | ((k % 8 == 0) & (F.col("copy") == 1)), "unknown")
             .otherwise(self._us_time(k, c * 37 % 86400)).alias("Date"),
            F.concat(F.lit("BLOCK "), _text(place)).alias("Block"),
            _unless(k % 103 == 0, F.concat(F.when(c % 50 == 0, "a").otherwise("A"), _text(c % 400))).alias("IUCR"),
            F.col("o_orderpriority").alias("Primary Type"), F.concat(F.lit("D"), _text("copy")).alias("Description"),
            _unless(k % 7 == 0, F.when(k % 2 == 0, "STREET").otherwise("HOME")).alias("Location Description"),
            F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "false").alias("Arrest"),
            F.when(k % 3 == 0, "True").otherwise("false").alias("Domestic"),
            _text(place % 90).alias("Beat"), _text(place % 22).alias("District"), _text(place % 45).alias("Ward"),
            F.when(place % 77 == 5, "x").otherwise(_text(place % 77)).alias("Community Area"),
            F.concat(F.lit("0"), _text(k % 9)).alias("FBI Code"),
            _text(1100000 + place * 16 + k % 2).alias("X Coordinate"), _text(1800000 + place * 8).alias("Y Coordinate"),
            _unless(k % 89 == 0, F.concat(F.lit("41."), _text(625 + place % 300))).alias("Latitude"),
            F.concat(F.lit("-87."), _text(525 + place % 400)).alias("Longitude"),
            F.concat(F.lit("("), _text(place), F.lit(")")).alias("Location"),
        )

    def arrests_raw(self) -> DataFrame:
        """One row per line item; arrest ids repeat, every third arrest is a day late.

        Some arrests come twice, once without a readable date.
        """
        k, n = F.col("l_orderkey"), F.col("l_linenumber")
        case = F.when(_mod("l_partkey", 97) == 0, "  ").otherwise(F.concat(F.lit("HX"), _text(k)))
        late = k + F.when(n % 3 == 0, 1).otherwise(0)
        kind = F.when(n % 4 == 0, "F").when(n % 4 == 1, "M").when(n % 4 == 2, "X")
        broken = F.explode(F.when(_mod("l_suppkey", 5) == 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False))))
        return self.table("lineitem").withColumn("broken", broken).select(
            _text(k * 8 + n).alias("CB_NO"), case.alias("CASE NUMBER"),
            F.when(F.col("broken"), "soon").when(_mod("l_partkey", 101) == 0, "").otherwise(
                self._us_time(late, F.col("l_suppkey") * 61 % 86400)).alias("ARREST DATE"),
            F.col("l_returnflag").alias("RACE"), F.concat(F.lit("S"), _text("l_suppkey")).alias("CHARGE 1 STATUTE"),
            F.concat(F.lit("P"), _text("l_partkey"), F.lit("/"), _text(F.col("l_quantity").cast("int")))
             .alias("CHARGE 1 DESCRIPTION"),
            kind.alias("CHARGE 1 TYPE"))

    def codes_raw(self) -> DataFrame:
        k, p = _mod("p_partkey", 400), F.col("p_partkey")
        code = (F.when(k < 100, F.concat(F.lit(" a"), _text(k), F.lit(" ")))
                 .when((k == 399) & (p % 800 >= 400), " A399").otherwise(F.concat(F.lit("A"), _text(k))))
        return self.table("part").select(
            code.alias("IUCR"), _unless(p % 17 == 0, F.col("p_name")).alias("PRIMARY DESCRIPTION"),
            F.col("p_brand").alias("SECONDARY DESCRIPTION"), F.when(p % 2 == 0, "i").otherwise("n").alias("INDEX CODE"),
            F.when(p % 5 == 0, "False").otherwise("true").alias("ACTIVE"))

    # --- events -------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @staticmethod
    def as_activity(events: DataFrame) -> DataFrame:
        device = F.get(F.array(*map(F.lit, ("mobile", "desktop", "tablet"))), (F.col("event_id") % 3).cast("int"))
        return events.select(_text("event_id").alias("event_id"), _text("user_id").alias("user_id"), "event_type",
                             device.alias("device"), F.col("ts").cast("timestamp").alias("timestamp"))

    @staticmethod
    def as_transactions(events: DataFrame) -> DataFrame:
        """Every event as a payment."""
        merchant = F.get(F.array(*map(F.lit, ("Amazon", "Paypal", "Ebay", "Etsy"))), (F.col("event_id") % 4).cast("int"))
        return events.select(
            _text("event_id").alias("transaction_id"), _text("user_id").alias("user_id"),
            (F.floor(F.col("value") * 64) / 8).cast("float").alias("amount"), merchant.alias("merchant"),
            F.lit("USD").alias("currency"), F.col("ts").cast("timestamp").alias("timestamp"),
            (F.col("event_id") % 3 != 1).alias("is_fraud"))

    def activity(self) -> DataFrame:
        return self.as_activity(self.events())

    def transactions(self) -> DataFrame:
        return self.as_transactions(self.events())


# --- the same views in SQL --------------------------------------------------------------------


def _sql_player_columns(k: str, club: str, row: str, value: str, pos: str, updated: str) -> str:
    extras = ", ".join(f"CAST({base} + {k} % {span} AS VARCHAR) AS {c}" for c, base, span in (
        ("height_cm", 150, 50), ("weight_kg", 50, 45), ("release_clause_eur", 1000, 777), ("pace", 30, 70),
        ("shooting", 31, 69), ("passing", 32, 68), ("dribbling", 33, 67), ("defending", 34, 66), ("physic", 35, 65)))
    return f"""SELECT {k} AS player_id, {row} AS row_no,
        CASE WHEN ({club}) % 11 <> 10 THEN {club} END AS club_team_id, 'Club ' || CAST({club} AS VARCHAR) AS club_name,
        ({club}) % 5 AS league_id, 'League ' || CAST(({club}) % 5 AS VARCHAR) AS league_name,
        CASE WHEN {k} % 97 <> 0 THEN 40 + {k} % 60 END AS overall, 45 + ({k} * 7) % 55 AS potential, 16 + {k} % 30 AS age,
        CAST(floor({value}) + 2000 AS BIGINT) AS value_eur, {k} % 3000 + 0.5 AS wage_eur,
        CASE WHEN {pos} % 53 <> 0 THEN (['RB, CB', 'ST', 'CM, CDM', 'GK', 'CF, LB', 'CAM'])[1 + {pos} % 6] END AS player_positions,
        {updated} AS fifa_update_date, {extras}"""


def _sql_us_time(day: str, second: str) -> str:
    return f"TIMESTAMP '2020-01-01 00:00:00' + to_days(CAST(({day}) % 1461 AS INTEGER)) + to_seconds({second})"


def number_text(name: str) -> str:
    """A double as a plain decimal without trailing zeros."""
    return rf"regexp_replace(CAST(CAST({name} AS DECIMAL(38, 10)) AS VARCHAR), '\.?0+$', '')"


_EDGES = ", ".join("'" + t.replace("'", "''") + "'" for t in EDGE_TEXTS)

SQL_VIEWS = {
    "trips": """
        SELECT *, pickup_datetime + to_minutes(part_key % 90 - 5) + to_seconds(order_key % 7 * 15) AS dropoff_datetime
        FROM (SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS vendor_id,
            l_suppkey % 30 AS pu_location_id, l_partkey % 30 AS do_location_id,
            CAST(l_linenumber AS BIGINT) AS ratecode_id, l_orderkey % 4 AS payment_type,
            CASE WHEN l_partkey % 41 <> 0 THEN (l_orderkey + l_linenumber) % 9 END AS passenger_count,
            floor(l_quantity * l_discount * 320) / 64 AS trip_distance,
            floor(l_extendedprice) / 128 - 16 AS total_amount, floor(l_extendedprice) / 256 AS fare_amount,
            floor(l_discount * 6400) / 64 AS tip_amount,
            CASE WHEN l_orderkey % 5 <> 0 THEN floor(l_tax * 1600) / 16 END AS fee,
            CAST(l_linenumber AS DOUBLE) / 8 AS extra,
            l_shipdate + to_minutes(l_orderkey % 1440) + to_seconds(l_suppkey % 60) AS pickup_datetime,
            l_returnflag AS store_and_fwd_flag,
            CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS taxi_type FROM lineitem)""",
    "trip_copies": """SELECT *, unnest(generate_series(1, CASE WHEN order_key % 3 = 0 THEN 2 ELSE 1 END)) AS copy
        FROM trips""",
    "zones": """
        SELECT CASE WHEN n_nationkey = 24 THEN 'n/a' ELSE CAST(n_nationkey + 3 AS VARCHAR) END AS location_id,
            CASE WHEN n_nationkey <> 7 THEN r_name END AS borough, n_name AS zone,
            'S' || CAST(n_regionkey AS VARCHAR) AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "zone_ids": "SELECT TRY_CAST(location_id AS BIGINT) AS location_id, borough, zone, service_zone FROM zones",
    "known_zones": "SELECT location_id FROM zone_ids WHERE location_id IS NOT NULL",
    "prepared": """
        SELECT *, hour(pickup_datetime) AS pickup_hour, dayofweek(pickup_datetime) + 1 AS pickup_day_of_week,
            round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 4)::DOUBLE AS duration_min
        FROM trips""",
    "anomaly_free": """
        SELECT * FROM prepared WHERE trip_distance >= 0.1 AND total_amount >= 2 AND duration_min >= 1""",
    "joined": """
        SELECT t.*, p.zone AS pickup_zone, d.zone AS dropoff_zone FROM anomaly_free t
        LEFT JOIN zone_ids p ON p.location_id = t.pu_location_id
        LEFT JOIN zone_ids d ON d.location_id = t.do_location_id""",
    "male_clean": "SELECT *, 'MALE' AS gender FROM (" + _sql_player_columns(
        "c_custkey", "c_nationkey", "c_custkey", "c_acctbal", "c_custkey", "'2023-09-22'") + " FROM customer)",
    "female_clean": _sql_player_columns(
        "o_custkey", "((o_orderkey + o_custkey) % 25)", "o_orderkey", "o_totalprice", "o_orderkey",
        "CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END") + " FROM orders",
    "female_latest": """
        SELECT * EXCLUDE (rn), 'FEMALE' AS gender FROM (SELECT *, row_number() OVER (
            PARTITION BY player_id ORDER BY fifa_update_date DESC NULLS FIRST, row_no) AS rn FROM female_clean)
        WHERE rn = 1""",
    "dirty": f"SELECT o_orderkey AS id, ([{_EDGES}])[1 + o_orderkey % {len(EDGE_TEXTS)}] AS raw FROM orders",
    "silver_crimes": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS crime_id, 'HX' || CAST(o_orderkey AS VARCHAR) AS case_number,
            CASE WHEN o_orderkey % 101 <> 0 THEN {_sql_us_time('o_orderkey', 'o_custkey * 37 % 86400')} END AS crime_datetime,
            'BLOCK ' || CAST(o_custkey % 500 AS VARCHAR) AS block,
            (CASE WHEN o_custkey % 50 = 0 THEN 'a' ELSE 'A' END) || CAST(o_custkey % 400 AS VARCHAR) AS iucr_code,
            o_orderpriority AS primary_type,
            CASE WHEN o_orderkey % 8 = 0 AND o_orderkey % 101 <> 0 THEN 'D2' ELSE 'D1' END AS description,
            CASE WHEN o_orderkey % 7 = 0 THEN 'Unknown' WHEN o_orderkey % 2 = 0 THEN 'STREET' ELSE 'HOME' END AS location_description,
            CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_arrest, o_orderkey % 3 = 0 AS is_domestic,
            o_custkey % 500 % 90 AS beat_id, o_custkey % 500 % 45 AS ward_id,
            CASE WHEN o_custkey % 500 % 77 <> 5 THEN o_custkey % 500 % 77 END AS community_area_id,
            '0' || CAST(o_orderkey % 9 AS VARCHAR) AS fbi_code,
            CAST(1100000 + o_custkey % 500 * 16 + o_orderkey % 2 AS DOUBLE) AS x_coordinate,
            CAST(1800000 + o_custkey % 500 * 8 AS DOUBLE) AS y_coordinate,
            CAST('41.' || CAST(625 + o_custkey % 500 % 300 AS VARCHAR) AS DOUBLE) AS latitude,
            CAST('-87.' || CAST(525 + o_custkey % 500 % 400 AS VARCHAR) AS DOUBLE) AS longitude,
            '(' || CAST(o_custkey % 500 AS VARCHAR) || ')' AS location_geo_point, o_custkey % 500 % 22 AS district_id
        FROM orders WHERE o_orderkey % 89 <> 0 AND o_orderkey % 103 <> 0""",
    "silver_arrests": f"""
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY arrest_id ORDER BY arrest_date NULLS LAST,
                case_number, arrestee_race, charge_one_statue, charge_one_description, charge_one_type) AS rn
            FROM (SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS arrest_id, 'HX' || CAST(l_orderkey AS VARCHAR) AS case_number,
                CASE WHEN l_partkey % 101 <> 0 AND NOT broken THEN {_sql_us_time('l_orderkey + CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END', 'l_suppkey * 61 % 86400')}
                END AS arrest_date, l_returnflag AS arrestee_race, 'S' || CAST(l_suppkey AS VARCHAR) AS charge_one_statue,
                'P' || CAST(l_partkey AS VARCHAR) || '/' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS charge_one_description,
                CASE l_linenumber % 4 WHEN 0 THEN 'felony' WHEN 1 THEN 'misdemeanor' ELSE 'other' END AS charge_one_type
                FROM (SELECT *, unnest(CASE WHEN l_suppkey % 5 = 0 THEN [TRUE, FALSE] ELSE [FALSE] END) AS broken FROM lineitem)
                WHERE l_partkey % 97 <> 0))
        WHERE rn = 1""",
    "silver_codes": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY iucr_code
                ORDER BY primary_description, secondary_description, index_code) AS rn
            FROM (SELECT CASE WHEN p_partkey % 400 < 100 THEN ' a' || CAST(p_partkey % 400 AS VARCHAR) || ' '
                    WHEN p_partkey % 400 = 399 AND p_partkey % 800 >= 400 THEN ' A399'
                    ELSE 'A' || CAST(p_partkey % 400 AS VARCHAR) END AS iucr_code,
                CASE WHEN p_partkey % 17 = 0 THEN 'Unknown' ELSE p_name END AS primary_description,
                p_brand AS secondary_description, CASE WHEN p_partkey % 2 = 0 THEN 'i' ELSE 'n' END AS index_code
                FROM part WHERE p_partkey % 5 <> 0))
        WHERE rn = 1""",
    "stg_codes": """SELECT upper(trim(iucr_code)) AS iucr_code, upper(trim(primary_description)) AS primary_description,
            upper(trim(secondary_description)) AS secondary_description, upper(trim(index_code)) AS index_code
        FROM silver_codes""",
    "stg_crimes": """
        SELECT c.*, i.primary_description, i.secondary_description, i.index_code, CAST(crime_datetime AS DATE) AS crime_date,
            hour(crime_datetime) AS crime_hour, dayofweek(crime_datetime) AS crime_day_of_week,
            month(crime_datetime) AS crime_month, year(crime_datetime) AS crime_year
        FROM silver_crimes c LEFT JOIN stg_codes i ON i.iucr_code = c.iucr_code""",
    "dim_location": """
        WITH places AS (
            SELECT block, latitude, longitude, x_coordinate, y_coordinate, arg_min({'location_description': location_description,
                'beat_id': beat_id, 'district_id': district_id, 'ward_id': ward_id, 'community_area_id': community_area_id},
                crime_id) AS of_first
            FROM stg_crimes GROUP BY ALL)
        SELECT md5(block || """ + " || ".join(map(number_text, ("latitude", "longitude", "x_coordinate", "y_coordinate"))) + """
                ) AS location_key,
            block, of_first.location_description, latitude, longitude, x_coordinate, y_coordinate, of_first.beat_id,
            of_first.district_id, of_first.ward_id, of_first.community_area_id,
            concat_ws(' ', block, of_first.location_description) AS location_full_text
        FROM places""",
    "dim_crime_type": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY iucr_code
            ORDER BY primary_description, secondary_description, index_code) AS rn FROM stg_codes) WHERE rn = 1""",
    # Facts by lists: all place keys of a spot, and all codes of a case's day, are gathered and then unnested.
    "spots": """
        SELECT block, latitude, longitude, list(location_key) AS keys FROM dim_location
        WHERE block IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL""",
    "fact_crimes": """
        WITH keyed AS (
            SELECT crime_id, case_number, crime_datetime, crime_date, crime_hour, crime_day_of_week, crime_month, crime_year,
                is_arrest IS NOT DISTINCT FROM TRUE AS is_arrest, is_domestic IS NOT DISTINCT FROM TRUE AS is_domestic,
                primary_type, fbi_code, iucr_code AS raw_code, unnest(coalesce(keys, [NULL])) AS location_key
            FROM stg_crimes LEFT JOIN spots USING (block, latitude, longitude))
        SELECT keyed.* EXCLUDE (raw_code), t.iucr_code, t.primary_description, t.secondary_description, t.index_code
        FROM keyed LEFT JOIN dim_crime_type t ON t.iucr_code = raw_code""",
    "case_days": """
        SELECT case_number, crime_date, list(coalesce(iucr_code, '?')) AS found FROM fact_crimes GROUP BY ALL""",
    "fact_arrests": """
        WITH coded AS (
            SELECT a.*, unnest(coalesce(found, ['?'])) AS found_code FROM silver_arrests a
            LEFT JOIN case_days d ON d.case_number = a.case_number AND d.crime_date = date_trunc('day', a.arrest_date)
            WHERE a.arrest_date IS NOT NULL)
        SELECT coded.* EXCLUDE (found_code), t.iucr_code, t.primary_description, t.secondary_description, t.index_code
        FROM coded LEFT JOIN dim_crime_type t ON t.iucr_code = found_code""",
    "activity": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
            (['mobile', 'desktop', 'tablet'])[1 + event_id % 3] AS device, ts AS "timestamp" FROM events""",
    "transactions": """
        SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
            CAST(CAST(floor(value * 64) / 8 AS FLOAT) AS DOUBLE) AS amount,
            (['Amazon', 'Paypal', 'Ebay', 'Etsy'])[1 + event_id % 4] AS merchant, 'USD' AS currency,
            ts AS "timestamp", event_id % 3 <> 1 AS is_fraud
        FROM events""",
}


def with_views(body: str) -> str:
    """Prefix SQL text with the views it names, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in SQL_VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(SQL_VIEWS[name])

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in SQL_VIEWS.items() if name in needed)
    own = re.match(r"\s*WITH\b", body)
    return f"WITH {ctes},\n{body[own.end():]}" if own else f"WITH {ctes}\n{body}"
