"""Sources, sinks and table history, on files that Spark writes from the given tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators import changes as chg
from lakemart.operators.columns import provenance_columns
from lakemart.operators.unions import union_by_name
from lakemart.parity.registry import query, rounded
from lakemart.parity.relational import HOURLY_SQL, RUN_TIME, ZONE_DAYS_SQL, ZONE_SUMMARY_SQL
from lakemart.parity.row_level import SQL_ID, TRIP_ID
from lakemart.parity.views import Tables
from lakemart.plans import crime, taxi
from lakemart.session import scratch_database, scratch_path
from lakemart.sources import files, schemas, sinks

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
ORDERS_DDL = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"


def _orders(t: Tables):
    return t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _by_year(t: Tables) -> tuple[str, list[int]]:
    """The orders in one folder per year, from one write."""
    parts, root = scratch_path(t.spark, "parts"), scratch_path(t.spark, "years")
    t.table("orders").withColumn("year", F.year("o_orderdate")).hint("rebalance", "year").write.partitionBy("year").parquet(parts)
    context = t.spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    system = path(parts).getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(path(root))
    years = []
    for status in system.listStatus(path(parts)):
        name = status.getPath().getName()
        if name.startswith("year="):
            years.append(int(name.removeprefix("year=")))
            system.rename(status.getPath(), path(f"{root}/{years[-1]}"))
    return root, sorted(years)


# --- files ------------------------------------------------------------------------------------


@query("scan_csv", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _(t: Tables):
    path = scratch_path(t.spark, "csv")
    t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").write.option("header", True).csv(path)
    return files.scan_csv(t.spark, path)


ORDERS_TEXT_SQL = "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders"


@query("scan_csv_many", f"{ORDERS_TEXT_SQL} UNION ALL {ORDERS_TEXT_SQL}")
def _(t: Tables):
    paths = [scratch_path(t.spark, "csv") for _ in range(2)]
    for path in paths:
        _orders(t).drop("o_totalprice").write.option("header", True).csv(path)
    return files.scan_csv(t.spark, paths)


@query("ingest_files", """SELECT p_partkey, p_name, 'p_partkey int, p_name string' AS types FROM part""")
def _(t: Tables):
    path = f"{scratch_path(t.spark, 'ingest')}/parts"
    t.table("part").select("p_partkey", "p_name").write.option("header", True).csv(path)
    database = scratch_database(t.spark)
    types = files.ingest_files(t.spark, [path], database)
    listed = ", ".join(f"{r['column']} {r['type']}" for r in types.collect())
    return t.spark.table(f"{database}.parts").withColumn("types", F.lit(listed))


@query("schema_diff", """SELECT * FROM (VALUES ('passenger_count', 'bigint', 'double'), ('fee', 'double', NULL), ('surplus', NULL, 'string'))
    x(name, left_type, right_type) WHERE (SELECT count(*) FROM lineitem) > 0""")
def _(t: Tables):
    trips = t.trips()
    other = trips.drop("fee").withColumn("passenger_count", F.col("passenger_count").cast("double")).withColumn("surplus", F.lit("x"))
    return schemas.schema_diff(trips, other)


@query("scan_csv_inferred", ORDERS_SQL)
def _(t: Tables):
    path = scratch_path(t.spark, "csv")
    _orders(t).write.option("header", True).csv(path)
    return files.scan_csv_inferred(t.spark, path)


@query("scan_csv_dialect", "SELECT p_partkey, trim(p_name) AS p_name, NULL AS absent FROM part")
def _(t: Tables):
    path = scratch_path(t.spark, "dialect")
    t.table("part").select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name")).write.options(
        header=True, sep="|", compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.scan_csv_dialect(t.spark, path, "p_partkey long, p_name string, absent string", sep="|")


@query("scan_years", f"{ORDERS_SQL} WHERE year(o_orderdate) NOT IN (1996, 1999)")
def _(t: Tables):
    root, years = _by_year(t)
    return files.scan_years(t.spark, root, years, StructType.fromDDL(ORDERS_DDL), skip=(1996, 1999))


@query("scan_days", """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders
    WHERE year(o_orderdate) = 1996 AND month(o_orderdate) <= 3""")
def _(t: Tables):
    """Orders by year; the days come from a calendar table, whose filter prunes the years."""
    root = scratch_path(t.spark, "by-year")
    orders = t.table("orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("ordered"))
    sinks.write_by_year(orders, f"{root}/orders", "ordered")
    orders.select(F.to_date("ordered").alias("date")).distinct().withColumn("quarter", F.quarter("date")).write.parquet(f"{root}/days")
    days = t.spark.read.parquet(f"{root}/days").filter("quarter = 1 AND year(date) = 1996").withColumn("month", F.date_format("date", "yyyy-MM"))
    return files.scan_days(t.spark.read.parquet(f"{root}/orders"), days, "ordered").select("o_orderkey", "o_totalprice", "month")


@query("scan_glob", f"{ORDERS_SQL} WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def _(t: Tables):
    return files.scan_glob(t.spark, f"{_by_year(t)[0]}/199[6-8]", StructType.fromDDL(ORDERS_DDL))


@query("scan_recursive", ORDERS_SQL)
def _(t: Tables):
    return files.scan_recursive(t.spark, _by_year(t)[0], StructType.fromDDL(ORDERS_DDL))


def _drifted(t: Tables) -> list[str]:
    """Two folders of customers; column sets and types differ between the files of the first one too."""
    root = scratch_path(t.spark, "drifted")
    base = t.table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    base.filter("c_custkey % 4 = 0").drop("c_acctbal").write.parquet(f"{root}/a")
    base.filter("c_custkey % 4 = 1").write.mode("append").parquet(f"{root}/a")
    base.filter("c_custkey % 4 = 2").withColumn("c_nationkey", F.col("c_nationkey").cast("double")).write.mode("append").parquet(f"{root}/a")
    base.filter("c_custkey % 4 = 3").withColumn("c_custkey", F.col("c_custkey").cast("int")).write.parquet(f"{root}/b")
    return [f"{root}/a", f"{root}/b"]


@query("scan_merged", "SELECT c_custkey, c_nationkey, NULL AS c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def _(t: Tables):
    root = scratch_path(t.spark, "merged")
    t.table("customer").select("c_custkey", "c_nationkey").write.parquet(f"{root}/a")
    t.table("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"),
                               F.col("s_acctbal").alias("c_acctbal")).write.parquet(f"{root}/b")
    return files.scan_merged(t.spark, [f"{root}/a", f"{root}/b"])


@query("scan_drifted", "SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal FROM customer")
def _(t: Tables):
    return files.scan_drifted(t.spark, _drifted(t), StructType.fromDDL("c_custkey long, c_nationkey long, c_acctbal double"))


@query("bulk_load", "SELECT o_orderkey AS id, o_custkey AS amount, NULL AS absent FROM orders WHERE o_orderkey % 9 <> 0")
def _(t: Tables):
    path = scratch_path(t.spark, "load")
    t.table("orders").select(F.when(F.col("o_orderkey") % 9 == 0, "bad").otherwise(F.col("o_orderkey").cast("string")).alias("ID"),
                             F.col("o_custkey").alias("Amount"), F.lit("x").alias("surplus")).write.option("header", True).csv(path)
    return files.bulk_load(files.scan_csv(t.spark, path), StructType.fromDDL("id long, amount double, absent string"))


@query("load_or_quarantine", """SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'malformed line' WHEN o_orderkey % 9 = 0 AND o_orderkey % 5 = 0 THEN 'not a bigint, not a double'
        WHEN o_orderkey % 9 = 0 THEN 'not a bigint' WHEN o_orderkey % 5 = 0 THEN 'not a double' ELSE 'loaded' END AS status,
    CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 9 = 0 THEN 'bad' || CAST(o_orderkey AS VARCHAR) END AS value,
    CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 9 <> 0 AND o_orderkey % 5 <> 0 THEN o_orderkey END AS id FROM orders""")
def _(t: Tables):
    """Orders as lines of text: some ids and amounts are no numbers, some lines have a field too many."""
    path, key = scratch_path(t.spark, "load"), F.col("o_orderkey")
    line = F.concat_ws(",", F.when(key % 9 == 0, F.concat(F.lit("bad"), key)).otherwise(key.cast("string")),
                       F.when(key % 5 == 0, "dear").otherwise(F.col("o_totalprice").cast("string")), F.when(key % 11 == 0, "surplus"))
    t.table("orders").select(line.alias("value")).write.text(f"{path}/in")
    rows = files.scan_csv_lines(t.spark, f"{path}/in", ["id", "amount"], header="false")
    loaded, kept = files.load_or_quarantine(rows, StructType.fromDDL("id long, amount double"), f"{path}/out")
    none = F.lit(None)
    return loaded.select(F.lit("loaded").alias("status"), none.cast("string").alias("value"), "id").unionByName(kept.select(
        F.when(F.array_contains("problems.reason", "malformed line"), "malformed line").otherwise(F.array_join("problems.reason", ", "))
        .alias("status"), F.when(~F.array_contains("problems.reason", "malformed line"), F.get(F.filter(
            "problems", lambda p: p["column"] == "id"), F.lit(0))["value"]).alias("value"), none.cast("long").alias("id")))


@query("load_report", """SELECT count(*) AS rows_parsed, count(*) FILTER (WHERE o_orderkey % 9 <> 0) AS rows_loaded,
    count(*) FILTER (WHERE o_orderkey % 9 = 0) AS rows_rejected FROM orders""")
def _(t: Tables):
    path = scratch_path(t.spark, "load")
    t.table("orders").select(F.when(F.col("o_orderkey") % 9 == 0, "bad").otherwise(F.col("o_orderkey").cast("string")).alias("ID")
                             ).write.option("header", True).csv(path)
    report = files.load_report(files.scan_csv(t.spark, path), StructType.fromDDL("id long"))
    return report.agg(*[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "rows_rejected")])


@query("list_files", "SELECT year(o_orderdate) AS year, TRUE AS has_bytes FROM orders GROUP BY 1")
def _(t: Tables):
    listed = files.list_files(t.spark, _by_year(t)[0], "*.parquet")
    year = F.regexp_extract("path", r"/(\d{4})/[^/]*$", 1).cast("int")
    return listed.groupBy(year.alias("year")).agg((F.sum("length") > 0).alias("has_bytes"))


@query("write_report", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1")
def _(t: Tables):
    path = scratch_path(t.spark, "report")
    sinks.write_report(t.table("orders").groupBy("o_custkey").agg(F.count("*").alias("orders")), path)
    return t.spark.read.parquet(path)


@query("save_table", ORDERS_SQL)
def _(t: Tables):
    name = f"{scratch_database(t.spark)}.saved"
    sinks.save_table(_orders(t), name, scratch_path(t.spark, "table"))
    return files.read_table(t.spark, name)


@query("create_table_as", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def _(t: Tables):
    name = f"{scratch_database(t.spark)}.made"
    sinks.create_table_as(t.spark, name, "SELECT o_orderstatus, count(*) AS orders FROM {rows} GROUP BY 1", rows=_orders(t))
    return files.read_table(t.spark, name)


@query("materialize", " UNION ALL ".join(f"SELECT *, '{kind}' AS kind FROM ({ORDERS_SQL})" for kind in ("table", "view", "inline")))
def _(t: Tables):
    layer = scratch_database(t.spark)
    kept = {kind: sinks.materialize(_orders(t), f"orders_{kind}", kind, layer) for kind in ("table", "view", "inline")}
    return union_by_name(*[df.withColumn("kind", F.lit(k)) for k, df in kept.items()])


#: Raw text is packed, and quoted in full, so that an empty text stays one and blanks around codes survive.
RAW_CSV = {"header": True, "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
           "compression": "lz4"}


def raw_crime_files(t: Tables) -> str:
    """The three raw tables as CSV."""
    raw = scratch_path(t.spark, "raw")
    for name, frame in (("crimes", t.crimes_raw()), ("arrests", t.arrests_raw()), ("iucr", t.codes_raw())):
        frame.write.options(**RAW_CSV).csv(f"{raw}/{name}")
    return raw


@query("bronze_layers", """SELECT 'crimes' AS layer, CAST(o_orderkey AS VARCHAR) AS id, 'D' || CAST(copy AS VARCHAR) AS detail,
        '2024-05-01 12:00:00' AS load_timestamp, TRUE AS named
    FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 4 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM orders)
    UNION ALL SELECT 'arrests', CAST(l_orderkey * 8 + l_linenumber AS VARCHAR),
        'P' || CAST(l_partkey AS VARCHAR) || '/' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '2024-05-01 12:00:00', TRUE
    FROM (SELECT *, unnest(CASE WHEN l_suppkey % 5 = 0 THEN [1, 2] ELSE [1] END) FROM lineitem)
    UNION ALL SELECT 'iucr', CASE WHEN k < 100 THEN ' a' || CAST(k AS VARCHAR) || ' ' WHEN k = 399 AND p_partkey % 800 >= 400 THEN ' A399'
        ELSE 'A' || CAST(k AS VARCHAR) END, p_brand, '2024-05-01 12:00:00', TRUE FROM (SELECT *, p_partkey % 400 AS k FROM part)""")
def _(t: Tables):
    raw, out = raw_crime_files(t), scratch_path(t.spark, "bronze")
    crime.load_bronze(t.spark, f"{raw}/crimes", f"{raw}/arrests", f"{raw}/iucr", out, datetime(2024, 5, 1, 12))
    layers = []
    for name, key, detail in (("crimes", "ID", "Description"), ("arrests", "CB_NO", "CHARGE 1 DESCRIPTION"),
                              ("iucr", "IUCR", "SECONDARY DESCRIPTION")):
        rows = t.spark.read.parquet(f"{out}/{name}")
        named = F.col("source_file").contains(f"/{name}/") if "source_file" in rows.columns else F.lit(True)
        layers.append(rows.select(F.lit(name).alias("layer"), F.col(f"`{key}`").alias("id"), F.col(f"`{detail}`").alias("detail"),
                                  F.to_timestamp_ntz(F.col("load_timestamp").cast("string")).alias("load_timestamp"), named.alias("named")))
    return union_by_name(*layers)


@query("provenance_columns", "SELECT o_orderkey, '2024-05-01 12:00:00' AS load_timestamp, 'orders.parquet' AS source_file FROM orders")
def _(t: Tables):
    stamped = provenance_columns(t.table("orders"), datetime(2024, 5, 1, 12))
    return stamped.select("o_orderkey", F.to_timestamp_ntz(F.col("load_timestamp").cast("string")).alias("load_timestamp"),
                          F.regexp_extract("source_file", "([^/]+)$", 1).alias("source_file"))


def raw_taxi_files(t: Tables) -> str:
    """Both colours as Parquet, the zones as CSV; some yellow files hold passengers as doubles."""
    root = scratch_path(t.spark, "taxi")
    yellow = t.raw_trips("yellow")
    yellow.filter("order_key % 2 = 0").write.options(**sinks.PACKED).parquet(f"{root}/yellow")
    doubled = yellow.filter("order_key % 2 = 1").withColumn("passenger_count", F.col("passenger_count").cast("double"))
    doubled.write.mode("append").options(**sinks.PACKED).parquet(f"{root}/yellow")
    t.raw_trips("green").write.options(**sinks.PACKED).parquet(f"{root}/green")
    t.zones().withColumnsRenamed({"location_id": "LocationID", "zone": "Zone", "borough": "Borough"}).write.option(
        "header", True).csv(f"{root}/zones")
    return root


def _zone_reports(t: Tables) -> dict[str, str]:
    root = raw_taxi_files(t)
    return taxi.run_zone_reports(t.spark, [f"{root}/yellow"], [f"{root}/green"], f"{root}/zones", f"{root}/out",
                                 datetime(2024, 5, 1).date())


@query("run_zone_reports", ZONE_SUMMARY_SQL)
def _(t: Tables):
    return t.spark.read.parquet(_zone_reports(t)["zone_statistic"])


@query("run_zone_reports_days", ZONE_DAYS_SQL)
def _(t: Tables):
    return t.spark.read.parquet(_zone_reports(t)["zone_days_statistic"])


# --- changes of tables ------------------------------------------------------------------------

TRIP_ROWS = (*TRIP_ID, "pu_location_id", "fee", "taxi_type")
KEPT = f"SELECT {SQL_ID}, pu_location_id, fee, taxi_type FROM trips"


def _trip_table(t: Tables):
    return t.trips().select(*TRIP_ROWS)


def _suppliers(t: Tables):
    return t.table("supplier").select(F.col("s_suppkey").alias("order_key"), F.lit("new").alias("taxi_type"))


@query("delete_where", f"{KEPT} WHERE NOT coalesce(fee > 4 AND pu_location_id = 7, FALSE)")
def _(t: Tables):
    return chg.delete_rows(_trip_table(t), (F.col("fee") > 4) & (F.col("pu_location_id") == 7))


@query("update_where", f"""SELECT {SQL_ID}, pu_location_id, CASE WHEN fee > 4 THEN fee * 2 ELSE fee END AS fee, taxi_type FROM trips""")
def _(t: Tables):
    return chg.update_rows(_trip_table(t), F.col("fee") > 4, {"fee": F.col("fee") * 2})


@query("insert_into_version", f"""{KEPT} UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL, NULL, 'new' FROM supplier""")
def _(t: Tables):
    return chg.insert_rows(_trip_table(t), _suppliers(t))


CHANGED = "(fee > 4 AND pu_location_id = 7)"


def _states(t: Tables) -> list:
    """The trips as they were, after an update, and after a delete on top of it."""
    first = _trip_table(t)
    second = chg.update_rows(first, (F.col("fee") > 4) & (F.col("pu_location_id") == 7), {"fee": F.col("fee") + 1})
    return [first, second, chg.delete_rows(second, (F.col("fee") < 1) & (F.col("pu_location_id") == 8))]


def _history(t: Tables):
    """All changes with their times: the first state as inserts, then an update at 13:00 and a delete at 14:00."""
    states = [_trip_table(t).limit(0), *_states(t)]
    return union_by_name(*[chg.table_changes(a, b).withColumn("changed_at", F.lit(f"2024-05-01 {12 + k}:00:00").cast("timestamp_ntz"))
                           for k, (a, b) in enumerate(zip(states, states[1:]))])


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("read_as_of", f"""SELECT {SQL_ID}, pu_location_id, CASE WHEN {CHANGED} THEN fee + 1 ELSE fee END AS fee, taxi_type FROM trips""")
def _(t: Tables):
    return chg.rows_as_of(_history(t), _moment("2024-05-01 13:30:00"))


@query("restore_version", KEPT)
def _(t: Tables):
    history = _history(t)
    back = chg.restore_version(history, _moment("2024-05-01 12:00:00"), _moment("2024-05-01 15:00:00"))
    return chg.rows_as_of(history.unionByName(back), _moment("2024-05-01 15:00:00"))


@query("version_changes", f"""SELECT {SQL_ID}, pu_location_id, fee, taxi_type, 'DELETE' AS action, TRUE AS is_update FROM trips WHERE {CHANGED}
    UNION ALL SELECT {SQL_ID}, pu_location_id, fee + 1, taxi_type, 'INSERT', TRUE FROM trips WHERE {CHANGED}
    UNION ALL SELECT {SQL_ID}, pu_location_id, fee, taxi_type, 'DELETE', FALSE FROM trips WHERE coalesce(fee < 1 AND pu_location_id = 8, FALSE)""")
def _(t: Tables):
    states = _states(t)
    return chg.table_changes(states[0], states[-1], key=TRIP_ID)


@query("consume_changes", f"""SELECT CAST(s_suppkey AS BIGINT) AS order_key, 'INSERT' AS action, 1 AS position FROM supplier
    UNION ALL SELECT s_suppkey, 'DELETE', 2 FROM supplier UNION ALL SELECT s_suppkey + 1000000, 'INSERT', 2 FROM supplier""")
def _(t: Tables):
    """Every position is consumed twice, and the second one breaks off once after its write."""
    log = f"{scratch_database(t.spark)}.log"
    first = _trip_table(t)
    second = chg.insert_rows(first, _suppliers(t))
    states = [first, second, chg.update_rows(second, F.col("taxi_type") == "new", {"order_key": F.col("order_key") + 1_000_000})]
    for position in (1, 1, 2, 2):
        chg.consume_changes(t.spark, states.__getitem__, position, log)
    again = chg.table_changes(states[1], states[2])  # as a run does that never saw its own write
    chg.log_changes(again, log, 2)
    return t.spark.table(log).select("order_key", "action", "position")


@query("guarded_insert", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 1""")
def _(t: Tables):
    base = t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    raised = base.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 3 == 1, 1).otherwise(0))
    return chg.insert_rows(base, chg.guarded_rows(raised.unionByName(raised), base, on_duplicate="skip"))


@query("clone_table", f"""{KEPT.replace("SELECT", "SELECT 'origin' AS side,", 1)} UNION ALL
    {KEPT.replace("SELECT", "SELECT 'copy' AS side,", 1)} WHERE fee <= 4 OR fee IS NULL""")
def _(t: Tables):
    layer = scratch_database(t.spark)
    origin = sinks.materialize(_trip_table(t), "origin", "table", layer)
    sinks.create_table_as(t.spark, f"{layer}.copy", "SELECT * FROM {rows}", rows=origin)
    copy = chg.delete_rows(t.spark.table(f"{layer}.copy"), F.col("fee") > 4)
    return union_by_name(origin.withColumn("side", F.lit("origin")), copy.withColumn("side", F.lit("copy")))


@query("hourly_increment", f"{HOURLY_SQL} UNION ALL {HOURLY_SQL.replace(RUN_TIME, '2024-05-01 13:00:00')}")
def _(t: Tables):
    """Each period is run twice."""
    trips = t.trips().withColumn("pickup_hour", F.hour("pickup_datetime"))
    table = f"{scratch_database(t.spark)}.stats"
    for hour in (12, 13, 12, 13):
        chg.save_hourly_stats(trips, table, datetime(2024, 5, 1, hour, tzinfo=timezone.utc))
    return t.spark.table(table).select("ts", "pickup_hour", "total_trips", "avg_trip_distance", "avg_total_amount")


@query("hourly_history", f"""SELECT strftime(pickup_datetime, '%Y-%m-%d') AS "day", pickup_hour, count(*) AS total_trips,
    round(avg(trip_distance), 4) AS avg_trip_distance, round(avg(total_amount), 4) AS avg_total_amount,
    count(DISTINCT vendor_id) AS distinct_values FROM prepared GROUP BY ALL""")
def _(t: Tables):
    """Three loads; the second is run twice, and the third brings trips of days that the others have already."""
    trips = t.trips().withColumn("pickup_hour", F.hour("pickup_datetime"))
    table = f"{scratch_database(t.spark)}.states"
    part = F.pmod(F.xxhash64("order_key", "part_key"), F.lit(3))
    for load in (0, 1, 1, 2):
        chg.save_hourly_states(trips.filter(part == load), table, f"load {load}")
    return rounded(chg.finished_hourly_stats(t.spark.table(table)), "avg_trip_distance", "avg_total_amount")


