import gzip
import json
import os
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart import session
from lakemart.operators.columns import provenance_columns
from lakemart.plans import crime, taxi
from lakemart.sources import files, jdbc, schemas, sinks
from tests.conftest import rows


def put(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_bytes(gzip.compress(text.encode()) if str(path).endswith(".gz") else text.encode())
    return str(path)


def test_declared_schema_widens_and_fills(spark, folder):
    spark.range(3).select(F.col("id").cast("int").alias("PULocationID")).write.parquet(folder("a"))
    spark.range(3, 5).select(F.col("id").alias("PULocationID")).write.parquet(folder("b"))
    got = files.scan_parquet(spark, [folder("a"), folder("b")], "pulocationid long, fee double")
    assert rows(got) == [(i, None) for i in range(5)]


def test_years_globs_and_nested_folders(spark, folder):
    for year in (2018, 2019, 2020):
        spark.range(1).select(F.lit(year).alias("y")).write.parquet(folder("green", str(year), "m"))
    extra = folder("green", "2023", "single")
    spark.range(1).select(F.lit(2023).alias("y")).write.parquet(extra)
    schema = StructType.fromDDL("y int")
    assert rows(files.scan_years(spark, folder("green"), range(2018, 2021), schema, skip=[2019], extra=[extra])) == [(2018,), (2020,), (2023,)]
    assert rows(files.scan_glob(spark, folder("green", "20[12][89]", "m"), schema)) == [(2018,), (2019,)]
    assert len(rows(files.scan_recursive(spark, folder("green"), schema))) == 4


def test_columns_and_types_may_differ_between_the_files_of_a_folder(spark, folder):
    spark.sql("SELECT 1L AS id").write.parquet(folder("2023-01"))
    spark.sql("SELECT 2L AS id, 5.0D AS fee").write.parquet(folder("2023-02"))
    spark.sql("SELECT 3L AS id, 7L AS n").write.mode("append").parquet(folder("2023-02"))
    spark.sql("SELECT 4 AS id, 7.5D AS n").write.mode("append").parquet(folder("2023-01"))
    target = StructType.fromDDL("id long, fee double, n double")
    got = files.scan_drifted(spark, [folder("2023-01"), folder("2023-02")], target)
    assert rows(got) == sorted([(1, None, None), (2, 5.0, None), (3, None, 7.0), (4, None, 7.5)], key=str)
    groups = files.schema_groups(spark, files.data_files(spark, [folder("2023-01"), folder("2023-02")]))
    assert len(groups) == 2


def test_load_report(spark, folder):
    put(folder("a.csv"), "id\n1\nx\n")
    put(folder("b.csv"), "id\n2\n")
    report = files.load_report(files.scan_csv(spark, [folder("a.csv"), folder("b.csv")]), StructType.fromDDL("id long"))
    assert rows(report.drop("file")) == [(1, 1, 0), (2, 1, 1)]


def test_unreadable_files_are_left_out(spark, folder):
    spark.range(3).write.parquet(folder("good"))
    put(folder("good", "part-broken.parquet"), "no parquet at all")
    read = files.scan_parquet(spark, folder("good"), "id long", ignoreCorruptFiles="true")
    assert files.bulk_load(read, StructType.fromDDL("id int")).count() == 3


def test_drifted_folders_share_scans(spark, folder):
    spark.range(2).selectExpr("cast(id as int) as VendorID", "cast(1 as bigint) as passenger_count").write.parquet(folder("d1"))
    spark.range(2, 3).selectExpr("id as VendorID", "2.0D as passenger_count").write.parquet(folder("d2"))
    spark.range(3, 4).selectExpr("cast(id as int) as VendorID", "cast(3 as bigint) as passenger_count").write.parquet(folder("d3"))
    target = StructType.fromDDL("vendorid bigint, passenger_count double, fee double")
    got = files.scan_drifted(spark, [folder("d1"), folder("d2"), folder("d3")], target)
    assert rows(got) == [(0, 1.0, None), (1, 1.0, None), (2, 2.0, None), (3, 3.0, None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def interleaved(spark, folder, count):
    """Files whose schemas take turns: whole numbers, doubles, and one without the column."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(folder("f"))
    for k in range(count):
        columns = {"id": pa.array([k], pa.int64())}
        if k % 3 < 2:
            columns["n"] = pa.array([k], pa.int64() if k % 3 == 0 else pa.float64())
        pq.write_table(pa.table(columns), folder("f", f"{k:04}.parquet"))
    return [f"file://{folder('f')}/{k:04}.parquet" for k in range(count)]


def jobs_of(spark, run):
    """What ``run`` returns, and the number of Spark jobs that it took."""
    group = f"census-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_interleaved_schemas_cost_a_few_jobs(spark, folder):
    names = interleaved(spark, folder, 500)
    groups, jobs = jobs_of(spark, lambda: files.schema_groups(spark, names))
    assert jobs <= 4  # the census, and one for each schema that Spark did not write
    assert sorted(len(own) for _, own in groups) == [167, 333]
    target = StructType.fromDDL("id bigint, n double")
    got = files.scan_drifted(spark, folder("f"), target)
    assert rows(got) == sorted(((k, float(k) if k % 3 < 2 else None) for k in range(500)), key=str)


def test_files_that_only_spark_opens(spark, folder, monkeypatch):
    names = interleaved(spark, folder, 7)
    target = StructType.fromDDL("id bigint, n double")
    expected = rows(files.scan_drifted(spark, folder("f"), target))
    monkeypatch.setattr(files, "footer_census", lambda _, paths: ([], list(paths)))
    assert rows(files.scan_drifted(spark, folder("f"), target)) == expected and len(expected) == 7
    assert sorted(f for _, own in files.schema_groups(spark, names) for f in own) == names
    unknown = spark.createDataFrame([(0, "viewfs://store/a.parquet"), (1, folder("f", "none.parquet"))], "number int, path string")
    assert rows(unknown.mapInArrow(files._footers(), "number int, signature string")) == [(0, None), (1, None)]


def test_schemas_of_spark_writers_need_no_more_jobs(spark, folder):
    for k in range(4):
        spark.range(1).selectExpr("id", f"cast(1 as {'bigint' if k % 2 else 'double'}) as n").coalesce(1).write.parquet(folder("s", str(k)))
    names = files.data_files(spark, folder("s"))
    groups, jobs = jobs_of(spark, lambda: files.schema_groups(spark, names))
    assert jobs == 1 and sorted(len(own) for _, own in groups) == [2, 2]


def test_csv_dialect(spark, folder):
    put(folder("z", "a.csv.gz"), 'id|name|note\n1| x |"a|b"\n2|y\n3|z|n|surplus\n')
    got = files.scan_csv_dialect(spark, folder("z"), "id int, name string, note string", sep="|")
    assert rows(got) == [(1, "x", "a|b"), (2, "y", None), (3, "z", "n")]


def test_csv_all_text_and_inferred(spark, folder):
    put(folder("c", "a.csv"), "LocationID,Zone\n1,A\nx,\"B, C\"\n")
    put(folder("d", "a.csv"), "n,d\n1,1.5\n2,2.5\n")
    assert rows(files.scan_csv(spark, folder("c"))) == [("1", "A"), ("x", "B, C")]
    assert files.scan_csv_inferred(spark, folder("d")).dtypes == [("n", "int"), ("d", "double")]


def test_bulk_load(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], ["ID", "Name"])
    target = StructType.fromDDL("id bigint, name string, extra double")
    assert rows(files.bulk_load(raw, target)) == [(1, "a", None), (None, "c", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.bulk_load(raw, target, on_error="abort").collect()
    with pytest.raises(ValueError):
        files.bulk_load(raw, target, on_error="maybe")


def test_listing_and_trimming(spark, folder):
    put(folder("l", "in", "a.csv"), "x\n")
    put(folder("l", "b.txt"), "yy")
    assert rows(files.list_files(spark, folder("l")).select("length")) == [(2,), (2,)]
    assert files.list_files(spark, folder("l"), "*.csv").count() == 1
    assert rows(files.trim_text(spark.createDataFrame([(" a ", 1)], ["t", "n"]))) == [("a", 1)]


def test_whole_files_as_tables(spark, folder):
    put(folder("raw", "coaches.csv"), "coach_id,dob\n" + "".join(f"{i},1980-01-01\n" for i in range(30)))
    types = files.ingest_files(spark, [folder("raw", "coaches.csv")], database="samples")
    assert rows(types) == [("coaches", "coach_id", "int"), ("coaches", "dob", "date")]
    assert files.read_table(spark, "samples.coaches").count() == 30


def test_schema_diff(spark):
    yellow = spark.createDataFrame([], schemas.trip_schema("yellow"))
    green = spark.createDataFrame([], schemas.trip_schema("green"))
    assert [r[0] for r in schemas.schema_diff(yellow, green).collect()] == [
        "airport_fee", "ehail_fee", "lpep_dropoff_datetime", "lpep_pickup_datetime", "tpep_dropoff_datetime", "tpep_pickup_datetime"]
    other = yellow.withColumn("RatecodeID", F.col("RatecodeID").cast("double"))
    assert rows(schemas.schema_diff(yellow, other)) == [("RatecodeID", "bigint", "double")]


def test_partitioned_write(spark, folder):
    sinks.write_parquet(spark.range(100).withColumn("year", F.col("id") % 2), folder("p"), partition_by=["year"])
    pruned = spark.read.parquet(folder("p")).filter("year = 1")
    assert pruned.count() == 50 and "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()


def test_tables_and_materialization(spark, folder):
    df = spark.range(4)
    sinks.save_table(df, "plain_t", folder("ext"))
    assert spark.read.parquet(folder("ext")).count() == 4
    sinks.create_table_as(spark, "made_t", "SELECT id * 2 AS d FROM {src} WHERE id > 1", src=df)
    assert rows(files.read_table(spark, "made_t")) == [(4,), (6,)]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        sinks.create_table_as(spark, "made_t", "SELECT 1 AS d")
    sinks.create_table_as(spark, "made_t", "SELECT 1 AS d", replace=True)
    assert rows(spark.table("made_t")) == [(1,)]
    assert sinks.materialize(df, "m", "table", "gold_test").count() == 4
    assert spark.table("gold_test.m").count() == 4
    sinks.materialize(df, "m", "view", "mart")
    assert spark.table("mart_m").count() == 4
    assert sinks.materialize(df, "m", "inline") is df
    with pytest.raises(ValueError):
        sinks.materialize(df, "m", "cube")


def test_provenance(spark, folder):
    put(folder("s", "x.csv"), "a\n1\n")
    got = provenance_columns(files.scan_csv(spark, folder("s")), datetime(2024, 1, 1)).first()
    assert got["source_file"].endswith("/x.csv") and got["load_timestamp"] == datetime(2024, 1, 1)
    assert provenance_columns(spark.range(1), source_file=False).columns == ["id", "load_timestamp"]


def test_bronze_appends_and_replaces(spark, folder):
    put(folder("in", "crimes", "c.csv"), "ID,Case Number\n1,A\n")
    put(folder("in", "arrests", "a.csv"), "CB_NO\n9\n")
    put(folder("in", "iucr", "i.csv"), "IUCR\n0110\n")
    for _ in range(2):
        crime.load_bronze(spark, folder("in", "crimes"), folder("in", "arrests"), folder("in", "iucr"), folder("out"))
    assert [spark.read.parquet(folder("out", n)).count() for n in ("crimes", "arrests", "iucr")] == [2, 2, 1]
    assert "source_file" not in spark.read.parquet(folder("out", "iucr")).columns


def test_bronze_rows_are_written_as_they_are_read(spark, folder):
    for name in "abc":
        put(folder("many", f"{name}.csv"), "ID\n" + "".join(f"{name}{i}\n" for i in range(40)))
    tracker = spark.sparkContext.statusTracker()
    rows = provenance_columns(files.scan_csv(spark, folder("many")), datetime(2024, 1, 1))
    spark.sparkContext.setJobGroup("bronze", "one append")
    try:
        sinks.bronze_append(rows, folder("bronze"))
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("bronze")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(len(j.stageIds) for j in jobs) == 1  # no shuffle
    written = spark.read.parquet(folder("bronze"))
    assert written.count() == 120 and written.select("source_file").distinct().count() == 3
    runs = written.select("ID", "source_file", F.spark_partition_id().alias("p")).collect()
    changes = sum(a["source_file"] != b["source_file"] and a["p"] == b["p"] for a, b in zip(runs, runs[1:]))
    assert changes <= 2  # a file's rows lie together


class Recorder:
    """Stands in for a Spark reader or writer and keeps the options it is given."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def options(self, **kw):
        self.seen.update(kw)
        return self

    def save(self):
        self.seen["saved"] = True

    def load(self):
        return self.seen


def test_jdbc_options():
    frame = type("F", (), {"write": Recorder(), "repartition": lambda self, n: self})()
    jdbc.write_jdbc(frame, "silver_crimes", "jdbc:postgresql://h/db", "u", "p", connections=4, mode="append")
    seen = frame.write.seen
    assert seen["numPartitions"] == 4
    assert seen["saved"] and seen["mode"] == "append" and seen["dbtable"] == "silver_crimes" and seen["batchsize"] == 10_000
    session_like = type("S", (), {"read": Recorder()})()
    got = jdbc.read_jdbc(session_like, "t", "jdbc:x", "u", "p", partition_column="id", bounds=(0, 9), connections=3)
    assert got["partitionColumn"] == "id" and got["lowerBound"] == 0 and got["numPartitions"] == 3
    with pytest.raises(ValueError):
        jdbc.read_jdbc(session_like, "t", "jdbc:x", "u", "p", connections=3, partition_column="id")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(session_like, "t", "jdbc:x", "u", "p", connections=3)


def test_scratch_folder_follows_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("X", (), {"master": "yarn", "getCheckpointDir": staticmethod(lambda: None)})

    for needs_folder in (lambda: session.scratch_path(Cluster, "x"), lambda: session.own_scratch(Cluster)):
        with pytest.raises(ValueError):
            needs_folder()


def test_local_sessions_without_a_setting_get_a_folder():
    given = []

    class Local:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("X", (), {"master": "local[2]", "applicationId": "app", "setCheckpointDir": staticmethod(given.append),
                                      "getCheckpointDir": staticmethod(lambda: given[0] if given else None)})

    session.own_scratch(Local)
    session.own_scratch(Local)
    assert len(given) == 1 and session.scratch_path(Local, "x").startswith(f"{given[0]}/lakemart/app/x-")


def test_dropped_scratch(spark, monkeypatch):
    root = session._scratch_root(spark)
    monkeypatch.setattr(session, "_scratch_root", lambda _: f"{root}/dropped")
    monkeypatch.setattr(session, "_DATABASES", {})
    name, path = session.scratch_database(spark), session.scratch_path(spark, "rows")
    spark.range(3).write.saveAsTable(f"{name}.t")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark)
    assert not spark.catalog.databaseExists(name) and not Path(f"{root}/dropped").exists()


def test_shuffle_sizing():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(1 << 40) == 8192
    assert session.shuffle_partitions(100 << 40) == 819_200


def test_zone_report_run_from_drifting_files(spark, folder):
    trip = ("CAST(1 AS BIGINT) AS VendorID, CAST({pu} AS {loc}) AS PULocationID, CAST(2 AS {loc}) AS DOLocationID, 3.0D AS trip_distance, "
            "40.0D AS fare_amount, 1.0D AS tip_amount, 50.0D AS total_amount, "
            "TIMESTAMP_NTZ '2024-01-07 10:00:00' AS {p}_pickup_datetime, TIMESTAMP_NTZ '2024-01-07 10:30:00' AS {p}_dropoff_datetime")
    spark.sql("SELECT " + trip.format(pu=1, loc="BIGINT", p="tpep") + ", 1 AS airport_fee").write.parquet(folder("y22"))
    spark.sql("SELECT " + trip.format(pu=1, loc="INT", p="tpep") + ", 1.5D AS airport_fee").write.parquet(folder("y23"))
    spark.sql("SELECT " + trip.format(pu=3, loc="BIGINT", p="lpep")).write.parquet(folder("g22"))
    put(folder("zones.csv"), "LocationID,Borough,Zone,service_zone\n1,B,One,s\n2,B,Two,s\n")
    paths = taxi.run_zone_reports(spark, [folder("y22"), folder("y23")], [folder("g22")], folder("zones.csv"), folder("out"),
                                  datetime(2024, 5, 1).date())
    got = rows(spark.read.parquet(paths["zone_statistic"]), "pickup_zone", "total_trips", "yellow_share", "green_share")
    assert got == [("One", 2, 100.0, 0.0), (None, 1, 0.0, 100.0)]
    assert rows(spark.read.parquet(paths["zone_days_statistic"])) == [("Sunday", "One", 2, 100.0), ("Sunday", None, 1, 100.0)]
    assert paths["zone_statistic"].endswith("zone_statistic/2024-05-01")


def test_quarantine_holds_what_is_not_loaded(spark, folder):
    put(folder("q", "a.csv"), "ID,amount,note\n1,1.5,a\nx,y,b\n3\n4,,c\n5,2.5,d,surplus\n,1,e\n")
    read = files.scan_csv_lines(spark, folder("q"), ["ID", "amount", "note"])
    target = StructType.fromDDL("id bigint NOT NULL, amount double, absent string")
    loaded, kept = files.load_or_quarantine(read, target, folder("out"))
    assert loaded.dtypes == [("id", "bigint"), ("amount", "double"), ("absent", "string")]
    assert rows(loaded) == [(1, 1.5, None), (4, None, None)]
    got = {json.loads(r["row"]).get("ID"): [tuple(p) for p in r["problems"]] for r in kept.collect()}
    assert got == {"x": [("id", "x", "not a bigint"), ("amount", "y", "not a double")],
                   "3": [(None, "3", "malformed line")], "5": [(None, "5,2.5,d,surplus", "malformed line")],
                   None: [("id", None, "missing")]}
    assert loaded.count() + kept.count() == read.count() == 6
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(loaded" in plan


def test_only_the_years_asked_for_are_read(spark, folder):
    trips = spark.range(4_000).select("id", F.expr("timestamp_ntz'2018-01-01 05:00:00' + make_interval(0, 0, 0, int(id))").alias("at"))
    sinks.write_by_year(trips.unionByName(spark.createDataFrame([(-1, None)], "id long, at timestamp_ntz")), folder("t"), "at")
    spark.range(4_000).select(F.expr("date'2018-01-01' + int(id)").alias("date")).write.parquet(folder("d"))
    days = spark.read.parquet(folder("d")).filter("date BETWEEN '2021-12-30' AND '2022-01-02'").withColumn("name", F.date_format("date", "EEE"))
    got = files.scan_days(spark.read.parquet(folder("t")), days, "at")
    assert sorted((r["at"].year, r["name"]) for r in got.collect()) == [(2021, "Fri"), (2021, "Thu"), (2022, "Sat"), (2022, "Sun")]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    read = [n.metrics().apply("numPartitions").value() for n in nodes(got) if n.metrics().contains("numPartitions")
            and n.metrics().apply("numPartitions").value()]
    assert read == [2]  # of twelve


def nodes(df):
    """The nodes of an executed plan."""
    open_ = [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            open_.append(node.plan())
        else:
            yield node
            children = node.children()
            open_ += [children.apply(k) for k in range(children.size())]


def test_reports_have_as_many_files_as_their_size_asks_for(spark, folder):
    sinks.write_report(spark.range(100).repartition(7), folder("small"))
    assert len(list(Path(folder("small")).glob("part-*"))) == 1
    limit = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        wide = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v")).repartition(2)
        sinks.write_report(wide, folder("large"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", limit)
    assert len(list(Path(folder("large")).glob("part-*"))) >= 3
