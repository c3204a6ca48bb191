"""Tables that grow by increments: nothing is lost or repeated, whatever fails in between."""

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakemart.operators.ranking import drop_duplicates
from lakemart.plans import crime
from lakemart.session import SORTED_SPLIT
from lakemart.sources import increments as inc
from lakemart.sources import sinks
from tests.conftest import rows
from tests.test_plans import CRIME_COLUMNS, crime_row

CODES = [("0110", "Theft", "x", "i", "true")]
CODE_NAMES = ["IUCR", "PRIMARY DESCRIPTION", "SECONDARY DESCRIPTION", "INDEX CODE", "ACTIVE"]


def load(spark, folder, name, ids, hour):
    """Raw files of some crimes and arrests, put into bronze with a load time."""
    arrests = [(str(i), f"HX{i}", "01/07/2024 11:00:00 PM", "R", "S", "D", "F") for i in ids]
    for table, data, columns in (("crimes", [crime_row(i) for i in ids], CRIME_COLUMNS),
                                 ("arrests", arrests, list(crime.ARREST_NAMES)), ("iucr", CODES, CODE_NAMES)):
        spark.createDataFrame(data, columns).write.option("header", True).csv(folder(name, table))
    crime.load_bronze(spark, *(folder(name, n) for n in ("crimes", "arrests", "iucr")), folder("bronze"),
                      datetime(2024, 5, 1, hour))


def silver(spark, folder):
    """The first step of a run alone: new bronze crimes to their silver table."""
    spark.sql("CREATE DATABASE IF NOT EXISTS once_s")
    return crime._consume_bronze(spark, folder("bronze", "crimes"), "once_s.silver_crimes", crime.silver_crimes, "crime_id", 2)


def test_no_load_is_lost_and_none_repeated(spark, folder, monkeypatch):
    load(spark, folder, "a", (1, 2), 12)
    silver(spark, folder)
    load(spark, folder, "b", (3,), 12)  # the same time again
    write, failures = inc.replace_partitions, iter([True])

    def breaks_off(*args, **kw):
        write(*args, **kw)
        if next(failures, False):
            raise OSError("lost after the write, before the stream noted it")

    monkeypatch.setattr(inc, "replace_partitions", breaks_off)
    with pytest.raises(StreamingQueryException):
        silver(spark, folder)
    load(spark, folder, "c", (2, 4), 11)  # began earlier, came later, and repeats a crime
    out = crime.run_crime(spark, folder("bronze"), "once_s", "once_g", strict=True)
    assert rows(out["fact_crimes"], "crime_id") == [(str(i),) for i in (1, 2, 3, 4)]
    assert rows(out["fact_arrests"], "arrest_id") == [(str(i),) for i in (1, 2, 3, 4)]
    before = rows(spark.table("once_s.silver_crimes"))
    assert rows(silver(spark, folder), "crime_id") == [(str(i),) for i in (1, 2, 3, 4)]  # nothing new
    assert rows(spark.table("once_s.silver_crimes")) == before


def test_a_load_that_broke_off_between_its_appends(spark, folder, monkeypatch):
    append, calls = crime.bronze_append, []

    def fails_second(df, path, **kw):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("between crimes and arrests")
        append(df, path, **kw)

    monkeypatch.setattr(crime, "bronze_append", fails_second)
    with pytest.raises(OSError):
        load(spark, folder, "a", (1, 2), 12)
    load(spark, folder, "b", (1, 2), 12)  # the same rows once more: the crimes are in bronze twice
    assert spark.read.parquet(folder("bronze", "crimes")).count() == 4
    spark.sql("CREATE DATABASE twice_s")
    for table, build, key in (("crimes", crime.silver_crimes, "crime_id"), ("arrests", crime.silver_arrests, "arrest_id")):
        got = crime._consume_bronze(spark, folder("bronze", table), f"twice_s.silver_{table}", build, key, 2)
        assert rows(got, key) == [("1",), ("2",)]


def test_replaced_partitions(spark, folder):
    spark.sql(f"CREATE DATABASE parts LOCATION '{folder('parts')}'")
    frame = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "a", 2)], "x int, day string, n int")
    for _ in range(2):
        inc.replace_partitions(frame, "parts.t", ["day"])
    inc.replace_partitions(spark.createDataFrame([("b", 9, 9)], "day string, n int, x int"), "parts.t", ["day"])
    assert rows(spark.table("parts.t"), "x", "n", "day") == [(1, 1, "a"), (3, 2, "a"), (9, 9, "b")]
    spark.sql("DROP DATABASE parts CASCADE")


def test_known_keys_are_not_shuffled(spark, folder):
    spark.sql(f"CREATE DATABASE known LOCATION '{folder('known')}'")
    for number in range(2):
        frame = spark.range(0, 500 * (number + 1)).withColumn("v", F.lit(number))
        inc.append_new_keys(frame, "known.t", "id", number, buckets=4)
    assert rows(spark.table("known.t").groupBy("v").count()) == [(0, 500), (1, 500)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.range(0, 2000).repartition(3)
        plan = new.join(spark.table("known.t").filter("increment < 2").select("id"), "id", "left_anti")
        tree = plan._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in tree and tree.count("Exchange hashpartitioning") == 1
        assert plan.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP DATABASE known CASCADE")


def test_deduplicated_rows_are_shuffled_once_on_their_way_into_the_buckets(spark, folder):
    spark.sql(f"CREATE DATABASE onceonly LOCATION '{folder('onceonly')}'")
    kept = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for n in kept:
        spark.conf.set(n, "-1")
    try:
        inc.append_new_keys(spark.range(400).withColumn("v", F.lit("a" * 9)), "onceonly.t", "id", 0, buckets=4)
        assert inc.bucket_count(spark, "onceonly.t") == 4
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("onceonly", "one increment")
        new = spark.range(0, 900, 1, 3).withColumn("v", F.lit("b")).unionByName(spark.range(0, 900, 1, 3).withColumn("v", F.lit("c")))
        inc.append_new_keys(drop_duplicates(new, ["id"], ["v"]), "onceonly.t", "id", 1, buckets=16)
        stages = {s for j in tracker.getJobIdsForGroup("onceonly") for s in tracker.getJobInfo(j).stageIds}
        assert len([s for s in map(tracker.getStageInfo, stages) if s and s.numCompletedTasks == 6]) == 1  # the rows' one shuffle
        assert {s.numTasks for s in map(tracker.getStageInfo, stages) if s and s.numCompletedTasks} <= {1, 4, 6}
        assert rows(spark.table("onceonly.t").groupBy("v").count()) == [("aaaaaaaaa", 400), ("b", 500)]
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for n, v in kept.items():
            spark.conf.set(n, v)
        spark.sql("DROP DATABASE onceonly CASCADE")


def test_buckets_follow_the_size_of_the_files(spark, folder, monkeypatch):
    spark.range(50_000).write.parquet(folder("sized"))
    assert inc.buckets_for(spark, folder("sized")) == 8
    monkeypatch.setattr(inc, "BUCKET_BYTES", 4096)
    assert inc.buckets_for(spark, folder("sized")) > 20


def test_arriving_rows_meet_their_key_without_a_shuffle(spark, folder, monkeypatch):
    """The typed rows of an increment are dealt into buckets as they are read; the rest of the way has no shuffle."""
    spark.sql(f"CREATE DATABASE dealt LOCATION '{folder('dealt')}'")
    odd = [crime_row(i) for i in (1, 2, 2, 3, 3)] + [(None, *crime_row(4)[1:]), (None, *crime_row(5)[1:])]
    raw = spark.createDataFrame(odd, CRIME_COLUMNS)
    plain = rows(crime.silver_crimes(raw), "crime_id", "case_number")
    dealt = crime.silver_crimes(raw, lambda typed: inc.deal_by_key(typed, "dealt.arriving", "crime_id", 4))
    tree = dealt._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in tree and "Exchange" not in tree
    assert rows(dealt, "crime_id", "case_number") == plain and len(plain) == 4
    monkeypatch.setattr(inc, "MOST_FILES", 3)
    frame = spark.range(9)
    assert inc.deal_by_key(frame, "dealt.too_many", "id", 4) is frame
    assert not spark.catalog.tableExists("dealt.too_many")
    spark.sql("DROP DATABASE dealt CASCADE")


def test_a_run_leaves_no_arriving_rows_and_joins_arrests_by_bucket(spark, folder):
    load(spark, folder, "a", (1, 2, 3), 12)
    crime.run_crime(spark, folder("bronze"), "left_s", "left_g", buckets=3)
    assert not [t.name for t in spark.catalog.listTables("left_s") if "arriving" in t.name]
    assert [inc.bucket_count(spark, f"left_g.{n}") for n in ("stg_arrests", "fact_crimes", "fact_arrests")] == [3, 3, None]
    assert rows(spark.table("left_g.fact_arrests"), "arrest_id", "iucr_code") == [("1", "0110"), ("2", "0110"), ("3", "0110")]
    for name in ("left_s", "left_g"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_daily_crimes_are_shuffled_once(spark):
    crimes = spark.createDataFrame(
        [("k1", "2024-01-01", "Theft", True, False), ("k1", "2024-01-01", "Theft", False, True), ("k2", "2024-01-01", "Theft", True, None),
         (None, "2024-01-01", "Theft", True, True)], "location_key string, crime_date string, primary_type string, is_arrest boolean, is_domestic boolean")
    places = spark.createDataFrame([("k1", 1, 7), ("k2", 1, 7)], "location_key string, district_id int, community_area_id int")
    daily = crime.agg_daily_crimes(crimes, F.broadcast(places))
    assert daily._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert set(rows(daily)) == {("2024-01-01", "Theft", None, None, 1, 1, 1), ("2024-01-01", "Theft", 1, 7, 3, 2, 1)}


def test_increments_are_plain_scans_of_their_files(spark, folder):
    """An increment reads the columns it uses, of its own files, and none of the rest."""
    spark.range(4).withColumn("v", F.lit("x")).coalesce(1).write.mode("append").parquet(folder("a b"))
    plans, seen = [], []

    def take(raw, number):
        plans.append(raw.select("id")._jdf.queryExecution().executedPlan().toString())
        seen.append(rows(raw))

    inc.consume_files(spark, folder("a b"), folder("ck"), take)
    spark.range(4, 6).withColumn("v", F.lit("y")).coalesce(1).write.mode("append").parquet(folder("a b"))
    inc.consume_files(spark, folder("a b"), folder("ck"), take)
    assert seen == [[(i, "x") for i in range(4)], [(4, "y"), (5, "y")]]
    assert all("FileScan parquet" in p and "ReadSchema: struct<id:bigint>" in p for p in plans)


def test_rows_ask_for_buckets_and_row_groups_for_one_task(spark, folder, monkeypatch):
    spark.range(50_000).write.parquet(folder("rows"))
    monkeypatch.setattr(inc, "BUCKET_ROWS", 2_000)
    assert inc.buckets_for(spark, folder("rows")) == 25
    assert int(sinks.PACKED["parquet.block.size"]) < SORTED_SPLIT


def test_dealt_rows_are_not_sorted_by_key(spark, folder):
    spark.sql(f"CREATE DATABASE unsorted LOCATION '{folder('unsorted')}'")
    inc.deal_by_key(spark.range(9), "unsorted.t", "id", 4)
    sinks.save_table(spark.range(9), "unsorted.u", dealt=(4, "id"))
    inc.append_new_keys(spark.range(9), "unsorted.v", "id", 0, 4)
    for name in "tuv":
        found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED unsorted.{name}").collect()}
        assert found["Num Buckets"] == "4" and found.get("Sort Columns", "[]") == "[]"
    spark.sql("DROP DATABASE unsorted CASCADE")
