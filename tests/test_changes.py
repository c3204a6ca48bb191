from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lakemart.operators import changes as chg
from tests.conftest import rows

DDL = "id int, name string, price double"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(i, f"n{i}", i * 1.5) for i in range(10)], DDL)


def test_unknown_condition_is_not_deleted(spark, table):
    more = chg.insert_rows(table, spark.createDataFrame([(99,)], "ID int"))
    assert rows(more.filter("id = 99")) == [(99, None, None)]
    assert rows(chg.delete_rows(more, F.col("price") >= 0), "id") == [(99,)]
    assert chg.delete_rows(more, F.lit(True)).count() == 0


def test_insert_refuses_unknown_columns(spark, table):
    with pytest.raises(ValueError, match="colour"):
        chg.insert_rows(table, spark.createDataFrame([(1, "x")], "id int, colour string"))


def test_update_uses_old_values(table):
    new = chg.update_rows(table, F.col("id") == 2, {"id": F.lit(20), "price": F.col("id") * 100.0})
    assert rows(new.filter("id = 20")) == [(20, "n2", 200.0)]
    assert new.count() == 10


def test_net_changes(spark, table):
    new = chg.insert_rows(table, spark.createDataFrame([(100, "a", 1.0)], DDL))
    new = chg.update_rows(new, F.col("id").isin(5, 100), {"name": F.lit("A")})
    new = chg.delete_rows(new, F.col("id") == 7)
    assert rows(chg.table_changes(table, new, key=["id"])) == sorted([
        (100, "A", 1.0, "INSERT", False), (5, "n5", 7.5, "DELETE", True), (5, "A", 7.5, "INSERT", True),
        (7, "n7", 10.5, "DELETE", False)], key=str)
    assert chg.table_changes(table, table).count() == 0


def test_changes_applied_to_the_old_state_give_the_new(table):
    new = chg.delete_rows(table, F.col("id") % 2 == 0)
    new = new.unionAll(new.filter("id < 4"))
    change = chg.table_changes(table, new)
    removed, added = (change.filter(F.col("action") == a).drop("action", "is_update") for a in ("DELETE", "INSERT"))
    assert rows(table.exceptAll(removed).unionAll(added)) == rows(new)


def test_many_equal_rows_all_show(spark):
    old = spark.range(25_001).select(F.lit("x").alias("v"))
    got = chg.table_changes(old, old.limit(1))
    assert got.count() == 25_000
    assert rows(got.distinct()) == [("x", "DELETE", False)]


def test_states_of_the_past(table):
    states = [table.limit(0), table, chg.delete_rows(table, F.col("id") < 3), table]
    history = None
    for hour, (old, new) in enumerate(zip(states, states[1:]), 12):
        step = chg.table_changes(old, new).withColumn("changed_at", F.lit(f"2024-01-01 {hour}:00:00").cast("timestamp"))
        history = step if history is None else history.unionByName(step)

    def count(clock):
        return chg.rows_as_of(history, F.lit(f"2024-01-01 {clock}").cast("timestamp")).count()

    assert [count(c) for c in ("11:59:59", "12:00:00", "13:30:00", "14:00:00")] == [0, 10, 7, 10]
    assert rows(chg.rows_as_of(history, F.lit("2024-01-02").cast("timestamp"))) == rows(table)


@pytest.mark.parametrize("key", [(), ("id",)])
def test_digests_give_the_same_changes(spark, key):
    old = spark.createDataFrame([(i % 40, f"n{i % 7}", None if i % 5 == 0 else float(i % 3)) for i in range(400)], DDL)
    new = chg.update_rows(old.filter("id <> 3"), F.col("id") == 5, {"name": F.lit("new")}).unionAll(old.filter("id = 9"))
    expected = rows(chg.table_changes(old, new, key, buckets=0))
    assert len(expected) == 40 and expected == rows(chg.table_changes(old, new, key, buckets=16))
    assert rows(chg.table_changes(old, new, key)) == expected
    # One value for another, twice each: no sum of counts can tell.
    pair = spark.createDataFrame([(1, "a", 0.0)] * 2, DDL)
    other = spark.createDataFrame([(1, "b", -0.0)] * 2, DDL)
    assert chg.table_changes(pair, other, key, buckets=1).count() == 4
    assert chg.table_changes(pair, pair.withColumn("price", -F.col("price")), key).count() == 0


def shuffled_rows(df):
    """Rows that the exchanges of an executed frame wrote, one number each."""
    out, open_ = [], [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            open_.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                out.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            open_ += [children.apply(k) for k in range(children.size())]
    return out


def test_what_is_shuffled_follows_the_change(spark):
    old = spark.range(50_000).select("id", F.md5(F.col("id").cast("string")).alias("v"))
    new = old.filter("id <> 17").withColumn("v", F.when(F.col("id") == 4711, "x").otherwise(F.col("v")))
    changes = chg.table_changes(old, new, buckets=512)
    assert sorted((r["id"], r["action"]) for r in changes.collect()) == [(17, "DELETE"), (4711, "DELETE"), (4711, "INSERT")]
    written = sorted(shuffled_rows(changes))
    assert 512 <= written[-1] <= 16 * 512  # a digest for each bucket and task
    assert written[-2] < 2_500  # rows of three of 512 buckets, twice


def test_many_renamed_columns_are_planned(spark):
    wide = spark.range(20).select(*[(F.col("id") + k).alias(f"c{k}") for k in range(60)])
    changes = chg.table_changes(wide, wide.filter("c0 <> 3"))
    assert rows(changes.toDF(*[f"d{k}" for k in range(62)]).filter("d1 > 0"), "d0", "d60") == [(3, "DELETE")]


def test_log_holds_each_position_once(spark, table, folder, monkeypatch):
    spark.sql(f"CREATE DATABASE logs LOCATION '{folder('logs')}'")
    more = chg.insert_rows(table, spark.createDataFrame([(50,)], "id int"))
    states = [table, more, table, table, chg.insert_rows(more, spark.createDataFrame([(51,)], "id int"))]
    expected = [(50, "INSERT", 1), (50, "DELETE", 2), (50, "INSERT", 4), (51, "INSERT", 4)]

    def run(position):
        return chg.consume_changes(spark, states.__getitem__, position, "logs.log")

    assert [run(1), run(1), run(2), run(3), run(1)] == [True, False, True, False, False]
    write, failures = chg.replace_partitions, iter([True])

    def breaks_off(*args):
        write(*args)
        if next(failures, False):
            raise OSError("after the write")

    monkeypatch.setattr(chg, "replace_partitions", breaks_off)
    with pytest.raises(OSError):
        run(4)
    assert run(4) is False
    chg.log_changes(chg.table_changes(states[3], states[4]), "logs.log", 4)  # a run that never saw its write
    assert rows(spark.table("logs.log"), "id", "action", "position") == sorted(expected, key=str)
    spark.sql("DROP DATABASE logs CASCADE")


def test_restore_is_a_change(table):
    gone = chg.delete_rows(table, F.col("id") < 3)

    def at(text):
        return F.lit(f"2024-01-01 {text}").cast("timestamp")

    history = chg.table_changes(table.limit(0), table).withColumn("changed_at", at("12:00:00")).unionByName(
        chg.table_changes(table, gone).withColumn("changed_at", at("13:00:00")))
    after = history.unionByName(chg.restore_version(history, at("12:30:00"), at("14:00:00")))
    assert rows(chg.rows_as_of(after, at("14:00:00"))) == rows(table)
    assert rows(chg.rows_as_of(after, at("13:30:00"))) == rows(gone)


def test_guarded_rows(spark, table):
    fresh = spark.createDataFrame([(70, "new", 1.0)], DDL)
    assert rows(chg.guarded_rows(fresh, table)) == [(70, "new", 1.0)]
    more = chg.insert_rows(table, fresh)
    with pytest.raises(chg.DuplicateRows):
        chg.guarded_rows(fresh, more)
    with_null = spark.createDataFrame([(71, None, 1.0)], DDL)
    more = chg.insert_rows(more, with_null)
    assert chg.guarded_rows(with_null, more).count() == 1
    with pytest.raises(chg.DuplicateRows):
        chg.guarded_rows(with_null, more, null_safe=True)
    twice = spark.createDataFrame([(72, "t", 1.0)] * 2, DDL)
    with pytest.raises(chg.DuplicateRows):
        chg.guarded_rows(twice, more)
    assert rows(chg.guarded_rows(twice.unionByName(fresh), more, on_duplicate="skip")) == [(72, "t", 1.0)]
    with pytest.raises(ValueError):
        chg.guarded_rows(twice, more, on_duplicate="keep")


def test_hourly_history(spark):
    trips = spark.createDataFrame([(8, 1.0, 2.0), (8, 3.0, 4.0)], "pickup_hour int, trip_distance double, total_amount double")
    for hour in (9, 10, 9):
        chg.save_hourly_stats(trips, "hourly_history", datetime(2024, 1, 1, hour, tzinfo=timezone.utc))
    assert rows(spark.table("hourly_history"), "pickup_hour", "total_trips", "avg_trip_distance") == [(8, 2, 2.0)] * 2
    assert spark.table("hourly_history").select("ts").distinct().count() == 2


def test_states_of_loads_are_merged(spark):
    ddl = "pickup_hour int, trip_distance double, total_amount double, vendor_id int, pickup_datetime timestamp"
    first = [(8, 1.0, 2.0, 1, datetime(2024, 1, 1, 8)), (8, None, 4.0, 2, datetime(2024, 1, 1, 8)), (None, 9.0, 9.0, 9, datetime(2024, 1, 1, 8))]
    late = [(8, 5.0, 6.0, 1, datetime(2024, 1, 1, 8)), (9, 1.0, 1.0, 1, datetime(2024, 1, 2, 9))]
    for load, trips in (("a", first), ("b", late), ("a", first)):
        chg.save_hourly_states(spark.createDataFrame(trips, ddl), "hourly_states", load)
    by_day = chg.finished_hourly_stats(spark.table("hourly_states"))
    assert rows(by_day, F.date_format("day", "MM-dd"), "pickup_hour", "total_trips", "avg_trip_distance", "avg_total_amount", "distinct_values") == [
        ("01-01", 8, 3, 3.0, 4.0, 2), ("01-02", 9, 1, 1.0, 1.0, 1)]
    by_hour = chg.finished_hourly_stats(spark.table("hourly_states"), ["pickup_hour"])
    assert rows(by_hour, "pickup_hour", "total_trips") == [(8, 3), (9, 1)]


def test_a_first_version_is_all_inserted(spark):
    new = spark.createDataFrame([(1, None), (1, None), (2, "b")], "x int, s string")
    got = chg.all_inserted(new)
    assert rows(got) == rows(chg.table_changes(new.limit(0), new))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
