import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakemart.operators import aggregates as agg
from lakemart.operators import columns as cols
from lakemart.operators import filters as flt
from lakemart.operators import joins
from lakemart.operators import quality as qa
from lakemart.operators import ranking as rank
from lakemart.operators import unions
from lakemart.streaming import events as ev
from tests.conftest import rows

T0 = datetime(2024, 1, 1, 12)


def test_anomaly_edges(spark):
    df = spark.createDataFrame([(0.1, 2.0, 1.0), (0.05, 2.0, 1.0), (0.1, 1.99, 1.0), (0.1, 2.0, 0.9833), (None, 2.0, 1.0)],
                               "trip_distance double, total_amount double, duration_min double")
    assert rows(flt.filter_anomalies(df)) == [(0.1, 2.0, 1.0)]


def test_stage_filter_edges(spark):
    df = spark.createDataFrame([(0.1, 500.0, 0), (0.1, 500.01, 1), (0.1, 0.0, 1), (0.1, 1.0, 7), (0.0, 1.0, 1), (1.0, 1.0, None)],
                               "trip_distance double, total_amount double, passenger_count int")
    got = flt.filter_sql(df, "trip_distance > 0 AND total_amount > 0 AND total_amount <= :most AND passenger_count BETWEEN 0 AND :full",
                         most=500, full=6)
    assert rows(got) == [(0.1, 500.0, 0)]


def test_remove_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(flt.filter_equals_all(df, {"a": 1}, remove=True)) == [(2,), (None,)]


def test_zone_join_keeps_rows_and_ignores_bad_keys(spark):
    trips = spark.createDataFrame([(1, 2), (2, 9), (None, 1)], "pu_location_id long, do_location_id long")
    zones = spark.createDataFrame([("1", "A"), ("2", "B"), ("n/a", "C"), (None, "D")], "location_id string, zone string")
    got = joins.join_zones(trips, zones)
    assert rows(got, "pu_location_id", "pickup_zone", "dropoff_zone") == [(1, "A", "B"), (2, "B", None), (None, None, "A")]


def interval_case(spark, left, right, **kw):
    a = spark.createDataFrame(left, "user_id string, transaction_id int, timestamp timestamp")
    b = spark.createDataFrame(right, "user_id string, event_id int, timestamp timestamp")
    got = ev.join_activity(a, b, **kw).select("transaction_id", "event_id")
    want = [(i, j) for u, i, x in left for v, j, y in right if u == v and abs((x - y).total_seconds()) <= 300]
    assert rows(got) == sorted(want, key=str)
    return want


def test_interval_join_edges(spark):
    right = [("u", i, T0 + timedelta(seconds=d)) for i, d in enumerate((-301, -300, 0, 300, 301))]
    right += [("u", 9, T0 + timedelta(seconds=300, microseconds=1)), ("v", 10, T0)]
    assert len(interval_case(spark, [("u", 1, T0)], right)) == 3


def test_hot_keys_are_found_and_only_they_are_repeated(spark):
    # Keys 0 and NULL hold a third of the rows each; the other third are 2 000 keys. Types differ between the sides.
    left = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
                                     F.col("id").cast("string").alias("v")).repartition(6)
    right = spark.range(0, 6_000, 2).select(F.col("id").cast("int").alias("k"), F.col("id").alias("w"))
    found = joins.hot_keys(left, ["k"], 0.1)
    assert sorted(found.values()) == [4, 4]
    dealt, repeated, on = joins.deal_out_hot(left, right, ["k"], 0.1)
    assert on == ["k", joins.SALT]
    assert repeated.count() == right.count() + 3  # the one row of key 0, four times
    assert dealt.filter("k = 0").select(joins.SALT).distinct().count() == 4
    assert dealt.filter(f"k > 0 AND {joins.SALT} > 0").count() == 0
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(joins.join_multi_key(left, right, ["k"], how, hot_share=0.1)) == rows(left.join(right, "k", how))
    even = spark.range(1_000).withColumnRenamed("id", "k")
    assert joins.hot_keys(even, ["k"]) == {} and joins.hot_keys(even.limit(0), ["k"]) == {}
    assert joins.deal_out_hot(even, right, ["k"])[2] == ["k"]
    with pytest.raises(ValueError, match="full"):
        joins.join_multi_key(left, right, ["k"], "full", hot_share=0.1)


@pytest.mark.parametrize("salts", [1, 4])
def test_interval_join_with_hot_user(spark, salts):
    rng = random.Random(7)

    def events(n):
        return [("hot" if rng.random() < 0.4 else f"u{rng.randrange(9)}", i,
                 T0 + timedelta(microseconds=rng.randrange(7_200_000_000))) for i in range(n)]

    assert interval_case(spark, events(300), events(400), salts=salts)
    assert interval_case(spark, events(300), events(400), hot_share=0.05)


def test_salted_join_equals_plain_for_hot_key(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = joins.join_multi_key(left, right, ["k"], how)
        assert rows(joins.join_multi_key(left, right, ["k"], how, salts=8)) == rows(plain)
    with pytest.raises(ValueError):
        joins.join_multi_key(left, right, ["k"], "full", salts=2)


def test_guard_with_nulls_and_internal_duplicates(spark):
    schema = "a int, b string"
    old = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], schema)
    new = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "y"), (3, "y")], schema)
    assert rows(joins.insert_guard_anti(new, old)) == [(2, None), (2, None), (3, "y")]
    assert rows(joins.insert_guard_anti(new, old, null_safe=True)) == [(3, "y")]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (5,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(joins.orphan_rows(child, "k", parent, "id")) == [(5,)]


def test_shares_leave_out_unknown(spark):
    df = spark.createDataFrame([("g", 40.0), ("g", 20.0), ("g", None)], "k string, fare double")
    assert rows(agg.share_by(df, ["k"], {"p": F.col("fare") > 30})) == [("g", 50.0)]


def test_mode_ties_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("a", None), ("b", None), ("c", "z"), ("c", "z"), ("c", "a")],
                               "k string, v string")
    assert rows(agg.mode_value(df, ["k"], "v")) == [("a", "x"), ("b", None), ("c", "z")]


def test_trip_fact_defaults(spark):
    df = spark.createDataFrame([(1, 1, None, None, None, None, None, None)],
                               "pu_location_id int, do_location_id int, taxi_type string, fee double, extra double, "
                               "total_amount double, trip_distance double, trip_duration_minutes double")
    got = agg.finish_trip_facts(agg.trip_totals(df, F.lit(3).alias("h")), "h").first().asDict()
    assert got["total_fee"] == 0 and got["avg_trip_duration_minutes"] == 0 and got["most_trips_by"] == "-"


def test_best_player_with_unknown_rating_ranks_first(spark):
    df = spark.createDataFrame([("p1", "c", 80, 90, 1, 1, 20), ("p2", "c", None, 70, 1, 1, 20), ("p4", "d", 70, 71, 1, 1, 20),
                                ("p3", "d", 70, 79, 1, 1, 20)],
                               "player_id string, club_id string, overall int, potential int, value_eur int, wage_eur int, age int")
    got = rows(agg.club_metrics(df), "club_id", "player_count", "best_player_id", "best_player_overall", "max_overperformance")
    assert got == [("c", 2, "p2", None, 10), ("d", 2, "p3", 70, 9)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert rows(agg.column_profile(df)) == [("a", 2, 2), ("b c", 1, 2)]


def test_latest_per_key_puts_unknown_date_first(spark):
    df = spark.createDataFrame([(1, "2023-01-01", 1), (1, "2023-05-01", 2), (2, None, 3), (2, "2024-01-01", 4)], "id int, d string, n int")
    assert rows(rank.latest_per_key(df, "id", "d"), "n") == [(2,), (3,)]


def test_first_per_key_keeps_one_row_per_task_before_the_shuffle(spark):
    df = rank.first_per_key(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert rows(df, "id") == [(0,), (1,), (2,)]


def test_union_count_check(spark):
    a, b = spark.range(3), spark.range(4)
    assert rows(unions.union_count_check(a, b, a.union(b))) == [(3, 4, 7, True)]
    assert rows(unions.union_count_check(a, b, a)) == [(3, 4, 3, False)]


def test_suffixed_ids_do_not_collide(spark):
    df = spark.createDataFrame([(1, None)], "id int, club int")
    got = unions.union_suffixed({"male": df, "female": df}, ["id", "club"])
    assert rows(got) == [("1_female", None), ("1_male", None)]


def test_report_on_clean_and_faulty_data(spark):
    good = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, kind string, n int")
    bad = spark.createDataFrame([(1, "a", 5), (1, "z", None), (None, None, -1)], "id int, kind string, n int")
    checks = [qa.Check("t", "unique", "id"), qa.Check("t", "not_null", "id"), qa.Check("t", "accepted_values", "kind", ("a", "b")),
              qa.Check("t", "expression", "n > 0"), qa.Check("t", "expression", "n > 0", strict=True),
              qa.Check("t", "relationships", "id", parent="p", parent_column="id")]
    parent = spark.createDataFrame([(2,), (1,)], "id int")
    clean = qa.quality_report({"t": good, "p": parent}, checks)
    assert {r["violations"] for r in clean.collect()} == {0}
    qa.assert_clean(clean)
    report = qa.quality_report({"t": bad, "p": parent.filter("id = 2")}, checks)
    assert sorted((r["check"], r["violations"]) for r in report.collect()) == [
        ("accepted_values", 1), ("expression", 1), ("expression", 2), ("not_null", 1), ("relationships", 2), ("unique", 1)]
    with pytest.raises(qa.QualityError, match="t.id unique: 1"):
        qa.assert_clean(report)


def test_unknown_check_kind(spark):
    with pytest.raises(ValueError):
        qa.quality_report({"t": spark.range(1)}, [qa.Check("t", "shape", "id")])


def test_null_pad_and_star_plus(spark):
    from pyspark.sql.types import StructType

    padded = cols.null_pad(spark.range(1), StructType.fromDDL("ID bigint, fee double"))
    assert padded.schema.simpleString() == "struct<id:bigint,fee:double>"


@pytest.mark.parametrize("salts", [2, 5, 8])
def test_both_sides_share_the_repeats(spark, salts):
    left, right = (spark.range(0, 60, 1, 3).withColumnRenamed("id", n) for n in ("l", "r"))
    dealt, other = joins.deal_out_both(left, right, salts, 2)
    pairs = dealt.join(other, joins.SALT).groupBy("l", "r").count()
    assert pairs.count() == 3600 and pairs.agg({"count": "max"}).first()[0] == 1
    assert dealt.count() + 2 * other.count() <= 60 * {2: 4, 5: 7, 8: 8}[salts]  # 8 salts: 17 before
    assert dealt.select(joins.SALT).distinct().count() >= salts
