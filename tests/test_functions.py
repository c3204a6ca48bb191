from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.functions import cleaning as c
from lakemart.functions import naming as n
from lakemart.functions import scalars as s
from lakemart.operators import columns as cols
from tests.conftest import rows


@pytest.mark.parametrize("name, snake", [
    ("PULocationID", "pu_location_id"), ("VendorID", "vendor_id"), ("store_and_fwd_flag", "store_and_fwd_flag"),
    ("RatecodeID", "ratecode_id"), ("Airport_fee", "airport_fee"), ("tpep_pickup_datetime", "tpep_pickup_datetime"),
    ("a1B", "a1_b"), ("LocationID", "location_id")])
def test_camel_names(name, snake):
    assert n.camel_to_snake(name) == snake


def test_spaced_and_label_names():
    assert n.spaced_to_snake("Case Number") == "case__number"
    assert n.spaced_to_snake("Case Number", squeeze=True) == "case_number"
    assert n.spaced_to_snake("CHARGE 1 TYPE") == "charge_1_type"
    assert n.label_to_snake("Club-Team/ID No.1") == "club_team_id_no_1"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


CLEAN = [
    (" 12 ", 12, Decimal(12), None, None, None),
    ("-3", -3, Decimal(-3), None, None, None),
    ("4.0", None, Decimal("4.0"), None, None, None),
    ("1e5", None, None, None, None, None),
    ("+1", None, None, None, None, None),
    ("99999999999", None, Decimal(99999999999), None, None, None),
    ("12\n", None, None, None, None, None),
    ("", None, None, None, None, None),
    (" ", None, None, None, None, None),
    ("N/A", None, None, None, None, None),
    ("—", None, None, None, None, None),
    (" Yes ", None, None, True, None, None),
    ("0", 0, Decimal(0), False, None, None),
    ("maybe", None, None, None, None, None),
    ("2024-02-29", None, None, None, date(2024, 2, 29), None),
    ("2024-02-30", None, None, None, None, None),
    ("02/29/2024", None, None, None, date(2024, 2, 29), None),
    ("2024-01-02T03:04", None, None, None, None, datetime(2024, 1, 2, 3, 4)),
    ("2024-01-02 03:04:05", None, None, None, None, datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02 25:04:05", None, None, None, None, None),
    (None, None, None, None, None, None),
]


def test_cleaning(spark):
    raw = spark.createDataFrame([(i, r[0]) for i, r in enumerate(CLEAN)], "i int, raw string")
    got = raw.select("i", c.clean_int("raw").alias("int"), c.clean_number("raw").alias("number"), c.clean_bool("raw").alias("bool"),
                     c.clean_date("raw").alias("date"), c.clean_timestamp("raw").alias("ts")).orderBy("i").collect()
    for row, (raw_text, *expected) in zip(got, CLEAN):
        assert list(row[1:]) == expected, raw_text


def test_text_columns_keep_null_tokens(spark):
    raw = spark.createDataFrame([(" n/a ", " "), ("x", None)], ["Some Name", "b.c"])
    assert rows(cols.clean_table(raw)) == [("n/a", None), ("x", None)]
    assert cols.clean_table(raw).columns == ["some_name", "b_c"]


def test_custom_null_tokens(spark):
    raw = spark.createDataFrame([("7",), ("8",), ("",), ("n/a",)], ["v"])
    assert rows(raw.select(c.null_token("v", ["7"]))) == [("8",), ("n/a",), (None,), (None,)]


def test_cleaners_by_type_name():
    for name in ("int", "bigint", "numeric", "double precision", "bool", "date", "timestamptz", "text", "auto"):
        assert callable(c.cleaner_for(name))


def test_classes(spark):
    df = spark.createDataFrame([(1.9, 20, "GK, RB"), (2.0, 21, "ST"), (10.0, 28, "CDM"), (10.01, 29, "GK"), (None, None, None)],
                               "d double, a int, p string")
    assert [tuple(r) for r in df.select(s.trip_category("d"), s.age_group("a"), s.role_class("p")).collect()] == [
        ("Short", "U21", "Wingback"), ("Medium", "Prime", "Poacher"), ("Medium", "Prime", "Regista"),
        ("Long", "Veteran", "Other"), ("Long", "Veteran", "Other")]


def test_weekdays(spark):
    sunday = F.lit("2024-01-07").cast("date")
    assert one(spark, s.day_of_week(sunday)) == 1
    assert one(spark, s.day_of_week(sunday, sunday=0)) == 0
    assert [one(spark, s.day_name(F.lit(i))) for i in (1, 7, 0, 8)] == ["Sunday", "Saturday", None, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_duration_equals_rounding(spark, kind):
    base = F.lit("2024-01-01 00:00:00").cast("timestamp").cast("long")
    df = spark.range(-400, 4000).select("id", F.timestamp_seconds(base).cast(kind).alias("a"),
                                        F.timestamp_seconds(base + F.col("id")).cast(kind).alias("b"))
    wrong = df.filter(s.duration_minutes("a", "b") != F.round(F.col("id") / 60, 4))
    assert wrong.count() == 0
    with pytest.raises(ValueError):
        s.duration_minutes("a", "b", 1)


def test_surrogate_key_and_full_text(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "t string, x double")
    import hashlib

    assert [r[0] for r in df.select(s.surrogate_key("t", "x")).collect()] == [hashlib.md5(b"a1.5").hexdigest(), None]
    assert [r[0] for r in df.select(s.full_text("t", F.col("x").cast("string"))).collect()] == ["a 1.5", "b"]


def test_run_time(spark):
    assert one(spark, s.run_time(datetime(2024, 5, 1))) == datetime(2024, 5, 1)
    assert abs((one(spark, s.run_time()) - datetime.now()).total_seconds()) < 86400


def test_conform_strict_and_lenient(spark):
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([("1", "x"), ("z", "y")], ["A", "b"])
    target = StructType.fromDDL("a int, c string")
    assert rows(cols.conform(df, target)) == [(1, None), (None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cols.conform(df, target, strict=True).collect()


def test_str_enum_tags(spark):
    from enum import Enum

    class Colour(str, Enum):
        GREEN = "green"

    assert rows(cols.tag_literal(spark.range(1), "colour", Colour.GREEN)) == [(0, "green")]
