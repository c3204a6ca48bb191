"""Row-level functions: ``Column`` in, ``Column`` out, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# English day names in the order of Spark's dayofweek, which counts from Sunday = 1.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Playing roles and the position marks that decide them; the first match wins.
ROLE_MARKS = {"Wingback": ("RB", "LB"), "Poacher": ("ST", "CF"), "Regista": ("CM", "CDM")}

# Charge letters and their names; anything else is "other".
CHARGE_TYPES = {"F": "felony", "M": "misdemeanor"}

# Fixed value: how the crime files write times.
US_TIMESTAMP = "MM/dd/yyyy hh:mm:ss a"

Col = Column | str


def _c(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- time -------------------------------------------------------------------------------------


def hour_of(ts: Col) -> Column:
    return F.hour(ts)


def day_of_week(ts: Col, sunday: int = 1) -> Column:
    """Weekday number; ``sunday=1`` counts 1-7 and ``sunday=0`` counts 0-6."""
    if sunday not in (0, 1):
        raise ValueError("sunday must be 0 or 1")
    return F.dayofweek(ts) if sunday else F.dayofweek(ts) - 1


def day_name(number: Col) -> Column:
    """English name of a 1-7 weekday number; NULL for anything else."""
    return F.get(F.array(*map(F.lit, DAY_NAMES)), _c(number) - 1)


def month_of(ts: Col) -> Column:
    return F.month(ts)


def year_of(ts: Col) -> Column:
    return F.year(ts)


def date_of(ts: Col) -> Column:
    return F.to_date(ts)


def duration_minutes(start: Col, end: Col, digits: int = 4) -> Column:
    """Whole seconds between two timestamps, in minutes, rounded to 2 or more digits.

    ``round`` on doubles goes through big decimals for each row. With two digits or more a number of
    seconds over 60 never lies half-way between two results, so flooring gives the same, faster.
    """
    if digits < 2:
        raise ValueError("digits must be 2 or more")
    seconds = F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))
    return F.floor(seconds * 10**digits / 60 + 0.5) / 10**digits


def parse_us_timestamp(text: Col) -> Column:
    """``01/31/2024 02:05:00 PM`` -> timestamp, NULL where the text does not fit.

    Texts too short for the pattern are not parsed: each failure costs as much as many successes.
    """
    return F.when(F.length(_c(text)) >= len("01/31/2024 02:05:00 PM"), F.try_to_timestamp(_c(text), F.lit(US_TIMESTAMP)))


def interval_shift(ts: Col, interval: str) -> Column:
    """Timestamp moved by an interval literal such as ``"5 MINUTES"`` or ``"-5 MINUTES"``."""
    return _c(ts) + F.expr(f"INTERVAL {interval}")


def run_time(value=None) -> Column:
    """The run's time stamp: the given moment or column, else the query's start time."""
    return F.current_timestamp() if value is None else F.lit(value)


# --- classes ----------------------------------------------------------------------------------


def trip_category(distance: Col, short: float = 2, long: float = 10) -> Column:
    """Short below ``short``, Medium up to and including ``long``, else Long (NULL too)."""
    d = _c(distance)
    return F.when(d < short, "Short").when(d <= long, "Medium").otherwise("Long")


def age_group(age: Col, prime_from: int = 21, prime_to: int = 28) -> Column:
    a = _c(age)
    return F.when(a < prime_from, "U21").when(a <= prime_to, "Prime").otherwise("Veteran")


def text_contains_any(text: Col, parts: Sequence[str]) -> Column:
    return reduce(or_, [_c(text).contains(part) for part in parts])


def regex_match(text: Col, pattern: str) -> Column:
    """Whole-string pattern test."""
    return _c(text).rlike(rf"\A(?:{pattern})\z")


def role_class(positions: Col) -> Column:
    chain = F
    for role, marks in ROLE_MARKS.items():
        chain = chain.when(text_contains_any(positions, marks), role)
    return chain.otherwise("Other")


def charge_type(letter: Col) -> Column:
    chain = F
    for key, label in CHARGE_TYPES.items():
        chain = chain.when(_c(letter) == key, label)
    return chain.otherwise("other")


def growth_gap(potential: Col, rating: Col) -> Column:
    return _c(potential) - _c(rating)


# --- text and keys ----------------------------------------------------------------------------


def coalesce_default(value: Col, default) -> Column:
    return F.coalesce(_c(value), F.lit(default))


def suffix_id(number: Col, suffix: str) -> Column:
    """Number followed by a text suffix, NULL for a NULL number."""
    return F.concat(_c(number).cast("string"), F.lit(suffix))


def full_text(*parts: Col) -> Column:
    """Parts joined with blanks; NULL parts are left out."""
    return F.concat_ws(" ", *parts)


def surrogate_key(*parts: Col) -> Column:
    """md5 over the parts as text; NULL if any part is NULL.

    Doubles are written as plain decimals without trailing zeros (10000000, not 1.0E7), as databases do.
    """
    def text(part: Column) -> Column:
        plain = F.regexp_replace(part.try_cast("decimal(38,10)").cast("string"), r"\.?0+$", "")
        return F.when(F.typeof(part).isin("double", "float"), plain).otherwise(part.cast("string"))

    return F.md5(F.concat(*[text(_c(p)) for p in parts]))


def upper_trim(text: Col) -> Column:
    return F.upper(F.trim(text))


def trimmed_length(text: Col) -> Column:
    return F.length(F.trim(text))


def bytes_to_text(value: Col) -> Column:
    return _c(value).cast("string")


def parse_json(text: Col, schema: StructType) -> Column:
    """JSON text to a declared struct; broken text gives NULL fields."""
    return F.from_json(_c(text), schema)


def cast_to(value: Col, target: DataType | str) -> Column:
    """Cast that gives NULL instead of raising."""
    return _c(value).try_cast(target)


# --- aggregate pieces -------------------------------------------------------------------------


def conditional_share(condition: Column) -> Column:
    """Percentage of rows meeting the condition; rows where it is NULL count on neither side."""
    return F.avg(condition.cast("int")) * 100


def conditional_count(condition: Column) -> Column:
    return F.count_if(condition)


def any_row(condition: Column) -> Column:
    """Whether at least one row meets the condition; never NULL."""
    return F.count_if(condition) != 0
