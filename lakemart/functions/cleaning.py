"""Turning dirty text columns into typed ones. Text that does not fit its type becomes NULL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.scalars import Col, _c, regex_match

# Texts that stand for a missing value, compared trimmed and without case.
NULL_TOKENS = ("", "na", "n/a", "null", "none", "-", "—")
# Texts read as booleans.
TRUE_TOKENS = ("true", "t", "1", "yes", "y")
FALSE_TOKENS = ("false", "f", "0", "no", "n")
# The accepted shapes per type.
INT_SHAPE = r"-?[0-9]+"
NUMBER_SHAPE = r"-?[0-9]+(\.[0-9]+)?"
ISO_DATE_SHAPE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
US_DATE_SHAPE = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
TIMESTAMP_SHAPE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2})?"


def trimmed_or_null(text: Col) -> Column:
    return F.nullif(F.trim(_c(text)), F.lit(""))


def null_token(text: Col, tokens: Sequence[str] | None = None) -> Column:
    """Trimmed text, NULL where it is blank or one of the tokens."""
    trimmed = F.trim(_c(text))
    listed = {t.lower() for t in (NULL_TOKENS if tokens is None else tokens)} | {""}
    return F.when(~F.lower(trimmed).isin(sorted(listed)), trimmed)


def clean_int(text: Col, target: str = "int", tokens: Sequence[str] | None = None) -> Column:
    value = null_token(text, tokens)
    return F.when(regex_match(value, INT_SHAPE), value.try_cast(target))


def clean_number(text: Col, target: str = "decimal(38,6)", tokens: Sequence[str] | None = None) -> Column:
    value = null_token(text, tokens)
    return F.when(regex_match(value, NUMBER_SHAPE), value.try_cast(target))


def clean_bool(text: Col, tokens: Sequence[str] | None = None) -> Column:
    value = F.lower(null_token(text, tokens))
    return F.when(value.isin(*TRUE_TOKENS), True).when(value.isin(*FALSE_TOKENS), False)


def clean_date(text: Col, tokens: Sequence[str] | None = None) -> Column:
    value = null_token(text, tokens)
    return (F.when(regex_match(value, ISO_DATE_SHAPE), F.try_to_date(value, "yyyy-MM-dd"))
             .when(regex_match(value, US_DATE_SHAPE), F.try_to_date(value, "MM/dd/yyyy")))


def clean_timestamp(text: Col, tokens: Sequence[str] | None = None) -> Column:
    value = null_token(text, tokens)
    blank_form = F.translate(value, "T", " ")
    return F.when(regex_match(value, TIMESTAMP_SHAPE),
                  F.try_to_timestamp(blank_form, F.lit("yyyy-MM-dd HH:mm[:ss]")))


# Type names a type map may use, with Spark types for numbers. Unknown names mean trimmed text.
_INTEGERS = {"int": "int", "integer": "int", "bigint": "bigint", "smallint": "smallint"}
_NUMBERS = {"numeric": "decimal(38,6)", "decimal": "decimal(38,6)", "float": "double", "double": "double",
            "real": "float", "double precision": "double"}
_BOOLEANS = ("boolean", "bool")
_TIMESTAMPS = ("timestamp", "timestamptz", "timestamp with time zone", "timestamp without time zone")


def cleaner_for(type_name: str = "auto", tokens: Sequence[str] | None = None) -> Callable[[Col], Column]:
    """The cleaning function for one type-map entry."""
    if type_name in _INTEGERS:
        return lambda c: clean_int(c, _INTEGERS[type_name], tokens)
    if type_name in _NUMBERS:
        return lambda c: clean_number(c, _NUMBERS[type_name], tokens)
    if type_name in _BOOLEANS:
        return lambda c: clean_bool(c, tokens)
    if type_name == "date":
        return lambda c: clean_date(c, tokens)
    if type_name in _TIMESTAMPS:
        return lambda c: clean_timestamp(c, tokens)
    return trimmed_or_null
