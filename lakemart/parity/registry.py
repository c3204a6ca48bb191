"""Registered queries: each operator run over the given tables, with equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, FloatType, TimestampNTZType, TimestampType

from lakemart.parity.views import Tables, with_views
from lakemart.session import own_scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that print alike in every engine: times as text, decimals and floats as doubles."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (DecimalType, FloatType)):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`; ``sql`` may use the names of the views as tables."""
    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own_scratch(spark)
            return comparable(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return add


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    """Averages of decimals differ between engines past the tenth digit."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})
