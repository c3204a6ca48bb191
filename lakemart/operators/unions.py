"""Stacking frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalars import suffix_id
from lakemart.operators.columns import quoted


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_tagged(frames: Mapping[str, DataFrame], tag: str, renames: Mapping[str, Mapping[str, str]] | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Stack named sources: per-source renames, NULL for columns one side lacks, and a source tag."""
    renames = renames or {}
    parts = [df.withColumnsRenamed(dict(renames.get(name, {}))).withColumn(tag, F.lit(name))
             for name, df in frames.items()]
    stacked = union_by_name(*parts, allow_missing=True)
    return stacked.select(*map(quoted, [*columns, tag])) if columns else stacked


def union_suffixed(frames: Mapping[str, DataFrame], ids: Sequence[str]) -> DataFrame:
    """Stack sources after appending ``_<name>`` to their ids, so ids of two sources cannot collide."""
    return union_by_name(*[
        df.withColumns({i: suffix_id(quoted(i), f"_{name}") for i in ids}) for name, df in frames.items()])


def union_count_check(left: DataFrame, right: DataFrame, stacked: DataFrame) -> DataFrame:
    """One row: rows on each side, rows of the union, and whether they add up."""
    sides = {"left_rows": left, "right_rows": right, "union_rows": stacked}
    counts = union_by_name(*[df.agg(F.count("*").alias("n")).withColumn("side", F.lit(s)) for s, df in sides.items()])
    row = counts.agg(*[F.max(F.when(F.col("side") == s, F.col("n"))).alias(s) for s in sides])
    return row.withColumn("matches", F.col("left_rows") + F.col("right_rows") == F.col("union_rows"))
