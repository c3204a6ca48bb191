"""Projections and schema changes. All narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from lakemart.functions.cleaning import cleaner_for
from lakemart.functions.naming import NAME_STYLES, label_to_snake


def quoted(name: str) -> Column:
    """Column by its exact name, blanks and dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_by_copy(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the listed columns, under their new names, in the order given."""
    return df.select(*[quoted(old).alias(new) for old, new in names.items()])


def cast_columns(df: DataFrame, types: Mapping[str, DataType | str]) -> DataFrame:
    """Cast by map; values that do not fit become NULL."""
    return df.withColumns({c: quoted(c).try_cast(t) for c, t in types.items()})


def tag_literal(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def snake_case_columns(df: DataFrame, style: str = "camel", **options) -> DataFrame:
    """Rename every column by one of ``camel``, ``spaced`` or ``label``."""
    rule = NAME_STYLES[style]
    return df.toDF(*[rule(c, **options) for c in df.columns])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*map(quoted, names))


def star_plus(left: DataFrame, right: DataFrame, extra: Sequence[str], on: Sequence[str], how: str = "left") -> DataFrame:
    """Every column of ``left`` plus the ``extra`` ones of ``right``."""
    return left.join(right.select(*on, *[c for c in extra if c not in on]), list(on), how).select(
        *map(quoted, left.columns), *[quoted(c) for c in extra if c not in left.columns])


def null_pad(df: DataFrame, target: StructType) -> DataFrame:
    """Typed NULL columns for every target field the frame lacks."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in target if f.name.lower() not in have})


def conform(df: DataFrame, target: StructType, strict: bool = False) -> DataFrame:
    """Exactly the target's columns, in its order: matched without case, cast, NULL where missing.

    ``strict`` lets a value that does not fit raise instead of becoming NULL.
    """
    by_name = {c.lower(): c for c in df.columns}
    out = []
    for f in target:
        source = by_name.get(f.name.lower())
        value = F.lit(None) if source is None else quoted(source)
        cast = value.cast(f.dataType) if strict or source is None else value.try_cast(f.dataType)
        out.append(cast.alias(f.name))
    return df.select(*out)


def unify_schema(groups: Sequence[DataFrame], target: StructType) -> DataFrame:
    """Stack inputs whose column types drifted apart, after casting each to one schema."""
    return reduce(DataFrame.unionByName, [conform(g, target) for g in groups])


def provenance_columns(df: DataFrame, load_time=None, source_file: bool = True) -> DataFrame:
    """Load time and, for frames read from files, the file each row came from."""
    stamp = F.current_timestamp() if load_time is None else F.lit(load_time)
    added = {"load_timestamp": stamp}
    if source_file:
        added["source_file"] = F.col("_metadata.file_path")
    return df.withColumns(added)


def clean_table(df: DataFrame, type_map: Mapping[str, str] | None = None,
                tokens: Sequence[str] | None = None) -> DataFrame:
    """Snake-case every column and clean it by the type map; unmapped columns become trimmed text.

    Input columns should be text as read: a double rendered to text ("4.0") is no integer.
    """
    types = type_map or {}
    out = []
    for c in df.columns:
        name = label_to_snake(c)
        out.append(cleaner_for(types.get(name, "auto"), tokens)(quoted(c).cast("string")).alias(name))
    return df.select(*out)


def flatten_struct(df: DataFrame, name: str) -> DataFrame:
    return df.select(f"{name}.*")


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))
