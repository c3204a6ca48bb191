"""Joins.

No broadcast hints: a lookup is broadcast by Spark when its size is under the session threshold, and
shuffled otherwise (see ``session.py``). For a shuffled join, AQE splits a hot key's partition on the
row-preserving side, provided both sides come straight from a shuffle. Where one side is an aggregate
on the join key, that does not hold, and the functions below deal a hot key's rows out themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil, sqrt
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakemart.operators.columns import quoted


SALT = "_salt"


def deal_out(left: DataFrame, right: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column to join on as well: rows of ``left`` get one, rows of ``right`` all.

    The salt depends on the row and on the number of its partition only, never on chance or on the order
    of rows, so a task that is lost and run again deals its rows out the same way. Equal rows differ by
    their partition.
    """
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *map(quoted, left.columns)), F.lit(salts)).cast("int")
    return left.withColumn(SALT, dealt), right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def deal_out_both(left: DataFrame, right: DataFrame, salts: int, weight: int = 1) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column to join on as well, as cells of a grid of at least ``salts`` cells: a row of ``left``
    gets one of its lines and goes to each cell of it, a row of ``right`` one of its columns.

    Two rows meet in one cell. Both sides are repeated a few times where :func:`deal_out` repeats ``right`` ``salts`` times;
    ``weight`` is how many rows of ``right`` there are
    for one of ``left``. Salts depend on the row and its partition's
    number only.
    """
    lines = max(1, round(sqrt(salts / weight)))
    columns = ceil(salts / lines)

    def own(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64(F.spark_partition_id(), *map(quoted, df.columns)), F.lit(n)).cast("int")

    return (left.withColumn(SALT, own(left, lines)).withColumn(
                SALT, F.explode(F.sequence(F.col(SALT) * columns, F.col(SALT) * columns + (columns - 1)))),
            right.withColumn(SALT, own(right, columns)).withColumn(
                SALT, F.explode(F.transform(F.sequence(F.lit(0), F.lit(lines - 1)), lambda line: line * columns + F.col(SALT)))))


#: Share of a side's rows from which a key counts as hot, and keys that each task's sketch has room for.
HOT_SHARE, TRACKED = 0.01, 4096


def _key_hash(df: DataFrame, on: Sequence[str], types: Mapping[str, DataType]) -> Column:
    """One number for a row's key, the same on both sides of a join: key columns in the left side's types."""
    return F.xxhash64(*[quoted(c).cast(types[c]) for c in on])


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> dict[int, int]:
    """Hashes of the keys that hold ``share`` of the rows or more, with how many times that share each holds, rounded up.

    One pass over the key columns. Each task keeps a frequent-items sketch and sends nothing else, so no key is brought
    together anywhere; the sketches find every key over one in about ``TRACKED`` rows. The answer has 1 / share keys at most.
    """
    most = max(1, int(1 / share))
    types = {c: df.schema[c].dataType for c in on}
    counted = df.select(_key_hash(df, on, types).alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {most}, {max(TRACKED, 4 * most)})").alias("top")).first()
    least = max(2.0, share * counted["n"])
    return {r["item"]: ceil(r["count"] / least) for r in counted["top"] or [] if r["count"] > least}


def deal_out_hot(left: DataFrame, right: DataFrame, on: Sequence[str], share: float = HOT_SHARE
                 ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides, and the columns to join them on: rows of a hot key of ``left`` get one of as many salts as the key needs,
    and the rows of ``right`` with that key, and no others, are repeated for each. Without hot keys, the sides as they are.

    Salts depend on the row and its partition's number only, as in :func:`deal_out`.
    """
    hot = hot_keys(left, on, share)
    if not hot:
        return left, right, list(on)
    types = {c: left.schema[c].dataType for c in on}
    table = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])

    def salts(df: DataFrame) -> Column:
        return F.coalesce(F.try_element_at(table, _key_hash(df, on, types)), F.lit(1))

    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *map(quoted, left.columns)), salts(left)).cast("int")
    return (left.withColumn(SALT, dealt),
            right.withColumn(SALT, F.explode(F.sequence(F.lit(0), salts(right) - 1))), [*on, SALT])


def lookup(df: DataFrame, key: str, names: Mapping[str, str], key_as: str, key_type: str = "bigint") -> DataFrame:
    """A lookup cut to its key (cast so that bad text matches nothing) and renamed payload columns."""
    return df.select(quoted(key).try_cast(key_type).alias(key_as),
                     *[quoted(old).alias(new) for old, new in names.items()])


def join_zones(trips: DataFrame, zones: DataFrame, payload: str = "zone", zone_key: str = "location_id",
               pickup_key: str = "pu_location_id", dropoff_key: str = "do_location_id", how: str = "left",
               suffix: str | None = None) -> DataFrame:
    """Join a zone lookup twice, giving ``pickup_<suffix>`` and ``dropoff_<suffix>``."""
    suffix = suffix or payload.lower()
    pickup = lookup(zones, zone_key, {payload: f"pickup_{suffix}"}, pickup_key)
    dropoff = lookup(zones, zone_key, {payload: f"dropoff_{suffix}"}, dropoff_key)
    return trips.join(pickup, pickup_key, how).join(dropoff, dropoff_key, how)


def join_dimensions_inner(facts: DataFrame, dimension: DataFrame, dimension_key: str,
                          fact_keys: Sequence[str]) -> DataFrame:
    """Inner-join the same dimension once per fact key; only the check remains, no columns are added."""
    for key in fact_keys:
        facts = facts.join(lookup(dimension, dimension_key, {}, key), key, "inner")
    return facts


def join_multi_key(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                   salts: int = 1, hot_share: float | None = None) -> DataFrame:
    """Equi join on several columns.

    For a right side that is too large to broadcast, and hot keys: with ``hot_share``, the keys that hold that share of
    ``left`` are found first, by a pass over its key columns, and only they are dealt out, with only their rows of ``right``
    repeated. ``salts`` > 1 deals every key out over that many tasks without a pass, and repeats all of ``right``.
    """
    if salts == 1 and hot_share is None:
        return left.join(right, list(on), how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting cannot repeat the right side of a {how} join")
    if hot_share is not None:
        salted, repeated, keys = deal_out_hot(left, right, on, hot_share)
        return salted.join(repeated, keys, how).drop(SALT)
    salted, repeated = deal_out(left, right, salts)
    return salted.join(repeated, [*on, SALT], how).drop(SALT)


def join_using(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join on shared column names; each key appears once in the result."""
    return left.join(right, on, how)


def join_key_and_day(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                     right_columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join on a key and the calendar day of one timestamp per side; adds renamed right columns."""
    keyed = right.select(quoted(key).alias("_key"), F.to_date(quoted(right_time)).alias("_day"),
                         *[quoted(old).alias(new) for old, new in right_columns.items()])
    condition = (left[key] == keyed["_key"]) & (F.to_date(left[left_time]) == keyed["_day"])
    return left.join(keyed, condition, how).drop("_key", "_day")


def join_with_fallback(base: DataFrame, metrics: Sequence[DataFrame], on: str,
                       choose: Mapping[str, Column]) -> DataFrame:
    """Left-join several one-row-per-key frames, then compute output columns (usually coalesces).

    The joins share the key, so after the first shuffle Spark reuses the partitioning.
    """
    joined = reduce(lambda acc, m: acc.join(m, on, "left"), metrics, base)
    return joined.select(*[expr.alias(name) for name, expr in choose.items()])


def join_group_metrics(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left-join one aggregate to another by the id of the group."""
    return left.join(right, on, "left")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                  minutes: int = 5, salts: int = 1, hot_share: float | None = None) -> DataFrame:
    """Inner join of two event sets: same key, times at most ``minutes`` apart, both ends included.

    Joining on the key alone would compare every pair of a key's events, so both sides also get a time
    bucket twice as wide as the tolerance: a right row lies in one bucket, a left row reaches into two.
    Each match meets exactly once. Works for batch and, given watermarks on both sides, for
    streaming frames: the time-range condition stays in the join, and bounds the state.
    ``salts`` spreads a bucket that is itself too hot; a stream keeps every repeated row, so both sides share the repeats. For batch frames, ``hot_share`` finds the keys and buckets that hold
    that share of ``right``, and deals out only these. In batch frames a left row's two bounds are computed once, not for
    every row that it is compared with; a stream's join must show the interval itself, or its state has no bound.
    """
    width = 2 * 60 * minutes
    tolerance = F.expr(f"INTERVAL {minutes} MINUTES")
    seconds = F.unix_timestamp(quoted(left_time))
    first = F.floor((seconds - width / 2) / width)
    last = F.floor((seconds + width / 2) / width)
    spread_left = left.withColumn("_bucket", F.explode(F.sequence(first, last)))
    spread_right = right.withColumn("_bucket", F.floor(F.unix_timestamp(quoted(right_time)) / width))
    on = ["_bucket", key]
    if hot_share is not None:
        spread_right, spread_left, on = deal_out_hot(spread_right, spread_left, on, hot_share)
    elif salts > 1:
        spread_right, spread_left = deal_out_both(spread_right, spread_left, salts, 2)
        on.append(SALT)
    spread_right = spread_right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    condition = reduce(and_, [spread_left[c] == spread_right[f"_right_{c}"] for c in on])
    if left.isStreaming or right.isStreaming:
        near = spread_right[right_time].between(spread_left[left_time] - tolerance, spread_left[left_time] + tolerance)
    else:
        spread_left = spread_left.withColumns({"_from": quoted(left_time) - tolerance, "_to": quoted(left_time) + tolerance})
        near = spread_right[right_time].between(spread_left["_from"], spread_left["_to"])
    return spread_left.join(spread_right, condition & near, "inner").drop(
        "_bucket", "_from", "_to", SALT, *[f"_right_{c}" for c in on])


def _complete(columns: Sequence[str]) -> Column:
    return reduce(and_, [quoted(c).isNotNull() for c in columns])


def split_new_rows(new: DataFrame, existing: DataFrame, null_safe: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(fresh, known)``: rows of ``new`` not yet / already in ``existing``, each counted once.

    With plain equality a row holding any NULL equals nothing, so it is always fresh and never merged
    with its twins; ``null_safe`` treats NULL as a value. Both sides go through one grouping by all columns, which
    combines in the map tasks, so a row that fills much of the table meets no other in one place.
    """
    columns = new.columns
    table = existing.select(*map(quoted, columns))
    loose = None
    if not null_safe:
        table, loose, new = table.filter(_complete(columns)), new.filter(~_complete(columns)), new.filter(_complete(columns))
    sides = new.withColumn("_new", F.lit(True)).unionByName(table.withColumn("_new", F.lit(False)))
    seen = sides.groupBy(*map(quoted, columns)).agg(F.max("_new").alias("_new"), F.min("_new").alias("_only_new"))
    fresh, known = (seen.filter(F.col("_new") & c).select(*map(quoted, columns))
                    for c in (F.col("_only_new"), ~F.col("_only_new")))
    return (fresh if loose is None else fresh.unionByName(loose)), known


def insert_guard_anti(new: DataFrame, existing: DataFrame, null_safe: bool = False) -> DataFrame:
    return split_new_rows(new, existing, null_safe)[0]


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent.

    Keys are compared once each; the child's rows then meet only the missing keys, which are few as a rule.
    """
    keys = parent.select(quoted(parent_key).alias("_key")).distinct()
    own = child.select(quoted(child_key).alias("_key")).filter("_key IS NOT NULL").distinct()
    missing = own.join(keys, "_key", "left_anti")
    return child.join(missing, child[f"`{child_key}`"] == missing["_key"], "left_semi")
