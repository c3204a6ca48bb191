"""Changes of tables as functions of frames: deletes, updates, inserts, differences, states of the past; and the tables
that consume changes.

No versions of files are kept: frames come in and go out, and versions are the business of a table format that has
transactions. What consumes changes or periods owns one partition for each and replaces it, so a rerun adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.aggregates import hourly_stats
from lakemart.operators.columns import conform, quoted
from lakemart.operators.joins import split_new_rows
from lakemart.sources.increments import replace_partitions


class DuplicateRows(Exception):
    """Raised by a guarded insert that meets rows the table already holds."""


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with rows added, columns matched by name; columns the rows lack become NULL, unknown ones are refused."""
    unknown = {c.lower() for c in rows.columns} - {c.lower() for c in df.columns}
    if unknown:
        raise ValueError(f"the table has no column {sorted(unknown)}")
    return df.unionByName(conform(rows, df.schema, strict=True))


def guarded_rows(rows: DataFrame, table: DataFrame, on_duplicate: str = "raise", null_safe: bool = False) -> DataFrame:
    """The rows that a guarded insert may add to the table.

    ``raise``: any row that is in the table or twice in the batch refuses the batch. ``skip``: such rows are left out.
    A row holding a NULL never counts as a duplicate unless ``null_safe``.
    """
    if on_duplicate not in ("raise", "skip"):
        raise ValueError("on_duplicate must be 'raise' or 'skip'")
    batch = conform(rows, table.schema, strict=True)
    fresh, known = split_new_rows(batch, table, null_safe)
    if on_duplicate == "skip":
        return fresh
    guarded = batch if null_safe else batch.dropna()
    twice = guarded.groupBy(*map(quoted, batch.columns)).count().filter("count > 1")
    if known.head(1) or twice.head(1):
        raise DuplicateRows("the batch repeats rows of the table or its own")
    return batch


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """The rows a delete leaves: those for which the condition is false or unknown."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_rows(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; every new value is computed from the old row."""
    changed = {f.name: F.when(condition, values[f.name].cast(f.dataType)).otherwise(quoted(f.name)).alias(f.name)
               for f in df.schema if f.name in values}
    return df.select(*[changed.get(c, quoted(c)) for c in df.columns])


def _differing(signed: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int) -> DataFrame:
    """The rows of the buckets in which the two sides differ, told by counts and sums of row hashes in any order.

    Two independent 64-bit hashes are summed without loss, so that differing buckets look alike with a chance of 2^-128.
    At most ``buckets`` numbers are broadcast; rows of equal buckets meet no shuffle.
    """
    row = [quoted(c) for c in columns]
    # With the partition's number in it, never used, the bucket takes no part in the planner's inferred conditions, whose
    # number doubles with each renamed column that a hash reads.
    bucket = F.when(F.spark_partition_id() < 0, -1).otherwise(
        F.pmod(F.xxhash64(*[quoted(c) for c in (key or columns)]), F.lit(buckets)))
    hashes = [F.xxhash64(*row).cast("decimal(20,0)"), F.xxhash64(F.lit("second"), *row).cast("decimal(20,0)")]
    sums = [F.sum(h * F.col("_n")).alias(f"_h{i}") for i, h in enumerate(hashes)]
    differ = (signed.select("*", bucket.alias("_bucket")).groupBy("_bucket").agg(F.sum("_n").alias("_count"), *sums)
              .filter("_count <> 0 OR _h0 <> 0 OR _h1 <> 0").select("_bucket"))
    return signed.withColumn("_bucket", bucket).join(F.broadcast(differ), "_bucket", "left_semi").drop("_bucket")


def table_changes(old: DataFrame, new: DataFrame, key: Sequence[str] = (), buckets: int = 4096) -> DataFrame:
    """Net difference between two versions: their rows plus ``action`` (INSERT or DELETE) and ``is_update``.

    An updated row shows as a DELETE of its old and an INSERT of its new form, both marked ``is_update``,
    which takes a key. Rows are counted per side in one grouping, so equal rows cancel, and a row that changed n times
    over appears n times.

    Both versions are read twice: a first pass digests them by bucket, and only rows of the ``buckets`` that differ are
    shuffled, so what is shuffled follows the change. With 0 buckets both versions are shuffled whole and read once, which
    suits versions that are dear to compute or differ everywhere.
    """
    columns = old.columns
    signed = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
    if buckets:
        signed = _differing(signed, columns, key, buckets)
    net = signed.groupBy(*map(quoted, columns)).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    if key:
        sides = net.groupBy(*map(quoted, key)).agg(
            (F.min("_n") < 0).alias("_gone"), (F.max("_n") > 0).alias("_came"))
        both = sides.filter("_gone AND _came").select(*[quoted(k).alias(f"_k{i}") for i, k in enumerate(key)])
        marked = both.withColumn("_both", F.lit(True))
        same = F.lit(True)
        for i, k in enumerate(key):
            same = same & quoted(k).eqNullSafe(F.col(f"_k{i}"))
        net = net.join(marked, same, "left")
        is_update = F.coalesce("_both", F.lit(False))
    else:
        is_update = F.lit(False)
    # Repeat each row |n| times in chunks, so that no array grows with the number of copies.
    chunk = 10_000
    copies = F.abs("_n")
    chunks = net.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / chunk))))
    size = F.least(F.lit(chunk).cast("long"), copies - F.col("_chunk") * chunk).cast("int")
    repeated = chunks.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), size)))
    return repeated.select(*map(quoted, columns),
                           F.when(F.col("_n") > 0, "INSERT").otherwise("DELETE").alias("action"),
                           is_update.alias("is_update"))


def all_inserted(new: DataFrame) -> DataFrame:
    """:func:`table_changes` from nothing to a first version: each of its rows as an INSERT, read once and not shuffled."""
    return new.withColumns({"action": F.lit("INSERT"), "is_update": F.lit(False)})


def rows_as_of(changes: DataFrame, moment: Column, time: str = "changed_at") -> DataFrame:
    """A table as it was at a moment, from all its changes: rows with ``action`` (INSERT or DELETE) and their time.

    What was inserted and not deleted up to then, in one grouping by all columns.
    """
    columns = [c for c in changes.columns if c not in ("action", "is_update", time)]
    past = changes.filter(F.col(time) <= moment)
    inserted, deleted = (past.filter(F.col("action") == a).select(*map(quoted, columns)) for a in ("INSERT", "DELETE"))
    return table_changes(deleted, inserted, buckets=0).filter(F.col("action") == "INSERT").select(*map(quoted, columns))


def restore_version(changes: DataFrame, moment: Column, at: Column, time: str = "changed_at") -> DataFrame:
    """The changes that bring a table back to what it was at ``moment``: to be added to all its changes, as made ``at``.

    A restore is a change like others, so the states between the two moments stay readable.
    """
    now, then = rows_as_of(changes, at, time), rows_as_of(changes, moment, time)
    return table_changes(now, then, buckets=0).withColumn(time, at)


# --- tables that consume changes --------------------------------------------------------------


def last_position(spark: SparkSession, log: str) -> int | None:
    """The newest position that the log holds; None for a log that does not exist or is empty."""
    return spark.table(log).agg(F.max("position")).first()[0] if spark.catalog.tableExists(log) else None


def log_changes(changes: DataFrame, log: str, position) -> None:
    """Put changes into a log as those of ``position``, in place of what is there for it."""
    replace_partitions(changes.withColumn("position", F.lit(position)), log, ["position"])


def consume_changes(spark: SparkSession, state_at: Callable[[int], DataFrame], newest: int, log: str, first: int = 0,
                    key: Sequence[str] = (), buckets: int = 4096) -> bool:
    """Bring a log of changes up to the ``newest`` position of a table; whether there was anything to add.

    ``state_at`` gives the table as of a position, such as a table format's time travel or a written snapshot. The log
    itself is the only memory: the newest position that it holds (``first``, if none) is where reading goes on, and the net
    changes from there are its next partition. A run that is repeated, or broke off, leaves the same log. Without net
    changes the position stays, and the next run starts from the same state.
    """
    last = last_position(spark, log)
    start = first if last is None else last
    if start >= newest:
        return False
    changes = table_changes(state_at(start), state_at(newest), key, buckets)
    log_changes(changes, log, newest)
    return last_position(spark, log) == newest


def save_hourly_stats(trips: DataFrame, table: str, at=None) -> None:
    """Keep the statistics of this run in their history, a table that is made on the first run, in place of what an earlier
    run of the same period left."""
    replace_partitions(hourly_stats(trips, at), table, ["ts"])


#: What an average is made of, by the name of its column.
AVERAGED = {"avg_trip_distance": "trip_distance", "avg_total_amount": "total_amount"}


def save_hourly_states(trips: DataFrame, table: str, load: str, day: str = "pickup_datetime",
                       distinct: str = "vendor_id") -> None:
    """Keep a load's part of the statistics by day and pick-up hour, unfinished: counts, sums and a sketch of the different
    ``distinct`` values, which can all be merged.

    A load owns its partition: doing it again replaces it. Trips that come late belong to their own day, whatever load
    brings them.
    """
    known = trips.filter(F.col("pickup_hour").isNotNull())
    sums = [m for c in AVERAGED.values() for m in (F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"count_{c}"))]
    states = known.groupBy(F.to_date(quoted(day)).alias("day"), "pickup_hour").agg(
        F.count("*").alias("trips"), *sums, F.hll_sketch_agg(quoted(distinct)).alias("sketch"))
    replace_partitions(states.withColumn("load", F.lit(load)), table, ["load"])


def finished_hourly_stats(states: DataFrame, by: Sequence[str] = ("day", "pickup_hour")) -> DataFrame:
    """The statistics of all loads, merged: by day and hour, or by either alone."""
    averages = [(F.sum(f"sum_{c}") / F.sum(f"count_{c}")).alias(name) for name, c in AVERAGED.items()]
    return states.groupBy(*by).agg(
        F.sum("trips").alias("total_trips"), *averages,
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
