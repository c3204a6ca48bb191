"""Tables that grow by increments: each input file is consumed once, and each increment owns a partition that it replaces.

Both together are exactly once: a stream's checkpoint gives a failed increment the same files and the same number again,
and writing it again puts the same partition in place of what the first try may have left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.columns import quoted
from lakemart.session import settings, small_splits
from lakemart.sources.files import list_files, scan_recursive
from lakemart.sources.sinks import PACKED

#: Bytes and rows of an increment's files that ask for a bucket: what a task can sort in memory, grown tables included. Rows
#: count as well, as well packed ones are many times as large in memory.
BUCKET_BYTES, BUCKET_ROWS = 32 << 20, 1_000_000


def bucket_count(spark: SparkSession, name: str) -> int | None:
    """How many buckets a table has; None for one without."""
    found = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else None


def buckets_for(spark: SparkSession, folder: str, least: int = 8) -> int:
    """Buckets for a table that is made from the Parquet files below a folder, by their size and rows, which are in their
    footers."""
    size = list_files(spark, folder, "*.parquet").agg(F.sum("length")).first()[0] or 0
    return max(least, -(-size // BUCKET_BYTES), -(-scan_recursive(spark, folder).count() // BUCKET_ROWS))


#: Files that a dealt table has at most, one for each task and bucket.
MOST_FILES = 100_000


def as_they_are(rows: DataFrame) -> DataFrame:
    return rows


def deal_by_key(rows: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The rows, dealt into buckets by a key in a table that is replaced: what goes on by that key needs no shuffle.

    Tasks write what they read, a packed file for each bucket, which is a third of the bytes that a shuffle of whole rows
    writes. Rows that would make more than ``MOST_FILES`` files come back as they are, to be shuffled. All rows of a key
    lie in one bucket, copies included. Files are not sorted: a bucket has several, which are sorted where they meet.
    """
    if rows.rdd.getNumPartitions() * buckets > MOST_FILES:
        return rows
    rows.write.mode("overwrite").bucketBy(buckets, key).options(**PACKED).saveAsTable(name)
    return rows.sparkSession.table(name)


def replace_partitions(df: DataFrame, name: str, by: Sequence[str], bucket_key: str | None = None,
                       buckets: int = 8) -> None:
    """Write the partitions anew that the rows fall in; all others stay. The table is made on first use.

    ``bucket_key`` deals the table's rows into ``buckets`` for good, one file each for a write: joins on that column then
    shuffle the other side only. Choose as many buckets as the grown table needs tasks; a table that is there keeps its
    own. Rows that come from a shuffle by that column are not shuffled again.
    """
    spark = df.sparkSession
    ordered = df.select(*[quoted(c) for c in df.columns if c not in by], *map(quoted, by))
    if not spark.catalog.tableExists(name):
        writer = spark.createDataFrame([], ordered.schema).write.mode("ignore").partitionBy(*by)
        if bucket_key:
            writer = writer.bucketBy(buckets, bucket_key)
        writer.option("partitionOverwriteMode", "dynamic").options(**PACKED).saveAsTable(name)
    if not bucket_key:
        ordered.write.insertInto(name, overwrite=True)
        return
    dealt = bucket_count(spark, name) or buckets
    # Rows that are shuffled by the key on the way here then lie in their buckets, and are shuffled neither to meet the
    # table nor to be written.
    with settings(spark, spark__sql__shuffle__partitions=str(dealt)):
        ordered.repartition(dealt, quoted(bucket_key)).write.insertInto(name, overwrite=True)


def consume_files(spark: SparkSession, folder: str, checkpoint: str, take: Callable[[DataFrame, int], None],
                  files_per_batch: int | None = None, max_age: str = "36500d") -> None:
    """Give every Parquet file below ``folder`` to ``take`` once, with the number of its increment, then return.

    Files are told apart by name, never by a time in them, so it does not matter when a load began, when it committed or
    what it is stamped with; ``max_age`` is how much older than the newest a late file may be. If ``take`` fails, the next
    call repeats the increment with the same files and number before it goes on; ``take`` must replace what it wrote.

    The stream carries the names of the files only, no column of them; ``take`` gets a plain scan of these files, which
    reads the columns that it uses.
    """
    schema = scan_recursive(spark, folder).schema
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    names = reader.option("maxFileAge", max_age).parquet(folder).select(F.col("_metadata.file_path").alias("file"))

    def taken(batch: DataFrame, number: int) -> None:
        files = [r["file"] for r in batch.distinct().collect()]
        rows = scan_recursive(batch.sparkSession, folder, schema)
        take(rows.filter(F.col("_metadata.file_path").isin(files)), number)

    with small_splits(spark):
        query = (names.writeStream.foreachBatch(taken).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
    query.awaitTermination()


def consumed_path(spark: SparkSession, table: str) -> str:
    """Where the ledger of a table's consumed files lies: in its database's folder, so that both go together."""
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database or 'default').locationUri.rstrip('/')}/_consumed/{name}"


def append_new_keys(rows: DataFrame, name: str, key: str, number: int, buckets: int = 8) -> None:
    """Add the rows whose key no earlier increment has, as increment ``number`` of a table bucketed by the key.

    The increments before it alone decide what is new, so doing it again gives the same rows.
    """
    spark = rows.sparkSession
    if spark.catalog.tableExists(name):
        known = spark.table(name).filter(F.col("increment") < number).select(quoted(key))
        rows = rows.join(known, key, "left_anti").select(*rows.columns)
    replace_partitions(rows.withColumn("increment", F.lit(number).cast("long")), name, ["increment"], key, buckets)
