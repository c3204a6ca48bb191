"""Database tables over JDBC. The driver jar must be on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, table: str, url: str, user: str, password: str, connections: int, mode: str = "overwrite",
               driver: str = "org.postgresql.Driver", batch_size: int = 10_000, truncate: bool = True) -> None:
    """Write in batches over ``connections`` parallel connections, as many as the database bears.

    The rows are dealt out over the connections in a step of its own, so what made them keeps its width.
    """
    (df.repartition(connections).write.format("jdbc").mode(mode)
       .options(url=url, dbtable=table, user=user, password=password, driver=driver, batchsize=batch_size,
                numPartitions=connections, truncate=str(truncate).lower())
       .save())


def read_jdbc(spark: SparkSession, table: str, url: str, user: str, password: str, connections: int,
              partition_column: str | None = None, bounds: tuple | None = None, predicates: list[str] | None = None,
              driver: str = "org.postgresql.Driver", fetch_size: int = 10_000) -> DataFrame:
    """Read a table in parallel: in ranges of ``partition_column`` between ``bounds``, or by ``predicates``, one task each.

    One of the two is required, as Spark reads a table without them in a single task.
    """
    if predicates:
        properties = {"user": user, "password": password, "driver": driver, "fetchsize": str(fetch_size)}
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if not partition_column or bounds is None:
        raise ValueError("a partition column with bounds, or predicates, are needed")
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, user=user, password=password, driver=driver, fetchsize=fetch_size)
    return reader.options(partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
                          numPartitions=connections).load()
