"""Session defaults and the shared scratch folder. Library code never creates a session itself."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pyspark.sql import SparkSession

#: The state of a stream, which grows with its joins, windows and ids and not with the executors' heap: kept on executor disk,
#: with a cache and write buffers that all its stores on an executor share. Rows are not counted, which would read each before
#: it is written.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# Sizes are for executors with about 4 GB per core. Joins carry no broadcast hint anywhere in this
# package: Spark broadcasts a side only when its estimated (or, with AQE, measured) size is below the
# thresholds here, and otherwise shuffles, where AQE splits skewed partitions.
CLUSTER_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **STATE_ON_DISK,
}


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """How many partitions a shuffle of the input starts with, so that a task gets about ``target_bytes`` at every size;
    AQE merges those that turn out small."""
    return max(200, -(-input_bytes // target_bytes))


def build_session(name: str, master: str | None = None, input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots and win over them.

    ``input_bytes``, the size of the data to be read, sets the number of shuffle partitions. Streams fix
    that number in their checkpoint when they first start.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    settings = CLUSTER_DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_DATABASES: dict[str, set[str]] = {}


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """SQL settings for what is planned or started meanwhile; keys use ``__`` for dots."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_on_disk(spark: SparkSession):
    """Streams started meanwhile keep their state on executor disk, unless the session itself names a store. A stream that is
    taken up again stays with the store of its checkpoint."""
    own = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    return settings(spark, **({} if own else STATE_ON_DISK))


#: Bytes of Parquet that a task reads whose rows are sorted before their shuffle, as "first per key" does: packed rows are
#: ten times as large in memory, where a task has one to two GB.
SORTED_SPLIT = 32 << 20


def small_splits(spark: SparkSession):
    """Scans planned meanwhile are cut so finely that their tasks sort what they read without spilling."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    own = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)
    return settings(spark, spark__sql__files__maxPartitionBytes=f"{min(own, SORTED_SPLIT)}b")


def own_scratch(spark: SparkSession) -> None:
    """For local sessions without ``spark.checkpoint.dir``, such as tests: a temporary folder in its place."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lakemart-"))


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/lakemart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared ``spark.checkpoint.dir``; :func:`drop_scratch` removes it."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables live in a scratch folder; :func:`drop_scratch` removes it."""
    path = scratch_path(spark, "db")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    _DATABASES.setdefault(spark.sparkContext.applicationId, set()).add(name)
    return name


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch folders and databases; call it when the results that read them are done."""
    for name in _DATABASES.pop(spark.sparkContext.applicationId, set()):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
