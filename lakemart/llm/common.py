"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import scratch_path


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if that folder exists for them.

    On a cluster, install the package on the executors or ship it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound the bytes of rows that a Python worker gets at a time, where the session sets no bound: texts are long, and
    a batch is held several times."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, size)


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Point Spark's checkpoints at the shared folder of ``spark.checkpoint.dir``; an error if there is none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and written to the shared checkpoint folder: lost executors cost no recomputation,
    and what is derived from row positions afterwards comes out the same when tasks are run again."""
    set_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the cluster's shared scratch folder: computed once, and small ones are known as such, so
    that Spark may broadcast them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
