"""From documents to packed training sequences: quality rules, near-dedup, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
``docs``; all but the last return the columns of ``documents``.

Stages take null and repeated ids, null, empty and very long texts and empty tables: empty tables give no rows, other cases
are those of the operator that a stage calls. Further columns pass through all stages but the last.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakemart.llm import mixing, packing, pii, quality, simhash  # noqa: E402
from lakemart.llm.common import bound_batches, share_code, stored  # noqa: E402
from lakemart.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, with_domain  # noqa: E402
from lakemart.session import own_scratch  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are too short, too repetitive or probably bad go."""
    share_code(spark)
    bound_batches(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    share_code(spark)
    bound_batches(spark)
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the names of their kinds."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows by the target weights; a document that two epochs take is there twice."""
    mixed = mixing.mix(with_domain(docs), ["domain", "lang", "source"], MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select(*docs.columns)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    share_code(spark)
    bound_batches(spark)
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("PII", personal_data),
          ("mixing", source_mix), ("best-fit packing", best_fit)]

#: Votes weighed by expectation-maximisation, XXH64 fingerprints and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written in between."""
    own_scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
