"""Frames with the cases that every operator has to survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Null id and text, empty and white texts, a repeated row, one id with two texts, equal texts.
ODD = [
    (1, None, "en", "src1", None), (2, "", "en", None, 0), (3, " \n\t ", None, "src1", 4), (None, "a b c d e f", "en", "src2", 11),
    (None, None, None, None, None), (4, "same words here again and again", "en", "src1", 31),
    (4, "same words here again and again", "en", "src1", 31), (5, "same words here again and again", "de", "src1", 31),
    (6, "one text of this id", "fr", "src3", 19), (6, "another text of this id", "fr", "src3", 23),
    (7, "naïve — café 😀 ÉÀ", "fr", "a/b", 17), (8, "x" * 30_000, "en", "src1", 30_000), (9, "word " * 20_000, "es", "src4", 100_000),
]
#: Names that the operators use inside.
CLASHING = ("row", "key", "id", "n", "s", "fp", "pii", "epoch", "text_hash", "copy", "component", "share", "t", "votes")


def odd(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ODD, DOCS)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def clashing(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
