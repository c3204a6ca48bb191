"""Mixing sources to target weights by hierarchical budgets; built-in functions only.

A token budget flows down a tree such as domain, language, source. Siblings share their parent's budget by weight; one
that has too few tokens gives the shortage to its siblings, and only what all of them cannot take goes up to the
parent's siblings. A leaf then takes whole epochs and, from one more epoch in a seeded order, a prefix of tokens.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import stored

#: Hex digits of the order key that make a bucket: 4096 for each leaf.
BUCKET_DIGITS = 3
#: What stands in a path for null.
NONE = "%null"


def token_estimate(text: Column) -> Column:
    """Tokens by bytes: a token for every four bytes begun, and one for the end."""
    return F.floor((F.coalesce(F.octet_length(text), F.lit(0)) + 3) / 4).cast("long") + 1


def _weight(path: Column, weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    return F.coalesce(F.try_element_at(table, path), F.lit(1)).cast("long")


def _paths(levels: list[str]) -> list[Column]:
    """Paths from the root. In a name, % is written %25 and a slash %2F, so that NONE is no name."""
    names = [F.replace(F.col(f"`{c}`").cast("string"), F.lit("%"), F.lit("%25")) for c in levels]
    parts = [F.coalesce(F.replace(name, F.lit("/"), F.lit("%2F")), F.lit(NONE)) for name in names]
    return [F.concat_ws("/", *parts[:k + 1]) for k in range(len(levels))]


def leaf_budgets(leaves: DataFrame, depth: int, weights: Mapping[str, int], budget_share: float,
                 max_epochs: int) -> DataFrame:
    """path, tokens, budget for each leaf, from columns path_0 ... path_<depth - 1> and tokens.

    Water-filling in closed form: siblings in order of capacity by weight are full as long as their capacity is under
    the level that the remaining budget would reach over the remaining weights; the others share that level. Nodes of
    weight 0 go with all below them before any sum is taken, so their tokens are nobody's capacity; the whole budget
    still counts them.
    """
    parent = leaves.select(F.lit("").alias("path"), "tokens").groupBy("path").agg(
        (F.sum("tokens") * F.lit(budget_share)).alias("budget"))
    for k in range(depth):
        leaves = leaves.where(_weight(F.col(f"path_{k}"), weights) > 0)
    for k in range(depth):
        above = F.lit("") if k == 0 else F.col(f"path_{k - 1}")
        nodes = leaves.groupBy(above.alias("parent"), F.col(f"path_{k}").alias("path")).agg(
            F.sum("tokens").cast("double").alias("tokens"))
        nodes = (nodes.withColumn("weight", _weight(F.col("path"), weights))
                 .withColumn("capacity", F.col("tokens") * max_epochs)
                 .join(parent.select(F.col("path").alias("parent"), "budget"), "parent"))
        siblings = Window.partitionBy("parent").orderBy(F.col("capacity") / F.col("weight"), "path")
        before = F.coalesce(F.sum("capacity").over(siblings.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        after = F.sum("weight").over(siblings.rowsBetween(0, Window.unboundedFollowing))
        level = F.when(F.col("capacity") > F.col("reach") * F.col("weight"), F.col("reach"))
        filled = (nodes.withColumn("reach", (F.col("budget") - before) / after)
                  .withColumn("level", F.max(level).over(Window.partitionBy("parent"))))
        parent = filled.select("path", "tokens", F.least(
            F.col("capacity"), F.coalesce(F.col("level") * F.col("weight"), F.col("capacity"))).alias("budget"))
    return parent


def mix(docs: DataFrame, levels: list[str], weights: Mapping[str, int] | None = None, budget_share: float = 0.5,
        max_epochs: int = 2, seed: int = 17, id_col: str = "doc_id", tokens: Column | None = None) -> DataFrame:
    """The chosen rows of ``docs``, once for each epoch they are in, with the number of that ``epoch``.

    ``levels``: columns from the root to the leaf; null is a branch of its own. ``weights``: whole numbers by path
    ("en", "en/src1"; in a name % is written %25 and a slash %2F, null is %null), 1 where not named, 0 leaves the branch
    out. The budget is ``budget_share`` of all tokens; no row is taken more than ``max_epochs`` times. ``tokens``: each row's, by default estimated from ``text`` (null:
    the end token alone).

    Epoch e orders a leaf by md5 of seed, e and id. Rows are taken while the tokens before them are under what the
    leaf still needs; rows with the same id in a leaf have the same place and are taken or left together. Other columns
    pass through (one named ``epoch`` is replaced); empty tables and budgets give no rows.

    The prefix is found without sorting a leaf: sums over buckets of the order key give the bucket that holds the end,
    and only its rows are put in order. The rows themselves are not shuffled.
    """
    tokens = token_estimate(F.col("text")) if tokens is None else tokens
    row = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
                      F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("id"), tokens.alias("n"),
                      *(p.alias(f"path_{k}") for k, p in enumerate(_paths(levels))))
    leaf = f"path_{len(levels) - 1}"
    paths = [f"path_{k}" for k in range(len(levels))]
    sizes = stored(row.select(*paths, "id", "n"), "mix-sizes")
    totals = stored(sizes.groupBy(*paths).agg(F.sum("n").alias("tokens")), "mix-totals")
    budgets = stored(leaf_budgets(totals, len(levels), weights or {}, budget_share, max_epochs)
                     .withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
                     .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
                     .select(F.col("path").alias(leaf), "epochs", "rest"), "mix-budgets")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("id")).cast("binary"))
    keyed = (sizes.join(budgets.where("rest > 0"), leaf).select(leaf, "rest", "n", key.alias("key"))
             .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    buckets = keyed.groupBy(leaf, "bucket").agg(F.sum("n").alias("in_bucket"))
    upto = F.sum("in_bucket").over(Window.partitionBy(leaf).orderBy("bucket"))
    last = stored(buckets.withColumn("before", upto - F.col("in_bucket")).withColumn("upto", upto)
                  .join(budgets.select(leaf, "rest"), leaf).where("before < rest")
                  .groupBy(leaf).agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("b"))
                  .select(leaf, "b.bucket", "b.before"), "mix-buckets")
    inside = F.sum("n").over(Window.partitionBy(leaf, "bucket").orderBy("key")
                             .rowsBetween(Window.unboundedPreceding, -1))
    cuts = stored(keyed.join(last, [leaf, "bucket"])
                  .withColumn("ahead", F.col("before") + F.coalesce(inside, F.lit(0))).where("ahead < rest")
                  .groupBy(leaf).agg(F.max("key").alias("last_key")), "mix-cuts")
    # Written so that its size is known: the rows meet it without a shuffle as long as it is small.
    plan = stored(budgets.join(cuts, leaf, "left").select(leaf, "epochs", "last_key"), "mix-plan")
    times = F.col("epochs") + F.when(key <= F.col("last_key"), 1).otherwise(0)
    epochs = F.when(F.col("times") > 0, F.sequence(F.lit(0), F.col("times") - 1)).otherwise(F.array().cast("array<int>"))
    taken = row.join(plan, leaf).withColumn("times", times).select("row", F.explode(epochs).alias("epoch"))
    return taken.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "epoch"), "epoch")
