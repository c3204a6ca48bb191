"""A Merkle manifest of a dataset, kept as content-addressed records: a digest and the digests it is made of.

Rows are leaves. The leaves of a group, in order, are joined by runs of 16 until one digest is left, the group's; the
groups' digests, in order, are joined likewise to the root. A leaf's place is a path of rank digits from the root. A
request descends from the root: it looks up the record of a digest, follows the digit of its path, collects the children
that it does not choose, and at the leaf turns the collected segments round. Requests go down together as long as their
paths agree, so the work is that of the nodes that lie above them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import stored

#: Children of a record; paths have one hexadecimal digit for each level.
FANOUT = 16
#: What a row's digest covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "struct<left: string, right: string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value so that no two rows give the same text: its length in bytes, ``:``, the value; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """The rows, written, with ``position``: their number from 0 in the order of the whole table.

    Rows are dealt by ranges and numbered within each; only the ranges' sizes meet in one task.
    """
    low = (1 << 33) - 1
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("position", F.monotonically_increasing_id()), name)
    part = F.shiftright("position", 33)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"))
    return (dealt.withColumn("part", part).join(F.broadcast(offsets), "part")  # a row for each range of the shuffle
            .withColumn("position", F.col("ahead") + F.col("position").bitwiseAND(low)).drop("part", "ahead"))


def digits(count: Column) -> Column:
    """Levels over ``count`` nodes: none over one, else as many as their last number has hexadecimal digits."""
    return F.when(count < 2, 0).otherwise(F.length(F.hex(count - 1)))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the given columns and path; ``records``: digest, children, once for each digest; the root's digest
    (None without leaves), the length of the groups' paths, and the length of the longest path."""

    leaves: DataFrame
    records: DataFrame
    root: str | None
    top: int
    depth: int


def build(leaves: DataFrame, group: str, order: list[str], name: str = "manifest") -> Manifest:
    """The manifest of rows with a column ``leaf`` (their digest), grouped by ``group`` (null is a group, and the first) and
    ordered by ``order``, null first, equal ones by digest. A group may hold any share of the rows."""
    fine = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = numbered(leaves, f"{name}-leaves", *fine, F.col("leaf"))
    groups = stored(placed.groupBy(group).agg(F.min("position").alias("first"), F.count("*").alias("size")), f"{name}-groups")
    ranked = numbered(groups, f"{name}-ranks", F.col("first")).withColumnRenamed("position", "rank")
    n_groups, most, size = groups.agg(F.count("*"), F.max("size"), F.sum("size")).first()
    top = 0 if n_groups < 2 else len(f"{n_groups - 1:x}")
    depth = top + (0 if (most or 0) < 2 else len(f"{most - 1:x}"))
    ranked = ranked.select(
        F.col(group).alias("same"), "first", digits(F.col("size")).alias("levels"),
        F.lpad(F.hex("rank"), top, "0").alias("above"))
    own = F.lpad(F.hex(F.col("position") - F.col("first")), F.col("levels"), "0")
    leaves = stored(placed.join(ranked, placed[group].eqNullSafe(ranked["same"])).withColumn("path", F.concat("above", own))
                    .drop("same", "first", "levels", "above", "position"), f"{name}-paths")
    if not size:
        return Manifest(leaves, leaves.select(F.col("leaf").alias("digest"), F.array("leaf").alias("children")), None, 0, 0)
    # Runs of leaves first, from all groups at once; lone leaves of a group are nodes of the upper tree already.
    lone = F.length("path") == top
    made = _joined(leaves.where(~lone).select("path", F.col("leaf").alias("digest")), f"{name}-runs")
    nodes = made.select("path", "digest").unionByName(leaves.where(lone).select("path", F.col("leaf").alias("digest")))
    records = made.select("digest", "children")
    for level in range(depth if depth == top else depth - 1, 0, -1):
        made = _joined(nodes.where(F.length("path") == level), f"{name}-nodes")
        records = records.unionByName(made.select("digest", "children"))
        nodes = nodes.where(F.length("path") < level).unionByName(made.select("path", "digest"))
    root = nodes.where(F.length("path") == 0).select("digest").first()[0]
    unique = stored(records.groupBy("digest").agg(F.first("children").alias("children")), f"{name}-records")
    return Manifest(leaves, unique, root, top, depth)


def _joined(nodes: DataFrame, name: str) -> DataFrame:
    """path, digest, children of the parents of ``nodes``; a parent has 16 children at most."""
    parent = F.expr("substring(path, 1, length(path) - 1)")
    runs = nodes.groupBy(parent.alias("path")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("path").alias("p"), F.col("digest").alias("d")))),
                    lambda child: child["d"]).alias("children"))
    return stored(runs.select("path", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children"), name)


def prove(manifest: Manifest, requests: DataFrame, name: str = "manifest") -> DataFrame:
    """``requests`` (paths of leaves, with any other columns) with leaf_digest, group_digest and segments: from the leaf up,
    the digests left and right of the way, concatenated. A path that leads nowhere gives no row."""
    columns = requests.columns
    if manifest.depth == 0:  # one leaf, which is the root, or none
        own = F.lit(manifest.root).cast("string")
        return requests.where((F.col("path") == "") & own.isNotNull()).select(
            "*", own.alias("leaf_digest"), own.alias("group_digest"), F.expr(f"cast(array() as array<{SEGMENT}>)")
            .alias("segments"))
    asked = requests.where(F.length("path") > 0).groupBy(F.expr("substring(path, 1, length(path) - 1)").alias("run"))
    asked = stored(asked.agg(F.collect_list(F.struct(*columns)).alias("requests")), f"{name}-requests")
    frontier = requests.sparkSession.createDataFrame(
        [("", manifest.root, manifest.root if manifest.top == 0 else None, [])],
        f"path string, digest string, group_digest string, segments array<{SEGMENT}>")
    passed: DataFrame | None = None
    for level in range(manifest.depth):
        met = stored(frontier.join(manifest.records, "digest").select("path", "children", "group_digest", "segments"),
                     f"{name}-met")
        passed = met if passed is None else passed.unionByName(met)
        if level + 1 == manifest.depth:
            break
        # Only digits that some request follows are opened, so that runs of leaves stay one row here.
        wanted = (asked.where(F.length("run") > level).groupBy(F.substring("run", 1, level).alias("path"))
                  .agg(F.collect_set(F.substring("run", level + 1, 1)).alias("digits")))
        children = _chosen(met.join(wanted, "path").select("*", F.explode("digits").alias("digit")))
        frontier = children.select(
            F.concat("path", "digit").alias("path"), F.col("chosen").alias("digest"),
            (F.col("chosen") if level + 1 == manifest.top else F.col("group_digest")).alias("group_digest"), "segments")
    one = _chosen(asked.join(passed, asked["run"] == passed["path"]).drop("path").select("*", F.explode("requests").alias("r"))
                  .withColumn("digit", F.substring("r.path", -1, 1)))
    return one.select("r.*", F.col("chosen").alias("leaf_digest"), F.coalesce("group_digest", "chosen").alias("group_digest"),
                      F.reverse("segments").alias("segments"))


def _chosen(nodes: DataFrame) -> DataFrame:
    """Nodes with the child that ``digit`` chooses, and the others added to the segments; no row if there is no such child."""
    at, children = F.conv("digit", 16, 10).cast("int"), F.col("children")
    around = F.struct(F.array_join(F.slice(children, 1, at), "").alias("left"),
                      F.array_join(F.slice(children, at + 2, F.lit(FANOUT)), "").alias("right"))
    return (nodes.where(at < F.size("children")).withColumn("chosen", children[at])
            .withColumn("segments", F.array_append("segments", around)))


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and its segments give."""
    return F.aggregate(segments, leaf, lambda below, s: digest(s["left"], below, s["right"]))


def proof_digest(segments: Column) -> Column:
    return F.sha2(F.array_join(F.transform(segments, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest_report(docs: DataFrame, tampered: Column, name: str = "manifest") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    The digest covers doc_id, source, lang, n_chars and text, null or not; where ``tampered`` holds, the fold starts from
    the row with A-Z of its text in lower case. Empty and null texts differ. Rows with a null doc_id come first in their
    source; repeated rows are leaves of their own, next to each other. Further columns are not read; an empty table gives no
    rows. Texts of any length are hashed whole, in one pass.
    """
    def leaf(text: Column) -> Column:
        return digest(*(field(text if c == "text" else F.col(c)) for c in FIELDS))

    rows = stored(docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"),
                              F.when(tampered, leaf(lowered(F.col("text").cast("string")))).alias("changed")), f"{name}-rows")
    manifest = build(rows, "source", ["doc_id"], name)
    proved = prove(manifest, manifest.leaves.select("path", "doc_id", "changed"), name)
    root = F.lit(manifest.root).cast("string")
    return proved.select(
        "doc_id", F.col("leaf_digest").alias("leaf"), F.col("group_digest").alias("subroot"), root.alias("root"),
        proof_digest(F.col("segments")).alias("proof_sha256"),
        fold(F.coalesce("changed", "leaf_digest"), F.col("segments")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
