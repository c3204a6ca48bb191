"""Near-duplicate embeddings by a neighbour graph in the way of NN-descent.

Random projections give a first graph: within a bucket of a table, every vector keeps its nearest neighbours. Rounds of
neighbours-of-neighbours joins look for links that the graph does not connect yet, until no list changes. Lists that are
full of links are saturated: a second list holds the nearest neighbours outside the vector's component, and for counting
they are enlarged to the whole component, which is compared block by block. A recall audit against brute force on a fixed
number of vectors decides whether further tables are needed, with lists of twice the length; beyond a number of tables, all
vectors are compared block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import cut
from lakemart.llm.components import connected_components, union

THRESHOLD = 0.9
#: Similarity from which a pair is an edge of the neighbour graph, and edges that a vector keeps in each of its lists.
EXPLORE, NEIGHBOURS = 0.6, 8
#: Up to where saturated lists are enlarged; beyond it there are more tables, and in the end the exact way.
LONGEST = 64
#: Tables made at a time, and vectors that a bucket is meant to hold.
TABLES, BUCKET = 12, 256
#: Vectors that meet in one task: parts of a bucket, and of a component.
PART = 1024
#: Links that one task labels; more are labelled by joins. Two longs each, so a few megabytes.
SMALL = 1 << 17
#: Vectors that the audit compares with all others: 64 dimensions make half a megabyte.
AUDIT = 1024


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one dimension as unit rows of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def grouped(run: Callable[[tuple, pa.Table], pa.RecordBatch], keys: list[str], enough: int = 1 << 14):
    """For ``mapInArrow`` over partitions sorted by ``keys``: ``run`` once for every group."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows >= enough:
                starts = borders(held)
                yield from groups(held.slice(0, starts[-1]), starts[:-1])
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from groups(held, borders(held))

    def borders(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for k in keys:
            values = rows[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    def groups(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        for a, b in zip(starts, [*starts[1:], rows.num_rows], strict=True):
            if b > a and (found := run(rows.slice(a, b - a))) is not None:
                yield found

    return each


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what the symmetric boolean matrix connects; one less than the members of each group."""
    left = np.ones(len(near), bool)
    a, b = [], []
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root] = False
        open_ = [root]
        while open_:
            pivot = open_.pop()
            found = np.flatnonzero(near[pivot] & left)
            left[found] = False
            a += [pivot] * len(found)
            b += found.tolist()
            open_ += found.tolist()
    return np.array(a, int), np.array(b, int)


EDGES = "a long, b long, cosine double"


def _edges(a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(cosine, pa.float64())],
                                      ["a", "b", "cosine"])


def _in_bucket(threshold: float, explore: float, neighbours: int):
    """The nearest neighbours of each vector within a bucket, those that no links of the bucket connect with it, and
    pairs that connect all its links."""
    def run(rows: pa.Table) -> pa.RecordBatch | None:
        if rows.num_rows < 2:
            return None
        node = rows["node"].to_numpy()
        x = matrix(rows["vector"].combine_chunks())
        cosine = x @ x.T
        np.fill_diagonal(cosine, -1)
        if cosine.max() < explore:
            return None
        a, b = forest(cosine >= threshold)
        group = np.arange(len(node))
        for pivot, other in zip(a, b, strict=True):
            group[other] = group[pivot]
        k = min(neighbours, len(node) - 1)
        row = np.repeat(np.arange(len(node)), k)
        found = [(a, b, cosine[a, b])]
        for near in (cosine, np.where(group[:, None] == group[None, :], -1, cosine)):
            best = np.argpartition(-near, k - 1, axis=1)[:, :k].ravel()
            use = near[row, best] >= explore
            found.append((row[use], best[use], near[row, best][use]))
        a, b, value = (np.concatenate(c) for c in zip(*found, strict=True))
        return _edges(node[a], node[b], value)

    return grouped(run, ["key", "part"])


def bucket_edges(nodes: DataFrame, count: int, first_table: int, tables: int, threshold: float, explore: float,
                 neighbours: int) -> DataFrame:
    """Edges from ``tables`` tables of random projections, for ``count`` vectors; buckets larger than a part are compared by
    pairs of parts, so that all vectors of a bucket meet and a task holds two parts at most. With a count of 1 there is one
    bucket, and all vectors meet."""
    bits = 0 if count < 2 else max(1, int(np.ceil(np.log2(max(2, count / BUCKET)))))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((batch.num_rows, tables), np.int64)
            sizes = np.diff(batch["vector"].offsets.to_numpy())
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = matrix(batch["vector"].take(pa.array(at)))
                for t in range(tables):
                    planes = np.random.default_rng([first_table + t, int(size)]).standard_normal((int(size), bits))
                    key = ((x @ planes) > 0) @ (np.int64(1) << np.arange(bits))
                    keys[at, t] = (np.int64(t) << 56) | (np.int64(size) % 65536 << 40) | key
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["vector"], pa.array(list(keys), pa.list_(pa.int64()))], ["node", "vector", "keys"])

    kind = nodes.schema["vector"].dataType.simpleString()
    signed = nodes.select("node", "vector").mapInArrow(sign, f"node long, vector {kind}, keys array<long>")
    keyed = cut(signed).select("node", "vector", F.explode("keys").alias("key"))
    large = cut(keyed.groupBy("key").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
                .where("parts > 1"))
    dealt = (keyed.join(large, "key", "left")
             .withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int")))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: k != F.col("own"))
    tasks = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.transform(others, lambda k: F.least(k, "own") * F.col("parts") + F.greatest(k, "own")))
    dealt = dealt.select("key", F.explode(tasks).alias("part"), "node", "vector")
    return (dealt.repartition("key", "part").sortWithinPartitions("key", "part")
            .mapInArrow(_in_bucket(threshold, explore, neighbours), EDGES))


def keep_nearest(edges: DataFrame, component: DataFrame, neighbours: int) -> DataFrame:
    """Each vector's nearest neighbours over both directions of ``edges``: a list of those in its own component and one
    of those outside, so that a vector of a dense group still leads out of it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    once = both.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    of = component.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    once = once.join(of, "a", "left").join(of.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
    order = Window.partitionBy("a", F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).orderBy(F.desc("cosine"), "b")
    near = once.withColumn("k", F.row_number().over(order)).where(F.col("k") <= neighbours)
    return near.select("a", "b", "cosine")


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch["a"].to_numpy(), batch["b"].to_numpy()
        sizes = np.diff(batch["x"].offsets.to_numpy())
        value = np.zeros(len(a))
        for size in np.unique(sizes):
            at = pa.array(np.flatnonzero(sizes == size))
            value[at.to_numpy()] = (matrix(batch["x"].take(at)) * matrix(batch["y"].take(at))).sum(axis=1)
        yield _edges(a, b, value)


def descend(nodes: DataFrame, lists: DataFrame, component: DataFrame, explore: float) -> DataFrame:
    """New edges between neighbours of neighbours that no links connect yet; at most the square of a list per vector."""
    of = component.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    hop = lists.select(F.col("a").alias("via"), F.col("b").alias("far"))
    pairs = (lists.select("a", F.col("b").alias("via")).join(hop, "via").where("a < far")
             .select("a", F.col("far").alias("b")).distinct().join(lists.select("a", "b"), ["a", "b"], "left_anti"))
    pairs = (pairs.join(of, "a", "left").join(of.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
             .where(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b"))
    size = F.size("x") == F.size("y")
    met = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("vector").alias("x")), "a")
           .join(nodes.select(F.col("node").alias("b"), F.col("vector").alias("y")), "b").where(size))
    return met.select("a", "b", "x", "y").mapInArrow(_cosines, EDGES).where(F.col("cosine") >= explore)


def _counts(threshold: float):
    """For the parts of a component in one task: the rows that each vector links with."""
    def run(rows: pa.Table) -> pa.RecordBatch | None:
        node, copies, part = (rows[n].to_numpy() for n in ("node", "copies", "part"))
        x = matrix(rows["vector"].combine_chunks())
        linked = np.zeros(len(node), np.int64)
        low, high = part.min(), part.max()
        for k in range(0, len(node), PART):
            near = x[k:k + PART] @ x.T >= threshold
            near[np.arange(len(near)), np.arange(k, k + len(near))] = False
            if low != high:
                near &= part[k:k + PART, None] != part[None, :]
            linked[k:k + PART] = near @ copies
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(linked)], ["node", "linked"])

    return grouped(run, ["component", "task"])


def count_links(nodes: DataFrame, component: DataFrame, threshold: float) -> DataFrame:
    """node, linked: rows in the same component at the threshold or over; components larger than a part are compared by
    pairs of parts, so that a task holds two of them at most."""
    member = nodes.join(component, "node")
    parts = cut(component.groupBy("component").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts")))
    dealt = member.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    tasks = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda k: F.least(k, "part") * F.col("parts") + F.greatest(k, "part"))
    dealt = dealt.select("component", F.explode(tasks).alias("task"), "part", "node", "copies", "vector")
    return (dealt.repartition("component", "task").sortWithinPartitions("component", "task")
            .mapInArrow(_counts(threshold), "node long, linked long")
            .groupBy("node").agg(F.sum("linked").alias("linked")))


def label(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) of the given links, which must be written already."""
    if links.count() > SMALL:
        return connected_components(links, a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [(batch[0].to_numpy(), batch[1].to_numpy()) for batch in batches if batch.num_rows]
        if pairs:
            i, j = (np.concatenate(side) for side in zip(*pairs, strict=True))
            node, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            roots = union(np.arange(len(node)), at[:len(i)], at[len(i):])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[roots])], ["node", "component"])

    return links.select(a, b).coalesce(1).mapInArrow(run, "node long, component long")


def relabel(component: DataFrame, links: DataFrame) -> DataFrame:
    """Components after new links: these only join roots, so the graph to label has a node for each component they touch."""
    of = component.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    ends = links.join(of, "a", "left").join(of.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
    ends = cut(ends.select("a", "b", F.coalesce("ca", "a").alias("ra"), F.coalesce("cb", "b").alias("rb")))
    joined = cut(label(cut(ends.select("ra", "rb").where("ra <> rb").distinct()), "ra", "rb")).select(
        F.col("node").alias("root"), F.col("component").alias("now"))
    # Vectors that had no link so far are their own roots.
    alone = ends.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("ra").alias("component")),
                                          F.struct(F.col("b").alias("node"), F.col("rb").alias("component")))).alias("e"))
    every = component.unionByName(alone.select("e.*").where("node = component").distinct()).distinct()
    return every.join(joined, every["component"] == joined["root"], "left").select(
        "node", F.coalesce("now", "component").alias("component"))


def _samples(labelled: DataFrame, sample: int, kinds: list[bool]) -> dict[int, tuple[np.ndarray, ...]]:
    """By dimension: unit vectors, nodes, components and whether they are in a crowd; for each kind (in a crowd or not, or
    not in one) the ``sample`` vectors with the smallest hashes."""
    chosen = {}
    for outside in kinds:
        among = labelled.where("not crowd") if outside else labelled
        chosen |= {r["node"]: r for r in among.orderBy(F.xxhash64("node", F.lit(99)), "node").limit(sample).collect()}
    by_size: dict[int, tuple[np.ndarray, ...]] = {}
    for size in {len(r["vector"]) for r in chosen.values()}:
        rows = [r for r in chosen.values() if len(r["vector"]) == size]
        by_size[size] = (matrix(pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))),
                         *(np.array([r[c] for r in rows]) for c in ("node", "component", "crowd")))
    return by_size


def _audit(labelled: DataFrame, by_size: dict[int, tuple[np.ndarray, ...]],
           threshold: float) -> list[tuple[bool, int, int]]:
    """For the sampled vectors: whether in a crowd, links that the components hold, and all links by brute force.

    The sample goes to every task, where it meets the vectors in blocks: work in proportion to them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch["vector"].offsets.to_numpy())
            for size in np.unique(sizes):
                if int(size) not in by_size:
                    continue
                q, node, own, crowd = by_size[int(size)]
                at = pa.array(np.flatnonzero(sizes == size))
                near = q @ matrix(batch["vector"].take(at)).T >= threshold
                near &= node[:, None] != batch["node"].take(at).to_numpy()[None, :]
                held = near & (own[:, None] == batch["component"].take(at).to_numpy()[None, :])
                some = near.any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(crowd[some]), pa.array(held.sum(axis=1)[some]),
                                                  pa.array(near.sum(axis=1)[some])], ["node", "crowd", "held", "total"])

    found = labelled.mapInArrow(run, "node long, crowd boolean, held long, total long").groupBy("node")
    return [tuple(r)[1:] for r in found.agg(F.first("crowd"), F.sum("held"), F.sum("total")).collect()]


def _labelled(nodes: DataFrame, component: DataFrame, large: int) -> DataFrame:
    """Nodes with their component and whether it has more than ``large`` members, written."""
    crowds = cut(component.groupBy("component").count().where(F.col("count") > large).select(
        "component", F.lit(True).alias("crowd")))
    every = nodes.join(component, "node", "left").select(
        "node", "vector", F.coalesce("component", "node").alias("component"))
    return cut(every.join(crowds, "component", "left").withColumn("crowd", F.coalesce("crowd", F.lit(False))))


def audit_recall(nodes: DataFrame, component: DataFrame, threshold: float, sample: int = AUDIT) -> tuple[int, int]:
    """Links of a fixed number of vectors that the components hold, and all their links by brute force."""
    labelled = _labelled(nodes, component, BUCKET)
    found = _audit(labelled, _samples(labelled, sample, [False]), threshold)
    return sum(held for _, held, _ in found), sum(total for *_, total in found)


def vector_recalls(nodes: DataFrame, component: DataFrame, threshold: float, sample: int = AUDIT,
                   large: int = BUCKET) -> list[float]:
    """The mean share of a vector's links that the components hold: over a sample of all vectors, and over one of those
    outside components of more than ``large`` members. Vectors without links do not count.

    The first sample counts all vectors that either chose, so that one pass serves both.
    """
    labelled = _labelled(nodes, component, large)
    found = _audit(labelled, _samples(labelled, sample, [False, True]), threshold)
    return [float(np.mean([held / total for _, held, total in f])) if f else 1.0
            for f in (found, [x for x in found if not x[0]])]


def usable(vector: Column) -> Column:
    """Vectors that have a direction: not null, all components finite, not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def linked_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                   explore: float = EXPLORE, neighbours: int = NEIGHBOURS, recall: float = 0.995,
                   max_tables: int = 96) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row, by cosine in doubles of ``threshold`` or more.

    Equal vectors are one node of the graph with a number of copies, so copies are never paired. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing; vectors of different lengths never link.
    Repeated ids are rows of their own; a null id is a member without ever being the component_id, unless there is no
    other. ``kept``: the id is the component_id. Other columns are not read; an empty table gives no rows.

    Tables are added, and lists doubled, until the audit finds ``recall`` of a vector's links in the mean, over all vectors
    and over those outside large components; if ``max_tables`` do not reach it, all vectors are compared by pairs of parts,
    which misses nothing. Within a component all links are found, so a link can only be lost between components.
    """
    # Floats are moved as they are, half the size of doubles; cosines are computed in doubles.
    floats = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.col(f"`{vector_col}`").cast("array<float>" if floats else "array<double>")
    base = cut(rows.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"), F.monotonically_increasing_id()
                           .alias("uid")).withColumn("usable", usable(F.col("vector"))))
    nodes = cut(base.where("usable").groupBy("vector").agg(
        F.min("uid").alias("node"), F.count("*").alias("copies"), F.min("id").alias("first_id")))
    count = nodes.count()
    edges, tables = None, 0
    component = rows.sparkSession.createDataFrame([], "node long, component long")
    while count > 1:
        whole = tables >= max_tables  # the exact way: one bucket, whose parts are compared by pairs
        found = cut(bucket_edges(nodes, 1 if whole else count, tables, 1 if whole else TABLES, threshold, explore, neighbours))
        near = cut(found.where(F.col("cosine") >= threshold).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        component = cut(label(near) if edges is None else relabel(component, near))
        if whole:
            break
        tables += TABLES
        edges = cut(keep_nearest(found if edges is None else found.unionByName(edges), component, neighbours))
        while True:
            new = cut(descend(nodes, edges, component, explore))
            more = new.where(F.col("cosine") >= threshold).select("a", "b")
            linked = bool(more.head(1))
            if linked:
                component = cut(relabel(component, more))
            elif not new.head(1):
                break
            before, edges = edges, cut(keep_nearest(edges.unionByName(new), component, neighbours))
            # Lists only get nearer while the components stay, so this ends.
            if not linked and not edges.join(before, ["a", "b"], "left_anti").head(1):
                break
        if min(vector_recalls(nodes, component, threshold)) >= recall:
            break
        neighbours = min(2 * neighbours, LONGEST)  # full lists hid something; others hold no more than they have
    named = cut(nodes.join(component, "node", "left").join(count_links(nodes, component, threshold), "node", "left").select(
        "vector", "first_id", F.coalesce("component", "node").alias("component"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    roots = cut(named.groupBy("component").agg(F.min("first_id").alias("component_id")))
    facts = named.join(roots, "component").select("vector", "component_id", "n_links")
    joined = base.join(facts, base["usable"] & (base["vector"] == facts["vector"]), "left")
    component_id = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept"))
