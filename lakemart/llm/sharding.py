"""Resharding that moves the fewest bytes: a minimum-cost flow from old shard sizes to new capacities."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import cut, stored
from lakemart.session import scratch_path

#: A size class of so many rows or fewer is dealt row by row, a larger one in blocks.
FEW_ROWS = 1024

Flow = dict[tuple[int, int], int]
#: old shard, size class, and the first byte and new shard of every block that it is cut into.
Cuts = tuple[int, int, list[tuple[int, int]]]
CUTS = "old_shard int, tier int, blocks array<struct<at: long, shard: int>>"


def min_cost_flow(supply: Mapping[int, int], capacity: Mapping[int, int],
                  cost: Callable[[int, int], int] = lambda old, new: int(old != new)) -> Flow:
    """Units sent from each old to each new shard at the least total cost; a byte that stays costs nothing.

    Successive shortest paths over the shards alone: the work depends on their number, not on the data. Capacities
    must add up to the supplies or more.
    """
    if sum(capacity.values()) < sum(supply.values()):
        raise ValueError("the capacities are less than the sizes")
    price = {(i, j): cost(i, j) for i in supply for j in capacity}
    flow: Flow = dict.fromkeys(price, 0)
    left, room = dict(supply), dict(capacity)
    while any(left.values()):
        # Bellman-Ford from all old shards with something left, over the arcs that can still change.
        far = {("old", i): (0 if left[i] else None) for i in supply} | {("new", j): None for j in capacity}
        came: dict = {}
        changed = True
        while changed:
            changed = False
            for (i, j), c in price.items():
                a, b = ("old", i), ("new", j)
                if far[a] is not None and (far[b] is None or far[a] + c < far[b]):
                    far[b], came[b], changed = far[a] + c, a, True
                if flow[i, j] and far[b] is not None and (far[a] is None or far[b] - c < far[a]):
                    far[a], came[a], changed = far[b] - c, b, True
        end = min((n for n in far if n[0] == "new" and room[n[1]] and far[n] is not None), key=lambda n: (far[n], n[1]))
        path = [end]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        steps = list(zip(path, path[1:], strict=False))
        amount = min([left[path[0][1]], room[end[1]], *(flow[b[1], a[1]] for a, b in steps if a[0] == "new")])
        for a, b in steps:
            if a[0] == "old":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        left[path[0][1]] -= amount
        room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def even_capacities(total: int, shards: int) -> dict[int, int]:
    return {j: total // shards + (j < total % shards) for j in range(shards)}


def _blocks(flow: Flow, left: Mapping[int, int], sums: Mapping[int, int], tier: int) -> list[Cuts]:
    """How the rows of one size class are cut: every old shard in the proportions of its flow, what stays first."""
    cuts: list[Cuts] = []
    for i in sorted(sums):
        at, blocks = 0, []
        for j in sorted((j for o, j in flow if o == i), key=lambda j: (j != i, j)):
            blocks.append((at * sums[i] // left[i], j))
            at += flow[i, j]
        cuts.append((i, tier, blocks))
    return cuts


def _placed(rows: DataFrame, cuts: Iterable[Cuts]) -> DataFrame:
    """The rows with the shard of the block that their middle byte lies in; a cut table has a row per old shard and
    size class, so it is small whatever the data."""
    table = F.broadcast(rows.sparkSession.createDataFrame(list(cuts), CUTS))
    block = F.element_at(F.filter("blocks", lambda b: b["at"] <= F.col("middle")), -1)
    return rows.join(table, ["old_shard", "tier"]).withColumn("shard", block["shard"]).drop("blocks")


def _singles(rows: Iterable[tuple[int, int, int]], left: Mapping[int, int], room: Mapping[int, int], tier: int
             ) -> list[Cuts]:
    """A block for each row (old shard, first byte, size), largest first: it stays where there is room for it, else it
    goes where most room is left beside the rows that are there and yet to be placed."""
    need = {j: r - left.get(j, 0) for j, r in room.items()}
    room, blocks = dict(room), {}
    for i, at, size in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        j = i if room.get(i, 0) >= size else min(need, key=lambda k: (-need[k], k))
        if i in need:
            need[i] += size
        room[j] -= size
        need[j] -= size
        blocks.setdefault(i, []).append((at, j))
    return [(i, tier, sorted(some)) for i, some in sorted(blocks.items())]


def _all_cuts(rows: DataFrame, classes: Mapping[tuple[int, int], tuple[int, int]], capacity: Mapping[int, int]
              ) -> list[Cuts]:
    """Cuts of every size class, largest rows first; each class makes good what whole rows left over before it.

    ``classes``: bytes and number of rows by old shard and class.
    """
    left: dict[int, int] = {}
    for (i, _), (size, _) in classes.items():
        left[i] = left.get(i, 0) + size
    room, cuts = dict(capacity), []
    for tier in sorted({t for _, t in classes}, reverse=True):
        here = {i: size for (i, t), (size, _) in classes.items() if t == tier}
        members = rows.where(F.col("tier") == tier)
        if sum(n for (_, t), (_, n) in classes.items() if t == tier) <= FEW_ROWS:
            start = F.col("middle") - F.floor(F.col("size") / 2)
            new = _singles([tuple(r) for r in members.select("old_shard", start, "size").collect()], left, room, tier)
        else:
            new = _blocks(min_cost_flow(left, {j: max(0, r) for j, r in room.items()}), left, here, tier)
        if any(len({j for _, j in blocks}) > 1 for _, _, blocks in new):
            got = _placed(members, new).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
            taken = [(r["shard"], r["bytes"]) for r in got]
        else:
            taken = [(blocks[0][1], here[i]) for i, _, blocks in new]
        cuts += new
        for j, size in taken:
            room[j] -= size
        for i, size in here.items():
            left[i] -= size
    return cuts


def reshard(docs: DataFrame, old_shard: Column, shards: int = 16, capacity: Mapping[int, int] | None = None,
            keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """doc_id, the other ``keys``, size, text_crc32, old_shard, shard, slot for every row of ``docs``.

    size: the text's bytes in UTF-8 and one (null text: none and one). A minimum-cost flow says how many bytes go from
    each old shard to each new one. Rows fall into classes by the doubling of their size. From the class of the largest
    rows to that of the smallest, blocks in the proportions of the flow are cut from the rows in the order they are
    stored in, a row goes where its middle byte lies, and the flow is solved anew for what is left of the old shards
    and of the capacities. So the small rows make good what the large ones left over: in the end the sizes are off
    their capacities (even ones by default) by a few of the smallest rows, where there are enough of them, and all moves
    are in the cost of a flow. A class of ``FEW_ROWS`` rows at most is dealt row by row: what has room in its shard stays,
    others go where most is left beside the rows that stay. Capacities must add up to the sizes or more. Slots count
    each shard's rows from 0. No key may be named like one of the columns returned.

    ``old_shard`` is a whole number not below 0; null counts as 0. Running sums go over the partitions the rows were
    read in and then within them, so no task sees a whole shard, however many rows it has. The flows take one number for
    each old shard and class. Equal or repeated rows are rows like any other, and so are very long texts, the first to
    be placed; an empty table gives no rows; other columns are not read.
    """
    keys = list(dict.fromkeys(["doc_id", *keys]))
    text = F.col("text").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    uid = F.monotonically_increasing_id()
    base = cut(docs.select(
        *keys, size.alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard"), F.length(F.bin(size)).alias("tier"),
        uid.alias("uid"), F.shiftright(uid, 33).alias("part")))
    group = ["old_shard", "tier", "part"]
    parts = base.groupBy(*group).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    upto = F.sum("bytes").over(Window.partitionBy("old_shard", "tier").orderBy("part"))
    starts = stored(parts.select(*group, (upto - F.col("bytes")).alias("start"), "bytes", "n"), "shard-starts")
    classes = {(r["old_shard"], r["tier"]): (r["bytes"], r["n"]) for r in starts.groupBy("old_shard", "tier")
               .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).orderBy("old_shard", "tier").collect()}
    if not classes:
        return base.select(*keys, "size", "text_crc32", "old_shard", F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    capacity = dict(capacity or even_capacities(sum(size for size, _ in classes.values()), shards))
    inside = F.sum("size").over(Window.partitionBy(*group).orderBy("uid"))
    laid = (base.join(starts.drop("bytes", "n"), group)
            .withColumn("middle", F.col("start") + inside - F.col("size") + F.floor(F.col("size") / 2)).drop("start"))
    # By class, so that a class is read alone.
    path = scratch_path(docs.sparkSession, "shard-rows")
    laid.write.partitionBy("tier").parquet(path)
    rows = docs.sparkSession.read.schema(laid.schema).parquet(path)
    placed = stored(_placed(rows, _all_cuts(rows, classes, capacity)).drop("middle", "tier"), "shard-placed")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("part")) - F.col("rows")
    first = stored(counts.select("shard", "part", before.alias("first")), "shard-slots")
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("uid")) - 1
    return stored(placed.join(first, ["shard", "part"]).select(
        *keys, "size", "text_crc32", "old_shard", "shard", (F.col("first") + own).cast("long").alias("slot")), "resharded")


def rewrite_affected(docs: DataFrame, placed: DataFrame, path: str, keys: Sequence[str] = ("doc_id",)) -> list[int]:
    """Write the new shards whose rows differ from before to ``path``/shard=<n> and return their numbers.

    The files of the other shards can stay where they are. The files have the columns of ``docs`` and slot; columns of
    ``docs`` called shard or slot give way. ``keys``, null or not, must tell the rows apart and come out the same when
    ``docs`` is read again, as the file and row number of a Parquet file do. The texts are shuffled once, by key;
    a task then writes a file for each shard it has rows of.
    """
    changed = placed.where("old_shard != shard")
    touched = sorted({n for r in changed.select("old_shard", "shard").distinct().collect() for n in r})
    gone = set(touched) - {r["shard"] for r in placed.select("shard").distinct().collect()}
    named = [(k, f"key {n}") for n, k in enumerate(keys)]
    to = placed.where(F.col("shard").isin(touched)).select(*(F.col(k).alias(name) for k, name in named), "shard", "slot")
    source = docs.drop("shard", "slot")
    rows = source.join(to, reduce(and_, (source[k].eqNullSafe(to[name]) for k, name in named)))
    rows.drop(*(name for _, name in named)).write.partitionBy("shard").parquet(path)
    return [n for n in touched if n not in gone]
