"""SimHash fingerprints of word shingles, linked by Hamming distance.

Fingerprints of a common band are held bit by bit: one 64-bit word has the same bit of up to 64 fingerprints. A
carry-save counter adds up the differing bits of all 64 at once, and a block is abandoned when every distance in it
has passed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from lakemart.llm.common import cut
from lakemart.llm.components import connected_components, union

BITS, LANES = 64, 64
#: Fingerprints of a band that meet in one task; larger bands go to tasks by pairs of their parts.
BAND_LIMIT = 8192


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The unsigned fingerprint; words are lower-cased (A-Z) runs without ASCII white space, 0 if there are none."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles: Iterator[bytes] = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words)), strict=False))
    n = max(1, len(tokens) - words + 1)
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), np.uint64, n).astype("<u8")
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns and ``fp``, the fingerprint as a signed long, for every row; a null text has fingerprint 0."""
    source = docs.select(*keys, F.col("text").cast("string").alias("text"))
    out = source.select(*keys, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keys), pa.array(fps.view(np.int64))], [*keys, "fp"])

    return source.mapInArrow(run, out)


def equal_blocks(n: int, radius: int) -> int:
    """How many blocks of bits must be equal for a band to hold some 64 of ``n`` random fingerprints at most: 2, 3 or 4.

    More fingerprints take wider bands, and more of them, so the comparisons grow in proportion and not with the square.
    """
    return next((k for k in (2, 3) if n <= LANES << (BITS * k // (radius + k))), 4)


def _bands(radius: int, equal: int = 2) -> list[Column]:
    """A key for every ``equal`` of radius + ``equal`` blocks of bits: within the radius, that many blocks are equal."""
    n = radius + equal
    edges = [k * BITS // n for k in range(n + 1)]
    chosen = list(combinations(range(n), equal))
    keys = []
    for number, blocks in enumerate(chosen):
        # The lowest bits tell the choices apart; they and the blocks fit 64 bits.
        key, at = F.lit(number).cast("long"), (len(chosen) - 1).bit_length()
        for k in blocks:
            width = edges[k + 1] - edges[k]
            block = F.shiftrightunsigned("fp", edges[k]).bitwiseAND(F.lit((1 << width) - 1))
            key, at = key.bitwiseOR(F.shiftleft(block, at)), at + width
        keys.append(key)
    return keys


def near_edges(fps: np.ndarray, starts: np.ndarray, radius: int, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join the fingerprints (unsigned) of each group just as all pairs within the radius do.

    ``starts``: where groups begin. Every query meets blocks of 64 fingerprints of its group; a block whose members
    are all joined with the query already is passed over, so a dense group takes few rounds and gives few pairs.
    """
    n = len(fps)
    sizes = np.diff(np.append(starts, n))
    group = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(n) - starts[group]
    blocks_of = -(-sizes // LANES)
    first_block = np.concatenate([[0], np.cumsum(blocks_of)[:-1]])
    block, lane = first_block[group] + place // LANES, (place % LANES).astype(np.uint64)
    block_start = np.flatnonzero(lane == 0)
    one, full = np.uint64(1), np.uint64(2**64 - 1)
    planes = np.empty((BITS, len(block_start)), np.uint64)
    for k in range(BITS):
        planes[k] = np.bitwise_or.reduceat(((fps >> np.uint64(k)) & one) << lane, block_start)
    valid = np.bitwise_or.reduceat(one << lane, block_start)
    last_block = first_block[group] + blocks_of[group]
    meets = last_block - block
    upto = np.cumsum(meets)
    roots = np.arange(n)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(upto, (upto[row - 1] if row else 0) + step)))
        q = np.repeat(np.arange(row, end), meets[row:end])
        b = block[q] + np.arange(len(q)) - np.repeat(upto[row:end] - meets[row:end] - (upto[row - 1] if row else 0),
                                                     meets[row:end])
        row = end
        least, most = np.minimum.reduceat(roots, block_start), np.maximum.reduceat(roots, block_start)
        alive = valid[b]
        own = b == block[q]
        alive[own] &= (full << lane[q[own]]) << one
        use = (alive != 0) & ~((least[b] == most[b]) & (least[b] == roots[q]))
        q, b, alive = q[use], b[use], alive[use]
        # The counter starts at 7 - radius, so that its fourth bit says that the radius has been passed.
        c1, c2, c4 = (np.full(len(q), full if (7 - radius) >> k & 1 else 0, np.uint64) for k in range(3))
        over = np.zeros(len(q), np.uint64)
        fq = fps[q]
        for k in range(0, BITS, 2):
            d = planes[k, b] ^ (np.uint64(0) - ((fq >> np.uint64(k)) & one))
            e = planes[k + 1, b] ^ (np.uint64(0) - ((fq >> np.uint64(k + 1)) & one))
            both = d ^ e
            carry = (d & e) | (both & c1)
            c1 ^= both
            up = c2 & carry
            c2 ^= carry
            over |= c4 & up
            c4 ^= up
            if k % 8 == 6:
                alive &= ~over
                if not (use := alive != 0).all():
                    q, b, alive, fq, over = q[use], b[use], alive[use], fq[use], over[use]
                    c1, c2, c4 = c1[use], c2[use], c4[use]
                if not len(q):
                    break
        if len(q):
            bits = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            item, bit = np.nonzero(bits)
            roots = union(roots, q[item], block_start[b[item]] + bit)
    child = np.flatnonzero(roots != np.arange(n))
    return child, roots[child]


def _link(radius: int, enough: int = 1 << 16):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([batch[n].to_numpy() for n in ("key", "task", "fp")]))
            if sum(x.shape[1] for x in held) >= enough:
                rows = np.concatenate(held, axis=1)
                # All but the last group are whole.
                whole = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0))
                end = whole[-1] + 1 if len(whole) else 0
                yield edges(rows[:, :end])
                held = [rows[:, end:]]
        if held:
            yield edges(np.concatenate(held, axis=1))

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        a = b = np.zeros(0, np.int64)
        if rows.shape[1]:
            starts = np.concatenate([[0], np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1])
            i, j = near_edges(np.ascontiguousarray(rows[2]).view(np.uint64), starts, radius)
            a, b = rows[2][i], rows[2][j]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def near_links(fps: DataFrame, radius: int = 4, band_limit: int = BAND_LIMIT, equal: int | None = None) -> DataFrame:
    """a, b: pairs of the distinct fingerprints in ``fps`` that join them just as all pairs within the radius do.

    The radius is 0 to 7. Bands are as wide as the number of fingerprints asks for (:func:`equal_blocks`), or are made
    of ``equal`` blocks, 2 to 4; every width finds all pairs. A band of more than ``band_limit`` fingerprints is dealt
    out by pairs of its parts, so no task holds more than two parts and no pair is lost.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the radius must be 0 to 7")
    equal = equal or equal_blocks(fps.count(), radius)
    bands = fps.select("fp", F.explode(F.array(*_bands(radius, equal))).alias("key"))
    crowded = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(band_limit)).cast("int")
    met = bands.join(crowded, "key").withColumn("parts", parts)
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("own"))
    tasks = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.transform(others, lambda x: F.least(x, "own") * F.col("parts") + F.greatest(x, "own") + 1))
    dealt = met.withColumn("own", own).select("key", F.explode(tasks).alias("task"), "fp")
    return (dealt.withColumn("task", F.col("task").cast("long")).repartition("key", "task").sortWithinPartitions("key", "task", "fp")
            .mapInArrow(_link(radius), "a long, b long"))


def near_components(prints: DataFrame, radius: int = 4, id_col: str = "doc_id") -> DataFrame:
    """fp, component, component_id for every distinct fingerprint of ``prints``.

    ``component`` is the smallest fingerprint that links reach and ``component_id`` the smallest id.
    """
    distinct = cut(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    component = connected_components(near_links(distinct, radius))
    linked = cut(distinct.join(component, distinct["fp"] == component["node"], "left")
                 .select("fp", "first_id", F.coalesce("component", "fp").alias("component")))
    roots = cut(linked.groupBy("component").agg(F.min("first_id").alias("component_id")))
    return cut(linked.join(roots, "component").select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Null, empty and white-space texts have fingerprint zero and link like any other; a text with fewer words than a
    shingle is one shingle. Repeated rows appear as often as they come. Null doc_ids are members, but never the
    component_id unless a component has no other. Texts of any length are read whole. Further columns are not read; an
    empty table gives no rows.
    """
    prints = cut(fingerprints(docs, words))
    found = near_components(prints, radius)
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, then the smallest text hash.

    A row without a doc_id stays only if its component has no row with one. Rows with the same doc_id and text are
    one document and leave one row. Columns of any name pass through.
    """
    keys = ["no_id", "id", "text_hash"]
    keyed = docs.select(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"),
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    prints = cut(fingerprints(keyed.select(*keys, "row.doc_id", "row.text"), words, (*keys, "doc_id")))
    found = near_components(prints, radius)
    chosen = cut(prints.join(found, "fp").groupBy("component").agg(F.min(F.struct(*keys)).alias("k")).select("k.*"))
    # Repeats go before the shuffle, where they meet the first of their task; the join needs no further shuffle.
    copies = Window.partitionBy(*keys).orderBy(F.lit(0))
    once = keyed.withColumn("copy", F.row_number().over(copies)).where("copy = 1")
    return once.join(chosen, keys, "left_semi").select("row.*")
