"""Packing documents into sequences of a fixed token capacity with as few sequences as possible.

Every partition packs its pieces by best-fit decreasing and computes a lower bound of its bin count from dual
feasible functions. A partition that meets its bound is certified: no packing of its documents has fewer bins. Partitions
with gaps exchange the documents of the bins that have them, through ever fewer shares, and run best-fit decreasing
again, with a bound for each share.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import cut

CAPACITY = 2048
#: Bins that one task repacks in an exchange; some 100 000 small rows at most.
BINS_PER_SHARE = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long, share_sequences long, share_bound long, loose boolean"


@functools.cache
def encoder(vocabulary: str):
    """Byte-level BPE over a rank file, with the added tokens of the JSON file of the same vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(public_tokenizers.path(vocabulary.removesuffix(".tiktoken") + ".json"), encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def token_ids(text: str | None, vocabulary: str, end_id: int) -> np.ndarray:
    ids = encoder(vocabulary).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, np.uint32(end_id)).astype("<u4")


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` tokens: whole pieces at the end, the first takes the rest."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """Each document's pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 (and ids).

    A null or empty text has one piece, the end token. The rank file holds the vocabulary of ``byte_bpe_50k.json``
    and gives the same ids three times as fast; an added token's string in a text is that token, as there. Repeated rows and null doc_ids are packed like any other; further
    columns of ``docs`` are not read.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = token_ids(text.as_py(), vocabulary, end_id)
                starts = cut_points(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    row = (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    out.append((*row, ids[a:b].astype(np.int32)) if with_ids else row)
            columns = list(zip(*out, strict=True)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)],
                                             schema=schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each size, and the number of bins: largest first, into the fullest bin with room.

    Bins with equal gaps are interchangeable, so a bit set of the gaps finds the smallest sufficient one.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                mask ^= 1 << gap
        else:
            gap, b, used = capacity, used, used + 1
        bins[i], offsets[i] = b, capacity - gap
        gap -= size
        by_gap[gap].append(b)
        mask |= 1 << gap
    return bins, offsets, used


def lower_bound(count: np.ndarray, capacity: int, k_max: int = 12) -> int:
    """The least number of bins that any packing needs, by dual feasible functions; count[s]: how many have size s.

    For every threshold t up to half the capacity, sizes over capacity - t count as whole bins and those under t as
    nothing; on the result, u_k (k = 1 to ``k_max``) rounds to multiples of 1/k. Work depends on the capacity only.
    """
    size = np.arange(capacity + 1)
    maps = [size / capacity]
    for k in range(1, k_max + 1):
        scaled = size * (k + 1)
        maps.append(np.where(scaled % capacity == 0, size / capacity, (scaled // capacity) / k))
    best = 0.0
    for value in maps:
        below = np.concatenate([[0.0], np.cumsum(value * count)])
        number = np.concatenate([[0.0], np.cumsum(count)])
        t = np.arange(capacity // 2 + 1)
        middle = below[capacity - t + 1] - below[t]
        best = max(best, float((middle + number[-1] - number[capacity - t + 1]).max()))
    return int(np.ceil(best - 1e-6))


def _placed(columns: dict[str, np.ndarray], sizes: np.ndarray, first_id: int, capacity: int,
            old: tuple[np.ndarray, np.ndarray] | None = None) -> pa.RecordBatch:
    """One share packed; ``old`` (ids and offsets) stays where the new packing is no better."""
    bins, offsets, used = best_fit_decreasing(sizes, capacity)
    ids = bins + first_id
    if old is not None:
        kept, inverse = np.unique(old[0], return_inverse=True)
        if len(kept) <= used:
            bins, ids, offsets, used = inverse, old[0], old[1], len(kept)
    free = capacity - np.bincount(bins, weights=sizes, minlength=max(used, 1))
    # Certified shares of an exchange are done, but for bins with much room. Partitions go on with every gap: certified or
    # not, the gaps of many partitions together may hold whole sequences.
    bound = lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
    loose = free >= (max(1, capacity // 32) if old is not None and used <= bound else 1)
    arrays = [pa.array(columns[n]) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
    arrays += [pa.array(ids), pa.array(offsets), *(pa.array(np.full(len(bins), v, np.int64)) for v in (used, bound))]
    arrays += [pa.array(loose[bins] if len(bins) else np.zeros(0, bool))]
    return pa.RecordBatch.from_arrays(arrays, schema=PLACED_ARROW)


PLACED_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                          ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                          ("share_sequences", pa.int64()), ("share_bound", pa.int64()), ("loose", pa.bool_())])


def _pack_partition(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is not None and table.num_rows:
            columns = {n: table[n].combine_chunks() for n in table.column_names}
            yield _placed(columns, columns["length"].to_numpy(), TaskContext.get().partitionId() << 32, capacity)

    return run


def _repack(round_number: int, capacity: int):
    def run(share: pa.Table) -> pa.Table:
        columns = {n: share[n].combine_chunks() for n in share.column_names}
        first = (round_number << 56) | (columns["share"][0].as_py() << 32)
        old = columns["sequence_id"].to_numpy(), columns["offset"].to_numpy()
        return pa.Table.from_batches([_placed(columns, columns["length"].to_numpy(), first, capacity, old)])

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, bins_per_share: int = BINS_PER_SHARE,
                max_rounds: int = 8) -> DataFrame:
    """``pieces`` with sequence_id, offset, share_sequences and share_bound; no sequence holds more than ``capacity`` tokens.

    ``share_bound`` is what any packing of the share (a partition, or a share of an exchange) needs that placed the piece, and
    ``share_sequences`` what it has; the share is certified where they are equal.

    The first packing needs no shuffle: a partition packs what it holds, which leaves most sequences full. In each
    exchange, the loose ones (those with a gap; from a certified share of an exchange, those with a 32nd of the capacity
    free) go as a whole to fewer shares, whose documents are packed anew; a share that gains nothing keeps its sequences.
    It ends with a single share or when nothing is gained. An empty frame gives an empty result.
    """
    placed = cut(pieces.mapInArrow(_pack_partition(capacity), PLACED))
    parts, loose = [placed.where("not loose")], placed.where("loose")
    # The row with offset 0 stands for its bin.
    bins = loose.where("offset = 0").count()
    for number in range(1, max_rounds + 1):
        if bins < 2:
            break
        shares = -(-bins // bins_per_share)
        dealt = loose.withColumn("share", F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(shares)))
        placed = cut(dealt.groupBy("share").applyInArrow(_repack(number, capacity), PLACED))
        after, left = placed.where("offset = 0").agg(F.count("*"), F.count_if("loose")).first()
        if after == bins or shares == 1:
            loose = placed
            break
        parts.append(placed.where("not loose"))
        loose, bins = placed.where("loose"), left
    for part in parts:
        loose = loose.unionByName(part)
    return loose.drop("loose")


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY,
                   end_id: int = 0) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset, share_sequences,
    share_bound.

    Nulls, empty texts, repeated rows and further columns: see :func:`token_pieces`. Texts of any length are packed
    whole.
    """
    return pack_pieces(token_pieces(docs, vocabulary, capacity, end_id), capacity)


def bound_report(placed: DataFrame, capacity: int = CAPACITY) -> dict[str, int]:
    """Sequences used and the lower bound of the whole corpus, from the counts of each length (``capacity`` at most)."""
    counts = placed.groupBy("length").count().collect()
    histogram = np.zeros(capacity + 1)
    for row in counts:
        histogram[row["length"]] = row["count"]
    return {"sequences": placed.where("offset = 0").count(), "bound": lower_bound(histogram, capacity)}


def assemble(placed: DataFrame, docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY,
             end_id: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id, ids in order of the offsets. doc_id must be unique and not null."""
    ids = token_pieces(docs, vocabulary, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids")
    joined = placed.join(ids, ["doc_id", "piece"])
    return (joined.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids")))
