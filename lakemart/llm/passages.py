"""Repeated passages: near-equal paragraphs by MinHash bands, and equal runs of words wherever they stand.

Paragraphs are lines. Their signatures are banded, lines that meet in a band are compared by exact Jaccard similarity of
their word shingles, and linked ones form components of which one member stays. Whole texts are compared for equality,
so copies of any length meet. As a passage may also begin or end within a line, word windows that start at
content-chosen places are compared for equality; any run of SURE_WORDS words that two texts share holds at least one
such window in common.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from lakemart.llm.common import cut, stored
from lakemart.llm.components import connected_components

SHINGLE, THRESHOLD = 5, 0.8
#: Words of the shortest line and text that are compared if a call names no others; the registered query takes all.
PARAGRAPH_WORDS = 20
#: Words of a window, and shingles among which the smallest hash chooses where one starts.
WINDOW_WORDS, CHOICE = 20, 30
SURE_WORDS = WINDOW_WORDS + CHOICE - 1
#: Rows of a band, and paragraphs of a band that meet in one task; larger bands go to tasks by pairs of their parts.
BAND_ROWS, BAND_LIMIT = 2, 2048
LINE, WINDOW, TEXT = 0, 1, 2

SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: Odd factors of the running hashes, with their inverses modulo 2^64.
FACTORS = tuple((f, pow(f, -1, 2**64)) for f in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))


def band_count(threshold: float = THRESHOLD, rows: int = BAND_ROWS, recall: float = 0.999) -> int:
    """The fewest bands in which a pair at the threshold meets with the given probability."""
    bands = 1
    while 1 - (1 - threshold**rows) ** bands < recall:
        bands += 1
    return bands


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))])


class Runs:
    """Hashes of any run of words from running sums."""

    def __init__(self, hashes: np.ndarray):
        size = 1 << max(12, int(len(hashes)).bit_length())
        self.sums, self.back = [], []
        for factor, inverse in FACTORS:
            self.sums.append(np.concatenate([np.zeros(1, np.uint64),
                                             np.cumsum(hashes * _powers(factor, size)[:len(hashes)])]))
            self.back.append(_powers(inverse, size))

    def __call__(self, start: np.ndarray, stop: np.ndarray, k: int = 0) -> np.ndarray:
        return mix((self.sums[k][stop] - self.sums[k][start]) * self.back[k][start] + (stop - start).astype(np.uint64))


def anchors(grams: np.ndarray, choice: int = CHOICE) -> np.ndarray:
    """Places of the smallest hash of every ``choice`` neighbours (winnowing); of all, if there are fewer."""
    if len(grams) <= choice:
        return np.array([grams.argmin()]) if len(grams) else np.zeros(0, int)
    found = []
    for k in range(0, len(grams) - choice + 1, 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(grams[k:k + (1 << 16) + choice - 1], choice)
        found.append(np.unique(view.argmin(axis=1) + np.arange(k, k + len(view))))
    return np.unique(np.concatenate(found))


def band_keys(grams: np.ndarray, start: np.ndarray, stop: np.ndarray, bands: int) -> np.ndarray:
    """MinHash keys of stretches of shingle hashes, a row per stretch and a column per band.

    The hashes are well mixed, so an exclusive or and an odd factor give another order each time.
    """
    if not len(start):
        return np.zeros((0, bands), np.uint64)
    edges = np.stack([start, stop], axis=1).ravel()
    edges = edges[:-1] if edges[-1] >= len(grams) else edges
    number = np.arange(1, bands * BAND_ROWS + 1, dtype=np.uint64)
    seed, factor = mix(number), mix(~number) | np.uint64(1)
    step = max(1, (1 << 20) // len(grams))
    least = np.concatenate([
        np.minimum.reduceat((grams ^ seed[k:k + step, None]) * factor[k:k + step, None], edges, axis=1)[:, ::2]
        for k in range(0, len(number), step)])
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64)[:, None], (bands, len(start)))
    for row in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[row::BAND_ROWS])
    return np.ascontiguousarray(key.T)


def units(text: str, bands: int, shortest: int) -> tuple[np.ndarray, ...] | None:
    """kind, start, stop (code points), words, two content hashes and band keys of a text's lines and windows and of
    the text itself."""
    data = text.encode().lower()
    words = data.split()
    n = len(words)
    if n < max(1, shortest):
        return None
    raw = np.frombuffer(data, np.uint8)
    space = SPACE[raw]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(~space & np.concatenate([space[1:], [True]]))
    if len(data) == len(text):
        begin, end = first, last + 1
    else:
        points = np.cumsum((raw & 0xC0) != 0x80)
        begin, end = points[first] - 1, points[last]
    run = Runs(np.fromiter(map(xxh64_intdigest, words), np.uint64, n))
    place = np.arange(max(0, n - SHINGLE + 1))
    grams = run(place, place + SHINGLE)

    line = np.cumsum(raw == 10)[first]
    start = np.concatenate([[0], np.flatnonzero(line[1:] != line[:-1]) + 1])
    stop = np.append(start[1:], n)
    long = stop - start >= max(SHINGLE, shortest)
    start, stop = start[long], stop[long]
    keys = band_keys(grams, start, stop - SHINGLE + 1, bands)

    # A window that would leave the text is moved back to its last words.
    at = np.unique(np.minimum(anchors(grams), n - WINDOW_WORDS)) if n >= WINDOW_WORDS else place[:0]
    start, stop = np.concatenate([start, at, [0]]), np.concatenate([stop, at + WINDOW_WORDS, [n]])
    kind = np.repeat([LINE, WINDOW, TEXT], [len(keys), len(at), 1])
    return kind, begin[start], end[stop - 1], stop - start, run(start, stop), run(start, stop, 1), keys


UNITS = "doc_id long, text_hash long, kind int, start long, stop long, words long, c1 long, c2 int, bands array<long>"


def text_units(docs: DataFrame, bands: int, shortest: int) -> DataFrame:
    """All lines and windows of all texts and the texts, with a number ``uid``; written once to the shared folder."""
    names = ("kind", "start", "stop", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = ((k, units(t.as_py() or "", bands, shortest)) for k, t in enumerate(batch["text"]))
            found = [(k, u) for k, u in every if u is not None]
            if not found:
                continue
            row = pa.array(np.concatenate([np.full(len(u[0]), k) for k, u in found]))
            column = [np.concatenate([u[k] for _, u in found]) for k in range(len(names) + 2)]
            sizes = np.where(column[0] == LINE, bands, 0)
            flat = np.concatenate([u[6].ravel() for _, u in found])
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].take(row), batch["text_hash"].take(row), pa.array(column[0].astype(np.int32)),
                *(pa.array(c.astype(np.int64)) for c in column[1:4]), pa.array(column[4].view(np.int64)),
                pa.array((column[5] >> np.uint64(33)).astype(np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))],
                ["doc_id", "text_hash", *names, "c1", "c2", "bands"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    return stored(source.mapInArrow(run, UNITS).withColumn("uid", F.monotonically_increasing_id()), "passage-units")


def shingles(text: str) -> frozenset[bytes]:
    words = text.encode().lower().split()
    return frozenset(b" ".join(words[k:k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1)))


def similar_links(sets: list[frozenset], threshold: float) -> Iterator[tuple[int, int]]:
    """Pairs that join the sets just as all pairs with a Jaccard similarity of the threshold or more do.

    Each found set is compared with those not found yet, so a group of near copies costs few rounds.
    """
    left = list(range(len(sets)))
    found: list[int] = []
    while left or found:
        pivot = found.pop() if found else left.pop()
        a, rest = sets[pivot], []
        for k in left:
            b = sets[k]
            if min(len(a), len(b)) >= threshold * max(len(a), len(b)):
                both = len(a & b)
                if both >= threshold * (len(a) + len(b) - both) - 1e-9:
                    found.append(k)
                    yield pivot, k
                    continue
            rest.append(k)
        left = rest


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for key, task, node, text in zip(*(batch[n].to_pylist() for n in ("key", "task", "node", "text")),
                                             strict=True):
                if (key, task) != group:
                    pairs += links(held)
                    group, held = (key, task), []
                held.append((node, shingles(text)))
            yield edges(pairs)
        yield edges(links(held))

    def links(held: list[tuple[int, frozenset]]) -> list[tuple[int, int]]:
        return [(held[i][0], held[j][0]) for i, j in similar_links([s for _, s in held], threshold)]

    def edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _near_lines(docs: DataFrame, lines: DataFrame, threshold: float, band_limit: int) -> DataFrame:
    """c1, c2, component for the contents of lines that are linked with other contents."""
    key = F.explode("bands").alias("key")
    crowded = stored(lines.select("c1", key).groupBy("key").agg(F.min("c1").alias("low"), F.max("c1").alias("high"))
                     .where("low != high").select("key"), "passage-bands")
    met = lines.select("uid", key).join(crowded, "key").groupBy("uid").agg(F.collect_list("key").alias("keys"))
    # One place for each content; its copies have the same keys.
    contents = cut(lines.drop("bands").join(met, "uid").groupBy("c1", "c2").agg(
        F.min("uid").alias("node"), F.min(F.struct("text_hash", "start", "stop")).alias("at"),
        F.first("keys").alias("keys")))
    texts = docs.select(F.col("text").cast("string").alias("text"))
    texts = texts.select("text", F.xxhash64("text").alias("text_hash"))
    copies = Window.partitionBy("text_hash").orderBy(F.lit(0))
    once = texts.withColumn("copy", F.row_number().over(copies)).where("copy = 1")
    wanted = contents.select("node", "keys", "at.*").groupBy("text_hash").agg(
        F.collect_list(F.struct("node", "keys", "start", "stop")).alias("lines"))
    fetched = cut(once.join(wanted, "text_hash").select("text", F.explode("lines").alias("l")).select(
        "l.node", "l.keys", F.expr("substring(text, int(l.start) + 1, int(l.stop - l.start))").alias("text")))
    keyed = fetched.select("node", "text", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / F.lit(band_limit)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("own"))
    tasks = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.transform(others, lambda x: F.least(x, "own") * F.col("parts") + F.greatest(x, "own") + 1))
    dealt = (keyed.join(cut(sizes), "key").withColumn("own", own)
             .select("key", F.explode(tasks).alias("task"), "node", "text"))
    edges = (dealt.repartition("key", "task").sortWithinPartitions("key", "task", "node")
             .mapInArrow(_verify(threshold), "a long, b long"))
    component = connected_components(edges)
    return contents.join(component, "node").select("c1", "c2", "component")


def repeated_passages(docs: DataFrame, threshold: float = THRESHOLD, recall: float = 0.999,
                      band_limit: int = BAND_LIMIT, shortest: int = PARAGRAPH_WORDS) -> DataFrame:
    """One row per repeated unit: doc_id, kind, start, stop, words, component_id, removed.

    ``kind``: "line" (of ``shortest`` words or more and one shingle at least, in a component of lines with a Jaccard
    similarity of ``threshold`` or more of their 5-word shingles), "window" (of WINDOW_WORDS words, equal to another
    one) or "text" (a whole text of ``shortest`` words or more, equal to another one). Places are code
    points; case of A-Z and the kind of white space do not count. Of each component, the unit with the smallest doc_id,
    then place, stays and the others are to be removed. Two texts that share SURE_WORDS words in a row always show at
    least one common window, and equal texts always meet as texts.

    Null and empty texts and those of fewer than ``shortest`` words have no units; 1 leaves no text out.
    Repeated rows and repeats within one text count as repeats. Texts are read whole; columns other than doc_id and text are not read; an empty table gives no rows.
    """
    all_units = text_units(docs, band_count(threshold, BAND_ROWS, recall), shortest)
    lines = all_units.where(F.col("kind") == LINE)
    linked = stored(_near_lines(docs, lines, threshold, band_limit), "passage-links")
    repeated = (all_units.groupBy("kind", "c1", "c2").agg(F.count("*").alias("n"), F.min("uid").alias("node"))
                .where("n > 1"))
    both = (repeated.select("kind", "c1", "c2", "node", F.lit(None).cast("long").alias("component"))
            .unionByName(linked.select(F.lit(LINE).alias("kind"), "c1", "c2", F.lit(None).cast("long").alias("node"),
                                       "component")))
    wanted = stored(both.groupBy("kind", "c1", "c2").agg(
        F.coalesce(F.max("component"), F.max("node")).alias("component_id")), "passage-contents")
    members = cut(all_units.drop("bands", "text_hash").join(wanted, ["kind", "c1", "c2"]).drop("c1", "c2"))
    first = cut(members.groupBy("component_id", "kind").agg(
        F.min_by("uid", F.struct(F.col("doc_id").isNull(), "doc_id", "start", "uid")).alias("first")))
    kind = F.element_at(F.array(*map(F.lit, ("line", "window", "text"))), F.col("kind") + 1)
    return members.join(first, ["component_id", "kind"]).select(
        "doc_id", kind.alias("kind"), "start", "stop", "words", "component_id", (F.col("uid") != F.col("first")).alias("removed"))


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the removed units of :func:`repeated_passages` cut out; doc_id must be unique and not null."""
    spans = (found.where("removed").groupBy("doc_id")
             .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans")))
    kept = F.expr("""aggregate(spans, named_struct('pos', 0L, 'out', cast(array() as array<string>)),
        (a, s) -> named_struct('pos', greatest(a.pos, s.stop), 'out', if(s.start > a.pos,
            array_append(a.out, substring(text, int(a.pos) + 1, int(s.start - a.pos))), a.out)),
        a -> concat(array_join(a.out, ''), substring(text, int(a.pos) + 1)))""")
    return (docs.join(spans, "doc_id", "left")
            .withColumn("text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept)).drop("spans"))
