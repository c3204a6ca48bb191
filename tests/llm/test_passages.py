import collections

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.llm import passages
from lakemart.llm.queries import QUERIES
from tests.llm.helpers import SF, clashing, empty, odd
from tests.llm.test_simhash import plain_components

RNG = np.random.default_rng(11)
VOCABULARY = [f"w{k}" for k in range(5000)]


def words(n):
    return " ".join(RNG.choice(VOCABULARY, n))


def grams(line):
    w = line.lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def found_lines(texts, rows):
    """Component by content of a line."""
    return {" ".join(texts[r["doc_id"]][r["start"]:r["stop"]].lower().split()): r["component_id"]
            for r in rows if r["kind"] == "line"}


def plain_lines(texts):
    """Components of the contents of lines over all pairs with a similarity of 0.8 or more, with two lines or more."""
    count = collections.Counter(" ".join(line.lower().split()) for t in texts.values() for line in (t or "").split("\n")
                                if len(line.split()) >= passages.PARAGRAPH_WORDS)
    names = sorted(count)
    sets = [grams(n) for n in names]
    meets = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            meets[g].append(k)
    pairs = {(a, b) for ks in meets.values() for a in ks for b in ks if a < b}
    linked = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = plain_components(linked, range(len(names)))
    members = collections.Counter(root[k] for k, n in enumerate(names) for _ in range(count[n]))
    return {n: root[k] for k, n in enumerate(names) if members[root[k]] > 1}


def same_partition(a, b):
    assert a.keys() == b.keys()
    assert len(set(a.values())) == len(set(b.values())) == len({(a[k], b[k]) for k in a})


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = passages.repeated_passages(docs).collect()
    same_partition(found_lines(texts, rows), plain_lines(texts))
    # Every text that shares a long enough run of words with another is there, and no text without any repeat.
    def sharing(n):
        runs = collections.defaultdict(set)
        for i, t in texts.items():
            w = t.lower().split()
            for k in range(len(w) - n + 1):
                runs[tuple(w[k:k + n])].add((i, k))
        return {i for ks in runs.values() if len(ks) > 1 for i, _ in ks}

    got = {r["doc_id"] for r in rows}
    assert sharing(passages.SURE_WORDS) <= got <= sharing(5)


def test_planted_passages_within_lines(spark):
    shared = [words(51) for _ in range(12)]
    texts = [f"{words(int(RNG.integers(0, 70)))}\n{words(9)} {shared[k % 12].upper()} {words(int(RNG.integers(0, 40)))}"
             for k in range(36)]
    texts += [f"{words(100)}\n{words(50)}" for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = passages.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in rows} == set(range(36))
    for r in rows:
        assert shared[r["doc_id"] % 12].upper().find(texts[r["doc_id"]][r["start"]:r["stop"]]) >= 0 or r["kind"] == "line"
    assert {r["doc_id"] for r in rows if not r["removed"]} <= set(range(12))


def test_near_copies_of_a_paragraph(spark):
    line = words(60).split()
    texts = []
    for k in range(40):
        changed = list(line)
        changed[int(RNG.integers(0, 60))] = f"new{k}"
        texts.append(f"{words(20)}\n{' '.join(changed)}\n{words(20)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limit in (passages.BAND_LIMIT, 4):
        rows = passages.repeated_passages(docs, band_limit=limit).collect()
        same_partition(found_lines(dict(enumerate(texts)), rows), plain_lines(dict(enumerate(texts))))


def test_query_compares_short_lines_and_texts(spark, folder):
    wrapped = [words(12) for _ in range(6)]
    line = words(19)
    texts = [f"{words(15)}\n{line}", f"{words(3)}\n{line} end", *["\n".join(wrapped[:2])] * 2,
             "\n".join([words(14), *wrapped[2:], words(14)]), "\n".join([words(13), *wrapped[2:], words(13)]),
             "two words", "Two  WORDS", "alone", f"{words(11)}\n{words(12)}", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(folder("documents.parquet"))
    rows = QUERIES["op7_paragraph_dedup"](spark, folder()).collect()
    lines = {(r["doc_id"], texts[r["doc_id"]][r["start"]:r["stop"]]) for r in rows if r["kind"] == "line"}
    assert lines == {(0, line), (1, f"{line} end"), *((k, w) for k in (2, 3) for w in wrapped[:2]),
                     *((k, w) for k in (4, 5) for w in wrapped[2:])}
    whole = {(r["doc_id"], r["removed"]) for r in rows if r["kind"] == "text"}
    assert whole == {(2, False), (3, True), (6, False), (7, True)}


def test_equal_texts_meet_at_any_length(spark):
    texts = [t for n in range(20, 50) for t in ["\n".join([words(n // 2), words(n - n // 2)])] * 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = passages.repeated_passages(docs).collect()
    for kind in ("text", "window"):
        assert {r["doc_id"] for r in rows if r["kind"] == kind} == set(range(len(texts)))


def test_odd_rows_and_empty_tables(spark):
    rows = passages.repeated_passages(clashing(odd(spark))).collect()
    assert {r["doc_id"] for r in rows} == {9}
    twice = passages.repeated_passages(clashing(odd(spark)).union(clashing(odd(spark)))).collect()
    assert {r["doc_id"] for r in twice} == {9}
    assert passages.repeated_passages(empty(spark)).collect() == []


def test_repeats_are_cut_out(spark):
    line, a, b = words(30), words(15), words(15)
    docs = spark.createDataFrame([(1, f"{a}\n{line}"), (2, f"{line}\n{b}"), (3, None)], "doc_id long, text string")
    found = passages.repeated_passages(docs).where(F.col("kind") == "line")
    clean = {r["doc_id"]: r["text"] for r in passages.without_repeats(docs, found).collect()}
    assert clean == {1: f"{a}\n{line}", 2: f"\n{b}", 3: None}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9])
def test_bands_reach_the_recall(threshold):
    bands = passages.band_count(threshold)
    assert 1 - (1 - threshold**2) ** bands >= 0.999 > 1 - (1 - threshold**2) ** (bands - 1) - 1e-12


@given(st.lists(st.frozensets(st.integers(0, 9), min_size=1), max_size=14), st.sampled_from([0.3, 0.6, 0.8]))
@settings(max_examples=200, deadline=None)
def test_links_join_what_all_pairs_join(sets, threshold):
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)
             if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9]
    got = list(passages.similar_links(sets, threshold))
    assert plain_components(got, range(len(sets))) == plain_components(pairs, range(len(sets)))


@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(2, 9))
@settings(max_examples=100, deadline=None)
def test_every_stretch_has_an_anchor(values, choice):
    places = passages.anchors(np.array(values, np.uint64), choice)
    for k in range(len(values) - choice + 1):
        assert any(k <= p < k + choice for p in places)
