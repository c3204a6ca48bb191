import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import packing
from tests.llm.helpers import clashing, empty, odd


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(placed, texts, tokenizer, capacity=packing.CAPACITY):
    """Every document's tokens come back from its pieces, sequences are gapless and hold no more than they may."""
    expected = []
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        for k, start in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[start:first if k == 0 else start + capacity]
            expected.append((doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)[:5]) for r in placed)
    sequences = {}
    for r in placed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_odd_rows(spark, tokenizer):
    docs = odd(spark)
    placed = packing.pack_documents(clashing(docs)).collect()
    check(placed, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer)


def test_added_tokens_are_matched(spark, tokenizer):
    texts = ["'s<|endoftext|></s>", "<|endoftext|>" * 3, " <|endoftext|> x", "<|endoftext|"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(packing.pack_documents(docs).collect(), list(enumerate(texts)), tokenizer)
    assert packing.token_ids(texts[0], "byte_bpe_50k.tiktoken", 0).tolist()[1] == 50256


def test_empty(spark):
    assert packing.pack_documents(empty(spark)).collect() == []


def test_given_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    placed = packing.pack_documents(docs.repartition(7))
    used = check(placed.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer)
    report = packing.bound_report(placed)
    assert report["sequences"] == used
    assert placed.where("share_sequences < share_bound").count() == 0
    assert used <= report["bound"] + 1


def test_exchange_removes_what_partitions_waste(spark):
    sizes = [(k, 0, 0, size, 0) for k, size in enumerate([1500, 548, 700, 700, 648, 1024] * 40)]
    pieces = spark.createDataFrame(sizes, packing.PIECES).repartition(40)
    placed = packing.pack_pieces(pieces)
    report = packing.bound_report(placed)
    assert placed.count() == len(sizes)
    assert report["sequences"] == report["bound"]


def test_many_small_shares(spark):
    sizes = [(k, 0, 0, 1 + k * 7919 % 2048, 0) for k in range(3000)]
    placed = packing.pack_pieces(spark.createDataFrame(sizes, packing.PIECES).repartition(30), bins_per_share=20)
    totals = placed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in totals) <= 2048
    assert sum(r[1] for r in totals) == sum(s[3] for s in sizes)


@given(st.lists(st.integers(1, 20), max_size=9))
@settings(max_examples=150, deadline=None)
def test_bound_is_below_the_best_packing(sizes):
    def best(items, bins):
        if not items:
            return len(bins)
        least = len(items) + len(bins)
        for k in {b: k for k, b in enumerate(bins) if b >= items[0]}.values():
            least = min(least, best(items[1:], [b - items[0] * (j == k) for j, b in enumerate(bins)]))
        return min(least, best(items[1:], [*bins, 20 - items[0]]))

    optimum = best(sorted(sizes, reverse=True), [])
    bound = packing.lower_bound(np.bincount(sizes, minlength=21) if sizes else np.zeros(21), 20)
    bins, offsets, used = packing.best_fit_decreasing(np.array(sizes, int), 20)
    assert bound <= optimum <= used <= len(sizes)
    for b in range(used):
        spans = sorted((offsets[k], sizes[k]) for k in range(len(sizes)) if bins[k] == b)
        assert spans and all(a + n == c for (a, n), (c, _) in zip(spans, spans[1:]))
        assert spans[0][0] == 0 and sum(spans[-1]) <= 20


def test_bound_sees_more_than_the_sum():
    assert packing.lower_bound(np.bincount([11] * 10, minlength=21), 20) == 10
    assert packing.lower_bound(np.bincount([7] * 9, minlength=21), 20) == 5


@given(st.text(max_size=60) | st.text("ab '\n\t!  <|endoftext|>'s'll9", max_size=60) | st.lists(
    st.sampled_from(["<|endoftext|>", "<|endoftext|", ">", " ", "\n", "'s", "</s>", "é", "word"]), max_size=9).map("".join))
@settings(max_examples=300, deadline=None)
def test_rank_file_gives_the_same_ids(tokenizer, text):
    got = packing.token_ids(text, "byte_bpe_50k.tiktoken", 0).tolist()
    assert got == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_assembled_sequences(spark, tokenizer):
    docs = spark.createDataFrame([(k, f"document number {k} " * (k + 1)) for k in range(30)], "doc_id long, text string")
    placed = packing.pack_documents(docs, capacity=64)
    whole = {r["sequence_id"]: r["ids"] for r in packing.assemble(placed, docs, capacity=64).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in placed.collect():
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0]
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids[r["start"]:r["start"] + r["length"]]
    assert max(map(len, whole.values())) <= 64
