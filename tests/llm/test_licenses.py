"""License scans against plain counting of shared words."""

import random
import re

import pytest

from lakemart.llm import licenses
from tests.llm.helpers import clashing, empty, odd

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, templates, percent):
    """(template, first word) -> containment for every block of the text."""
    words, out = plain_words(text), {}
    for number, (_, wording) in enumerate(templates):
        own = plain_words(wording)
        stride = 1
        while stride < len(own):
            stride *= 2
        for start in range(0, max(1, len(words)), stride):
            shared = len(set(words[start:start + 2 * stride]) & set(own))
            if 100 * shared >= percent * len(set(own)):
                out[number, start] = shared / len(set(own))
    return out


def made_up_texts(seed, count):
    rng = random.Random(seed)
    known = plain_words(" ".join(t for _, t in licenses.TEMPLATES))
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(4)):
            words += [rng.choice(["foo", "bar", "the", "é", *known]) for _ in range(rng.randrange(30))]
            notice = plain_words(rng.choice(licenses.TEMPLATES)[1])
            words += [w for w in notice if rng.random() > rng.choice([0, 0.1, 0.25])]
        if rng.random() < 0.3:
            rng.shuffle(words)
        yield "".join(w.title() + rng.choice([" ", "-", "\n", ". "]) for w in words)


@pytest.mark.parametrize("percent", [80, 55, 100])
def test_every_block_is_found(spark, percent):
    texts = list(made_up_texts(percent, 150))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["template"], r["first_word"]): r["containment"]
           for r in licenses.license_blocks(docs, containment=percent).collect()}
    expected = {(k, *at): value for k, text in enumerate(texts)
                for at, value in plain(text, licenses.TEMPLATES, percent).items()}
    assert got == expected and len(got) > 50


def test_places_of_phrases(spark):
    texts = ["The MIT License, the mit-license; MIT  LICENSE", "mit licenses, permit license", "GNU General\nPublic License",
             "gnu general license", "CC-BY-NC cc by", "Apache\tLicense", "mit é license", "KMIT license", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:6] for r in sorted(licenses.license_report(docs).collect())]
    assert got == [(8, 3, 1, 6, "mit"), (4, 0, None, None, ""), (4, 1, 0, 0, "gpl"), (3, 0, None, None, ""),
                   (5, 2, 0, 3, "cc-by"), (2, 1, 0, 0, "apache"), (3, 0, None, None, ""), (2, 0, None, None, ""),
                   (0, 0, None, None, "")]


def test_words_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("aBz09é😀 -\n\x00") for _ in range(rng.randrange(60)))
        for size in (1, 3, 1000):
            monkeypatch.setattr(licenses, "CHUNK", size)
            assert [w for chunk in licenses.words_of(text) for w in chunk] == plain_words(text)


def test_labels_and_score(spark):
    notice = licenses.TEMPLATES[1][1]
    docs = spark.createDataFrame([(1, "x " * 500 + notice + " y" * 500), (2, "some words"), (3, "MIT license. " + notice)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.license_report(docs).collect()}
    assert (got[1]["labels"], got[1]["base_labels"], got[1]["score"]) == ("mit", "", 1.0)
    assert (got[2]["labels"], got[2]["score"]) == ("", 0.0)
    assert (got[3]["labels"], got[3]["base_labels"], got[3]["first_word"]) == ("mit", "mit", 0)


def test_any_input(spark):
    docs = odd(spark)
    rows = licenses.license_report(clashing(docs)).collect()
    assert len(rows) == docs.count() and all(r["n_base"] == 0 and r["labels"] == "" and r["score"] == 0 for r in rows)
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in rows) == sorted(
        (r["doc_id"] or 0, len(plain_words(r["text"]))) for r in docs.collect())
    assert licenses.license_report(empty(spark)).collect() == []
    assert licenses.license_blocks(empty(spark)).collect() == []
