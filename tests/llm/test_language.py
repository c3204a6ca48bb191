import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import language
from tests.llm.helpers import clashing, empty, odd


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.language_report(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es"} for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in tested) >= 0.98 * len(tested)


def test_texts_without_letters_are_undetermined(spark):
    train = [(k, "der die und das ist nicht " * 3 if k % 2 else "the and of that was with " * 3, "de" if k % 2 else "en")
             for k in range(40)]
    docs = spark.createDataFrame([*train, (100, None, "en"), (101, "", "de"), (102, "123 + 4 😀\n", "en"),
                                  (103, "Und Das IST", None)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in language.language_report(clashing(docs)).collect()}
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (100, 101, 102))
    assert found[103]["lang_pred"] == "de"


def test_other_columns_are_no_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs)
    swapped = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'y' AS source")
    assert sorted(language.identify(docs, model).collect()) == sorted(language.identify(swapped, model).collect())


def test_odd_rows_and_empty_tables(spark):
    rows = language.language_report(clashing(odd(spark))).collect()
    assert len(rows) == odd(spark).count()
    assert language.language_report(empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language.language_report(unlabelled).first()["lang_pred"] == "und"
    single = spark.createDataFrame([(k, "some words", "en") for k in range(9)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.language_report(single).collect()} == {"en"}


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(None if k % 2 else k, f"text number {k}", "ab"[k % 2]) for k in range(400)],
                                 "doc_id long, text string, lang string")
    taken = []
    train = language.train
    language.train = lambda x, languages, **kw: taken.append(languages) or train(x, languages, **kw)
    try:
        language.fit(docs, sample_texts=20)
    finally:
        language.train = train
    assert len(taken[0]) <= 20 and set(taken[0]) == {"a", "b"}


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 12, 40])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
    assert min(apart) >= (1 if n == 2 else 2)
    assert all(len(set(column)) == 2 for column in code.T)


def test_decoding_survives_a_wrong_bit():
    code = language.codewords(4)
    weights = np.zeros((language.BUCKETS + 1, code.shape[1]))
    weights[-1] = 3 * code[2]
    weights[-1, 0] *= -0.3
    name, score, ambiguous = language.LanguageModel(list("abcd"), code, weights).predict("x")
    assert name == "c" and score > 0.5 and not ambiguous
    assert language.LanguageModel(list("abcd"), code, 0 * weights).predict("x")[2]


@given(st.text(max_size=40))
@settings(max_examples=100, deadline=None)
def test_features_are_of_unit_length(text):
    assert np.linalg.norm(language.features(text)) <= 1 + 1e-5


def test_long_texts_go_in_steps(monkeypatch):
    text = "ein langer text mit vielen wörtern " * 50
    whole = language.features(text)
    monkeypatch.setattr(language, "STEP", 64)
    assert np.allclose(language.features(text), whole, atol=1e-6)
