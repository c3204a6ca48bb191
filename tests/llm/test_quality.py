import collections
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import quality
from tests.llm.helpers import SF, clashing, empty, odd


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


@given(st.text(st.sampled_from("ab é　\n\t\x1c#!|"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts(text):
    assert quality.measure(text)[:5] == plain(text)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in quality.quality_report(docs).collect()}
    for r in docs.collect():
        got = rows[r["doc_id"]]
        n, *_, repeats = counts = plain(r["text"])
        assert tuple(got[c] for c in quality.COUNTS) == counts
        assert got["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (got["base_failed"] and got["kept"])


def test_held_out_labels(spark):
    """The labels were never used, so all of them measure the rules."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality_report(docs).join(labels, "doc_id").where("not base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert right >= 0.97 * len(rows)
    assert all(r["kept"] for r in rows if r["quality"] == 1)


def test_model_learns_which_rules_are_noise():
    good, bad = quality.GOOD, quality.BAD
    # Rule 0 and 1 agree on the bad documents; rule 2 says bad at random.
    patterns = collections.Counter()
    for k in range(10_000):
        junk = k % 10 == 0
        votes = [bad if junk else good] * 2 + [bad if k % 7 < 2 else good] + [good] * 5
        patterns["".join(votes)] += 1
    accuracy = quality.fit(dict(patterns)).accuracies()
    names = list(quality.RULES)
    assert accuracy[names[0]] > 20 * accuracy[names[2]]
    assert accuracy[names[2]] < 3


def test_result_does_not_depend_on_size():
    patterns = {"00000000": 900, "22000000": 60, "00010000": 40}
    small, large = quality.fit(patterns), quality.fit({k: 1000 * v for k, v in patterns.items()})
    assert abs(small.prior - large.prior) < 1e-6


def test_clean_corpus_is_kept(spark):
    text = " ".join(f"word{k} and then" for k in range(60)) + "."
    docs = spark.createDataFrame([(k, f"{k} {text}") for k in range(20)], "doc_id long, text string")
    assert quality.keep_good(docs).count() == 20


def test_odd_rows_and_empty_tables(spark):
    docs = clashing(odd(spark))
    report = {(r["doc_id"], r["n_words"]): r for r in quality.quality_report(docs).collect()}
    assert report[1, 0]["base_failed"] and report[3, 0]["base_failed"] and report[9, 20_000]["n_repeat_words"] == 20_000
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.collect() == []
    assert quality.quality_report(empty(spark)).collect() == [] and quality.keep_good(empty(spark)).collect() == []


def test_kept_rows_are_unchanged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality_report(docs).where("kept").collect()}
    assert sorted(quality.keep_good(clashing(docs)).collect()) == sorted(
        r for r in clashing(docs).collect() if r["doc_id"] in kept)
