import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import pii
from tests.llm.helpers import clashing, empty, odd

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def base_spans(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, pattern) in enumerate(PLAIN.items())
             for m in re.finditer(pattern, text or "") if valid(kind, m.group())]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def report(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.pii_report(frame).collect()}


HARD = [
    "a@b.c.@d.e x_y@z.w_q@r.s a@b_c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0000001.002.3.4 1.2.3", "@x.y a@b a@b. .@-.-",
    "4111 1111 1111 1111 x 4111-1111-1111-1111 4111111111111111", "4111  1111 1111 1111", "+1 (743) 555-3824 +49 30 1234567) (",
    "é😀 a@b.co 😀 1.2.3.4 ++1 222 333 4444", "+12345678901234567890 +1-", "9" * 20_000, "1 " * 9_000, "a." * 6_000,
    "4111111111111111-" * 500, "x@y." + "z." * 9_000, "+1((((((((" * 500, None, "", "\n\n",
]


def test_hard_cases(spark):
    found = report(spark, HARD)
    for k, text in enumerate(HARD):
        spans = base_spans(text)
        assert found[k]["base_sha256"] == digest(spans), text
        assert [found[k][f"n_{kind}"] for kind in PLAIN] == [sum(s[0] == kind for s in spans) for kind in PLAIN]


@given(st.lists(st.text(st.sampled_from("a1@.+- (9é4"), max_size=40), min_size=20, max_size=60))
@settings(max_examples=5, deadline=None)
def test_random_texts(spark, texts):
    found = report(spark, texts)
    for k, text in enumerate(texts):
        assert found[k]["base_sha256"] == digest(base_spans(text)), text


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r["doc_id"]: r for r in pii.pii_report(docs).collect()}
    spans = {r["doc_id"]: base_spans(r["text"]) for r in docs.collect()}
    assert {k: r["base_sha256"] for k, r in found.items()} == {k: digest(s) for k, s in spans.items()}
    assert any(spans.values())


def test_texts_with_many_matches(spark):
    """More matches than one run holds, at and around its borders."""
    cards = ["4111 1111 1111 1111", "4111 1111 1111 1112", "378282246310005"]
    texts = [" ".join(f"é{'x' * (k % 5)} a{k}@b.co 10.0.{k % 300}.1 {cards[k % 3]} +1 743 555 {1000 + k};" for k in range(n))
             for n in (1, pii.RUN - 1, pii.RUN, pii.RUN + 1, 3 * pii.RUN + 7)]
    found = report(spark, texts)
    for k, text in enumerate(texts):
        assert found[k]["base_sha256"] == digest(base_spans(text))
        assert found[k]["n_email"] == text.count("@")


def test_checksums_and_words_nearby_add_spans(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32.", "IBAN GB83 WEST 1234 5698 7654 32.", "konto DE89370400440532013000",
             "phone (743) 555-3824", "order (743) 555-3824", "+1 (743) 555-3824"]
    found = report(spark, texts)
    assert [found[k]["spans"] for k in range(len(texts))] == [
        "iban:5:32", "", "iban:6:28", "phone_local:6:20", "", "phone:0:17"]
    assert report(spark, ["server 10.0.0.1"])[0]["top_score"] > report(spark, ["version 10.0.0.1"])[0]["top_score"]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é a@b.co, 10.0.0.1!", 19, "x"), (2, "clean 12", 8, "y"), (3, None, None, "z")],
                                 "doc_id long, text string, n_chars int, pii string")
    assert [tuple(r) for r in pii.redact(docs).orderBy("doc_id").collect()] == [
        (1, "é [EMAIL], [IP]!", 16, "x"), (2, "clean 12", 8, "y"), (3, None, None, "z")]


def test_overlapping_spans_become_one(spark):
    docs = spark.createDataFrame([(1, "call 4111111111111111@x.yz now")], "doc_id long, text string")
    assert pii.redact(docs).first()["text"] == "call [EMAIL] now"


def test_odd_rows_and_empty_tables(spark):
    docs = clashing(odd(spark))
    assert pii.redact(docs).columns == docs.columns
    assert sorted(map(str, pii.redact(docs).collect())) == sorted(map(str, docs.collect()))
    assert pii.pii_report(docs).count() == docs.count()
    assert pii.pii_report(empty(spark)).collect() == []
    assert pii.redact(empty(spark)).collect() == []


@pytest.mark.parametrize("frame", [pii.pii_report, pii.redact])
def test_built_in_functions_only(spark, frame):
    plan = frame(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
