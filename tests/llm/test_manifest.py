"""The manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakemart.llm import manifest
from tests.llm.helpers import DOCS, clashing, empty, odd


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, change=lambda t: t):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars, text if text is None else change(text))
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) per row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x for _, x in sorted(((r[0] is not None, r[0] or 0), plain_leaf(r)) for r in groups[s])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        ranked = sorted(groups[s], key=lambda r: ((r[0] is not None, r[0] or 0), plain_leaf(r)))
        for k, row in enumerate(ranked):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded, proof, place = plain_leaf(row, lower if tampered else str), "", k
            for tree, start in ((trees[s], k), (top, at)):
                place = start
                for nodes in tree[:-1]:
                    run = nodes[place // 16 * 16:place // 16 * 16 + 16]
                    left, right = "".join(run[:place % 16]), "".join(run[place % 16 + 1:])
                    proof, folded, place = proof + left + right, h(left, folded, right), place // 16
            root = top[-1][0]
            out.append((row[0], trees[s][0][k], trees[s][-1][0], root, h(proof), folded, folded == root))
    return sorted(out, key=str)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def report(docs):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in manifest.manifest_report(docs, tampered()).collect()), key=str)


def made_up(sizes, seed=1):
    rng, out = random.Random(seed), []
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "ABC é Éa", "plain", "Text " * rng.randrange(9)])
            out.append((len(out), text, rng.choice(["en", None]), source, rng.choice([None, len(out)])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [
    {None: 3, "": 1, "a": 260, "é": 16, "z": 17, "Z": 2},
    {f"s{k}": k % 3 + 1 for k in range(20)},  # more sources than one run, some with a lone leaf
    {f"s{k}": 1 for k in range(18)},
    {"one": 40}, {"one": 1}, {None: 2}])
def test_against_a_plain_tree(spark, sizes):
    rows = made_up(sizes)
    assert report(spark.createDataFrame(rows, DOCS).repartition(3)) == plain(rows)


def test_records_lead_to_every_leaf(spark):
    rows = made_up({"a": 40, "b": 3})
    docs = spark.createDataFrame(rows, DOCS)
    built = manifest.build(docs.select("doc_id", "source", manifest.digest(*(manifest.field(F.col(c)) for c in manifest.FIELDS))
                                       .alias("leaf")), "source", ["doc_id"])
    records = {r["digest"]: r["children"] for r in built.records.collect()}
    assert all(d == h(*children) and len(children) <= 16 for d, children in records.items())
    found, open_ = [], [built.root]
    while open_:
        d = open_.pop()
        open_ += records.get(d, [])
        found += [d] * (d not in records)
    assert sorted(found) == sorted(plain_leaf(r) for r in rows)
    few = built.leaves.where("doc_id in (0, 7, 41)").select("path", "doc_id", "leaf")
    proved = manifest.prove(built, few.unionByName(few.select(F.lit("0FF").alias("path"), F.lit(-1).alias("doc_id"), "leaf")))
    got = proved.select("doc_id", "leaf", "leaf_digest", manifest.fold(F.col("leaf"), F.col("segments")).alias("root")).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 7, 41]
    assert all(r["root"] == built.root and r["leaf"] == r["leaf_digest"] for r in got)


def test_any_input(spark):
    docs = odd(spark)
    expected = plain([tuple(r) for r in docs.collect()])
    assert report(clashing(docs)) == expected and len(expected) == docs.count()
    assert report(empty(spark)) == []
    copies = [(1, "Same", "en", "s", 4)] * 300 + [(2, "Other", "en", "s", 5)]
    assert report(spark.createDataFrame(copies, DOCS)) == plain(copies)
