import collections

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemart.llm import vectors
from tests.llm.helpers import SF, clashing
from tests.llm.test_simhash import plain_components

ROWS = "vec_id long, embedding array<float>"


def expected(rows):
    """n_links, component_id by brute force; rows are (id, list or None), ids unique."""
    good = [k for k, (_, v) in enumerate(rows)
            if v and None not in v and np.isfinite(v).all() and np.abs(np.array(v)).max() > 0]
    edges = []
    for a in good:
        for b in good:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
                    edges.append((a, b))
    root = plain_components(edges, range(len(rows)))
    out = {}
    for k, (i, _) in enumerate(rows):
        out[i] = (sum(k in e for e in edges), min(rows[m][0] for m in range(len(rows)) if root[m] == root[k]))
    return out


def found(frame):
    rows = vectors.linked_vectors(frame).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def clusters(sizes, dimension=24, noise=0.2, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dimension)
        rows += [(centre + noise * rng.standard_normal(dimension)).tolist() for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(k), rows[j]) for k, j in enumerate(order)]


def test_against_all_pairs(spark):
    rows = clusters([1] * 150 + [2] * 30 + [7] * 5 + [60])
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    assert found(frame) == expected(rows)


def test_chains_near_the_threshold(spark):
    rows = clusters([25] * 6 + [1] * 100, noise=0.33, seed=8)
    assert found(spark.createDataFrame(rows, ROWS)) == expected(rows)


def test_parts_of_a_large_component(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 16)
    rows = clusters([70, 20, 1, 1])
    member = spark.createDataFrame([(k, v, 1 + k % 2, k) for k, v in rows],
                                   "node long, vector array<double>, copies long, first_id long")
    component = spark.createDataFrame([(k, int(expected(rows)[k][1])) for k, _ in rows], "node long, component long")
    # Workers read the usual part size, so only the dealing out is small here.
    got = {r["node"]: r["linked"] for r in vectors.count_links(member, component, 0.9).collect()}
    x = vectors.matrix(pa.array([v for _, v in rows]))
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    copies = np.array([1 + k % 2 for k, _ in rows])
    assert got == dict(enumerate((near @ copies).tolist()))


def test_all_of_a_crowded_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 4)
    rng = np.random.default_rng(5)
    topic = rng.standard_normal(24)
    rows = [v + 0.1 * rng.standard_normal(24) for v in topic + 0.6 * rng.standard_normal((30, 24)) for _ in range(2)]
    nodes = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rows)], "node long, vector array<double>")
    edges = vectors.bucket_edges(nodes, 2, 0, 1, 0.9, 0.6, 8).where("cosine >= 0.9").collect()
    x = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    side = (x @ np.random.default_rng([0, 24]).standard_normal((24, 1)) > 0).ravel()
    links = [(a, b) for a in range(60) for b in range(a) if side[a] == side[b] and x[a] @ x[b] >= 0.9]
    assert len(links) >= 20
    assert plain_components([(r["a"], r["b"]) for r in edges], range(60)) == plain_components(links, range(60))


def test_copies_and_unusable_vectors(spark):
    one, two = [1.0, 2.0, 0.5], [-3.0, 1.0, 0.25]
    rows = [(k, one) for k in range(5, 45)] + [(50, two), (51, [v * 4 for v in two]), (52, None), (53, []), (54, [0.0] * 3),
            (55, [1.0, None, 2.0]), (56, [float("nan"), 1.0, 1.0]), (57, [float("inf"), 1.0, 1.0]), (58, [1.0, 2.0])]
    assert found(clashing(spark.createDataFrame(rows, ROWS))) == expected(rows)


def test_only_copies(spark):
    assert found(spark.createDataFrame([(k, [1.0, 1.0]) for k in range(3)], ROWS)) == {k: (2, 0) for k in range(3)}


def test_null_and_repeated_ids(spark):
    rows = vectors.linked_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.1]),
                                                         (None, [0.0, 1.0])], ROWS)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, [
        rows[0].__class__(vec_id=i, n_links=n, component_id=c, kept=k) for i, n, c, k in
        [(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 0, None, True)]]))


def test_empty(spark):
    assert vectors.linked_vectors(spark.createDataFrame([], ROWS)).collect() == []


def test_audit_counts_missing_links(spark):
    rows = clusters([6, 6])
    nodes = spark.createDataFrame([(k, v) for k, v in rows], "node long, vector array<double>")
    none = spark.createDataFrame([], "node long, component long")
    assert vectors.audit_recall(nodes, none, 0.9) == (0, sum(n for n, _ in expected(rows).values()))


def test_recall_is_audited_by_vector(spark):
    rows = clusters([120, *[2] * 15], noise=0.05)
    nodes = spark.createDataFrame(rows, "node long, vector array<double>")
    held = collections.Counter(c for _, c in expected(rows).values())
    hot = max(held, key=held.get)
    component = spark.createDataFrame([(k, c) for k, (_, c) in expected(rows).items() if c == hot],
                                      "node long, component long")
    found, total = vectors.audit_recall(nodes, component, 0.9)
    assert found >= 0.995 * total  # pooled over links, the lost pairs are not seen
    assert vectors.vector_recalls(nodes, component, 0.9, large=100) == [pytest.approx(0.8), 0.0]


def test_where_tables_do_not_do_all_vectors_meet(spark, monkeypatch):
    rows = clusters([2] * 20 + [1] * 30)
    real, calls = vectors.bucket_edges, []

    def nothing_from_tables(nodes, count, *rest):
        calls.append(count)
        return real(nodes, count, *rest) if count == 1 else spark.createDataFrame([], vectors.EDGES)

    monkeypatch.setattr(vectors, "bucket_edges", nothing_from_tables)
    frame = spark.createDataFrame(rows, ROWS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.linked_vectors(frame, max_tables=12).collect()}
    assert got == expected(rows) and calls[-1] == 1 and len(calls) == 2


def test_new_links_join_components(spark):
    component = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (9, 9), (10, 9)], "node long, component long")
    links = spark.createDataFrame([(2, 6), (6, 2), (10, 20), (21, 22), (1, 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in vectors.relabel(component, links).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 9: 9, 10: 9, 20: 9, 21: 21, 22: 21}


def test_few_links_are_labelled_as_many_are(spark, monkeypatch):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2)) if a != b]
    links = vectors.cut(spark.createDataFrame(pairs, "a long, b long"))
    few = sorted(map(tuple, vectors.label(links).collect()))
    monkeypatch.setattr(vectors, "SMALL", 0)
    assert sorted(map(tuple, vectors.label(links).collect())) == few and len(few) > 150


def test_descent_finds_neighbours_of_neighbours(spark):
    angles = [0.0, 0.3, 0.6]
    nodes = spark.createDataFrame([(k, [float(np.cos(a)), float(np.sin(a))]) for k, a in enumerate(angles)],
                                  "node long, vector array<double>")
    edges = spark.createDataFrame([(0, 1, 0.95), (1, 0, 0.95), (1, 2, 0.95), (2, 1, 0.95)], vectors.EDGES)
    none = spark.createDataFrame([], "node long, component long")
    assert [(r["a"], r["b"]) for r in vectors.descend(nodes, edges, none, 0.6).collect()] == [(0, 2)]


def test_full_lists_still_lead_outside(spark):
    edges = spark.createDataFrame([*((0, k, 0.99) for k in range(1, 10)), (0, 20, 0.7), (0, 21, 0.65)], vectors.EDGES)
    component = spark.createDataFrame([(k, 0) for k in range(10)], "node long, component long")
    kept = {(r["a"], r["b"]) for r in vectors.keep_nearest(edges, component, 8).collect()}
    assert {b for a, b in kept if a == 0} == {*range(1, 9), 20, 21}


def test_rounds_go_on_while_lists_get_nearer(spark, monkeypatch):
    # Only 0 and 3 link; the first round finds the diagonals, the second can join them.
    plane = [(-0.2, -0.3), (-0.3, 0.3), (0.3, 0.3), (0.2, -0.3)]
    rows = [(k, (np.array([p, q, 1.0]) / np.linalg.norm([p, q, 1.0])).tolist()) for k, (p, q) in enumerate(plane)]
    x = np.array([v for _, v in rows])
    monkeypatch.setattr(vectors, "bucket_edges", lambda nodes, *_: spark.createDataFrame(
        [(a, b, float(x[a] @ x[b])) for a, b in [(0, 1), (1, 2), (2, 3)]], vectors.EDGES))
    truth = expected(rows)
    assert [n for n, _ in truth.values()] == [1, 0, 0, 1]
    one = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)  # numbers nodes as the edges do
    assert found(one) == truth


def test_given_vectors(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = np.array([r["embedding"] for r in frame.orderBy("vec_id").collect()], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = {k: int(n) - 1 for k, n in enumerate((x @ x.T >= 0.9).sum(axis=1))}
    assert {k: n for k, (n, _) in found(frame.select("vec_id", F.col("embedding"))).items()} == links
