import collections
import hashlib

from pyspark.sql import functions as F

from lakemart.llm import mixing
from tests.llm.helpers import SF, clashing, empty, odd

LEVELS = ["domain", "lang", "source"]


def share_out(budget, nodes):
    """(name, weight, capacity): by weight, the full ones' shortage to the others, again and again."""
    out, left = {}, [n for n in nodes if n[1] > 0]
    while left:
        total = sum(w for _, w, _ in left)
        full = [n for n in left if n[2] <= budget * n[1] / total]
        if not full:
            return out | {n: budget * w / total for n, w, _ in left}
        out |= {n: c for n, _, c in full}
        budget -= sum(c for _, _, c in full)
        left = [n for n in left if n not in full]
    return out


def plain(rows, weights, share, most, seed):
    """(id, epoch) by the definition; rows are (id, path, tokens)."""
    leaf = collections.defaultdict(list)
    for i, path, n in rows:
        leaf[path].append((i, n))
    total = {p: sum(n for _, n in v) for p, v in leaf.items()}
    budget = {(): share * sum(total.values())}
    for depth in range(3):
        for parent in [p for p in budget if len(p) == depth]:
            children = sorted({p[:depth + 1] for p in total if p[:depth] == parent})
            budget |= share_out(budget[parent], [
                (c, weights.get("/".join(c), 1), most * sum(n for p, n in total.items() if p[:depth + 1] == c))
                for c in children])
    taken = set()
    for path, members in leaf.items():
        if path not in budget:
            continue
        epochs = int(budget[path] // total[path])
        rest = budget[path] - epochs * total[path]
        taken |= {(i, e) for i, _ in members for e in range(epochs)}
        ahead = 0
        for _, i, n in sorted((hashlib.md5(f"{seed}|{epochs}|{i}".encode()).hexdigest(), i, n) for i, n in members):
            if ahead >= rest:
                break
            taken.add((i, epochs))
            ahead += n
    return taken


def check(docs, weights, share, most, seed=17):
    rows = [(r["doc_id"], tuple(r[c] for c in LEVELS), (len((r["text"] or "").encode()) + 3) // 4 + 1)
            for r in docs.collect()]
    got = [(r["doc_id"], r["epoch"]) for r in mixing.mix(docs, LEVELS, weights, share, most, seed).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, weights, share, most, seed)
    return got


def with_domain(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").withColumn(
        "domain", F.concat(F.lit("d"), F.length("source").cast("string")))


def test_shortage_under_a_zero_weight_goes_on(spark):
    rows = [(k, "d", x, y, n) for k, (x, y, n) in enumerate(
        [("x", "p", 10)] * 9 + [("x", "q", 1)] * 10 + [("y", "r", 1)] * 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n long")
    got = mixing.mix(docs, LEVELS, {"d/x/p": 0}, 0.5, 1, tokens=F.col("n")).groupBy("lang", "source").agg(F.sum("n")).collect()
    # Half of 1100 tokens: x can give no more than q's 10, so y gives 540.
    assert sorted(map(tuple, got)) == [("x", "q", 10), ("y", "r", 540)]
    none = mixing.mix(docs, LEVELS, {"d": 0}, 0.5, 1, tokens=F.col("n"))
    assert none.count() == 0


def test_null_is_no_name(spark):
    names = [None, "(none)", "%null", "%25null", "a/b", "a%2Fb", ""]
    rows = [(k, "d", "en", names[k % 7], 1) for k in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n long")
    weights = {"d/en/%null": 0, "d/en/a%2Fb": 0}
    got = {r["source"] for r in mixing.mix(docs, LEVELS, weights, 1.0, 2, tokens=F.col("n")).collect()}
    assert got == {"(none)", "%null", "%25null", "a%2Fb", ""}


def test_against_the_definition(spark):
    docs = with_domain(spark)
    check(docs, {}, 0.5, 1)
    got = check(docs, {"d4": 9, "d4/en": 1, "d4/fr": 30, "d5/de": 0}, 0.9, 3)
    assert max(e for _, e in got) > 0


def test_seeds_differ_and_repeat(spark):
    docs = with_domain(spark)
    first = set(check(docs, {}, 0.3, 1, seed=1))
    assert first == set(check(docs, {}, 0.3, 1, seed=1)) and first != set(check(docs, {}, 0.3, 1, seed=2))


def test_more_than_there_is(spark):
    docs = with_domain(spark)
    assert len(check(docs, {}, 5.0, 2)) == 2 * docs.count()


def test_siblings_come_before_ancestors(spark):
    # a/x can give 10 of its 50; a/y takes the other 40, and b keeps its own half.
    rows = [(k, "a", "x", "s", 10) for k in range(1)] + [(10 + k, "a", "y", "s", 10) for k in range(30)]
    rows += [(100 + k, "b", "z", "s", 10) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n long")
    got = mixing.mix(docs, LEVELS, budget_share=200 / 610, max_epochs=1, tokens=F.col("n")).collect()
    counts = collections.Counter((r["domain"], r["lang"]) for r in got)
    assert counts == {("a", "x"): 1, ("a", "y"): 9, ("b", "z"): 10}


def test_odd_rows_and_empty_tables(spark):
    docs = clashing(odd(spark)).withColumn("domain", F.lit(None).cast("string"))
    everything = mixing.mix(docs, LEVELS, budget_share=1.0, max_epochs=1)
    assert everything.count() == docs.count()
    assert everything.columns == [c for c in docs.columns if c != "epoch"] + ["epoch"]
    half = mixing.mix(docs, LEVELS, budget_share=0.5, max_epochs=1).collect()
    assert 0 < len(half) <= docs.count()
    assert mixing.mix(empty(spark), ["lang"]).collect() == []


def test_plan(spark):
    plan = mixing.mix(with_domain(spark), LEVELS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan
