import itertools
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import mixing as M


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 3)), max_size=4, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_fit_against_brute_force(classes, budget):
    sizes, counts = [c[0] for c in classes], [c[1] for c in classes]
    take = M.fit(sizes, counts, budget)
    best = max(s for t in itertools.product(*[range(c + 1) for c in counts]) if (s := sum(a * b for a, b in zip(t, sizes))) <= budget)
    assert sum(a * b for a, b in zip(take, sizes)) == best and all(0 <= t <= c for t, c in zip(take, counts))


def test_plan_of_a_large_budget():
    r = random.Random(2)
    sizes = np.array(sorted(r.sample(range(5, 3000), 400)))
    counts = np.array([r.randint(1, 500) for _ in sizes])
    whole = int((sizes * counts).sum())
    for budget in (0, 3, whole // 3, whole, whole * 2 + 12_345, whole * 9):
        every, extra = M.plan(sizes, counts, budget, 3)
        got = int((sizes * (counts * every + extra)).sum())
        assert ((0 <= extra) & (extra <= counts) & (every + (extra > 0) <= 3)).all()
        assert got <= budget and (got == min(budget, 3 * whole) or budget < 5)


def tables(spark, docs, targets):
    d = spark.createDataFrame(docs, "doc_id long, source string, text string, n_tokens string")
    return d, spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_shares(spark):
    r = random.Random(4)
    docs = [(i, s, "word " * r.randint(1, 40), "z") for i, s in enumerate(["a"] * 900 + ["b"] * 300 + ["c"] * 30 + ["other"] * 50 + [None] * 5)]
    docs += [(9000, "a", None, "z"), (9001, "a", "", "z")]
    d, t = tables(spark, docs, [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 3), ("empty", 0.1, 5), (None, 0.2, 1)])
    mixed, report = M.mix(d, t, seed=1)
    rep = {x["source"]: x for x in report.collect()}
    assert all(abs(rep[s]["share"] - rep[s]["aimed_share"]) < 0.001 for s in "abc") and rep["empty"]["tokens"] == 0
    rows = mixed.collect()
    got = {s: sum(x["n_tokens"] * x["uses"] for x in rows if x["source"] == s) for s in "abc"}
    assert got == {s: rep[s]["tokens"] for s in "abc"} and len({x["doc_id"] for x in rows}) == len(rows)
    assert all(0 < x["uses"] <= {"a": 1, "b": 2, "c": 3}[x["source"]] for x in rows)
    again = M.mix(d.repartition(3), t, seed=1)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_given_total_and_shortfall(spark):
    d, t = tables(spark, [(i, "ab"[i % 2], "x " * 10, "z") for i in range(40)], [("a", 0.9, 1), ("b", 0.1, 1)])
    rep = {x["source"]: x for x in M.mix(d, t, total=10_000)[1].collect()}
    assert rep["a"]["tokens"] == rep["a"]["available_tokens"] and rep["a"]["share"] < 0.9


def test_ranking_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(M, "RANK_BUCKET", 7)
    d, t = tables(spark, [(i, "a", "same", "z") for i in range(500)], [("a", 1.0, 1)])
    mixed, report = M.mix(d, t, total=211)
    assert mixed.agg(F.sum("uses")).first()[0] == 211 and report.first()["tokens"] == 211


def test_empty(spark):
    d, t = tables(spark, [(1, "a", "x", "z")], [("a", 1.0, 1)])
    for docs, targets in ((d.limit(0), t), (d, t.limit(0))):
        mixed, report = M.mix(docs, targets)
        assert mixed.count() == 0 and report.filter("tokens > 0").count() == 0
