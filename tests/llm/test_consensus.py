import random

import pytest

from fieldloom.llm import consensus as C


def simulated(n, accuracy, seed=1, spread=50):
    r = random.Random(seed)
    out, truth = [], {}
    for i in range(n):
        truth[i] = t = f"v{r.randrange(spread)}"
        for name, a in accuracy.items():
            if r.random() < 0.8:
                out.append(("f", i, name, t if r.random() < a else f"v{r.randrange(spread)}", 4))
    return out, truth


SCHEMA = "g string, i int, reader string, v string, lev int"


@pytest.mark.parametrize("wide", [True, False])
def test_held_out_accuracy(spark, wide, monkeypatch):
    if not wide:
        monkeypatch.setattr(C, "WIDE", 1)
    acc = {"a": 0.97, "b": 0.85, "c": 0.6, "d": 0.55}
    votes, truth = simulated(3000, acc)
    c = C.Consensus(spark.createDataFrame(votes, SCHEMA), "g", ["i"], values=True)
    got = c.decided().collect()
    right = sum(truth[r["i"]] == r["v"] for r in got) / len(got)
    plain = {}
    for _, i, _, v, _ in votes:
        plain.setdefault(i, []).append(v)
    many = {i: max(sorted(set(v)), key=v.count) for i, v in plain.items() if len(v) > 1}
    assert right > 0.95 and right > sum(truth[i] == v for i, v in many.items()) / len(many)
    est = {r["reader"]: r["accuracy"] for r in c.reliabilities().collect()}
    assert all(abs(est[k] - a) < 0.06 for k, a in acc.items())
    against = {(r["i"], r["reader"]) for r in c.dissent().collect()}
    chosen = {r["i"]: r["v"] for r in got}
    assert against == {(i, n) for _, i, n, v, _ in votes if i in chosen and chosen[i] != v}


def test_nulls_repeats_and_empty(spark, rows):
    v = spark.createDataFrame([(None, 1, "a", "x", 4), (None, 1, "a", "x", 4), (None, 1, "b", "y", 1), ("g", None, "a", "x", 0), ("g", 3, "a", "x", 0)], SCHEMA)
    assert rows(C.Consensus(v, "g", ["i"]).dissent()) == [(None, 1, "b")]
    assert C.Consensus(v.limit(0), "g", ["i"]).dissent().count() == 0
    assert C.agreement(v.limit(0), "g", ["i"]).count() == 0


def test_agreement_against_the_definition(spark):
    items = {1: ["a", "a", "b"], 2: ["b", "b"], 3: ["c"], 4: ["a", "c", "c", "c"]}
    votes = [("f", i, f"r{k}", v, 4) for i, vs in items.items() for k, v in enumerate(vs)]
    used = [vs for vs in items.values() if len(vs) > 1]
    n = sum(map(len, used))
    do = sum(sum(x != y for j, x in enumerate(vs) for k, y in enumerate(vs) if j != k) / (len(vs) - 1) for vs in used) / n
    flat = [v for vs in used for v in vs]
    de = sum(x != y for j, x in enumerate(flat) for k, y in enumerate(flat) if j != k) / (n * (n - 1))
    assert C.agreement(spark.createDataFrame(votes, SCHEMA), "g", ["i"]).first()["alpha"] == pytest.approx(1 - do / de)


def test_comparable_values(spark):
    pairs = [("date", "1/2/2024", "2024-01-02"), ("date", "01-02-2024", "2024-01-02"), ("sex", "Male", "m"), ("name", "Male", "male"), ("name", " A ＢС ", "abc"), ("name", None, None), ("date", "1/2/24", "1/2/24"), ("name", "Straße", "strasse")]
    df = spark.createDataFrame([(i, f, a, "c") for i, (f, a, _) in enumerate(pairs)], "i int, field string, value string, f string")
    assert {r["i"]: r["v"] for r in C.comparable(df, "value", "field").collect()} == {i: p[2] for i, p in enumerate(pairs)}


def test_misreadings(spark, rows):
    a = spark.createDataFrame([("d", "n", "1", "Anna", 0.9), ("d", "n", "2", "ANNA", 0.9), ("d", "n", "3a", "Ana", 0.9), ("d", "n", "3a", "Ana", 0.9), ("e", "n", "1", "x", 0.9), ("e", "n", "2", None, 0.9)], "doc_id string, field_name string, tier string, value string, confidence double")
    assert rows(C.misreadings(a)) == [("d", "n", "3a")]


def test_columns_and_lists_come_to_the_same(spark, monkeypatch):
    votes, _ = simulated(800, {"a": 0.95, "b": 0.8, "c": 0.65}, seed=4, spread=12)
    votes = [(f"g{i % 3}", i, n, v, 1 + (i + len(n)) % 4) for _, i, n, v, _ in votes]
    df = spark.createDataFrame(votes, SCHEMA)
    fit = lambda: C.Consensus(df, "g", ["i"], values=True)
    one = fit()
    monkeypatch.setattr(C, "WIDE", 1)
    two = fit()
    assert one.wide and not two.wide and max(one.moved, two.moved) <= C.STILL
    acc = lambda c: {(r["g"], r["reader"]): r["accuracy"] for r in c.reliabilities().collect()}
    a, b = acc(one), acc(two)
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 0.01 for k in a)
    of = lambda c: {(r["g"], r["i"]): (r["v"], r["votes"], r["votes_for"]) for r in c.decided().collect()}
    x, y = of(one), of(two)
    assert x.keys() == y.keys() and sum(x[k] != y[k] for k in x) <= 0.01 * len(x)
