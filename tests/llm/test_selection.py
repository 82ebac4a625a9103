import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import selection as S

Q = [0.01, 0.5, 0.9, 0.99, 1.0]


def brute(values, q):
    v = sorted(x for x in values if x is not None and not math.isnan(x) and x >= 0)
    return v[max(1, -(-len(v) * round(q * 1000) // 1000)) - 1] if v else None


def check(spark, groups, leaf):
    df = spark.createDataFrame([(g, x, "n") for g, xs in groups.items() for x in xs], "g string, x double, n string").repartition(5)
    got = {(r["g"], r["q"]): r["value"] for r in S.multi_select(df, ["g"], "x", Q, leaf=leaf).collect()}
    want = {(g, q): b for g, xs in groups.items() for q in Q if (b := brute(xs, q)) is not None}
    assert got == want


@pytest.mark.parametrize("leaf", [1, 7, 4096])
def test_against_brute_force(spark, leaf):
    r = random.Random(3)
    check(spark, {"hot": [r.lognormvariate(3, 2) for _ in range(3000)], "ties": [5.0] * 400 + [1.0, 9.0], None: [3.0, None, float("nan"), -1.0, 0.0], "none": [None, -2.0], "inf": [float("inf")] * 5 + [1.0]}, leaf)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["a", "b"]), st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True)), min_size=1, max_size=40), min_size=1))
def test_any_values(spark, groups):
    check(spark, groups, 2)


def test_empty_and_clashing_columns(spark):
    e = spark.createDataFrame([], "g string, x double, n long, seg int, q double, value string")
    assert S.multi_select(e, ["g"], "x", [0.5]).count() == 0
    one = spark.createDataFrame([("a", 1.0, 9, 9, 0.1, "z")], e.schema)
    assert [tuple(r) for r in S.multi_select(one, ["g"], "x", [0.5]).collect()] == [("a", 0.5, 1, 1.0)]


def test_summaries_combine_within_their_error(spark):
    r = random.Random(1)
    xs = [r.lognormvariate(5, 3) for _ in range(4000)] + [0.0] * 50
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(xs)], "day int, x double")
    parts = [S.summarise(df.filter(F.col("day") == d), ["day"], "x") for d in range(3)]
    got = {r["q"]: r["value"] for r in S.from_summary(S.combine(parts, []), [], [0.001, 0.5, 0.99]).collect()}
    for q, v in got.items():
        assert abs(v - brute(xs, q)) <= S.ALPHA * 1.0001 * brute(xs, q)


def test_misstated_batches(spark):
    t = lambda n: F.lit(f"2024-01-0{n}").cast("timestamp_ntz")
    base = "doc_id string, batch_id int, seed_version string, stage string, latency_ms double, n int"
    r = spark.createDataFrame([("a", 1, "v", "tier1", 100.0, 1), ("a", 1, "v", "tier1", 10.0, 2), ("b", 1, "v", "tier1", 50.0, 1), ("c", 1, "v", "tier1", None, 1), ("d", 2, "v", "tier1", -1.0, 1)], base)
    r = r.withColumn("created_at", F.when(F.col("n") == 1, t(1)).otherwise(t(2)))
    b = spark.createDataFrame([(1, "v", "s1", "tier1", 55.0), (1, "v", "s2", "tier1", 55.1), (1, "v", "s2", "tier1", 55.1), (1, "v", "s3", "tier1", None), (2, "v", "s4", "tier1", 3.0), (None, "v", "s5", "tier1", 3.0), (1, "v", "s6", "tier1", float("nan"))], "batch_id int, seed_version string, git_sha string, stage string, latency_p99_ms double")
    assert sorted(x["git_sha"] for x in S.misstated_batches(b, r).collect()) == ["s2", "s6"]


def test_found_comes_through_the_selection(spark):
    """The groups of p1_found on the real tables are parted by pivots, not merely sorted."""
    from fieldloom.runtime import table

    now = S.current_results(table(spark, "/root/testdata/sf0.01", "eval_results"))
    out = S.multi_select(now, ["batch_id", "seed_version", "stage"], "latency_ms", [0.99])
    assert out.rounds > 0 and out.count() == now.filter("latency_ms >= 0 and not isnan(latency_ms)").select("batch_id", "seed_version", "stage").distinct().count()


def test_ranges_too_large_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "is_small", lambda df: False)
    monkeypatch.setattr(S, "small_side", lambda df: df)
    r = random.Random(8)
    check(spark, {"a": [r.random() for _ in range(500)], None: [float(r.randrange(9)) for _ in range(300)]}, 4)
