import random

from pyspark.sql import functions as F

from fieldloom.llm import splits as S
from fieldloom.runtime import Scratch


def components(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_roots_against_union_find(spark):
    r = random.Random(5)
    pairs = [(f"{r.randrange(300):04}", f"{r.randrange(300):04}") for _ in range(180)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("hub", f"s{i}") for i in range(50)] + [("x", "x")]
    got = {x["node"]: x["root"] for x in S.roots(spark.createDataFrame(pairs, "a string, b string"), Scratch(spark, "t")).collect()}
    assert got == components([p for p in pairs if p[0] != p[1]])
    assert S.roots(spark.createDataFrame([("x", "x")], "a string, b string"), Scratch(spark, "t")).count() == 0


def test_spellings(spark):
    d = spark.createDataFrame([(" Train\t",), ("VAL",), ("validation",), ("training",), ("", ), (None,), ("odd",)], "s string")
    assert [r[0] for r in d.select(S.split_name(F.col("s"))).collect()] == ["train", "dev", "dev", "train", None, None, "odd"]


def test_merges_keep_and_quarantine(spark):
    t = S.ComponentTable(spark)
    rec = lambda *v: spark.createDataFrame(v, "author string, source string, split string, comp string")
    keys = [F.col("author"), F.col("source")]
    t.absorb(rec(("a", "s1", "train", "x"), ("b", "s2", "val", "x"), ("c", None, None, "x"), (None, None, "test", "x"), ("a", "s1", "train", "x")), keys, F.col("split"))
    t.fill()
    of = lambda: {r["node"]: (r["split"], r["status"]) for r in t.df.collect()}
    assert of()["0:a"] == of()["1:s1"] == ("train", "kept") and of()["0:b"] == ("dev", "kept") and of()["0:c"][1] == "filled"
    before = of()["0:c"]
    t.absorb(rec(("d", "s1", None, "x"), ("c", "s3", None, "x")), keys, F.col("split"))
    t.fill()
    assert of()["0:d"] == ("train", "kept") and of()["1:s3"][0] == before[0]
    t.absorb(rec(("a", "s2", None, "x")), keys, F.col("split"))
    t.fill()
    assert of()["0:a"] == of()["0:b"] == (None, "quarantined")
    assert {r["node"] for r in t.conflicts().collect()} == {"0:a", "0:b", "0:d", "1:s1", "1:s2"}


def test_proportions_and_hot_component(spark):
    t = S.ComponentTable(spark)
    t.absorb(spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 9001).cast("string"))).alias("k")), [F.col("k")])
    t.fill()
    w = {r["split"]: r["w"] for r in t.df.groupBy("split").agg(F.sum("weight").alias("w")).collect()}
    assert all(abs(w[s] / 30_000 - x) < 0.01 for s, x in S.RATIOS.items())
    assert t.df.filter("node = '0:hot'").first()["split"] == "train"


def test_empty(spark):
    m = spark.createDataFrame([], "doc_id string, split string, vertical string, partition_key string")
    assert S.violations(m, m).count() == 0 and S.assigned(m, m).count() == 0


def test_violations(spark):
    m = spark.createDataFrame([("p-1", "train"), ("p-2", "Training"), ("q-1", "dev"), ("b", None), (None, "test"), ("r-1", " test")], "doc_id string, split string")
    r = spark.createDataFrame([("q-7", "test"), ("b", "dev"), ("r-1", None)], "doc_id string, split string")
    assert [x[0] for x in S.violations(m, r).collect()] == ["q"]
    got = {x["doc_id"]: (x["split"], x["status"]) for x in S.assigned(m, r).collect()}
    assert got == {"p-1": ("train", "kept"), "p-2": ("train", "kept"), "q-1": (None, "quarantined"), "b": ("dev", "kept"), "r-1": ("test", "kept")}


def test_quarantine_of_given_splits_holds(spark):
    """Two components that were only ever given splits, not carried any, are merged: they stay quarantined over any number of fills, and so does what joins them."""
    t = S.ComponentTable(spark)
    rec = lambda *v: spark.createDataFrame(v, "author string, source string")
    keys = [F.col("author"), F.col("source")]
    t.absorb(rec(("a", "s1"), ("b", "s2")), keys).fill({"train": 0.5, "test": 0.5})
    of = lambda: {r["node"]: (r["split"], r["status"]) for r in t.df.collect()}
    assert {of()["0:a"][0], of()["0:b"][0]} == {"train", "test"}
    t.absorb(rec(("a", "s2"), ("c", "s2")), keys)
    for _ in range(3):
        t.fill({"train": 0.5, "test": 0.5})
        assert set(of().values()) == {(None, "quarantined")}
    assert t.conflicts().count() == 5


def test_a_table_goes_on_where_it_was_left(spark, tmp_path):
    rec = lambda *v: spark.createDataFrame(v, "author string, source string")
    keys = [F.col("author"), F.col("source")]
    first = S.ComponentTable(spark, str(tmp_path)).absorb(rec(*[(f"a{i}", f"s{i}") for i in range(40)]), keys).fill()
    before = {r["node"]: r["split"] for r in first.df.collect()}
    (tmp_path / "v=9").mkdir()  # a version that was never finished
    again = S.ComponentTable(spark, str(tmp_path))
    assert again.version == 2 and {r["node"]: r["split"] for r in again.df.collect()} == before
    again.absorb(rec(("new", "s3"), ("other", "t")), keys).fill()
    after = {r["node"]: r["split"] for r in again.df.collect()}
    assert all(after[n] == s for n, s in before.items()) and after["0:new"] == before["1:s3"] and after["0:other"]


def test_splits_without_a_ratio_count_in_the_whole(spark):
    many = [(f"k{i}", f"name{i}") for i in range(1500)] + [(f"o{i}", None) for i in range(1500)]
    t = S.ComponentTable(spark).absorb(spark.createDataFrame(many, "k string, s string"), [F.col("k")], F.col("s")).fill({"train": 0.4, "test": 0.1})
    got = {r["split"]: r["n"] for r in t.df.filter("split in ('train', 'test')").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(got["train"] - 1200) < 20 and abs(got["test"] - 300) < 20


def test_documents_are_merged_by_pointer_jumping(spark):
    from fieldloom.runtime import table

    d = "/root/testdata/sf0.01"
    t = S.domain_table(table(spark, d, "manifest_entries"), table(spark, d, "eval_results"))
    assert t.merges > 0 and t.df.select("comp").distinct().count() == t.df.filter("node LIKE '1:%'").count()
