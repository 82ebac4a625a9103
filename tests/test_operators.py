"""Decision tables and hard cases of the core operators, on small fixtures."""

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators import dictionary, flatten, layout, metrics, reconcile, retrieval, store


def one(spark, expr_of, *values, types=None):
    df = spark.createDataFrame([values], types or ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr_of(*[F.col(c) for c in df.columns]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "field, value, good",
    [
        ("address_zip", "12345", True), ("address_zip", "12345-6789", True), ("address_zip", "1234", False), ("address_state", "ny", True), ("address_state", "ZZ", False),
        ("phone", "(212) 555-0100", True), ("phone", "555-0100", False), ("date_of_birth", None, None), ("date_signed", "02/30/2024", False), ("date_signed", "2/3/2024", True),
        ("subscriber_dob", "1899-12-31", False), ("first_name", "Ada", None), ("address_zip", None, None), ("address_zip", "", False),
    ],
)
def test_verdict(spark, field, value, good):
    assert one(spark, X.verdict, field, value) is good


@pytest.mark.parametrize("text, day", [("4/7/2020", "2020-04-07"), ("04-07-2020", "2020-04-07"), ("2020-04-07", "2020-04-07"), (" 4/7/2020 ", "2020-04-07"), ("4/7/20", None), ("13/1/2020", None), ("", None), (None, None), ("4/7/2020 x", None)])
def test_iso_date(spark, text, day):
    assert one(spark, X.iso_date, text) == day


def test_text_functions(spark):
    assert one(spark, X.folded, " Straße １ ") == "strasse 1"
    assert one(spark, X.folded, "  ") is None
    assert one(spark, X.squeezed, "　 A \t b ") == "a b"
    assert one(spark, X.sex_code, " male") == "M" and one(spark, X.sex_code, "x") is None
    assert one(spark, lambda c: F.concat_ws("|", *X.last_first(c)), "Doe, Jo, Q") == "Doe|Jo, Q"
    assert one(spark, lambda c: F.concat_ws("|", *X.last_first(c)), "Doe") == ""
    assert one(spark, lambda c: F.concat_ws("|", *X.birth_and_sex(c)), "04/07/1990  f") == "04/07/1990|F"
    assert one(spark, X.without_box_number, "25A. Name") == "Name"
    assert one(spark, lambda a: X.word_index(X.label_words(a), X.label_words(F.lit("of birth"))), "Date of birth") == 1
    assert one(spark, lambda a: X.word_index(X.label_words(a), X.label_words(F.lit("irth"))), "Date of birth") is None
    assert one(spark, X.partition_key, "a-b-c", "healthcare") == "a-b" and one(spark, X.partition_key, "a-b-c", "business") == "a-b-c"
    for name in ("CON", "com0", "lpt9", "a.", ""):
        assert one(spark, X.safe_stem, name).startswith(one(spark, lambda c: F.substring(F.sha2(c, 256), 1, 16), name))
    assert one(spark, X.safe_stem, "con.x").startswith("con.x-")
    v = lambda f, x: one(spark, lambda c: X.verdict(F.lit(f), c), x)
    assert v("address_zip", " 12345\n") and v("address_state", "\u00a0ny ") and v("date_of_birth", " 1/2/2020 ") and not v("address_zip", "12345x") and v("address_state", "zz") is False


def wide(spark, rows):
    return reconcile.by_reader(spark.createDataFrame(rows, "doc_id string, field_name string, tier string, value string, confidence double"))


@pytest.mark.parametrize(
    "readings, rule, chosen, confidence",
    [
        ({"1": "Ann", "2": "Bob", "3a": "ANN"}, 1, "ANN", 0.95), ({"2": None, "3a": None}, 3, None, 1.0), ({"3a": None}, 2, None, None), ({"2": "Bob", "3a": "Bob"}, 4, "Bob", 0.95),
        ({"2": "Bob", "3a": None}, 5, "Bob", 0.5), ({"2": "Bob", "3a": "Bo"}, 6, "Bo", 0.5), ({"1": "Al", "2": "Bob", "3a": "Bob"}, 7, "Bob", 0.5), ({"1": "Al", "2": "Bob"}, 0, "Bob", 1.0), ({"1": "Al", "3a": "Al"}, 1, "Al", 0.95),
    ],
)
def test_reconcile_rules(spark, readings, rule, chosen, confidence):
    r = reconcile.reconcile(reconcile.route(wide(spark, [("d", "first_name", t, v, 1.0) for t, v in readings.items()]))).first()
    assert (r["rule_no"], r["chosen"], r["confidence"]) == (rule, chosen, confidence)


def test_valid_value_is_kept_and_invalid_reading_is_no_witness(spark):
    r = reconcile.reconcile(wide(spark, [("d", "address_zip", "1", "9", 1.0), ("d", "address_zip", "2", "12345", 1.0), ("d", "address_zip", "3a", "9", 1.0)])).first()
    assert (r["rule_no"], r["chosen"]) == (5, "12345")


def test_routes_parking_and_failure(spark):
    w = wide(spark, [("d", "a", "1", "x", 1.0), ("d", "a", "2", "X ", 1.0), ("d", "b", "2", "y", 0.6), ("d", "c", "1", "z", 0.3)])
    r = reconcile.route(w, covered=["a", "c"])
    assert {x["field_name"]: x["route"] for x in r.collect()} == {"a": "agree", "b": "uncovered", "c": None}
    done = reconcile.reconcile(reconcile.route(w))
    assert [tuple(x) for x in reconcile.parked(done).collect()] == [("d", ["b", "c"], 0.3)]
    after = reconcile.park_after_failure(done, F.lit(True))
    assert {x["field_name"]: x["confidence"] for x in after.collect()} == {"a": 1.0, "b": 0.5, "c": 0.3}


@pytest.mark.parametrize("tier, value, confidence, out", [(None, None, None, True), ("1", None, 0.1, False), ("1", "v", 0.84, True), ("1", "v", 0.85, False), ("1", "v", None, False)])
def test_escalation(spark, tier, value, confidence, out):
    assert one(spark, reconcile.escalates, tier, value, confidence, types="a string, b string, c double") is out


@pytest.mark.parametrize("value, truth, tier, out", [("a", "a", "1", (1, 0, 0, 0)), ("a", "b", "1", (0, 1, 1, 0)), ("a", None, "1", (0, 1, 0, 0)), (None, "a", "1", (0, 0, 1, 0)), (None, None, "1", (0, 0, 0, 1)), (None, None, None, (0, 0, 0, 0))])
def test_cell_counts(spark, value, truth, tier, out):
    df = spark.createDataFrame([(value, tier, truth)], "v string, t string, g string")
    assert tuple(df.select(*[c.alias(n) for n, c in metrics.cell_counts(F.col("v"), F.col("t"), F.col("v"), F.col("g")).items()]).first()) == out


def test_ratios_of_nothing(spark):
    z = spark.createDataFrame([(0, 0, 0)], "tp long, fp long, fn long")
    assert tuple(metrics.rated(z).select("precision", "recall", "f1").first()) == (1.0, 1.0, 1.0)
    assert tuple(metrics.rated(z, empty=0.0).select("precision", "recall", "f1").first()) == (0.0, 0.0, 0.0)


def test_store(spark, rows):
    t = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, None)], "k string, at int, v string")
    assert rows(store.keep_latest(t, ["k"], ["at"])) == [("a", 2, "y"), ("b", None, None)]
    up = store.upsert(t, spark.createDataFrame([("a", 0, "new"), ("c", 9, "z")], t.schema), ["k"])
    assert rows(up) == [("a", 0, "new"), ("b", None, None), ("c", 9, "z")]
    assert rows(store.upsert(store.upsert(t, up, ["k"]), up, ["k"])) == rows(up)
    assert store.keep_latest(t.limit(0), ["k"], ["at"]).count() == 0
    assert store.orphans(t, "k", spark.createDataFrame([("a",)], "id string"), "id").count() == 1


HTML = [
    ("<table><tr><td colspan=99>a</td><td>b</td></tr></table>", [("a", 0, 32)]), ("<table><tr><td colspan='-1'>a<td>b</table>", [("a", 0, 1), ("b", 1, 2)]), ("<table><tr><td>a&nbsp;b<br>c</td></tr>", [("a\xa0b\nc", 0, 1)]),
    ("plain", []), (None, []), ("<t<<<>", []), ("<table>" + "<tr><td>x</td></tr>" * 300, [("x", 0, 1)] * 200), ("<table><tr><td>" + "y" * 9000, [("y" * 512, 0, 1)]),
]


@pytest.mark.parametrize("html, cells", HTML)
def test_tables(html, cells):
    assert [(c["text"], c["first_col"], c["end_col"]) for c in layout.table_rows(html)] == cells


def test_layout_to_fields(spark):
    html = "<table><tr><td>Birth date</td><td>2. Sex at birth</td></tr><tr><td>seen 4/7/1990</td><td>F</td></tr></table>"
    d = spark.createDataFrame([("date_of_birth", "base", ["Birth date"]), ("sex", "healthcare", ["Sex at birth", "Birth"])], "canonical_name string, vertical string, aliases array<string>")
    pairs = layout.table_pairs(layout.cells(spark.createDataFrame([("i", html)], "image string, content string")), ["image"])
    best = layout.best_offers(layout.offers(pairs, d, ["image"]), ["image"])
    assert {r["field"]: (r["value"], r["confidence"]) for r in best.collect()} == {"date_of_birth": ("4/7/1990", 0.9), "sex": ("F", 0.84)}
    assert layout.lines(spark.createDataFrame([("i", "table", html), ("i", "text", "a\n\n b"), ("i", None, None)], "image string, label string, content string"), ["image"]).count() == 6
    assert one(spark, layout.value_after, "Sex at birth : F ", "SEX AT BIRTH") == "F" and one(spark, layout.value_after, "Sextant", "Sex") is None


def test_dictionary(spark, rows):
    d = spark.createDataFrame([("a_b", "base", ["Name", "Full name"]), ("c", "healthcare", ["Name of pet", "Chart"]), ("e", "hr", ["Pet name"]), ("f", "healthcare", [])], "canonical_name string, vertical string, aliases array<string>")
    assert rows(dictionary.generic(d)) == [("a_b", "base", "Name")]
    assert rows(dictionary.distinctive(d)) == [("CHART", 1.0), ("NAME OF PET", 1.0)]
    assert ("f", "healthcare", 0, "F") in rows(dictionary.alias_map(d))
    assert rows(dictionary.batches(d)) == [(1, 3, 3), (2, 3, 5)]
    t = spark.createDataFrame([(1, "my chart, chart"), (2, None)], "id int, text string")
    assert rows(dictionary.score_texts(t, dictionary.distinctive(d)).select("id", "score")) == [(1, 1.0), (2, 0.0)]
    many = spark.createDataFrame([("MY", 0.5), ("CHART", 1.0), ("ART", 0.25), ("ZZ", 9.0)], "alias string, weight double")
    for block in (1, 2, 10):  # a vocabulary of any size, in blocks
        assert rows(dictionary.score_texts(t, many, block=block).select("id", "score")) == [(1, 1.75), (2, 0.0)]
    lab = spark.createDataFrame([("1. full name:",), ("names",), (None,), ("",)], "label string")
    assert [(r["label"], r["field"]) for r in dictionary.match_labels(lab, d).collect()] == [("1. full name:", "a_b")]
    cor = spark.createDataFrame([("C", "chart "), ("c", " Card"), ("c", "CARD"), ("zz", "x"), (None, "y"), ("c", None)], "field_name string, learned_alias string")
    assert rows(dictionary.learned(cor, d)) == [("c", "healthcare", "CARD")]


def test_flatten(spark, rows):
    ann = spark.createDataFrame([('{"metadata": {"document_id": "d", "page_count": 1}, "field_extractions": [{"page": 0, "bbox": [-0.01, 0, 1.01, 1], "fieldtype": "iban", "text": null}, {"page": 0, "bbox": [0, 0, 1, 1], "fieldtype": "iban", "text": "X 1"}, {"page": 0, "bbox": [0, 0, 1, 1], "fieldtype": "odd", "text": "n"}]}',)], "j string")
    docs = ann.select(F.from_json("j", flatten.ANNOTATION).alias("j")).select("j.*")
    fields = flatten.annotated_fields(docs)
    assert fields.filter("pos = 0").first()["box"] == [0.0, 0.0, 1.0, 1.0]
    assert rows(flatten.annotated_truth(fields, ["iban"])) == [("d", "iban", "x 1")]
    bad = spark.createDataFrame([('{"metadata": {"document_id": "d"}, "field_extractions": [{"page": 0, "bbox": [0.5, 0, 0.1, 1], "fieldtype": "a", "text": "t"}]}',)], "j string").select(F.from_json("j", flatten.ANNOTATION).alias("j")).select("j.*")
    with pytest.raises(Exception, match="bad box"):
        flatten.annotated_fields(bad).collect()


def test_retrieval(spark, rows):
    t = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 2.0]), ("b", [1.0, 1.0]), ("c", None), ("c", []), ("d", [0.0, 0.0])], "doc string, vector array<double>")
    q = spark.createDataFrame([("q", 0, [3.0, 0.0]), ("q", 1, [0.0, 1.0]), ("q", 2, None)], "query string, token long, vector array<double>")
    got = {r["doc"]: round(r["score"], 6) for r in retrieval.max_sim(t, q).collect()}
    assert got == {"a": 2.0, "b": 1.414214, "d": 0.0}
    assert [r["doc"] for r in retrieval.top_k(retrieval.max_sim(t, q), 2).orderBy("rank").collect()] == ["a", "b"]
    assert retrieval.top_k(retrieval.max_sim(t, q), 0).count() == 0 and retrieval.max_sim(t, q.limit(0)).count() == 0
