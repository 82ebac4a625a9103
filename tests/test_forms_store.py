"""Forms, replies, training examples, pages, writers, sources and the application's functions."""

import datetime
import io
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import dictionary, flatten, forms, layout, metrics, pages, reconcile, retrieval, scoring, training
from fieldloom.plans import api, catalogue, folding, unchecked
from fieldloom.runtime import table
from fieldloom.sources import files, writers
from fieldloom.sources.readers import attempt

SF = "/root/testdata/sf0.001"
SHA = "a" * 64


def test_forms(spark, rows):
    w = spark.createDataFrame([("d", ("Ann", 0.7, "1"), (None, 0.9, "2"), (None, None, None))], "doc_id string, first_name struct<value string, confidence double, tier string>, sex struct<value string, confidence double, tier string>, phone struct<value string, confidence double, tier string>")
    long = forms.unpivoted(w, "doc_id", ["first_name", "sex", "phone"])
    assert rows(forms.field_rows(long)) == [("d", "first_name", "Ann", 0.7, "1", True, False), ("d", "phone", "", None, None, False, True), ("d", "sex", "", 0.9, "2", False, True)]
    a = forms.attempt_rows(long.withColumnRenamed("field", "field_name"), F.lit(5))
    assert {r["field_name"]: r["escalation_reason"] for r in a.collect()} == {"first_name": "low_confidence", "sex": None, "phone": "low_confidence"}
    assert forms.field_rows(long.limit(0)).count() == 0
    assert rows(forms.corrected(long, lambda f, v: v.upper()).filter("value is not null").select("field", "value", "tier")) == [("first_name", "ANN", "1")]
    assert forms.corrected(long) is long


def test_narrowed(spark, rows):
    d = spark.createDataFrame([("sex", "healthcare"), ("first_name", "base"), ("phone", "base")], "canonical_name string, vertical string")
    n = spark.createDataFrame([("a", "sex"), ("a", "phone"), ("a", "phone"), ("a", "first_name")], "doc_id string, field_name string")
    assert rows(forms.narrowed(n, d)) == [("a", ["first_name", "phone", "sex"])]
    assert forms.narrowed(n.limit(0), d).count() == 0
    with pytest.raises(Exception, match="no such field: odd"):
        forms.narrowed(spark.createDataFrame([("a", "odd")], "doc_id string, field_name string"), d).collect()


def test_typed_replies(spark):
    d = spark.createDataFrame([("name", "string"), ("born", "date"), ("n", "integer"), ("x", "float"), ("ok", "boolean"), ("sig", "signature"), ("items", "list")], "canonical_name string, data_type string")
    full = {"name": " Ann ", "born": "4/7/1990", "n": "12", "x": 1.5, "ok": True, "sig": "y", "items": "z"}
    r = spark.createDataFrame([("a", json.dumps(full)), ("b", json.dumps({"name": "  ", "born": "soon", "n": "1.5", "x": "abc", "ok": "maybe"})), ("c", None)], "doc_id string, content string")
    got = {(x["doc_id"], x["field"]): (x["value"], x["confidence"], x["tier"]) for x in forms.typed_replies(r, d, "2").collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "a"} == {"name": ("Ann", 1.0, "2"), "born": ("1990-04-07", 0.5, "2"), "n": ("12", 0.5, "2"), "x": ("1.5", 0.5, "2"), "ok": ("true", 0.5, "2")}
    assert {v for k, v in got.items() if k[0] in "bc"} == {(None, 0.0, "2")} and len(got) == 15


def test_typed_replies_of_the_table_by_brute_force(spark):
    d = spark.createDataFrame([("first_name", "string"), ("date_of_birth", "date"), ("sex", "enum")], "canonical_name string, data_type string")
    docs = table(spark, SF, "documents").select("doc_id", F.col("text").alias("content"))
    got = {(r["doc_id"], r["field"]): r["value"] for r in forms.typed_replies(docs, d, "2").collect()}
    for r in docs.collect():
        try:
            whole = json.loads(r["content"] or "")
        except ValueError:
            continue
        for f in ("first_name", "sex"):
            v = whole.get(f) if isinstance(whole, dict) else None
            assert got[r["doc_id"], f] == ((v or "").strip() or None)
    assert {r["doc_id"] for r in unchecked.typed_replies(spark, SF).select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_adherence_and_schema(spark):
    t = spark.createDataFrame([(1, '{"b": 1, "a": null}'), (2, '{"a": 1}'), (3, '{"a": 1, "b": 2} more'), (4, "[1]"), (5, None), (6, ' {"a": {}, "b": []}\n'), (7, "{broken}")], "i int, t string")
    assert {r["i"] for r in t.filter(forms.adheres(F.col("t"), ["a", "b"])).collect()} == {1, 6}
    s = forms.response_schema(table(spark, SF, "alias_dictionary")).collect()
    one = json.loads(next(r["schema"] for r in s if r["vertical"] == "healthcare"))
    assert one["properties"]["sex"] == {"type": ["string", "null"]} and sorted(one["properties"]) == one["required"] and one["additionalProperties"] is False
    assert spark.range(1).select(forms.xml_escaped(F.lit("<a & 'b'>"))).first()[0] == "&lt;a &amp; &#x27;b&#x27;&gt;"


def test_training_is_of_train_documents_only(spark, rows):
    m = spark.createDataFrame([("a", "healthcare", " Train"), ("b", "healthcare", "train"), ("b", "healthcare", "test"), ("c", "business", "train"), ("e", "healthcare", None), (None, "healthcare", "train")], "doc_id string, vertical string, split string")
    truth = spark.createDataFrame([(x, f, v) for x in "abce" for f, v in (("first_name", "ann"), ("sex", "F"), ("iban", "x"))], "doc_id string, field string, token string")
    got = spark.createDataFrame([("a", "first_name", "ANN"), ("a", "sex", "male"), ("b", "first_name", "x")], "doc_id string, field string, value string")
    s = training.seeded(m, truth, got)
    assert [(r["doc_id"], r["input"], r["response"]) for r in s.collect()] == [("a", "Field: sex\nField type: sex\nCascade extracted: M", "F")]
    assert training.seeded(m, truth, got.limit(0)).count() == 2 and training.seeded(m.limit(0), truth, got).count() == 0
    assert training.examples(m, truth, got).groupBy("source").count().count() == 2


def test_truth_of_corrections(spark, rows):
    at = datetime.datetime(2026, 1, 1)
    c = spark.createDataFrame([(1, "d", " Sex", "male", at), (2, "d", "sex", "F", at), (3, "d", "Sex?", "M", at), (4, "d", "sex", None, at), (5, None, "sex", "M", at), (6, "e", "date_of_birth", "soon", None)], "correction_id long, doc_id string, field_name string, corrected_value string, created_at timestamp_ntz")
    assert rows(scoring.correction_truth(c, ["sex", "date_of_birth"]).select("doc_id", "field", "token")) == [("d", "sex", "F")]


PAGES = "doc_id string, page_number int, image string, image_sha256 string, width_px int, height_px int"


def test_pages(spark, rows):
    docs = spark.createDataFrame([("a", 2, 0), ("b", 1, 1)], "doc_id string, page_count int, pos int")
    made = spark.createDataFrame([("a", 1, "a-p1.png", SHA, 10, 20), ("a", 2, "a-p2.png", SHA, 10, 20), ("b", 1, "b-p1.png", SHA, 10, 20)], PAGES)
    assert pages.page_rows(docs, made).count() == 3 and rows(pages.page_rows(docs, made, 1).select("doc_id").distinct()) == [("a",)] and pages.page_rows(docs, made, 0).count() == 3
    with pytest.raises(ValueError):
        pages.page_rows(docs, made, -1)
    with pytest.raises(Exception, match="page count mismatch for a"):
        pages.page_rows(docs, made.filter("page_number = 1")).collect()
    f = spark.createDataFrame([("a", 0, 1, "iban", "x", [0.0, 0.0, 1.0, 1.0]), ("a", 1, 1, "bic", None, [0.0, 0.0, 1.0, 1.0])], "doc_id string, pos int, page int, fieldtype string, text string, box array<double>")
    side = {r["source_id"]: [x["fieldtype"] for x in r["annotated"]["fields"]] for r in pages.page_sidecars(pages.page_rows(docs, made), f, "train").collect()}
    assert side == {"a-p1": ["iban", "bic"], "a-p2": [], "b-p1": []}
    s = spark.createDataFrame([([[10, 20], [1, 2]], 2, "d")], "s array<array<int>>, n int, w string")
    assert s.select(pages.page_sizes(F.col("s"), F.col("n"), F.col("w"))).first()[0] == [[10, 20], [1, 2]]
    for bad in ([[10, 0]], [[10]], [], None):
        with pytest.raises(Exception, match="bad page sizes in d"):
            spark.createDataFrame([(bad, 1, "d")], s.schema).select(pages.page_sizes(F.col("s"), F.col("n"), F.col("w"))).collect()


def test_labels_manifests_and_splits(spark, rows):
    s = spark.createDataFrame([("p-1", SHA, [("patient_name", " "), ("patient_name", "Doe, Jo")]), ("p-2", SHA, None), ("p-2", "b", [])], "doc_id string, image_sha256 string, fields array<struct<name string, value string>>")
    assert {r[0] for r in s.select(pages.label_of(F.col("fields"), F.col("doc_id"))).collect()} == {"Doe, Jo", "p-2"}
    m = pages.manifest_of(s, "healthcare")
    assert m.count() == 2 and m.select("split").distinct().count() == 1 and rows(pages.manifest_of(s, "healthcare", "test").select("split").distinct()) == [("test",)]
    man = spark.createDataFrame([("p-2", " Test"), ("p-1", "test"), ("q", "train")], "doc_id string, split string")
    assert [r["doc_id"] for r in pages.of_split(man, "test", s).collect()] == ["p-1", "p-2"] and [r["doc_id"] for r in pages.of_split(man, "test", s, 1).collect()] == ["p-1"]
    with pytest.raises(Exception, match="no file of q"):
        pages.of_split(man, "train", s).collect()
    with pytest.raises(ValueError):
        pages.first_of(man, "split", "doc_id", 0)


def test_writers(spark, rows, tmp_path):
    made = writers.create_tables(spark, "store_test", ["runs", "review_queue"])
    assert writers.create_tables(spark, "store_test", ["runs", "review_queue"]) == made and spark.table(made[0]).count() == 0
    spark.sql("DROP DATABASE store_test CASCADE")
    e = spark.createDataFrame([("d", 2, "2", "timeout"), ("d", 1, "1", None), (None, 1, "1", "x")], "doc_id string, pos int, tier string, error string")
    assert [(r["doc_id"], json.loads(r["error_history"])) for r in writers.review_rows(e).collect()] == [("d", [{"tier": "1"}, {"tier": "2", "error": "timeout"}])]
    old = spark.createDataFrame([(7, "d", "x")], "correction_id long, doc_id string, v string")
    new = spark.createDataFrame([("d", "y"), ("d", "y"), ("gone", "z"), (None, "n"), *[("d", f"v{i}") for i in range(40)]], "doc_id string, v string")
    every, refused = writers.append_corrections(old, new, spark.createDataFrame([("d",)], "doc_id string"))
    assert sorted(r["correction_id"] for r in every.collect()) == list(range(7, 50)) and refused.count() == 2
    assert writers.append_corrections(old.limit(0), new.limit(0), old)[0].count() == 0
    path = str(tmp_path / "emb")
    m = writers.matrices(spark.createDataFrame([("a", 1, [1.0, 2.0]), ("a", 0, [3.0, 4.0]), ("b", 0, None)], "doc_id string, token int, vector array<double>"))
    writers.upsert_table(spark, path, m, ["doc_id"])
    assert rows(writers.upsert_table(spark, path, m, ["doc_id"]).select("doc_id", retrieval.unpacked("matrix"))) == [("a", [[3.0, 4.0], [1.0, 2.0]])]
    kept, told = writers.refreshed(m, m.filter("false"), spark.createDataFrame([("a",), ("z",)], "doc_id string"))
    assert rows(told) == [("a", False), ("z", False)] and kept.count() == 1
    assert writers.corpus(m, ["a"]).count() == 0 and writers.corpus(m, m).count() == 0 and writers.corpus(m, []).count() == 1


def test_manifest_training_and_replies(spark, rows, tmp_path):
    m = spark.createDataFrame([("b", "business", "train", SHA, "k1"), ("a", "healthcare", "test", SHA, "k2"), ("a", "healthcare", "test", SHA, "k2")], "doc_id string, vertical string, split string, image_sha256 string, partition_key string")
    assert writers.write_manifest(m, str(tmp_path / "m")) == 2
    assert [json.loads(line)["doc_id"] for p in sorted((tmp_path / "m").glob("part*")) for line in p.read_text().splitlines()] == ["a", "b"]
    with pytest.raises(ValueError, match="k1"):
        writers.write_manifest(m.unionByName(m.filter("doc_id = 'b'").withColumn("split", F.lit("dev"))), str(tmp_path / "n"))
    assert not (tmp_path / "n").exists()
    assert writers.write_training(training.synthetic(spark), str(tmp_path / "t")) == {"synthetic_format_kind": 8}
    r = spark.createDataFrame([("tier2", SHA, "{}"), ("tier3", SHA, '{"a": 1}')], "provider string, image_sha256 string, reply string")
    for _ in range(2):
        writers.save_replies(r, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 2
    with pytest.raises(Exception, match="no name for a file"):
        writers.save_replies(r.withColumn("provider", F.lit("../x")), str(tmp_path / "r"))
    import hashlib

    sha = hashlib.sha256(b"png").hexdigest()
    f = spark.createDataFrame([(sha, bytearray(b"png")), (sha, bytearray(b"png"))], "image_sha256 string, content binary")
    for _ in range(2):
        assert [tuple(x) for x in writers.store_files(f, str(tmp_path), "/forms/", "png").collect()] == [(sha, f"{tmp_path}/forms/{sha}.png", 3)]
    assert [p.name for p in (tmp_path / "forms").iterdir()] == [f"{sha}.png"]
    with pytest.raises(Exception, match="another content"):
        writers.store_files(f.withColumn("image_sha256", F.lit(SHA)), str(tmp_path), "x", "png").collect()


def test_sources(spark, rows, tmp_path):
    (tmp_path / "train.json").write_text('["a", "b"]')
    known = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    assert [tuple(r) for r in files.split_index(spark, str(tmp_path / "train.json"), known).collect()] == [("a", 0), ("b", 1)]
    with pytest.raises(Exception, match="no annotation of b"):
        files.split_index(spark, str(tmp_path / "train.json"), known.filter("doc_id = 'a'")).collect()
    for bad in ('["a", 1]', '{"a": 1}', "[null]"):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception):
            files.split_index(spark, str(tmp_path / "bad.json"), known).collect()
    (tmp_path / "npy").mkdir()
    b = io.BytesIO()
    np.save(b, np.array([[1, 2], [3, 4]], dtype="f4"))
    (tmp_path / "npy" / f"{SHA}.npy").write_bytes(b.getvalue())
    (tmp_path / "npy" / "other.npy").write_bytes(b.getvalue())
    assert rows(files.cached_matrices(spark, str(tmp_path / "npy"))) == [(SHA, [[1.0, 2.0], [3.0, 4.0]])]
    with pytest.raises(Exception, match="no embedding of"):
        files.cached_matrices(spark, str(tmp_path / "npy"), spark.createDataFrame([("b" * 64,)], "image_sha256 string")).collect()
    (tmp_path / "lines.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert rows(files.json_lines(spark, str(tmp_path / "lines.jsonl"), "a int")) == [(1,), (2,)]
    df = spark.createDataFrame([("tier2", SHA), ("Bad/..", SHA), ("tier2", "x")], "p string, s string")
    assert [r[0] for r in df.select(files.cache_file(F.col("p"), F.col("s"))).collect()] == [f"tier2/{SHA}.json", None, None]
    assert files.is_live({"FIELDLOOM_LIVE": " Yes"}) and not files.is_live({"FIELDLOOM_LIVE": "0"}) and not files.is_live({})
    docs = spark.createDataFrame([("1",), ("2",)], "image_sha256 string")
    one = spark.createDataFrame([("1", "x")], "image_sha256 string, content string")
    assert rows(files.required(docs.filter("image_sha256 = '1'"), one, one.limit(0))) == [("1", "x", None)]
    with pytest.raises(Exception, match="no replay of 2"):
        files.required(docs, one, one).collect()
    assert rows(api.to_read(docs, one)) == [("2",)]


def test_cached_layouts_and_replies_become_forms(spark, tmp_path):
    d = spark.createDataFrame([("date_of_birth", "base", "date", ["Birth date"]), ("sex", "healthcare", "enum", ["Sex at birth"]), ("phone", "base", "string", ["Telephone"])], "canonical_name string, vertical string, data_type string, aliases array<string>")
    html = "<table><tr><td>Birth date</td><td>2. Sex at birth</td></tr><tr><td>4/7/1990</td><td>F</td></tr></table>"
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / f"{SHA}.json").write_text(json.dumps({"height": 1, "width": 1, "parsing_res_list": [{"block_bbox": [0, 0, 1, 1], "block_label": "table", "block_content": html}]}))
    (tmp_path / "l" / "notasha.json").write_text("{}")
    got = {r["field"]: (r["value"], r["confidence"], r["tier"], r["latency_ms"]) for r in files.layout_forms(spark, str(tmp_path / "l"), d).collect()}
    assert got == {"date_of_birth": ("4/7/1990", 0.9, "1", 0.0), "sex": ("F", 0.84, "1", 0.0)}
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / f"{SHA}.json").write_text(json.dumps({"message": {"role": "a", "content": '```json\n{"phone": " 555 ", "date_of_birth": "x"}\n```'}}))
    got = {r["field"]: (r["value"], r["confidence"], r["latency_ms"]) for r in files.typed(spark, str(tmp_path / "r"), "2", d).collect()}
    assert got == {"phone": ("555", 1.0, 0.0), "date_of_birth": (None, 0.0, 0.0), "sex": (None, 0.0, 0.0)}


def test_a_winner_of_another_type_is_dropped(spark):
    d = spark.createDataFrame([("date_of_birth", "base", "date", ["Birth date"])], "canonical_name string, vertical string, data_type string, aliases array<string>")
    o = spark.createDataFrame([("i", 0, "Birth date", "date_of_birth", "soon", 1.0, True, True, "soon"), ("i", 1, "Birth date", "date_of_birth", "1/2/2020", 0.5, True, False, "1/2/2020")], "image string, row_no int, label string, field string, value string, score double, aligned boolean, validates boolean, raw_text string")
    assert layout.best_offers(o, ["image"], d).count() == 0 and layout.best_offers(o, ["image"]).first()["value"] == "soon"


def test_block_matches(spark):
    d = spark.createDataFrame([("phone", "base", ["Telephone"]), ("sex", "healthcare", ["Sex at birth"])], "canonical_name string, vertical string, aliases array<string>")
    lines = ["Telephone: 555 1", "Telephone", "call our telephone - 555 2", "x " * 400 + "Sex at birth", "nothing", "Sex at birth: F"]
    got = {r["line"]: (r["field"], r["value"]) for r in layout.block_matches(spark.createDataFrame([(x,) for x in lines], "line string"), d).collect()}
    assert got == {"Telephone: 555 1": ("phone", "555 1"), "call our telephone - 555 2": ("phone", "555 2"), "Sex at birth: F": ("sex", "F")}
    real = layout.lines(table(spark, SF, "documents").select("doc_id", F.lit("text").alias("label"), F.col("text").alias("content")), ["doc_id"])
    known = table(spark, SF, "alias_dictionary")
    both = [sorted(map(tuple, layout.block_matches(real, known, held=n).collect()), key=repr) for n in (0, 10_000)]
    assert both[0] == both[1] and len(both[0]) > 100


def test_overlay_seed_and_sweep(spark, rows, tmp_path):
    d = spark.createDataFrame([("a", "healthcare", ["One", "Two"]), ("b", "base", [])], "canonical_name string, vertical string, aliases array<string>")
    assert files.overlay(spark, str(tmp_path / "none")).count() == 0
    more = spark.createDataFrame([("a", "healthcare", "Three"), ("b", "base", "Bee")], "field string, vertical string, alias string")
    more.write.parquet(str(tmp_path / "o"))
    assert files.overlay(spark, str(tmp_path / "o"), suppressed=True).count() == 0
    assert rows(dictionary.with_overlay(d, files.overlay(spark, str(tmp_path / "o")))) == [("a", "healthcare", 0, "One"), ("a", "healthcare", 1, "Two"), ("a", "healthcare", 2, "Three"), ("b", "base", 0, "Bee")]
    assert tuple(dictionary.totals(d).first()) == (2, 2)
    meta = "canonical_name string, vertical string, data_type string, description string, data_class string, sensitivity string, source_standard string"
    f = spark.createDataFrame([("n", "base", "string", "x", "phi", "low", None), ("n", "hr", "string", "x", "phi", "low", None), ("n", "healthcare", "string", "y", "phi", "low", None), ("m", "hr", "string", "x", "phi", "low", None), ("z", "odd", "string", "x", "phi", "low", None)], meta)
    lists = spark.createDataFrame([("n", "base", ["N"]), ("m", "hr", ["M"])], "canonical_name string, vertical string, aliases array<string>")
    assert [(r["canonical_name"], r["vertical"], r["aliases"]) for r in dictionary.build_seed(f, lists).collect()] == [("n", "base", ["N"]), ("n", "healthcare", ["N"]), ("m", "hr", ["M"]), ("z", "odd", [])]
    t = spark.createDataFrame([(1, "one two"), (2, "TWO"), (3, None)], "doc_id int, text string")
    assert rows(dictionary.sweep(t, d)) == [(1, 1, 1.0), (2, 1, 2.0), (2, 2, 1.0)]


def test_reply_rules():
    from fieldloom.functions.text import _read_reply

    cases = {'{"a": 1}': {"a": 1}, "[1]": {}, "3": {}, "": {}, None: {}, 'x ```json\n{"a": "}"}\n``` y': {"a": "}"}, 'so {"a": {"b": 2}} end': {"a": {"b": 2}}, "so {x} and {\"y\": 1}": {}, '{"a": 1': {}, "{" * 5000: {}, '{"a":' * 3000: {}}
    for text, want in cases.items():
        assert _read_reply(text) == want


def test_retries_of_failures_that_cannot_pass():
    def failing(*errors):
        left = list(errors)

        def call():
            if left:
                raise left.pop(0)
            return {"ok": 1}

        return attempt(call, sleep=lambda s: None)[0]

    assert failing(TimeoutError(), ValueError()) == {"ok": 1}  # its own retry stands whatever failed before
    assert failing(ValueError(), TimeoutError(), TimeoutError()) == {"ok": 1}
    assert failing(ValueError(), ValueError()) is None and failing(ValueError(), TimeoutError(), ValueError()) is None
    assert failing(*[TimeoutError()] * 4) is None and failing(*[TimeoutError()] * 3) == {"ok": 1}


def test_strongest_reader_is_the_last_that_read(spark):
    a = spark.createDataFrame([("d", "phone", "1", "1", 0.9), ("d", "phone", "2", "2", 0.9), ("d", "phone", "3a", "2", 0.9), ("d", "phone", "3b", None, 0.9), ("e", "phone", "3b", "9", 0.9)], "doc_id string, field_name string, tier string, value string, confidence double")
    r = {x["doc_id"]: x for x in reconcile.reconcile(reconcile.route(reconcile.by_reader(a))).collect()}
    assert r["d"]["t3_tier"] == "3b" and r["d"]["chosen"] == "2" and r["e"]["reader"] == "3b"
    assert set(reconcile.COVERED) < set(scoring.SCORABLE)


def test_metrics_in_one_pass_without_views(spark, rows):
    df = spark.createDataFrame([("a", "x", 1, 2, 3, 4), ("a", "y", 1, 0, 0, 0)], "s string, v string, tp int, fp int, fn int, blank int")
    one, two = metrics.summed(df, ["s", "v"], [["s"], ["s", "v"]]), metrics.summed(df.limit(0), ["s"], [["s"]])
    assert two.count() == 0 and sorted(r["tp"] for r in one.collect()) == [1, 1, 2]


def test_folding_table_is_what_python_says(spark):
    import duckdb
    import unicodedata

    texts = ["Ａｎｎ  Ｂ", "José", "Straße", "０４／０７／２０２０", "ﬁn x", "Σίσυφος", "ǅ", "½", "İstanbul", "Ꮳ", "　a b "]
    con = duckdb.connect()
    got = dict(con.execute(f"WITH {folding.folded('SELECT unnest($1) AS v')} SELECT v, f FROM folded", [texts]).fetchall())
    fold = lambda t: unicodedata.normalize("NFC", " ".join(unicodedata.normalize("NFKC", t).split()).casefold())
    assert got == {t: fold(t) for t in texts}


def test_application(spark, tmp_path, capsys):
    doc = table(spark, SF, "field_attempts").first()["doc_id"]
    out = api.run_document(spark, SF, doc)
    assert out["run"].count() == 1 and out["fields"].count() > 0 and out["run"].first()["routing_decision"].startswith("stage")
    assert {r["stage"] for r in api.score_document(spark, SF, doc).collect()} == set(scoring.STAGES)
    n = api.corrections_logged(spark, SF)
    made, new = api.submit_correction(spark, SF, {"doc_id": doc, "field_name": "sex", "corrected_value": "F", "learned_alias": " Anatomical sex "}, str(tmp_path / "s"))
    assert new and made == table(spark, SF, "correction_outcomes").agg(F.max("correction_id")).first()[0] + 1 and spark.read.parquet(str(tmp_path / "s/corrections")).count() == n + 1
    with pytest.raises(ValueError, match="no run of"):
        api.submit_correction(spark, SF, {"doc_id": "nobody"}, str(tmp_path / "s"))
    assert api.two_stage_f1(spark, SF).count() > 0 and all(x.count() for x in api.by_stage_summary(spark, SF))
    for args in (["by-stage"], ["query", "micro_f1"], ["document", doc], ["build-manifest", "--out", str(tmp_path / "m")], ["data", "--out", str(tmp_path / "t")], ["embed", "--out", str(tmp_path / "e")]):
        assert api.main([*args, "--tables", SF], spark) == 0
    assert api.main(["query", "none", "--tables", SF], spark) == 2 and api.main(["data", "--tables", SF], spark) == 2
    assert "F1" not in capsys.readouterr().err and api.hipaa_mode({"HIPAA_MODE": "true"})


def test_unchecked_queries_over_whole_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    m = unchecked.block_matches(spark, SF).collect()
    assert m and all(r["line"] in texts[r["doc_id"]] and r["value"] in r["line"] and r["alias"].upper() in r["line"].upper() for r in m)
    best = unchecked.best_readings(spark, SF).collect()
    assert best and len({(r["doc_id"], r["field"]) for r in best}) == len(best)
    assert set(catalogue.SQL) == set(catalogue.QUERIES)


def test_sidecar_files_round_trip(spark, tmp_path):
    s = table(spark, SF, "sidecars").filter("size(fields) = 11").limit(3)
    for r in s.toJSON().collect():
        x = json.loads(r)
        Path(tmp_path / f"{x.pop('doc_id')}.json").write_text(json.dumps(x))
    back = files.sidecars(spark, str(tmp_path))
    same = lambda df: sorted(map(tuple, flatten.sidecar_truth(df).collect()))
    assert same(back) == same(s)


def test_spread_stats_against_the_definition(spark):
    import random
    import statistics

    r = random.Random(4)
    groups = {"a": [r.lognormvariate(3, 2) for _ in range(501)], "b": [0.0] * 40 + [1.5, 2.5], "c": [5.0], "d": [1.0, 2.0], None: [0.0, 0.0, 9.0, 10.0]}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g string, x double")
    got = {x["g"]: (x["n"], x["mean"], x["median"], x["maximum"]) for x in metrics.spread_stats(df, ["g"], "x").collect()}
    assert got == {g: (len(xs), pytest.approx(statistics.mean(xs), abs=6e-4), pytest.approx(statistics.median(xs), abs=6e-4), pytest.approx(max(xs), abs=6e-4)) for g, xs in groups.items()}
    assert metrics.spread_stats(df.limit(0), ["g"], "x").count() == 0


def test_timing(spark):
    s = "eval_count long, eval_duration long, prompt_eval_count long, prompt_eval_duration long, load_duration long, total_duration long"
    t = {r["measure"]: (r["n"], r["mean"], r["median"], r["maximum"]) for r in metrics.timing(spark.createDataFrame([(10, 10**9, 3, 0, 0, 2 * 10**9), (30, 10**9, None, None, None, 4 * 10**9), (5, 0, 1, 1, 1, None)], s)).collect()}
    assert t["tokens_per_s"] == (2, 20.0, 20.0, 30.0) and t["seconds_per_call"] == (2, 3.0, 3.0, 4.0) and t["prompt_tokens"] == (2, 2.0, 2.0, 3.0)
    assert {r["mean"] for r in metrics.timing(spark.createDataFrame([], s)).collect()} <= {None}


def test_draws_chart_and_command_line_tables(spark):
    from fieldloom.functions import draws
    from fieldloom.plans import chart

    df = spark.range(2000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"))
    rows_ = df.select("k", draws.signature(F.col("k"), 7).alias("s")).select("k", "s.*").collect()
    assert rows_ == df.repartition(3).select("k", draws.signature(F.col("k"), 7).alias("s")).select("k", "s.*").orderBy(F.col("k").cast("int")).collect()
    assert abs(sum(r["mode"] == "typed" for r in rows_) / 2000 - draws.TYPED) < 0.04 and all(abs(r["rotation_deg"] or 0) <= draws.TURN for r in rows_)
    scores = spark.createDataFrame([("Tier 1", 0.5), ("Tier 1+2", 0.75)], "stage string, f1 double")
    funnel = spark.createDataFrame([(1, 2, 3, 4, 5)], "tier1 long, tier2 long, tier3 long, missed long, true_negative long")
    one = chart.svg(scores, funnel, "a < b")
    assert one == chart.svg(scores, funnel, "a < b") and "a &lt; b" in one and "0.750" in one and "15 cells" in one
    import xml.etree.ElementTree as ET

    ET.fromstring(one)
    text = "NAME      ID    PROCESSOR    CONTEXT\nm:7b      a1    100% GPU     4096\n\nn:32b     b2    22%/78% CPU/GPU 8192\n"
    assert chart.first_column(text) == ["m:7b", "n:32b"] and chart.under(text, "PROCESSOR", "m:7b") == "100% GPU"
    assert chart.under(text, "NONE", "m:7b") is None and chart.under("", "ID", "x") is None and chart.under(text, "ID", "zz") is None


def test_runs_and_generic_labels(spark, rows):
    a = spark.createDataFrame([("d", "phone", "1", "1", 0.9), ("d", "sex", "1", "F", 0.5), ("e", "phone", "1", None, 0.9)], "doc_id string, field_name string, tier string, value string, confidence double")
    done = reconcile.reconcile(reconcile.route(reconcile.by_reader(a)))
    assert rows(reconcile.run_records(done)) == [("d", "1", 0.7, "review_queue"), ("e", "1", 1.0, "extracted")]
    w = reconcile.route(reconcile.by_reader(spark.createDataFrame([("d", "first_name", t, v, 0.9) for t, v in (("1", "A"), ("2", "B"), ("3a", "B"))], a.schema)))
    assert [reconcile.reconcile(w, x).first()["rule_no"] for x in (None, F.lit(False), F.lit(True))] == [7, 4, 7]
    d = spark.createDataFrame([("a", "base", ["Name"]), ("b", "base", ["Name of pet"]), ("c", "base", ["Full name", "Chart"])], "canonical_name string, vertical string, aliases array<string>")
    p = spark.createDataFrame([("i", 0, "Name", "x", True), ("i", 0, "Chart", "y", True)], "image string, row_no int, label string, value string, aligned boolean")
    assert {r["label"]: r["generic"] for r in layout.offers(p, d, ["image"]).collect()} == {"Name": True, "Chart": False}


def test_packed_documents_are_ranked_where_they_lie(spark, monkeypatch):
    rng = np.random.default_rng(3)
    docs = [(f"d{i:02}", j, rng.normal(size=4).tolist()) for i in range(40) for j in range(1 + i % 3)]
    queries = [(f"q{i}", j, rng.normal(size=4).tolist()) for i in range(6) for j in range(1 + i % 2)]
    v = spark.createDataFrame(docs, "doc_id string, token int, vector array<double>").repartition(5)
    q = spark.createDataFrame(queries, "query string, token long, vector array<double>")
    want = {(r["query"], r["rank"]): r["doc"] for r in retrieval.top_k(retrieval.max_sim(v.select(F.col("doc_id").alias("doc"), "vector"), q), 3).collect()}
    for block in (1, 3, 4096):
        monkeypatch.setattr(retrieval, "BLOCK", block)
        assert {(r["query"], r["rank"]): r["doc"] for r in retrieval.nearest_packed(writers.matrices(v), q, 3).collect()} == want
    m = writers.matrices(v)
    assert retrieval.nearest_packed(m, q, 0).count() == 0 and retrieval.nearest_packed(m.limit(0), q, 2).count() == 0 and retrieval.nearest_packed(m, q.limit(0), 2).count() == 0
