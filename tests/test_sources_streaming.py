import json

from pyspark.sql import functions as F

from fieldloom.sources import files
from fieldloom.streaming import feedback

SHA = "ab" * 32


def test_file_sources(spark, rows, tmp_path):
    for name, content in {
        f"layout/{SHA}.json": {"height": 9, "parsing_res_list": [{"block_bbox": [0, 0, 1, 1], "block_label": "text", "block_content": "x"}]}, "layout/other.json": {"parsing_res_list": []},
        f"tier2/{SHA}.json": {"message": {"content": '{"a": "1", "b": " "}'}}, "bundles/p1.json": {"entry": [{"resource": {"resourceType": "Patient", "id": "p"}}]}, "bundles/hospitalInformation1.json": {"entry": []},
        "side/d-1.json": {"schema_version": 1, "image": "d-1.png", "image_sha256": SHA, "source_id": "d", "fields": []},
    }.items():
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text(json.dumps(content, indent=1))
    assert rows(files.layout_blocks(spark, str(tmp_path / "layout")).select("image_sha256", "label", "content")) == [(SHA, "text", "x")]
    r = files.replies(spark, str(tmp_path / "tier2"), "2")
    assert rows(r.select("tier", "field", "value")) == [("2", "a", "1"), ("2", "b", None)]
    assert files.bundles(spark, str(tmp_path / "bundles")).count() == 1
    docs = spark.createDataFrame([("d", SHA), ("e", "0")], "doc_id string, image_sha256 string")
    hit, miss = files.cached(docs, r)
    assert (rows(hit.select("doc_id")), rows(miss.select("doc_id"))) == ([("d",)], [("e",)])
    s = files.sidecars(spark, str(tmp_path / "side"))
    assert s.first()["doc_id"] == "d-1"
    assert rows(files.pairs(spark.createDataFrame([("d-1",), ("x",)], "stem string"), s.select(F.col("doc_id").alias("stem")))) == [("x", True, False)]


def test_learning_stream(spark, rows, tmp_path):
    d = spark.createDataFrame([("c", "hr", ["Chart"])], "canonical_name string, vertical string, aliases array<string>")
    schema = "field_name string, learned_alias string, created_at timestamp"
    source, overlay = str(tmp_path / "in"), str(tmp_path / "overlay")
    seen = []

    def run():
        c = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        feedback.learn(spark, c, d, overlay, str(tmp_path / "check"), lambda known, n: seen.append(known.count())).awaitTermination()

    put = lambda *v: spark.createDataFrame([(f, a, None) for f, a in v], schema).coalesce(1).write.mode("append").parquet(source)
    put(("c", "card"), ("C ", "CARD"), ("c", "chart"), ("c", None), ("zz", "q"))
    run()
    put(("c", "Card"), ("c", "file no"))
    run()
    assert rows(spark.read.option("recursiveFileLookup", True).parquet(overlay).select("field", "alias")) == [("c", "CARD"), ("c", "file no")]
    assert seen == [1, 2]


def test_windows_and_sessions(spark, rows):
    e = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 10:05:00', 'a', 2.0D), (1, TIMESTAMP '2024-01-01 10:20:00', 'a', 3.0D), (1, TIMESTAMP '2024-01-01 12:00:00', 'a', 1.0D) t(user_id, ts, event_type, value)")
    assert [(n, t) for _, _, n, t in rows(feedback.windowed(e))] == [(2, 5.0), (1, 1.0)]
    assert sorted(r["n"] for r in feedback.sessions(e).collect()) == [1, 2]
