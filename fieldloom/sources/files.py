"""Readers of the file formats of a corpus, with explicit schemas."""

from __future__ import annotations

import io
import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.text import is_sha256, reply_fields
from fieldloom.operators import forms, layout
from fieldloom.operators.flatten import ANNOTATION, BUNDLE
from fieldloom.runtime import hadoop
from fieldloom.sources.writers import PROVIDER

BLOCKS = "height int, width int, page_size_px array<int>, parsing_res_list array<struct<block_bbox array<double>, block_label string, block_content string>>"
REPLY = "model string, done boolean, eval_count bigint, eval_duration bigint, total_duration bigint, message struct<role string, content string>"
SIDECAR = (
    "schema_version int, image string, image_sha256 string, source_id string, page struct<number int, width_px int, height_px int>, signature struct<mode string, font string, rotation_deg double>,"
    " fields array<struct<name string, cms1500_box string, value string, bbox struct<x1 double, y1 double, x2 double, y2 double>>>"
)


def _json(spark: SparkSession, path: str, schema: str, name: str) -> DataFrame:
    """Whole-file JSON with the stem of the file as a column."""
    df = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    return df.withColumn(name, F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1))


def layout_blocks(spark: SparkSession, path: str) -> DataFrame:
    """image_sha256, block_pos, label, content, bbox of the blocks of cached layouts; files not named by a sha are left out."""
    d = _json(spark, path, BLOCKS, "image_sha256").filter(is_sha256(F.col("image_sha256")))
    b = d.select("image_sha256", F.posexplode("parsing_res_list").alias("block_pos", "b"))
    return b.select("image_sha256", "block_pos", F.col("b.block_label").alias("label"), F.col("b.block_content").alias("content"), F.col("b.block_bbox").alias("bbox"))


def replies(spark: SparkSession, path: str, tier: str) -> DataFrame:
    """image_sha256, tier, field, value, confidence of a reader's cached replies: a blank value is a confident blank."""
    d = _json(spark, path, REPLY, "image_sha256").filter(is_sha256(F.col("image_sha256")))
    kv = d.select("image_sha256", F.explode(reply_fields(F.col("message.content"))).alias("field", "value"))
    return kv.select("image_sha256", F.lit(tier).alias("tier"), "field", F.nullif(F.trim("value"), F.lit("")).alias("value"), F.lit(1.0).alias("confidence"))


def cache_file(provider: Column, sha: Column) -> Column:
    """<provider>/<sha>.json; null for a provider's name that isn't fit for a file, or what is no sha."""
    return F.when(provider.rlike(PROVIDER) & is_sha256(sha), F.concat(provider, F.lit("/"), sha, F.lit(".json")))


def is_live(env: dict[str, str] | None = None, name: str = "FIELDLOOM_LIVE") -> bool:
    """Whether live reading is switched on: by 1, true, yes, y or on, in any case."""
    return ((os.environ if env is None else env).get(name) or "").strip().lower() in ("1", "true", "yes", "y", "on")


def typed(spark: SparkSession, path: str, tier: str, dictionary: DataFrame) -> DataFrame:
    """image_sha256, field, value, confidence, tier, latency_ms (0, as they are cached) of a prompted reader's replies, as typed_replies() reads them."""
    d = _json(spark, path, REPLY, "image_sha256").filter(is_sha256(F.col("image_sha256"))).select("image_sha256", F.col("message.content").alias("content"))
    return forms.typed_replies(d, dictionary, tier, "image_sha256").withColumn("latency_ms", F.lit(0.0))


def layout_forms(spark: SparkSession, path: str, dictionary: DataFrame) -> DataFrame:
    """image_sha256, field, value, confidence, tier, latency_ms (0) of cached layouts read into forms: tables to cells, cells to pairs, pairs and cells to offers, and the best offer of each field."""
    blocks = layout_blocks(spark, path).filter("label = 'table'").select("image_sha256", "block_pos", "content")
    key = ["image_sha256", "block_pos"]
    grid = layout.cells(blocks)
    offered = layout.offers(layout.table_pairs(grid, key), dictionary, key, grid)
    best = layout.best_offers(offered, ["image_sha256"], dictionary)
    return best.select("image_sha256", "field", "value", "confidence", F.lit("1").alias("tier"), F.lit(0.0).alias("latency_ms"))


def split_index(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """doc_id, pos of a split's index, a JSON list of ids, in its order. An id that isn't a text, or has no annotation in known (doc_id), raises; so does a file that isn't a list, or isn't there."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>", {"mode": "FAILFAST"}).alias("ids"), F.regexp_like("value", F.lit(r"^\s*\[\s*(?:\"(?:[^\"\\]|\\.)+\"\s*,?\s*)*\]\s*\z")).alias("texts"))
    ids = F.when(F.col("texts"), F.col("ids")).otherwise(F.raise_error(F.lit("a split's index is a list of ids")).cast("array<string>"))
    each = text.select(F.posexplode(ids).alias("pos", "doc_id"))
    j = each.join(known.select("doc_id", F.lit(True).alias("there")).distinct(), "doc_id", "left")
    sure = F.when(F.col("there"), F.col("doc_id")).otherwise(F.raise_error(F.concat(F.lit("no annotation of "), F.col("doc_id"))).cast("string"))
    return j.select(sure.alias("doc_id"), "pos").orderBy("pos")


def cached_matrices(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """image_sha256, matrix (arrays of floats) of .npy files named by a sha. wanted: image_sha256 of documents that must have one; one without raises, as there is no live embedding here."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def load(s: pd.Series) -> pd.Series:
        return s.map(lambda b: np.load(io.BytesIO(b), allow_pickle=False).astype("<f4").tolist())

    d = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path)
    d = d.select(F.regexp_extract("path", r"([^/]*)\.npy$", 1).alias("image_sha256"), "content").filter(is_sha256(F.col("image_sha256")))
    found = d.select("image_sha256", load("content").alias("matrix"))
    if wanted is None:
        return found
    j = wanted.select("image_sha256").distinct().join(found, "image_sha256", "left")
    sure = F.when(F.col("matrix").isNotNull(), F.col("image_sha256")).otherwise(F.raise_error(F.concat(F.lit("no embedding of "), F.col("image_sha256"))).cast("string"))
    return j.select(sure.alias("image_sha256"), "matrix")


def required(documents: DataFrame, must: DataFrame, may: DataFrame, key: str = "image_sha256") -> DataFrame:
    """documents with a replay of must, and where there is one of may, as columns must and may (both: key, content); a document without the first raises."""
    j = documents.join(must.select(key, F.col("content").alias("must")), key, "left").join(may.select(key, F.col("content").alias("may")), key, "left")
    sure = F.when(F.col("must").isNotNull(), F.col("must")).otherwise(F.raise_error(F.concat(F.lit("no replay of "), F.col(key))).cast("string"))
    return j.withColumn("must", sure)


def overlay(spark: SparkSession, path: str, suppressed: bool = False) -> DataFrame:
    """field, vertical, alias of the learned aliases at path; none where the folder is absent or suppressed. A snapshot: what is read is what was there."""
    schema = "field string, vertical string, alias string"
    there, fs = hadoop(spark, path)
    if suppressed or not fs.exists(there):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def cached(documents: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with a cached reading, documents without), by image_sha256."""
    keys = found.select("image_sha256").distinct()
    return documents.join(keys, "image_sha256", "left_semi"), documents.join(keys, "image_sha256", "left_anti")


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, SIDECAR, "doc_id")


def bundles(spark: SparkSession, path: str) -> DataFrame:
    """Patient bundles; files about hospitals and practitioners are left out."""
    return _json(spark, path, BUNDLE, "bundle").filter(~F.col("bundle").rlike("^(hospital|practitioner)Information"))


def annotations(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, ANNOTATION, "file")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def pairs(images: DataFrame, sidecars_: DataFrame, key: str = "stem") -> DataFrame:
    """key, has_image, has_sidecar of what has only one of both."""
    j = images.select(key, F.lit(True).alias("i")).distinct().join(sidecars_.select(key, F.lit(True).alias("s")).distinct(), key, "full_outer")
    return j.select(key, F.coalesce("i", F.lit(False)).alias("has_image"), F.coalesce("s", F.lit(False)).alias("has_sidecar")).filter("not (has_image and has_sidecar)")
