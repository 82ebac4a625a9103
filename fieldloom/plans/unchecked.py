"""Registered queries of the core that SQL can't express; they are held against brute force in the tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators import forms, layout
from fieldloom.runtime import spread, table

Query = Callable[[SparkSession, str], DataFrame]


def document_replies(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, fields: the fields of each document's text read as a reader's reply, as JSON; {} where it holds no object."""
    r = spread(table(spark, d, "documents").select("doc_id", "text"))
    return r.select("doc_id", F.to_json(X.reply_fields(F.col("text")), {"ignoreNullFields": "false"}).alias("fields"))


def typed_replies(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, field, value, confidence, tier: each document read as a reader's reply to the fields of a health form, field by field."""
    r = spread(table(spark, d, "documents").select("doc_id", F.col("text").alias("content")))
    asked = table(spark, d, "alias_dictionary").filter("vertical IN ('base', 'healthcare')")
    return forms.typed_replies(r, asked, "2")


def block_matches(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, line, field, vertical, alias, score, value: each line of a document that holds a known label and goes on with a value."""
    lines = layout.lines(table(spark, d, "documents").select("doc_id", F.lit("text").alias("label"), F.col("text").alias("content")), ["doc_id"])
    return layout.block_matches(lines, table(spark, d, "alias_dictionary"))


def best_readings(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, field, value, confidence: the best reading of each field over the lines of a document, each taken as a cell that holds its own label and value."""
    lines = layout.lines(table(spark, d, "documents").select("doc_id", F.lit("text").alias("label"), F.col("text").alias("content")), ["doc_id"])
    grid = lines.select("doc_id", F.lit(0).alias("row_no"), F.col("line").alias("text"))
    none = grid.limit(0).select("doc_id", "row_no", F.col("text").alias("label"), F.col("text").alias("value"), F.lit(True).alias("aligned"))
    known = table(spark, d, "alias_dictionary")
    best = layout.best_offers(layout.offers(none, known, ["doc_id"], spread(grid)), ["doc_id"], known)
    return best.select("doc_id", "field", "value", "confidence")


QUERIES: dict[str, Query] = {f.__name__: f for f in (document_replies, typed_replies, block_matches, best_readings)}
