"""Annotated documents page by page: sizes, sidecars, fan-out with a limit on documents, and manifests from sidecars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import hash_split, partition_key

# Fixed value: version of a sidecar's layout.
VERSION = 1


def page_sizes(sizes: Column, page_count: Column, where: Column) -> Column:
    """The sizes of a document's pages, checked: as many as pages, each of two positive numbers; anything else raises with where it was."""
    ok = (F.size(sizes) == page_count) & F.forall(sizes, lambda s: (F.size(s) == 2) & F.forall(s, lambda x: x > 0))
    return F.when(F.coalesce(ok, F.lit(False)), sizes).otherwise(F.raise_error(F.concat(F.lit("bad page sizes in "), F.coalesce(where, F.lit("?")))).cast("array<array<int>>"))


def has_size(page: Column) -> Column:
    """Whether a sidecar's page has a positive width and height."""
    return F.coalesce((page["width_px"] > 0) & (page["height_px"] > 0), F.lit(False))


def page_rows(docs: DataFrame, rendered: DataFrame, limit: int | None = None) -> DataFrame:
    """doc_id, page_number (from 1), image, image_sha256, width_px, height_px of documents of several pages.

    docs: doc_id, page_count, and pos, in whose order limit counts documents, not pages (none or 0: all; below 0 raises). rendered: doc_id, page_number, image, image_sha256, width_px, height_px.
    A document with another number of rendered pages than it should have raises."""
    if limit is not None and limit < 0:
        raise ValueError(f"limit {limit}")
    if limit:
        docs = docs.orderBy("pos").limit(limit)
    n = rendered.groupBy("doc_id").agg(F.count("*").alias("n"))
    told = docs.join(n, "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sure = F.when(F.col("n") == F.col("page_count"), F.col("doc_id")).otherwise(F.raise_error(F.concat(F.lit("page count mismatch for "), F.col("doc_id"))).cast("string"))
    # the check is part of the key, so it can't be planned away
    return told.select(sure.alias("doc_id")).join(rendered, "doc_id").select("doc_id", "page_number", "image", "image_sha256", "width_px", "height_px")


def page_sidecars(pages: DataFrame, fields: DataFrame, split: str) -> DataFrame:
    """A sidecar a page: schema_version, image, image_sha256, source_id (doc-p1), page and the page's fields in order, an empty array for a page without any.

    pages: page_rows(). fields: doc_id, page (from 1), pos, fieldtype, text, box, as of flatten.annotated_fields()."""
    on = fields.groupBy("doc_id", F.col("page").alias("page_number")).agg(F.array_sort(F.collect_list(F.struct("pos", "fieldtype", F.col("box").alias("bbox"), "text"))).alias("f"))
    j = pages.join(on, ["doc_id", "page_number"], "left")
    listed = F.coalesce(F.transform("f", lambda x: F.struct(x["fieldtype"].alias("fieldtype"), x["bbox"].alias("bbox"), x["text"].alias("text"))), F.array().cast("array<struct<fieldtype string, bbox array<double>, text string>>"))
    return j.select(
        F.lit(VERSION).alias("schema_version"), "image", "image_sha256", F.concat("doc_id", F.lit("-p"), F.col("page_number").cast("string")).alias("source_id"),
        F.struct(F.col("page_number").alias("number"), "width_px", "height_px").alias("page"),
        F.struct("doc_id", F.lit(split).alias("split"), "page_number", listed.alias("fields")).alias("annotated"),
    )


def label_of(fields: Column, stem: Column, name: str = "patient_name") -> Column:
    """The first value of the field name that isn't blank, else the file's stem."""
    values = F.transform(F.filter(fields, lambda f: (f["name"] == name) & (F.trim(f["value"]) != "")), lambda f: f["value"])
    return F.coalesce(F.get(values, F.lit(0)), stem)


def manifest_of(sidecars: DataFrame, vertical: str, split: str | None = None) -> DataFrame:
    """doc_id, vertical, partition_key, split, image_sha256, one row a document, the smallest sha counting: all of split, or by the hash of the partition key. No sidecars at all raise when it is read."""
    one = sidecars.filter("doc_id is not null").groupBy("doc_id").agg(F.min("image_sha256").alias("image_sha256")).withColumn("vertical", F.lit(vertical))
    one = one.withColumn("partition_key", partition_key(F.col("doc_id"), F.col("vertical")))
    return one.select("doc_id", "vertical", "partition_key", (F.lit(split) if split else hash_split(F.col("partition_key"))).alias("split"), "image_sha256")


def of_split(manifest: DataFrame, split: str, present: DataFrame, limit: int | None = None, refuse: bool = True) -> DataFrame:
    """doc_id, image_sha256 of the documents of a split in order of doc_id, the first limit of them. present: doc_id, image_sha256 of the files there are.

    A document without its file raises if refuse, else it is left out."""
    docs = manifest.filter(F.lower(F.trim("split")) == split).select("doc_id").distinct()
    files = present.groupBy("doc_id").agg(F.min("image_sha256").alias("image_sha256"), F.lit(True).alias("there"))
    j = docs.join(files, "doc_id", "left" if refuse else "inner")
    if refuse:
        j = j.withColumn("image_sha256", F.when(F.col("there"), F.col("image_sha256")).otherwise(F.raise_error(F.concat(F.lit("no file of "), F.col("doc_id"))).cast("string")))
    j = j.select("doc_id", "image_sha256").orderBy("doc_id")
    return j.limit(limit) if limit else j


def first_of(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The first n rows of each group by order; n below 1 raises."""
    if n < 1:
        raise ValueError(f"the first {n}")
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(order))).filter(F.col("_r") <= n).drop("_r")
