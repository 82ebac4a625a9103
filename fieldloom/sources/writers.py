"""Writers: the store's tables, review rows, corrections, matrices, replies, manifests, training lines and content-addressed files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators import metrics, store
from fieldloom.operators.retrieval import packed
from fieldloom.runtime import Scratch, hadoop

# Columns of the store's tables.
DDL = {
    "runs": "doc_id string, vertical string, router_stage int, router_score double, final_tier string, final_confidence double, status string, total_latency_ms double, created_at timestamp_ntz",
    "field_attempts": "doc_id string, field_name string, tier string, value string, confidence double, escalation_reason string, latency_ms double",
    "review_queue": "doc_id string, error_history string, created_at timestamp_ntz",
    "corrections": "correction_id bigint, doc_id string, field_name string, original_value string, corrected_value string, tier_that_produced_original string, session_id string, created_at timestamp_ntz",
    "embeddings": "doc_id string, matrix binary, created_at timestamp_ntz",
    "eval_results": "doc_id string, batch_id int, seed_version string, stage string, vertical string, split string, tp int, fp int, fn int, blank_excluded int, latency_ms double, cost_usd double, created_at timestamp_ntz",
    "eval_batches": "batch_id int, seed_version string, git_sha string, stage string, doc_count int, tp int, fp int, fn int, precision double, recall double, f1 double, latency_p50_ms double, latency_p99_ms double, cost_per_doc_usd double, created_at timestamp_ntz",
}
STATUSES = ["extracted", "review_queue", "failed"]
PROVIDER = r"^[a-z0-9][a-z0-9_-]*\z"


def create_tables(spark: SparkSession, database: str, names: list[str] | None = None) -> list[str]:
    """Makes the store's tables where there are none yet, and gives their names; what is there stays. Keys and references are held by store.violations()."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = [f"{database}.{n}" for n in names or DDL]
    for n in made:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {n} ({DDL[n.split('.')[-1]]}) USING parquet")
    return made


def replace_table(df: DataFrame, path: str) -> None:
    """Puts df in the place of the table at path, which df may read: written beside it first, then moved, so a reader finds the old rows or the new ones."""
    spark = df.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").parquet(new)
    (target, fs), (fresh, _), (last, _) = hadoop(spark, path), hadoop(spark, new), hadoop(spark, old)
    fs.delete(last, True)
    if fs.exists(target):
        fs.rename(target, last)
    fs.rename(fresh, target)
    fs.delete(last, True)
    spark.catalog.refreshByPath(path)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, key: list[str]) -> DataFrame:
    """The table at path with the rows of new put in by key; an absent table counts as empty; rows of the table are never deleted."""
    there, fs = hadoop(spark, path)
    replace_table(store.upsert(spark.read.parquet(path), new, key) if fs.exists(there) else store.keep_latest(new, key, []), path)
    return spark.read.parquet(path)


def status_ok(c: Column) -> Column:
    """Whether a run's status is one that there is."""
    return F.coalesce(c.isin(*STATUSES), F.lit(False))


def review_rows(errors: DataFrame, order: str = "pos") -> DataFrame:
    """doc_id, error_history: a row a document, its errors (tier, error) in order as JSON; documents without errors have none. A later clean run doesn't take the row away, as upserts don't delete."""
    history = F.array_sort(F.collect_list(F.struct(order, "tier", "error")))
    e = errors.filter("doc_id is not null").groupBy("doc_id").agg(history.alias("h"))
    return e.select("doc_id", F.to_json(F.transform("h", lambda x: F.struct(x["tier"].alias("tier"), x["error"].alias("error")))).alias("error_history"))


def append_corrections(old: DataFrame, new: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old with the corrections of new under ids that go on from the largest, those of new whose document has no run).

    new has the columns of old but correction_id. Ids are given in order of all columns, by ranges of a sort and their sizes, so no task ranks all rows."""
    cols = [c for c in old.columns if c != "correction_id"]
    refused = store.orphans(new, "doc_id", runs, "doc_id").unionByName(new.filter("doc_id is null"))
    # written once, as sizes and ranks both read it, and what makes new may be dear
    fit = Scratch(old.sparkSession, "corrections").write(new.join(runs.select("doc_id").distinct(), "doc_id", "left_semi").select(*cols))
    first = old.agg(F.coalesce(F.max("correction_id"), F.lit(0))).first()[0]
    return old.unionByName(numbered(fit, cols, first).select(*old.columns)), refused


def numbered(df: DataFrame, order: list[str], first: int = 0, name: str = "correction_id") -> DataFrame:
    """df with ids first + 1, first + 2 ... in order. Rows are put into hash buckets of their order's columns; ranks within a bucket and the sums of the buckets before give the id."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    b = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(n)))
    sizes = b.groupBy("_b").agg(F.count("*").alias("n"))
    before = sizes.withColumn("_before", F.sum("n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))  # a row a bucket
    ranked = b.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(*order)))
    j = ranked.join(F.broadcast(before.select("_b", F.coalesce("_before", F.lit(0)).alias("_before"))), "_b")
    return j.withColumn(name, (F.col("_r") + F.col("_before") + F.lit(first)).cast("long")).drop("_b", "_r", "_before")


def matrices(vectors: DataFrame, doc: str = "doc_id", token: str = "token", vector: str = "vector") -> DataFrame:
    """doc_id, matrix: each document's vectors, in order of token, as one packed matrix; null vectors are left out."""
    rows = vectors.filter(F.col(vector).isNotNull()).groupBy(F.col(doc).cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct(F.col(token).alias("t"), F.col(vector).alias("v"))))["v"].alias("m"))
    return rows.select("doc_id", packed("m").alias("matrix"))


def refreshed(old: DataFrame, found: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(embeddings with those found (doc_id, matrix) for the asked documents put in, doc_id and whether each asked one was refreshed); one without an embedding stays as it was."""
    mine = found.join(asked.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "matrix")
    told = asked.select("doc_id").distinct().join(mine.select("doc_id", F.lit(True).alias("r")), "doc_id", "left").select("doc_id", F.coalesce("r", F.lit(False)).alias("refreshed"))
    return store.upsert(old.select("doc_id", "matrix"), mine, ["doc_id"]), told


def corpus(embeddings: DataFrame, exclude: list[str] | DataFrame) -> DataFrame:
    """embeddings without the documents of exclude, a list or a table with doc_id."""
    if isinstance(exclude, DataFrame):
        return embeddings.join(exclude.select("doc_id").distinct(), "doc_id", "left_anti")
    return embeddings.filter(~F.col("doc_id").isin(*exclude)) if exclude else embeddings


def save_replies(replies: DataFrame, root: str) -> None:
    """Writes raw replies (provider, image_sha256, reply as JSON text) into a folder a provider, over what was there for it; a provider's name or a sha that isn't fit for a file raises."""
    fit = F.col("provider").rlike(PROVIDER) & F.col("image_sha256").rlike(r"^[0-9a-f]{64}\z")
    sure = F.when(F.coalesce(fit, F.lit(False)), F.col("provider")).otherwise(F.raise_error(F.concat(F.lit("no name for a file: "), F.coalesce("provider", F.lit("null")))).cast("string"))
    spark = replies.sparkSession
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        replies.select(sure.alias("provider"), "image_sha256", "reply").write.mode("overwrite").partitionBy("provider").json(root)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)


def manifest_rows(entries: DataFrame) -> DataFrame:
    """The rows of a manifest as it is written: doc_id, vertical, split, image_sha256, one a document, in order of doc_id."""
    return entries.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct("vertical", "split", "image_sha256")).alias("e")).select("doc_id", "e.vertical", "e.split", "e.image_sha256").orderBy("doc_id")


def write_manifest(entries: DataFrame, path: str, key: str = "partition_key") -> int:
    """Writes manifest_rows() as JSON lines, in order, and gives their number. Keys in more than one split are refused, with the first of them named; nothing is written then, and nothing tells the time."""
    bad = metrics.mixed_keys(entries, key, "split").orderBy(key).limit(5).collect()
    if bad:
        raise ValueError(f"in several splits: {', '.join(str(r[0]) for r in bad)}")
    rows = manifest_rows(entries)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return entries.sparkSession.read.text(path).count()


def write_training(examples: DataFrame, path: str) -> dict[str, int]:
    """Writes examples as JSON lines and gives their number by source."""
    examples.write.mode("overwrite").json(path)
    return dict(map(tuple, examples.sparkSession.read.schema(examples.schema).json(path).groupBy("source").agg(F.count("*")).collect()))


def store_files(files: DataFrame, root: str, prefix: str, suffix: str, write: Callable[[str, bytes], None] | None = None) -> DataFrame:
    """image_sha256, path, bytes of files (image_sha256, content) copied to <root>/<prefix>/<sha>.<suffix>, each content once; a content that isn't of its sha raises. Writing again gives the same.

    The tasks write where their content lies. write(path, content) puts a file in place; without it root is a folder that all executors share."""
    one = files.filter("image_sha256 is not null").dropDuplicates(["image_sha256"])
    sure = F.when(F.sha2("content", 256) == F.col("image_sha256"), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("another content than "), F.col("image_sha256"))).cast("binary"))
    named = one.select("image_sha256", store.content_path(F.col("image_sha256"), root, prefix, suffix).alias("path"), sure.alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                (write or _write_file)(path, bytes(content))
            yield pd.DataFrame({"image_sha256": b["image_sha256"], "path": b["path"], "bytes": [len(c) for c in b["content"]]})

    schema = T.StructType([T.StructField("image_sha256", T.StringType()), T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType())])
    return named.mapInPandas(run, schema)


def _write_file(path: str, content: bytes) -> None:
    """Writes beside the place and moves there, so a file is whole or not there."""
    import os
    import uuid

    path = path.removeprefix("file://")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    beside = f"{path}.{uuid.uuid4().hex}"
    with open(beside, "wb") as f:
        f.write(content)
    os.replace(beside, path)
