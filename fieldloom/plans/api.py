"""Thin functions over the operators, as an application calls them, and the command line on top."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.text import stripped
from fieldloom.operators import dictionary as D
from fieldloom.operators import forms, reconcile, scoring, store
from fieldloom.plans import catalogue, scored, stored, unchecked
from fieldloom.runtime import session, table
from fieldloom.sources import writers


def run_document(spark: SparkSession, d: str, doc_id: str) -> dict[str, DataFrame]:
    """One document's run: its run record with the routing decision, its fields as they are shown, its attempts, and whether it is parked and why. All of it is a filter on doc_id that reaches the scans."""
    mine = lambda name: table(spark, d, name).filter(F.col("doc_id") == doc_id)
    resolved = reconcile.reconcile(reconcile.route(reconcile.by_reader(mine("field_attempts"))))
    shown = resolved.select("doc_id", F.col("field_name").alias("field"), F.col("chosen").alias("value"), "confidence", F.col("reader").alias("tier"))
    return {
        "run": forms.stamped(store.keep_latest(mine("runs"), ["doc_id"], ["created_at"])), "fields": forms.field_rows(shown), "attempts": mine("field_attempts").distinct(), "review": reconcile.parked(resolved),
    }


def score_document(spark: SparkSession, d: str, doc_id: str) -> DataFrame:
    """stage, tp, fp, fn, blank and the rates of one document in the three configurations of readers."""
    truth = scoring.correction_truth(table(spark, d, "correction_outcomes").filter(F.col("doc_id") == doc_id), scoring.SCORABLE)
    docs = table(spark, d, "runs").filter(F.col("doc_id") == doc_id)
    return scoring.score_forms(scoring.stage_forms(table(spark, d, "field_attempts").filter(F.col("doc_id") == doc_id)), truth, docs)


def submit_correction(spark: SparkSession, d: str, correction: dict, folder: str) -> tuple[int, bool]:
    """Appends a correction (doc_id, field_name, corrected_value, learned_alias ...) to the table in folder and learns its phrasing as an alias there; gives its id and whether the alias was new.

    A document without a run is refused."""
    old = table(spark, d, "correction_outcomes")
    new = spark.createDataFrame([{c: correction.get(c) for c in old.columns if c != "correction_id"}], old.drop("correction_id").schema)
    every, refused = writers.append_corrections(old, new, table(spark, d, "runs"))
    if refused.count():
        raise ValueError(f"no run of {correction.get('doc_id')}")
    known = D.learned(new.withColumn("learned_alias", stripped(F.col("learned_alias"))), table(spark, d, "alias_dictionary"))
    aliases = known.collect()  # a row a vertical that has the field
    writers.replace_table(every, f"{folder}/corrections")
    if aliases:
        writers.upsert_table(spark, f"{folder}/aliases", known.select("field", "vertical", "alias"), ["field", "vertical", "alias"])
    return spark.read.parquet(f"{folder}/corrections").agg(F.max("correction_id")).first()[0], bool(aliases)


def two_stage_f1(spark: SparkSession, d: str) -> DataFrame:
    """First, last and mean F1 of each release and stage over its batches."""
    return catalogue.two_stage(spark, d)


def by_stage_summary(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(scores by stage, funnel of the cells)."""
    return scored.by_stage(spark, d), scored.truth_funnel(spark, d)


def corrections_logged(spark: SparkSession, d: str) -> int:
    return table(spark, d, "correction_outcomes").count()


def to_read(documents: DataFrame, cached: DataFrame) -> DataFrame:
    """documents without a cached reading, by image_sha256: what is left to do for a run that goes on where an earlier one stopped."""
    return documents.join(cached.select("image_sha256").distinct(), "image_sha256", "left_anti")


def hipaa_mode(env: dict[str, str]) -> bool:
    """Whether the flag is set; it changes nothing."""
    return (env.get("HIPAA_MODE") or "").strip().lower() in ("1", "true", "yes", "on")


def _manifest(spark: SparkSession, d: str, out: str) -> DataFrame:
    from fieldloom.operators import pages

    entries = pages.manifest_of(table(spark, d, "sidecars"), "healthcare")
    writers.write_manifest(entries, out)
    return entries.groupBy("split").agg(F.count("*").alias("n"))


def _data(spark: SparkSession, d: str, out: str) -> DataFrame:
    counts = writers.write_training(scored.training_pairs(spark, d), out)
    return spark.createDataFrame(sorted(counts.items()), "source string, n long")


def _embed(spark: SparkSession, d: str, out: str) -> DataFrame:
    new = writers.matrices(table(spark, d, "embeddings"), "label", "vec_id", "embedding")
    return writers.upsert_table(spark, out, new, ["doc_id"]).agg(F.count("*").alias("documents"))


#: Commands and what they show; those that write take --out.
COMMANDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "run": catalogue.f1_over_time, "by-stage": scored.by_stage, "funnel": scored.truth_funnel, "correct": scored.replayed_corrections, "eval": scored.f1_change, "review": stored.review_rows,
}
WRITERS: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {"build-manifest": _manifest, "data": _data, "embed": _embed}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """fieldloom COMMAND --tables FOLDER [--out FOLDER], fieldloom query NAME --tables FOLDER [--out FOLDER]; spark-submit takes the same. Gives 0, or 2 where the command needs what is missing."""
    p = argparse.ArgumentParser(prog="fieldloom")
    p.add_argument("command", choices=[*COMMANDS, *WRITERS, "query", "document"])
    p.add_argument("name", nargs="?")
    p.add_argument("--tables", required=True)
    p.add_argument("--out")
    p.add_argument("--rows", type=int, default=20)
    a = p.parse_args(argv)
    spark = spark or SparkSession.getActiveSession() or session("fieldloom")
    if a.command in WRITERS:
        if not a.out:
            print(f"{a.command} needs --out", file=sys.stderr)
            return 2
        WRITERS[a.command](spark, a.tables, a.out).show(a.rows, truncate=False)
        return 0
    if a.command == "document":
        if not a.name:
            print("document needs an id", file=sys.stderr)
            return 2
        for title, df in run_document(spark, a.tables, a.name).items():
            print(title)
            df.show(a.rows, truncate=False)
        return 0
    every = catalogue.QUERIES | unchecked.QUERIES
    if a.command == "query" and a.name not in every:
        print(f"queries: {', '.join(sorted(every))}", file=sys.stderr)
        return 2
    df = (every[a.name] if a.command == "query" else COMMANDS[a.command])(spark, a.tables)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.rows, truncate=False)
    return 0
