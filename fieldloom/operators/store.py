"""Keep-latest upserts, declared constraints and content-addressed paths."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tables of the store: key, parent (column, table, column) and checks.
TABLES: dict[str, dict] = {
    "manifest_entries": {"key": ["doc_id"], "parents": []},
    "runs": {"key": ["doc_id"], "parents": [("doc_id", "manifest_entries", "doc_id")]},
    "field_attempts": {"key": ["doc_id", "field_name", "tier"], "parents": [("doc_id", "runs", "doc_id")]},
    "eval_results": {"key": ["doc_id", "batch_id", "seed_version", "stage"], "parents": [("doc_id", "runs", "doc_id")]},
    "eval_batches": {"key": ["batch_id", "seed_version", "git_sha", "stage"], "parents": []},
    "correction_outcomes": {"key": ["correction_id"], "parents": [("doc_id", "runs", "doc_id")]},
}


def keep_latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order, as an upsert leaves it; rows equal in order are told apart by their other columns, so the outcome is fixed.

    One aggregate: max of a struct, with partial aggregation, so a key of very many rows is reduced where it lies."""
    rest = [c for c in df.columns if c not in key]
    by = order + [c for c in rest if c not in order]
    last = df.groupBy(*key).agg(F.max(F.struct(*by)).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col("_last")[c].alias(c) for c in df.columns])


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of new put in by key: rows of new replace, keys only in old stay."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_latest(both, key, ["_new"]).drop("_new")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows of child whose value has no row in parent; nulls are no reference."""
    ids = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(ids, column, "left_anti")


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """check, n: for each table how many keys repeat, for each reference how many rows have no parent, and for stages and counts how many rows break the rule.

    A table is brought together by its key for its repeats only; values are counted where they lie, and a reference is checked by the rows' counts a parent, which are summed up where they lie, as rows of one parent mostly do."""
    out = []
    row = lambda name, df, n: df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("n")).select(F.lit(name).alias("check"), "n")
    for name, spec in TABLES.items():
        if name not in tables:
            continue
        checked = name in ("eval_results", "eval_batches")
        bad = F.coalesce(~F.col("stage").isin("tier1", "cascade") | (F.least("tp", "fp", "fn") < 0), F.lit(True)) if checked else F.lit(False)
        out.append(row(f"key {name}", tables[name].groupBy(*spec["key"]).agg(F.count("*").alias("_n")).filter("_n > 1"), F.count("*")))
        out += [row(f"parent {name}.{c}", orphans(tables[name].groupBy(c).agg(F.count("*").alias("_n")), c, tables[t], pc), F.sum("_n")) for c, t, pc in spec["parents"] if t in tables]
        if checked:
            out.append(row(f"values {name}", tables[name], F.count_if(bad)))
    return functools.reduce(DataFrame.unionByName, out)


def content_path(sha: Column, root: str, prefix: str, suffix: str) -> Column:
    """<root>/<prefix>/<sha>.<suffix>, with slashes at the ends of the parts dropped."""
    return F.concat_ws("/", *[F.lit(p.strip("/") if i else p.rstrip("/")) for i, p in enumerate((root, prefix)) if p.strip("/")], F.concat(sha, F.lit(f".{suffix}")))
