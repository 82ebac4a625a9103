"""The queries of this subpackage, and SQL for those that SQL can express over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import consensus, lookalike, mapping, mixing, selection, splits, stuffing, tokens
from fieldloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]
#: Parts that the readings are summarised by.
PARTS = 16


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return selection.misstated_batches(table(spark, d, "eval_batches"), table(spark, d, "eval_results"))


def latency_groups(spark: SparkSession, d: str) -> DataFrame:
    """kind, grp, latency_ms: each measurement under its tier and field, or its stage and release."""
    two = lambda a, b: F.inline(F.array(F.struct(F.lit(a).alias("kind"), F.col(a).alias("grp")), F.struct(F.lit(b).alias("kind"), F.col(b).alias("grp"))))
    a = table(spark, d, "field_attempts").select("latency_ms", two("tier", "field_name"))
    r = selection.current_results(table(spark, d, "eval_results")).select("latency_ms", two("stage", "seed_version"))
    return a.unionByName(r)


def p1_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """The exact median and other percentiles of each tier, field, stage and release."""
    return selection.multi_select(latency_groups(spark, d), ["kind", "grp"], "latency_ms", [0.5, 0.9, 0.99])


def p1_combined(spark: SparkSession, d: str) -> DataFrame:
    """The same for the pairs of stage and release, and for each tier, field, stage and release by itself, from summaries of parts, combined; within selection.ALPHA of the exact ones.

    kind, grp, grp2 (the release of a pair, else null). The parts are the day of a result, and PARTS hashes of the doc_id of a reading."""
    now = selection.current_results(table(spark, d, "eval_results")).withColumn("part", F.to_date("created_at").cast("string"))
    read = table(spark, d, "field_attempts").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("string"))
    results = selection.summarise(now, ["stage", "seed_version", "part"], "latency_ms")
    readings = selection.summarise(read, ["tier", "field_name", "part"], "latency_ms")
    named = lambda kind, a, b=None: F.struct(F.lit(kind).alias("kind"), F.col(a).alias("grp"), (F.col(b) if b else F.lit(None).cast("string")).alias("grp2"))
    under = lambda s, *kinds: s.select("bucket", "n", "part", F.inline(F.array(*kinds)))
    parts = [
        under(results, named("stage", "stage"), named("seed_version", "seed_version"), named("stage_seed_version", "stage", "seed_version")),
        under(readings, named("tier", "tier"), named("field_name", "field_name")),
    ]
    by = ["kind", "grp", "grp2"]
    return selection.from_summary(selection.combine(parts, by), by, [0.5, 0.9, 0.99])


def p1_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Each percentile of p1_combined beside the exact one of multi-select: whether it is within the stated error of it."""
    now = selection.current_results(table(spark, d, "eval_results"))
    none = F.lit(None).cast("string")
    one = lambda df, *names: df.select("latency_ms", F.inline(F.array(*[F.struct(F.lit("_".join(n)).alias("kind"), F.col(n[0]).alias("grp"), (F.col(n[1]) if len(n) > 1 else none).alias("grp2")) for n in names])))
    rows = one(now, ("stage",), ("seed_version",), ("stage", "seed_version")).unionByName(one(table(spark, d, "field_attempts"), ("tier",), ("field_name",)))
    by = ["kind", "grp", "grp2"]
    exact = selection.multi_select(rows, by, "latency_ms", [0.5, 0.9, 0.99]).select(*[F.col(c).alias(f"_{c}") for c in (*by, "q")], F.col("n").alias("exact_n"), F.col("value").alias("exact"))
    got = p1_combined(spark, d)
    j = got.join(exact, (F.col("kind") == F.col("_kind")) & F.col("grp").eqNullSafe(F.col("_grp")) & F.col("grp2").eqNullSafe(F.col("_grp2")) & (F.col("q") == F.col("_q")), "full_outer")
    within = F.coalesce((F.col("n") == F.col("exact_n")) & (F.abs(F.col("value") - F.col("exact")) <= F.col("exact") * (selection.ALPHA * 1.0001)), F.lit(False))
    return j.select("kind", "grp", "grp2", "q", "n", within.alias("within"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.violations(table(spark, d, "manifest_entries"), table(spark, d, "eval_results"))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assigned(table(spark, d, "manifest_entries"), table(spark, d, "eval_results"))


def p2_status(spark: SparkSession, d: str) -> DataFrame:
    """What p2_splits does with each document: whether its entity kept a split, and which, was filled, or is quarantined; and in how many splits the entity came out."""
    a = p2_splits(spark, d)
    of = a.groupBy("partition_key").agg(F.count_distinct("split").cast("int").alias("splits"))
    return a.join(of, "partition_key").select("doc_id", "partition_key", "status", F.when(F.col("status") == "kept", F.col("split")).alias("kept_split"), "splits")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.odd_values(table(spark, d, "field_attempts"), table(spark, d, "sidecars"))


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """Groups of values with equal skeletons."""
    return lookalike.skeleton_groups(lookalike.domain_values(table(spark, d, "field_attempts"), table(spark, d, "sidecars")), "value")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return mapping.meant_entries(table(spark, d, "correction_outcomes"), table(spark, d, "alias_dictionary"))


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return mapping.unmatched(table(spark, d, "correction_outcomes"), table(spark, d, "alias_dictionary"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return consensus.misreadings(table(spark, d, "field_attempts"))


def p5_consensus(spark: SparkSession, d: str) -> DataFrame:
    return consensus.domain_consensus(table(spark, d, "field_attempts"), values=True).decided()


def p5_reliability(spark: SparkSession, d: str) -> DataFrame:
    return consensus.domain_consensus(table(spark, d, "field_attempts")).reliabilities()


def p5_agreement(spark: SparkSession, d: str) -> DataFrame:
    return consensus.agreement(consensus.domain_votes(table(spark, d, "field_attempts")), "field_name", ["doc_id"])


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(table(spark, d, "documents"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """Of each target source: how many documents it has to give, whether its share is within a thousandth of the one aimed at or as near as its documents let it come (short of its budget by less than the longest of them),
    whether no document is used too often, and whether its uses sum up to the tokens reported."""
    mixed, report = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    used = mixed.groupBy("source").agg(F.max("uses").alias("most"), F.sum(F.col("uses") * F.col("n_tokens")).alias("used"), F.count_distinct("doc_id").alias("ids"), F.count("*").alias("rows"))
    ok = lambda c: F.coalesce(c, F.lit(False))
    return report.join(used, "source", "left").select(
        "source", "documents", (ok(F.abs(F.col("share") - F.col("aimed_share")) <= 0.001) | ok((F.col("tokens") <= F.col("budget")) & (F.col("budget") - F.col("tokens") < F.col("longest")))).alias("reached"),
        ok((F.coalesce("most", F.lit(0)) <= F.col("max_repeats")) & F.col("ids").eqNullSafe(F.col("rows"))).alias("within_repeats"), ok(F.coalesce("used", F.lit(0)) == F.col("tokens")).alias("summed"),
    )


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.stuffed_documents(table(spark, d, "documents"))


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.stuffing_scores(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_percentiles, p1_combined, p1_bounds, p2_found, p2_splits, p2_status, p3_found, p3_forms, p4_found, p4_unmatched, p5_found, p5_consensus,
        p5_reliability, p5_agreement, p6_ids, p7_mix, p7_shares, p7_checks, p8_found, p8_scores,
    )
}

_CURRENT = """current_results AS (
  SELECT doc_id, batch_id, seed_version, stage, latency_ms,
         row_number() OVER (PARTITION BY doc_id, batch_id, seed_version, stage ORDER BY created_at DESC NULLS LAST, latency_ms DESC NULLS LAST) AS rn
  FROM eval_results)"""

SQL: dict[str, str] = {
    "p1_found": f"""WITH {_CURRENT},
ranked AS (
  SELECT batch_id, seed_version, stage, latency_ms,
         row_number() OVER (PARTITION BY batch_id, seed_version, stage ORDER BY latency_ms) AS r,
         count(*) OVER (PARTITION BY batch_id, seed_version, stage) AS n
  FROM current_results WHERE rn = 1 AND latency_ms >= 0 AND NOT isnan(latency_ms))
SELECT DISTINCT b.batch_id, b.seed_version, b.git_sha, b.stage
FROM eval_batches b JOIN ranked x ON x.batch_id = b.batch_id AND x.seed_version = b.seed_version AND x.stage = b.stage
WHERE x.r = (x.n * 99 + 99) // 100 AND abs(b.latency_p99_ms - x.latency_ms) > 0.1 * x.latency_ms""",
    "p1_percentiles": f"""WITH {_CURRENT},
g AS (
  SELECT 'tier' AS kind, tier AS grp, latency_ms FROM field_attempts
  UNION ALL SELECT 'field_name', field_name, latency_ms FROM field_attempts
  UNION ALL SELECT 'stage', stage, latency_ms FROM current_results WHERE rn = 1
  UNION ALL SELECT 'seed_version', seed_version, latency_ms FROM current_results WHERE rn = 1),
ranked AS (
  SELECT kind, grp, latency_ms, row_number() OVER (PARTITION BY kind, grp ORDER BY latency_ms) AS r, count(*) OVER (PARTITION BY kind, grp) AS n
  FROM g WHERE latency_ms >= 0 AND NOT isnan(latency_ms))
SELECT kind, grp, CAST(p.q AS DOUBLE) / 100 AS q, n, latency_ms AS value
FROM ranked, (VALUES (50), (90), (99)) p(q) WHERE r = greatest(1, (n * p.q + 99) // 100)""",
    "p2_found": r"""WITH u AS (
  SELECT doc_id, split FROM manifest_entries UNION ALL SELECT doc_id, split FROM eval_results),
w AS (
  SELECT regexp_replace(doc_id, '-[^-]*$', '') AS partition_key, lower(regexp_replace(split, '^\s+|\s+$', '', 'g')) AS s FROM u WHERE doc_id IS NOT NULL AND split IS NOT NULL)
SELECT partition_key FROM w WHERE s <> ''
GROUP BY partition_key
HAVING count(DISTINCT CASE s WHEN 'training' THEN 'train' WHEN 'val' THEN 'dev' WHEN 'validation' THEN 'dev' ELSE s END) > 1""",
    "p1_bounds": f"""WITH {_CURRENT},
g AS (
  SELECT 'tier' AS kind, tier AS grp, NULL::VARCHAR AS grp2, latency_ms FROM field_attempts
  UNION ALL SELECT 'field_name', field_name, NULL, latency_ms FROM field_attempts
  UNION ALL SELECT 'stage', stage, NULL, latency_ms FROM current_results WHERE rn = 1
  UNION ALL SELECT 'seed_version', seed_version, NULL, latency_ms FROM current_results WHERE rn = 1
  UNION ALL SELECT 'stage_seed_version', stage, seed_version, latency_ms FROM current_results WHERE rn = 1)
SELECT kind, grp, grp2, CAST(p.q AS DOUBLE) / 100 AS q, count(*) AS n, true AS within
FROM g, (VALUES (50), (90), (99)) p(q) WHERE latency_ms >= 0 AND NOT isnan(latency_ms) GROUP BY ALL""",
    "p2_status": r"""WITH u AS (
  SELECT doc_id, split FROM manifest_entries UNION ALL SELECT doc_id, split FROM eval_results),
w AS (SELECT regexp_replace(doc_id, '-[^-]*$', '') AS partition_key, lower(regexp_replace(split, '^\s+|\s+$', '', 'g')) AS s FROM u WHERE doc_id IS NOT NULL),
e AS (SELECT partition_key, count(DISTINCT s) AS n, max(s) AS s
  FROM (SELECT partition_key, CASE s WHEN 'training' THEN 'train' WHEN 'val' THEN 'dev' WHEN 'validation' THEN 'dev' WHEN '' THEN NULL ELSE s END AS s FROM w) GROUP BY partition_key)
SELECT DISTINCT m.doc_id, e.partition_key, CASE WHEN n > 1 THEN 'quarantined' WHEN n = 1 THEN 'kept' ELSE 'filled' END AS status, CASE WHEN n = 1 THEN s END AS kept_split, CASE WHEN n > 1 THEN 0 ELSE 1 END::INTEGER AS splits
FROM manifest_entries m JOIN e ON e.partition_key = regexp_replace(m.doc_id, '-[^-]*$', '') WHERE m.doc_id IS NOT NULL""",
    "p7_checks": """SELECT t.source, count(d.doc_id) AS documents, true AS reached, true AS within_repeats, true AS summed
FROM mix_targets t LEFT JOIN documents d ON d.source = t.source AND d.text <> '' GROUP BY t.source""",
}
