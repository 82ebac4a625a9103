"""The registered queries of the core, each over whole tables, and the SQL that they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators import dictionary as D
from fieldloom.operators import flatten, layout, metrics, reconcile, retrieval, store
from fieldloom.plans import folding
from fieldloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


RESERVED_LIST = ", ".join(f"'{n}'" for n in X.RESERVED)
RESULT_KEY = ["doc_id", "batch_id", "seed_version", "stage"]
MEASURED = "latency_ms >= 0 AND NOT isnan(latency_ms)"


def results(spark: SparkSession, d: str) -> DataFrame:
    """The current row of each result."""
    return store.keep_latest(table(spark, d, "eval_results"), RESULT_KEY, ["created_at"]).withColumnRenamed("blank_excluded", "blank")


CURRENT = """cur AS (SELECT * EXCLUDE (rn, blank_excluded), blank_excluded AS blank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, batch_id, seed_version, stage ORDER BY created_at DESC NULLS LAST, vertical DESC NULLS LAST, split DESC NULLS LAST, tp DESC, fp DESC, fn DESC) AS rn
  FROM eval_results) WHERE rn = 1)"""

RATES = """round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall"""


# ---- scoring

@query(f"""WITH {CURRENT},
s AS (SELECT stage, vertical, count(*) AS doc_count, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, sum(blank)::BIGINT AS blank
  FROM cur GROUP BY GROUPING SETS ((stage), (stage, vertical)))
SELECT *, {RATES},
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM s""")
def micro_f1(spark: SparkSession, d: str) -> DataFrame:
    return metrics.rated(metrics.summed(results(spark, d), ["stage", "vertical"], [["stage"], ["stage", "vertical"]]))


@query(f"""WITH {CURRENT},
s AS (SELECT seed_version, batch_id, stage, count(*) AS doc_count, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM cur GROUP BY ALL),
b AS (SELECT batch_id, seed_version, git_sha, stage, max(doc_count) AS stored_docs, max(tp) AS stored_tp, max(fp) AS stored_fp, max(fn) AS stored_fn FROM eval_batches GROUP BY ALL)
SELECT b.batch_id, b.seed_version, b.git_sha, b.stage, stored_docs, s.doc_count, (stored_docs = s.doc_count AND stored_tp = s.tp AND stored_fp = s.fp AND stored_fn = s.fn) AS same
FROM b JOIN s USING (batch_id, seed_version, stage)""")
def batch_integrity(spark: SparkSession, d: str) -> DataFrame:
    key = ["batch_id", "seed_version", "stage"]
    s = results(spark, d).groupBy(*key).agg(F.count("*").alias("doc_count"), *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    b = table(spark, d, "eval_batches").groupBy(*key, "git_sha").agg(F.max("doc_count").alias("stored_docs"), *[F.max(c).alias(f"stored_{c}") for c in ("tp", "fp", "fn")])
    same = (F.col("stored_docs") == F.col("doc_count")) & (F.col("stored_tp") == F.col("tp")) & (F.col("stored_fp") == F.col("fp")) & (F.col("stored_fn") == F.col("fn"))
    return b.join(s, key).select("batch_id", "seed_version", "git_sha", "stage", "stored_docs", "doc_count", same.alias("same"))


@query(f"""WITH {CURRENT}
SELECT seed_version, batch_id, stage, count(*) AS n, quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.99) AS p99
FROM cur WHERE {MEASURED} GROUP BY ALL""")
def latency_percentiles(spark: SparkSession, d: str) -> DataFrame:
    r = results(spark, d).filter(MEASURED)
    return r.groupBy("seed_version", "batch_id", "stage").agg(F.count("*").alias("n"), metrics.nearest_rank("latency_ms", 0.5).alias("p50"), metrics.nearest_rank("latency_ms", 0.99).alias("p99"))


@query(f"""SELECT tier, count(*) AS n, round(avg(latency_ms), 3) AS mean, round(quantile_cont(latency_ms, 0.5), 3) AS median, round(max(latency_ms), 3) AS maximum
FROM field_attempts WHERE {MEASURED} GROUP BY tier""")
def latency_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.spread_stats(table(spark, d, "field_attempts").filter(MEASURED), ["tier"], "latency_ms")


SERIES = f"""{CURRENT},
s AS (SELECT seed_version, stage, batch_id, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM cur GROUP BY ALL),
f AS (SELECT *, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM s)"""


def series(spark: SparkSession, d: str) -> DataFrame:
    s = results(spark, d).groupBy("seed_version", "stage", "batch_id").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return metrics.rated(s).select("seed_version", "stage", "batch_id", "f1")


@query(f"WITH {SERIES} SELECT seed_version, stage, batch_id, f1 FROM f")
def f1_over_time(spark: SparkSession, d: str) -> DataFrame:
    return series(spark, d)


@query(f"""WITH {SERIES}, l AS (SELECT seed_version, stage, batch_id, f1, lag(f1) OVER w AS before,
  max(f1) OVER (PARTITION BY seed_version, stage ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM f WINDOW w AS (PARTITION BY seed_version, stage ORDER BY batch_id))
SELECT * FROM l WHERE f1 < before""")
def series_dips(spark: SparkSession, d: str) -> DataFrame:
    return metrics.dips(series(spark, d), ["seed_version", "stage"], "batch_id", "f1")


@query(f"""WITH {SERIES} SELECT seed_version, stage, arg_min(f1, batch_id) AS first_value, arg_max(f1, batch_id) AS last_value, round(avg(f1), 6) AS mean_value FROM f GROUP BY ALL""")
def two_stage(spark: SparkSession, d: str) -> DataFrame:
    return metrics.ends(series(spark, d), ["seed_version", "stage"], "batch_id", "f1")


@query(f"""WITH {CURRENT},
s AS (SELECT vertical, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, count(*) AS doc_count FROM cur WHERE stage = 'cascade' GROUP BY ROLLUP (vertical))
SELECT *, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM s""")
def coarse_f1(spark: SparkSession, d: str) -> DataFrame:
    s = results(spark, d).filter("stage = 'cascade'").rollup("vertical").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], F.count("*").alias("doc_count"))
    return metrics.rated(s, empty=0.0)


# ---- keep-latest, constraints, splits

@query("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY created_at DESC NULLS LAST, vertical DESC NULLS LAST, router_stage DESC NULLS LAST, router_score DESC NULLS LAST) AS rn FROM runs) WHERE rn = 1""")
def latest_runs(spark: SparkSession, d: str) -> DataFrame:
    return store.keep_latest(table(spark, d, "runs"), ["doc_id"], ["created_at"])


@query("""WITH u AS (SELECT DISTINCT doc_id, field_name, tier, value, confidence, 0 AS new FROM field_attempts UNION ALL
  SELECT DISTINCT doc_id, field_name, tier, corrected_value, 1.0, 1 FROM (SELECT doc_id, field_name, tier_that_produced_original AS tier, max(corrected_value) AS corrected_value FROM correction_outcomes
    WHERE field_name IS NOT NULL AND tier_that_produced_original IS NOT NULL GROUP BY ALL)),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id, field_name, tier ORDER BY new DESC, value DESC NULLS LAST, confidence DESC NULLS LAST) AS rn FROM u)
SELECT tier, count(*) AS n, count(value) AS filled, sum(new)::BIGINT AS replaced FROM l WHERE rn = 1 GROUP BY tier""")
def upsert_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts with the corrected values put in as upserts, counted by tier."""
    key = ["doc_id", "field_name", "tier"]
    old = table(spark, d, "field_attempts").select(*key, "value", "confidence").withColumn("new", F.lit(0))
    c = table(spark, d, "correction_outcomes").select("doc_id", "field_name", F.col("tier_that_produced_original").alias("tier"), "corrected_value").filter("field_name is not null and tier is not null")
    new = c.groupBy(*key).agg(F.max("corrected_value").alias("value")).withColumns({"confidence": F.lit(1.0), "new": F.lit(1)})
    return store.upsert(old, new, key).groupBy("tier").agg(F.count("*").alias("n"), F.count("value").alias("filled"), F.sum("new").alias("replaced"))


@query("""SELECT 'key manifest_entries' AS "check", count(*) AS n FROM (SELECT doc_id FROM manifest_entries GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'key runs', count(*) FROM (SELECT doc_id FROM runs GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'parent runs.doc_id', count(*) FROM runs WHERE doc_id NOT IN (SELECT doc_id FROM manifest_entries WHERE doc_id IS NOT NULL)
UNION ALL SELECT 'key field_attempts', count(*) FROM (SELECT doc_id, field_name, tier FROM field_attempts GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'parent field_attempts.doc_id', count(*) FROM field_attempts WHERE doc_id NOT IN (SELECT doc_id FROM runs WHERE doc_id IS NOT NULL)
UNION ALL SELECT 'key eval_results', count(*) FROM (SELECT doc_id, batch_id, seed_version, stage FROM eval_results GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'parent eval_results.doc_id', count(*) FROM eval_results WHERE doc_id NOT IN (SELECT doc_id FROM runs WHERE doc_id IS NOT NULL)
UNION ALL SELECT 'key eval_batches', count(*) FROM (SELECT batch_id, seed_version, git_sha, stage FROM eval_batches GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'key correction_outcomes', count(*) FROM (SELECT correction_id FROM correction_outcomes GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'parent correction_outcomes.doc_id', count(*) FROM correction_outcomes WHERE doc_id NOT IN (SELECT doc_id FROM runs WHERE doc_id IS NOT NULL)
UNION ALL SELECT 'values eval_results', count(*) FROM eval_results WHERE coalesce(stage NOT IN ('tier1', 'cascade') OR least(tp, fp, fn) < 0, true)
UNION ALL SELECT 'values eval_batches', count(*) FROM eval_batches WHERE coalesce(stage NOT IN ('tier1', 'cascade') OR least(tp, fp, fn) < 0, true)""")
def constraints(spark: SparkSession, d: str) -> DataFrame:
    return store.violations({name: table(spark, d, name) for name in store.TABLES})


@query("""WITH k AS (SELECT DISTINCT doc_id, CASE WHEN vertical = 'healthcare' THEN regexp_replace(doc_id, '-[^-]*$', '') ELSE doc_id END AS key FROM manifest_entries WHERE doc_id IS NOT NULL),
h AS (SELECT ('0x' || substr(sha256('intake-v1:' || key), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS x FROM k)
SELECT CASE WHEN x < 0.7 THEN 'train' WHEN x < 0.85 THEN 'dev' ELSE 'test' END AS split, count(*) AS n FROM h GROUP BY 1""")
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest_entries").filter("doc_id is not null").select("doc_id", X.partition_key(F.col("doc_id"), F.col("vertical")).alias("key")).distinct()
    return m.groupBy(X.hash_split(F.col("key")).alias("split")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT DISTINCT partition_key, lower(trim(split)) AS split FROM manifest_entries WHERE partition_key IS NOT NULL AND split IS NOT NULL)
SELECT partition_key, string_agg(split, ',' ORDER BY split) AS splits FROM s GROUP BY partition_key HAVING count(*) > 1""")
def leakage(spark: SparkSession, d: str) -> DataFrame:
    """Stored keys with documents in more than one split, as spelt."""
    m = table(spark, d, "manifest_entries").filter("split is not null").withColumn("s", F.lower(F.trim("split")))
    return metrics.mixed_keys(m, "partition_key", "s").select("partition_key", F.array_join("splits", ",").alias("splits"))


@query("SELECT split, vertical, count(*) AS n FROM manifest_entries GROUP BY ALL")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest_entries").groupBy("split", "vertical").agg(F.count("*").alias("n"))


@query("""SELECT coalesce(regexp_full_match(image_sha256, '[0-9a-f]{64}'), false) AS valid, count(*) AS n, count(DISTINCT image_sha256) AS different FROM manifest_entries GROUP BY 1""")
def content_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest_entries").groupBy(X.is_sha256(F.col("image_sha256")).alias("valid")).agg(F.count("*").alias("n"), F.count_distinct("image_sha256").alias("different"))


@query("""SELECT DISTINCT image_sha256, 'store/forms/' || image_sha256 || '.png' AS path FROM manifest_entries WHERE regexp_full_match(image_sha256, '[0-9a-f]{64}')""")
def store_paths(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest_entries").filter(X.is_sha256(F.col("image_sha256")))
    return m.select("image_sha256", store.content_path(F.col("image_sha256"), "store/", "/forms/", "png").alias("path")).distinct()


@query(f"""SELECT DISTINCT doc_id, CASE WHEN c = '' OR right(c, 1) = '.' OR lower(c) IN ({RESERVED_LIST}) THEN substr(sha256(doc_id), 1, 16) ELSE c END || '-' || substr(sha256(doc_id), 1, 8) AS stem
FROM (SELECT doc_id, regexp_replace(doc_id, '[^A-Za-z0-9._-]', '_', 'g') AS c FROM manifest_entries WHERE doc_id IS NOT NULL)""")
def safe_stems(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest_entries").filter("doc_id is not null").select("doc_id", X.safe_stem(F.col("doc_id")).alias("stem")).distinct()


# ---- readings

STATE_LIST = ", ".join(f"'{s}'" for s in X.STATES)


def sql_verdict(f: str, v: str) -> str:
    v = f"regexp_replace({v}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN {f} LIKE '%zip' THEN regexp_full_match({v}, '\\d{{5}}(-\\d{{4}})?') WHEN {f} LIKE '%state' THEN upper({v}) IN ({STATE_LIST})"
        f" WHEN {f} LIKE '%phone' THEN length(regexp_replace({v}, '[^0-9]', '', 'g')) = 10"
        f" WHEN regexp_matches({f}, '^date_|_date$|_dob$|^date$') THEN coalesce({folding.date(v)} BETWEEN '1900-01-01' AND '2100-12-31', false) END"
    )


READINGS = folding.folded("SELECT value AS v FROM field_attempts")


@query(f"SELECT field_name, {sql_verdict('field_name', 'value')} AS verdict, count(*) AS n FROM field_attempts GROUP BY ALL")
def verdicts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "field_attempts")
    return a.groupBy("field_name", X.verdict(F.col("field_name"), F.col("value")).alias("verdict")).agg(F.count("*").alias("n"))


@query(f"WITH {READINGS} SELECT field_name, count(*) AS n, count(k) AS filled, count(DISTINCT k) AS different FROM field_attempts LEFT JOIN folded ON v = value GROUP BY field_name")
def tokens_by_field(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "field_attempts").withColumn("t", X.comparable(F.col("value")))
    return a.groupBy("field_name").agg(F.count("*").alias("n"), F.count("t").alias("filled"), F.count_distinct("t").alias("different"))


@query("""SELECT field_name, count(*) AS n, count(*) FILTER (tier IS NULL OR (value IS NOT NULL AND confidence < 0.85)) AS escalated,
  round(coalesce(min(CASE WHEN value IS NOT NULL THEN confidence END), 1.0), 6) AS min_confidence, round(coalesce(avg(CASE WHEN value IS NOT NULL THEN confidence END), 1.0), 6) AS mean_confidence,
  count(*) FILTER (value IS NOT NULL) AS populated, count(*) FILTER (value IS NULL AND tier IS NOT NULL) AS blank, count(*) FILTER (tier IS NULL) AS unattempted
FROM field_attempts WHERE tier = '1' GROUP BY field_name""")
def escalations(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "field_attempts").filter("tier = '1'")
    esc = F.count_if(reconcile.escalates(F.col("tier"), F.col("value"), F.col("confidence"))).alias("escalated")
    return a.groupBy("field_name").agg(F.count("*").alias("n"), esc, *metrics.form_confidence(F.col("value"), F.col("tier"), F.col("confidence")))


def _reader(t: str, n: str) -> str:
    return f"""max(CASE WHEN tier = '{t}' THEN value END) AS {n}_value, max(CASE WHEN tier = '{t}' THEN confidence END) AS {n}_conf, coalesce(bool_or(tier = '{t}'), false) AS {n}_read"""


RESOLVED = f"""{READINGS},
ws AS (SELECT doc_id, field_name, {_reader('1', 't1')}, {_reader('2', 't2')}, {_reader('3a', 'ta')}, {_reader('3b', 'tb')} FROM field_attempts GROUP BY doc_id, field_name),
w AS (SELECT *, CASE WHEN tb_read THEN tb_value ELSE ta_value END AS t3_value, ta_read OR tb_read AS t3_read, CASE WHEN tb_read THEN '3b' ELSE '3a' END AS t3_tier FROM ws),
n AS (SELECT w.*, coalesce(t2_value, t1_value) AS f, f1.k AS k1, f2.k AS k2, f3.k AS k3, coalesce(f2.k, CASE WHEN t2_value IS NULL THEN f1.k END) AS kf,
  {sql_verdict('field_name', 't1_value')} AS ok1, {sql_verdict('field_name', 'coalesce(t2_value, t1_value)')} AS okf
  FROM w LEFT JOIN folded f1 ON f1.v = t1_value LEFT JOIN folded f2 ON f2.v = t2_value LEFT JOIN folded f3 ON f3.v = t3_value),
r AS (SELECT *, CASE WHEN coalesce(ok1, true) THEN t1_value END AS a, CASE WHEN coalesce(ok1, true) THEN k1 END AS ka,
  CASE WHEN k1 = k2 THEN 'agree' WHEN t2_read THEN 'routed' END AS route FROM n),
q AS (SELECT *, CASE WHEN NOT t3_read THEN 0 WHEN coalesce(k3 = ka, false) THEN 1 WHEN f IS NULL AND t3_value IS NULL AND NOT t2_read AND NOT t1_read THEN 2 WHEN f IS NULL AND t3_value IS NULL THEN 3
  WHEN f = t3_value THEN 4 WHEN t3_value IS NULL OR (f IS NOT NULL AND coalesce(okf, false)) THEN 5 ELSE 6 END AS rule0 FROM r),
c AS (SELECT *, CASE WHEN rule0 IN (1, 2, 6) THEN t3_value ELSE f END AS chosen, CASE WHEN rule0 IN (1, 2, 6) THEN k3 ELSE kf END AS kc FROM q),
resolved AS (SELECT doc_id, field_name, route, t1_value, t2_value, chosen, k1, kc, CASE WHEN rule0 IN (4, 5, 6) AND a IS NOT NULL AND NOT coalesce(ka = kc, false) THEN 7 ELSE rule0 END AS rule_no, rule0,
  CASE WHEN t2_read THEN t2_conf END AS c2, t1_conf, CASE WHEN rule0 IN (1, 2, 6) THEN t3_tier WHEN t2_read THEN '2' WHEN t1_read THEN '1' END AS reader FROM c),
done AS (SELECT *, CASE WHEN rule_no IN (1, 4) THEN 0.95::DOUBLE WHEN rule_no IN (5, 6, 7) THEN 0.5::DOUBLE ELSE coalesce(c2, t1_conf) END AS confidence FROM resolved)"""


def resolved(spark: SparkSession, d: str, values: bool = True) -> DataFrame:
    """Each item as the three readers leave it; values: with the values themselves, else with their hashes."""
    return reconcile.reconcile(reconcile.route(reconcile.by_reader(table(spark, d, "field_attempts"), values)))


@query(f"WITH {RESOLVED} SELECT doc_id, field_name, route, rule_no, chosen, confidence, reader FROM done")
def reconciled(spark: SparkSession, d: str) -> DataFrame:
    return resolved(spark, d).select("doc_id", "field_name", "route", "rule_no", "chosen", "confidence", "reader")


@query(f"WITH {RESOLVED} SELECT field_name, route, rule_no, count(*) AS n FROM done GROUP BY ALL")
def rules_by_field(spark: SparkSession, d: str) -> DataFrame:
    return resolved(spark, d, values=False).groupBy("field_name", "route", "rule_no").agg(F.count("*").alias("n"))


@query(f"""WITH {RESOLVED}, g AS (SELECT coalesce(CASE WHEN chosen IS NULL THEN 'missed' ELSE reader END, 'missed') AS reader, count(*) AS n FROM done GROUP BY 1)
SELECT reader, n, (sum(n) OVER (ORDER BY reader))::BIGINT AS cumulative FROM g""")
def funnel(spark: SparkSession, d: str) -> DataFrame:
    g = resolved(spark, d, values=False).groupBy(F.coalesce(F.when(F.col("chosen").isNull(), "missed").otherwise(F.col("reader")), F.lit("missed")).alias("reader")).agg(F.count("*").alias("n"))
    return metrics.cumulative(g, [], "reader", "n")


@query(f"""WITH {RESOLVED} SELECT CASE WHEN k1 = kc THEN 'matched' WHEN coalesce(t2_value, t1_value) IS NULL THEN 'blank' WHEN ({sql_verdict('field_name', 'coalesce(t2_value, t1_value)')}) IS NULL THEN 'free_text' ELSE 'failed' END AS reason, count(*) AS n
FROM done WHERE reader IN ('3a', '3b') AND chosen IS NOT NULL GROUP BY 1""")
def third_reader_reasons(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.attribution(resolved(spark, d, values=False))


@query(f"""WITH {RESOLVED}, b AS (SELECT doc_id, field_name, confidence FROM done WHERE reader IS NULL OR (chosen IS NOT NULL AND confidence < 0.8))
SELECT doc_id, string_agg(field_name, ',' ORDER BY field_name) AS drivers, min(confidence) AS lowest FROM b GROUP BY doc_id""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.parked(resolved(spark, d, values=False)).withColumn("drivers", F.array_join("drivers", ","))


@query(f"""WITH {READINGS}, a AS (SELECT doc_id, field_name, max(value) AS a FROM field_attempts WHERE tier = '2' GROUP BY ALL), b AS (SELECT doc_id, field_name, max(value) AS b FROM field_attempts WHERE tier = '3a' GROUP BY ALL),
j AS (SELECT field_name, (a IS NULL AND b IS NULL) OR coalesce(f1.k = f2.k, false) AS ok FROM a JOIN b USING (doc_id, field_name) LEFT JOIN folded f1 ON f1.v = a LEFT JOIN folded f2 ON f2.v = b)
SELECT field_name, count(*) AS n, count(*) FILTER (ok) AS agree, round(count(*) FILTER (ok) / count(*), 6) AS rate FROM j GROUP BY field_name""")
def pair_agreement(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.pair_agreement(table(spark, d, "field_attempts"), "2", "3a")


@query("""WITH r AS (SELECT doc_id, field_name, max(value) AS value, max(confidence) AS confidence FROM field_attempts WHERE tier = '1' GROUP BY ALL),
h AS (SELECT doc_id, field_name, max(value) AS value, max(confidence) AS confidence FROM field_attempts WHERE tier = '2' GROUP BY ALL),
m AS (SELECT r.field_name, CASE WHEN h.doc_id IS NOT NULL AND r.value IS NOT NULL AND r.confidence < 0.85 THEN '2' ELSE '1' END AS tier,
  CASE WHEN h.doc_id IS NOT NULL AND r.value IS NOT NULL AND r.confidence < 0.85 THEN h.value ELSE r.value END AS value FROM r LEFT JOIN h USING (doc_id, field_name))
SELECT field_name, tier, count(*) AS n, count(value) AS filled FROM m GROUP BY ALL""")
def merged_fields(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "field_attempts").filter("tier in ('1', '2')")
    one = lambda t: [F.max(F.when(F.col("tier") == t, F.col(c))).alias(f"{c}{t}") for c in ("value", "confidence")] + [F.max(F.when(F.col("tier") == t, F.lit(t))).alias(f"t{t}")]
    both = a.groupBy("doc_id", "field_name").agg(*one("1"), *one("2")).filter("t1 is not null")  # both forms in one scan
    low = both.select("doc_id", "field_name", F.col("value1").alias("value"), F.col("confidence1").alias("confidence"), F.col("t1").alias("tier"), F.when(F.col("t2").isNotNull(), F.struct(F.col("value2").alias("value"), F.col("confidence2").alias("confidence"), F.col("t2").alias("tier"))).alias("h"))
    m = reconcile.overlaid(low, reconcile.escalates(F.col("tier"), F.col("value"), F.col("confidence")))
    return m.groupBy("field_name", "tier").agg(F.count("*").alias("n"), F.count("value").alias("filled"))


# ---- dictionary and routing

ALIASES = "al AS (SELECT canonical_name AS field, vertical, i - 1 AS alias_pos, aliases[i] AS alias FROM alias_dictionary, range(1, 100) t(i) WHERE i <= len(aliases))"
VOCABULARY = f"""{ALIASES}, ua AS (SELECT DISTINCT field, vertical, upper(trim(alias)) AS alias FROM al),
voc AS (SELECT alias, 1.0::DOUBLE / count(*) AS weight FROM ua WHERE vertical = 'healthcare' AND alias NOT IN (SELECT alias FROM ua WHERE vertical IN ('base', 'insurance', 'hr')) GROUP BY alias)"""


@query(f"WITH {VOCABULARY} SELECT * FROM voc")
def distinctive_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return D.distinctive(table(spark, d, "alias_dictionary"))


@query(f"""WITH {VOCABULARY} SELECT doc_id, round(coalesce(sum(weight), 0.0), 6) AS score FROM documents LEFT JOIN voc ON contains(upper(text), alias) GROUP BY doc_id""")
def router_scores(spark: SparkSession, d: str) -> DataFrame:
    s = D.score_texts(table(spark, d, "documents"), D.distinctive(table(spark, d, "alias_dictionary")))
    return s.select("doc_id", F.round("score", 6).alias("score"))


@query("""WITH m AS (SELECT doc_id, max(vertical) AS second FROM manifest_entries GROUP BY doc_id), r AS (SELECT runs.doc_id, router_score, second FROM runs LEFT JOIN m USING (doc_id)),
x AS (SELECT CASE WHEN router_score >= 1.0 THEN 1 ELSE 2 END AS stage, CASE WHEN coalesce(router_score >= 1.0, false) OR coalesce(lower(second) <> 'business', true) THEN 'healthcare' ELSE 'business' END AS vertical FROM r)
SELECT stage, vertical, count(*) AS n FROM x GROUP BY ALL""")
def routes(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest_entries").groupBy("doc_id").agg(F.max("vertical").alias("second"))
    stage, vertical = D.routed(F.col("router_score"), F.col("second"))
    r = table(spark, d, "runs").select("doc_id", "router_score").join(m, "doc_id", "left")
    return r.groupBy(stage.alias("stage"), vertical.alias("vertical")).agg(F.count("*").alias("n"))


@query(f"""WITH {ALIASES}, b AS (SELECT unnest(range(1, (SELECT max(len(aliases)) FROM alias_dictionary) + 1)) AS batch)
SELECT batch::INTEGER AS batch, count(DISTINCT (field, vertical)) AS records, count(*) AS aliases FROM b JOIN al ON alias_pos < batch GROUP BY batch""")
def dictionary_sweep(spark: SparkSession, d: str) -> DataFrame:
    return D.batches(table(spark, d, "alias_dictionary"))


@query(f"""WITH {ALIASES}, w AS (SELECT *, regexp_extract_all(upper(alias), '[A-Z0-9'']+') AS words FROM al), u AS (SELECT DISTINCT field, unnest(words) AS word FROM w),
s AS (SELECT field, vertical, alias, words[1] AS word FROM w WHERE len(words) = 1)
SELECT s.field, s.vertical, s.alias FROM s JOIN u ON u.word = s.word AND u.field <> s.field GROUP BY ALL HAVING count(DISTINCT u.field) >= 2""")
def generic_aliases(spark: SparkSession, d: str) -> DataFrame:
    return D.generic(table(spark, d, "alias_dictionary"))


@query(f"""WITH {ALIASES}, x AS (SELECT field, vertical, min((alias_pos, alias)) AS a FROM al GROUP BY field, vertical, upper(alias)) SELECT field, vertical, a[1]::INTEGER AS alias_pos, a[2] AS alias FROM x""".replace("min((alias_pos, alias)) AS a", "min(alias_pos) AS p, arg_min(alias, alias_pos) AS q").replace("a[1]::INTEGER AS alias_pos, a[2] AS alias", "p::INTEGER AS alias_pos, q AS alias"))
def alias_map(spark: SparkSession, d: str) -> DataFrame:
    return D.alias_map(table(spark, d, "alias_dictionary"))


@query(f"""WITH {ALIASES}, fp AS (SELECT canonical_name AS field, vertical, row_number() OVER (ORDER BY vertical, canonical_name) AS field_pos FROM (SELECT DISTINCT canonical_name, vertical FROM alias_dictionary)),
a AS (SELECT al.*, field_pos, upper(alias) AS up, array_to_string(regexp_extract_all(upper(alias), '[A-Z0-9'']+'), ' ') AS run FROM al JOIN fp USING (field, vertical)),
l AS (SELECT DISTINCT learned_alias AS label, substr(regexp_replace(upper(learned_alias), '^\\s*(?:[0-9][0-9A-Z]{{0,2}}|[A-Z][A-E])\\s*[.,]\\s*', ''), 1, 512) AS clean FROM correction_outcomes WHERE learned_alias IS NOT NULL),
k AS (SELECT *, ' ' || array_to_string(regexp_extract_all(clean, '[A-Z0-9'']+'), ' ') || ' ' AS framed FROM l),
h AS (SELECT label, field, vertical, alias, round(least(1.0, length(up)::DOUBLE / length(trim(clean))), 6) AS score,
  row_number() OVER (PARTITION BY label ORDER BY least(1.0, length(up)::DOUBLE / length(trim(clean))) DESC, field_pos, alias_pos) AS rn
  FROM k JOIN a ON contains(framed, ' ' || run || ' ') AND contains(clean, up))
SELECT label, field, vertical, alias, score FROM h WHERE rn = 1 AND score >= 0.3""")
def label_matches(spark: SparkSession, d: str) -> DataFrame:
    return D.match_labels(table(spark, d, "correction_outcomes"), table(spark, d, "alias_dictionary"), "learned_alias")


def sql_upper(c: str) -> str:
    """upper(), with the letters that become two in capitals."""
    for small, big in (("ß", "ss"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        c = f"replace({c}, '{small}', '{big}')"
    return f"upper({c})"


@query(f"""WITH {ALIASES}, c AS (SELECT lower(trim(field_name)) AS field, trim(learned_alias) AS alias FROM correction_outcomes WHERE trim(learned_alias) <> ''),
n AS (SELECT field, d.vertical, {sql_upper('alias')} AS u, min(alias) AS alias FROM c JOIN alias_dictionary d ON d.canonical_name = c.field GROUP BY ALL)
SELECT field, vertical, alias FROM n WHERE NOT EXISTS (SELECT 1 FROM al WHERE al.field = n.field AND al.vertical = n.vertical AND upper(trim(al.alias)) = n.u)""")
def learned_aliases(spark: SparkSession, d: str) -> DataFrame:
    return D.learned(table(spark, d, "correction_outcomes"), table(spark, d, "alias_dictionary"))


@query("""SELECT canonical_name AS field, vertical, array_to_string(list_transform(string_split(canonical_name, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS label,
  CASE WHEN data_type IN ('string', 'enum') THEN 'string_like' WHEN data_type IN ('boolean', 'integer', 'float', 'date') THEN 'coerced' END AS kind, lower(data_class) IN ('phi', 'pci') AS protected FROM alias_dictionary""")
def field_metadata(spark: SparkSession, d: str) -> DataFrame:
    return D.metadata(table(spark, d, "alias_dictionary"))


@query("""SELECT vertical, string_agg('- ' || canonical_name || ' (' || data_type || '): ' || description, chr(10) ORDER BY '- ' || canonical_name || ' (' || data_type || '): ' || description) AS prompt FROM alias_dictionary GROUP BY vertical""")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alias_dictionary").groupBy("vertical").agg(flatten.prompt_lines(table(spark, d, "alias_dictionary")).alias("prompt"))


# ---- sidecars, corrections, corpus

@query("""SELECT count(*) AS n, count(DISTINCT doc_id) AS docs, count(*) FILTER (alias_learned) AS learned, count(DISTINCT session_id) AS sessions FROM correction_outcomes""")
def correction_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "correction_outcomes").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"), F.count_if("alias_learned").alias("learned"), F.count_distinct("session_id").alias("sessions"))


@query(f"""WITH s AS (SELECT doc_id, f.name AS name, f.value AS value FROM (SELECT doc_id, unnest(fields) AS f FROM sidecars)),
parts AS (
  SELECT doc_id, 'last_name' AS field, CASE WHEN contains(value, ',') THEN trim(split_part(value, ',', 1)) END AS part FROM s WHERE name = 'patient_name'
  UNION ALL SELECT doc_id, 'first_name', CASE WHEN contains(value, ',') THEN trim(substr(value, instr(value, ',') + 1)) END FROM s WHERE name = 'patient_name'
  UNION ALL SELECT doc_id, 'born', value FROM s WHERE name = 'patient_birth_date'
  UNION ALL SELECT doc_id, CASE name WHEN 'patient_address_line' THEN 'address_street' WHEN 'patient_city' THEN 'address_city' WHEN 'patient_state' THEN 'address_state' WHEN 'patient_postal_code' THEN 'address_zip'
    WHEN 'patient_phone' THEN 'phone' WHEN 'diagnosis' THEN 'reason_for_visit' ELSE name END, value
    FROM s WHERE name IN ('patient_address_line', 'patient_city', 'patient_state', 'patient_postal_code', 'patient_phone', 'diagnosis', 'date_signed')),
{folding.folded("SELECT part AS v FROM parts")},
p AS (SELECT doc_id, field, f, string_split(f, ' ') AS ws FROM parts JOIN folded ON v = part),
t AS (SELECT doc_id, 'date_of_birth' AS field, {folding.date('ws[1]')} AS token FROM p WHERE field = 'born'
  UNION ALL SELECT doc_id, 'sex', CASE WHEN upper(ws[-1]) IN ('M', 'F', 'U') THEN upper(ws[-1]) END FROM p WHERE field = 'born'
  UNION ALL SELECT doc_id, field, {folding.date('f')} FROM p WHERE field = 'date_signed'
  UNION ALL SELECT doc_id, 'signature', 'present' FROM s WHERE name = 'signature'
  UNION ALL SELECT doc_id, field, f FROM p WHERE field NOT IN ('born', 'date_signed'))
SELECT doc_id, field, min(token) AS token FROM t WHERE token IS NOT NULL GROUP BY ALL""")
def sidecar_truth(spark: SparkSession, d: str) -> DataFrame:
    return flatten.sidecar_truth(table(spark, d, "sidecars"))


@query("""SELECT DISTINCT doc_id, p AS problem FROM (
  SELECT doc_id, 'schema_version' AS p FROM sidecars WHERE NOT coalesce(schema_version = 1, false) UNION ALL SELECT doc_id, 'image_sha256' FROM sidecars WHERE NOT coalesce(regexp_full_match(image_sha256, '[0-9a-f]{64}'), false)
  UNION ALL SELECT doc_id, 'source_id' FROM sidecars WHERE NOT coalesce(trim(source_id) <> '', false) UNION ALL SELECT doc_id, 'image' FROM sidecars WHERE NOT coalesce(image = doc_id || '.png', false))""")
def sidecar_problems(spark: SparkSession, d: str) -> DataFrame:
    return flatten.sidecar_problems(table(spark, d, "sidecars"))


@query("""WITH f AS (SELECT page, unnest(fields) AS f FROM sidecars), b AS (SELECT f.name AS name, f.bbox AS b, page.width_px AS w, page.height_px AS h FROM f),
u AS (SELECT name, CASE WHEN b.x1 <= b.x2 AND b.y1 <= b.y2 AND w > 0 AND h > 0 THEN greatest(0, least(1, b.x1 / w)) END AS x1, CASE WHEN b.x1 <= b.x2 AND b.y1 <= b.y2 AND w > 0 AND h > 0 THEN greatest(0, least(1, b.y2 / h)) END AS y2 FROM b)
SELECT name, count(*) AS n, count(x1) AS boxes, round(avg(x1), 6) AS mean_x1, round(max(y2), 6) AS max_y2 FROM u GROUP BY name""")
def unit_boxes(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "sidecars").select("page", F.explode(F.arrays_zip("fields.name", "fields.bbox")).alias("f"))
    b = X.unit_box(F.col("f.bbox.x1"), F.col("f.bbox.y1"), F.col("f.bbox.x2"), F.col("f.bbox.y2"), F.col("page.width_px"), F.col("page.height_px"))
    u = f.select(F.col("f.name").alias("name"), b.alias("b"))
    return u.groupBy("name").agg(F.count("*").alias("n"), F.count("b.x1").alias("boxes"), F.round(F.avg("b.x1"), 6).alias("mean_x1"), F.round(F.max("b.y2"), 6).alias("max_y2"))


# ---- vectors and events

VECTORS = """n AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS len FROM embeddings),
q AS (SELECT label AS query, vec_id AS token, v, len FROM n WHERE vec_id % 20 = 0),
b AS (SELECT query, token, n.label AS doc, max(list_dot_product(q.v, n.v) / (q.len * n.len)) AS best FROM q, n GROUP BY ALL),
s AS (SELECT query::VARCHAR AS query, doc::VARCHAR AS doc, sum(best) AS score FROM b GROUP BY ALL)"""


def similarities(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    queries = e.filter("vec_id % 20 = 0").select(F.col("label").alias("query"), F.col("vec_id").alias("token"), F.col("embedding").alias("vector"))
    return retrieval.max_sim(e.select(F.col("label").alias("doc"), F.col("embedding").alias("vector")), queries)


@query(f"WITH {VECTORS} SELECT query, doc, round(score, 4) AS score FROM s")
def late_interaction(spark: SparkSession, d: str) -> DataFrame:
    return similarities(spark, d).select("query", "doc", F.round("score", 4).alias("score"))


@query(f"WITH {VECTORS}, r AS (SELECT query, doc, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM s) SELECT query, doc, rank::INTEGER AS rank FROM r WHERE rank <= 3")
def nearest_documents(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.top_k(similarities(spark, d), 3).select("query", "doc", "rank")


@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    from fieldloom.streaming.feedback import windowed

    return windowed(table(spark, d, "events")).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM g GROUP BY user_id, k""")
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    from fieldloom.streaming.feedback import sessions

    return sessions(table(spark, d, "events")).select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


@query("""SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1""")
def event_properties(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT * EXCLUDE (r) FROM (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""")
def latest_event(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts"), F.struct("ts", -F.col("event_id"))).alias("e"))
    return e.select("user_id", "e.event_id", "e.ts")


# ---- inline fixtures: markup and nested documents, which no table holds, and hard replies; those in documents are read by unchecked.document_replies

TABLE_HTML = (
    "<table><tr><td colspan=2>2. Name of subscriber</td><td>Member&nbsp;identification</td></tr><tr><td>Doe</td><td>Jo</td><td>HBM1</td></tr>"
    "<tr><td colspan=x>Birth date</td><td>Sex at birth</td><td></td></tr><tr><td>04/07/1990</td><td>F</td><td>z</td></tr></table>"
)


@query("""SELECT * FROM (VALUES (1, 'Doe', '2. Name of subscriber', true), (1, 'Jo', '2. Name of subscriber', true), (1, 'HBM1', 'Member identification', true),
(2, 'Birth date', 'Doe', true), (2, 'Sex at birth', 'Jo', true), (3, '04/07/1990', 'Birth date', true), (3, 'F', 'Sex at birth', true)) t(row_no, value, label, aligned)""")
def table_pairs(spark: SparkSession, d: str) -> DataFrame:
    b = spark.createDataFrame([("a", TABLE_HTML), ("b", "no markup"), ("c", None)], "block string, content string")
    return layout.table_pairs(layout.cells(b), ["block"]).select("row_no", "value", "label", "aligned")


@query("""SELECT * FROM (VALUES ('a', '{"x":"1","y":null}'), ('b', '{"x":"2"}'), ('c', '{"y":"{}"}'), ('d', '{}'), ('e', '{}'), ('f', '{}')) t(id, fields)""")
def reply_objects(spark: SparkSession, d: str) -> DataFrame:
    rows = [("a", '{"x": 1, "y": null}'), ("b", 'so ```json\n{"x": 2}\n``` there'), ("c", 'reply {"y": "{}"} end'), ("d", "[1]"), ("e", "none"), ("f", None)]
    r = spark.createDataFrame(rows, "id string, content string")
    return r.select("id", F.to_json(X.reply_fields(F.col("content")), {"ignoreNullFields": "false"}).alias("fields"))


@query("""SELECT * FROM (VALUES ('b1', 'Mia', '12 Elm', '555', TIMESTAMP '2024-05-01 10:00:00', 'cough'), ('b2', 'Ole', NULL, NULL, NULL, NULL)) t(bundle, first_name, address_street, phone, last_visit, reason_for_visit)""")
def bundle_patients(spark: SparkSession, d: str) -> DataFrame:
    visit = '{"resource": {"resourceType": "Encounter", "id": "%s", "period": {"start": "%s"}, "reasonCode": [{"text": "%s"}]}}'
    one = (
        '{"entry": [{"resource": {"resourceType": "Patient", "id": "p", "name": [{"family": "May", "given": ["Mia", "Q"]}], "address": [{"line": ["12 Elm"], "city": "X"}],'
        ' "telecom": [{"system": "email", "value": "m"}, {"system": "phone", "value": "555"}]}}, ' + ", ".join(visit % v for v in (("e1", "2024-05-01T10:00:00Z", "cough"), ("e2", "2023-01-01T00:00:00Z", "rash"), ("e3", "soon", "none"))) + "]}"
    )
    two = '{"entry": [{"resource": {"resourceType": "Patient", "id": "q", "name": [{"given": ["Ole"]}]}}]}'
    b = spark.createDataFrame([("b1", one), ("b2", two)], "bundle string, json string").select("bundle", F.from_json("json", flatten.BUNDLE).alias("j")).select("bundle", "j.*")
    p = flatten.patients(b)
    return p.select("bundle", "first_name", "address_street", "phone", F.col("last_visit").cast("timestamp_ntz").alias("last_visit"), "reason_for_visit")
