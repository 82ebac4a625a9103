"""Registered queries that score readings. Truth is what reviewers say: the latest corrected value of each document and exactly named field (scoring.correction_truth)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import metrics, reconcile, scoring, training
from fieldloom.plans import folding
from fieldloom.plans.catalogue import RATES, RESOLVED, query, resolved
from fieldloom.runtime import table

FIELDS = ", ".join(f"'{f}'" for f in scoring.SCORABLE)
VALUES = "SELECT value AS v FROM field_attempts UNION ALL SELECT corrected_value FROM correction_outcomes"


def sql_token(field: str, value: str, f: str) -> str:
    """What a reading is compared with truth by; f: its folded form."""
    return (
        f"CASE WHEN {field} IN ('date_of_birth', 'date_signed') THEN {folding.date(f)} WHEN {field} = 'sex' THEN CASE WHEN upper(left({f}, 1)) IN ('M', 'F', 'U') THEN upper(left({f}, 1)) END"
        f" WHEN {field} = 'signature' THEN CASE WHEN {f} = 'absent' THEN 'absent' WHEN {value} IS NOT NULL THEN 'present' END ELSE {f} END"
    )


TRUTH = f"""lastc AS (SELECT doc_id, field, value FROM (SELECT doc_id, lower(regexp_replace(field_name, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) AS field, corrected_value AS value,
    row_number() OVER (PARTITION BY doc_id, lower(regexp_replace(field_name, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) ORDER BY created_at DESC NULLS LAST, correction_id DESC, corrected_value DESC) AS rn
    FROM correction_outcomes WHERE doc_id IS NOT NULL AND field_name IS NOT NULL AND corrected_value IS NOT NULL) WHERE rn = 1),
truth_all AS (SELECT doc_id, field, value, {sql_token('field', 'value', 'f')} AS token FROM lastc JOIN folded ON v = value),
truth AS (SELECT * FROM truth_all WHERE token IS NOT NULL AND field IN ({FIELDS})),
docs AS (SELECT DISTINCT doc_id FROM truth)"""


def _slot(n: str, value: str, read: str, tier: str) -> str:
    """chosen and reader of readers 1 and 2 with this in the strongest reader's place."""
    return f"""{n}n AS (SELECT n.*, {value} AS s_value, {read} AS s_read, {tier} AS s_tier FROM r AS n),
{n}q AS (SELECT x.*, fs.k AS ks FROM {n}n x LEFT JOIN folded fs ON fs.v = s_value),
{n} AS (SELECT doc_id, field_name AS field, CASE WHEN third THEN s_value ELSE f END AS value, CASE WHEN third THEN s_tier WHEN t2_read THEN '2' WHEN t1_read THEN '1' END AS tier FROM (
  SELECT *, CASE WHEN NOT s_read THEN false WHEN coalesce(ks = ka, false) THEN true WHEN f IS NULL AND s_value IS NULL THEN NOT t2_read AND NOT t1_read WHEN f = s_value THEN false WHEN s_value IS NULL OR (f IS NOT NULL AND coalesce(okf, false)) THEN false ELSE true END AS third FROM {n}q))"""


BASE = RESOLVED.replace(folding.folded("SELECT value AS v FROM field_attempts"), folding.folded(VALUES))
FORMS = f"""{BASE},
{_slot('two', "CASE WHEN route = 'routed' THEN t2_value END", "(coalesce(route = 'routed', false) AND t2_read)", "CASE WHEN route = 'routed' THEN '2' ELSE '3a' END")},
{_slot('three', 't3_value', 't3_read', 't3_tier')},
forms AS (SELECT 'Tier 1' AS stage, doc_id, field_name AS field, t1_value AS value, '1' AS tier FROM w WHERE t1_read
  UNION ALL SELECT 'Tier 1+2', * FROM two UNION ALL SELECT 'Tier 1+2+3', * FROM three),
{TRUTH},
grid AS (SELECT stage, doc_id, field FROM docs, (SELECT unnest([{FIELDS}]) AS field), (SELECT unnest(['Tier 1', 'Tier 1+2', 'Tier 1+2+3']) AS stage)),
cells AS (SELECT g.stage, g.doc_id, g.field, f.value, f.tier, t.token AS truth, {sql_token('g.field', 'f.value', 'k.f')} AS token
  FROM grid g LEFT JOIN forms f USING (stage, doc_id, field) LEFT JOIN truth t ON t.doc_id = g.doc_id AND t.field = g.field LEFT JOIN folded k ON k.v = f.value),
scored AS (SELECT stage, doc_id, field, (value IS NOT NULL AND truth IS NOT NULL AND coalesce(token = truth, false))::BIGINT AS tp, (value IS NOT NULL AND NOT coalesce(token = truth, false))::BIGINT AS fp,
  (truth IS NOT NULL AND NOT coalesce(token = truth, false))::BIGINT AS fn, (value IS NULL AND truth IS NULL AND tier IS NOT NULL)::BIGINT AS blank FROM cells)"""
F1 = "round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, {0}) AS f1"


def _truth(spark: SparkSession, d: str, fields: list[str] | None = scoring.SCORABLE) -> DataFrame:
    return scoring.correction_truth(table(spark, d, "correction_outcomes"), fields)


@query(f"WITH {FORMS} SELECT stage, doc_id, field, tp, fp, fn, blank FROM scored")
def scored_cells(spark: SparkSession, d: str) -> DataFrame:
    """Each scorable cell of the documents with truth, in three configurations of readers."""
    truth = _truth(spark, d)
    return scoring.stage_cells(table(spark, d, "field_attempts"), truth, truth)


@query(f"""WITH {FORMS}, s AS (SELECT stage, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, sum(blank)::BIGINT AS blank FROM scored GROUP BY stage) SELECT *, {RATES}, {F1.format(6)} FROM s""")
def by_stage(spark: SparkSession, d: str) -> DataFrame:
    return metrics.rated(scored_cells(spark, d).groupBy("stage").agg(*[F.sum(c).alias(c) for c in metrics.COUNTS]))


@query(f"""WITH {FORMS} SELECT count(*) FILTER (value IS NOT NULL AND tier = '1') AS tier1, count(*) FILTER (value IS NOT NULL AND tier = '2') AS tier2, count(*) FILTER (value IS NOT NULL AND tier NOT IN ('1', '2')) AS tier3,
  count(*) FILTER (value IS NULL AND truth IS NOT NULL) AS missed, count(*) FILTER (value IS NULL AND truth IS NULL) AS true_negative FROM cells WHERE stage = 'Tier 1+2+3'""")
def truth_funnel(spark: SparkSession, d: str) -> DataFrame:
    truth = _truth(spark, d)
    some = table(spark, d, "field_attempts").filter(F.col("field_name").isin(*scoring.SCORABLE)).join(truth.select("doc_id").distinct(), "doc_id", "left_semi")
    done = reconcile.reconcile(reconcile.route(reconcile.by_reader(some)))
    forms = done.select("doc_id", F.col("field_name").alias("field"), F.col("chosen").alias("value"), F.col("reader").alias("tier"))
    return scoring.form_funnel(forms, truth, truth)


LOOSE = "nullif(regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g'), '')"


@query(f"""WITH {BASE}, {TRUTH}, m AS (SELECT doc_id, max(vertical) AS corpus FROM runs GROUP BY doc_id),
t AS (SELECT corpus, lastc.doc_id, field, coalesce({LOOSE.format('value')}, '') AS expected FROM lastc JOIN m USING (doc_id) WHERE value <> ''),
j AS (SELECT t.corpus, t.doc_id, expected, {LOOSE.format('chosen')} AS got FROM t LEFT JOIN done ON done.doc_id = t.doc_id AND done.field_name = t.field),
s AS (SELECT corpus, count(DISTINCT doc_id) AS docs, count(*) FILTER (coalesce(got = expected, false)) AS tp, count(*) FILTER (got IS NOT NULL AND NOT coalesce(got = expected, false)) AS fp, count(*) FILTER (got IS NULL) AS fn FROM j GROUP BY ROLLUP (corpus)),
rr AS (SELECT corpus, docs, tp, fp, fn, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS r FROM s)
SELECT corpus, docs, tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 4) AS f1,
  CASE WHEN round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 4) >= 0.8 THEN 'ship' WHEN round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 4) >= 0.65 THEN 'ship with gap' ELSE 'fall back' END AS verdict FROM rr""")
def coarse_scores(spark: SparkSession, d: str) -> DataFrame:
    """Loose scores of what was chosen, by vertical and for all, over all fields with truth."""
    corpus = table(spark, d, "runs").groupBy("doc_id").agg(F.max("vertical").alias("corpus"))
    truth = _truth(spark, d, None).join(corpus, "doc_id").filter("value <> ''").select("corpus", "doc_id", "field", "value")
    forms = resolved(spark, d).select("doc_id", F.col("field_name").alias("field"), F.col("chosen").alias("value"))
    return scoring.coarse(forms, truth)


CHANGED = f"""WITH {FORMS}, b AS (SELECT sum(tp)::DOUBLE AS tp, sum(fp)::DOUBLE AS fp, sum(fn)::DOUBLE AS fn FROM scored WHERE stage = '{{0}}'), a AS (SELECT sum(tp)::DOUBLE AS tp, sum(fp)::DOUBLE AS fp, sum(fn)::DOUBLE AS fn FROM scored WHERE stage = '{{1}}'),
f AS (SELECT 2 * b.tp / (2 * b.tp + b.fp + b.fn) AS bf, 2 * a.tp / (2 * a.tp + a.fp + a.fn) AS af FROM b, a)
SELECT round(bf, 4) AS baseline_f1, round(af, 4) AS corrected_f1, round(af - bf, 4) AS delta_f1 FROM f"""


@query(CHANGED.replace("{0}", "Tier 1").replace("{1}", "Tier 1+2+3"))
def f1_change(spark: SparkSession, d: str) -> DataFrame:
    """What readers 2 and 3 add to the score of reader 1."""
    cells = scored_cells(spark, d)
    return scoring.change(cells.filter("stage = 'Tier 1'"), cells.filter("stage = 'Tier 1+2+3'"))


@query(f"""WITH {FORMS}, sub AS (SELECT a.doc_id, a.field_name, max(a.value) AS value FROM field_attempts a SEMI JOIN docs USING (doc_id) WHERE tier = '2' GROUP BY ALL),
sv AS (SELECT r.*, sub.value AS s_value, sub.doc_id IS NOT NULL AS s_read FROM r SEMI JOIN docs USING (doc_id) LEFT JOIN sub USING (doc_id, field_name)),
sq AS (SELECT sv.*, fs.k AS ks FROM sv LEFT JOIN folded fs ON fs.v = s_value),
sf AS (SELECT doc_id, field_name AS field, CASE WHEN third THEN s_value ELSE f END AS value, CASE WHEN third THEN '3a' WHEN t2_read THEN '2' WHEN t1_read THEN '1' END AS tier FROM (
  SELECT *, CASE WHEN NOT s_read THEN false WHEN coalesce(ks = ka, false) THEN true WHEN f IS NULL AND s_value IS NULL THEN NOT t2_read AND NOT t1_read WHEN f = s_value THEN false WHEN s_value IS NULL OR (f IS NOT NULL AND coalesce(okf, false)) THEN false ELSE true END AS third FROM sq)),
sc AS (SELECT g.field, s.value, s.tier, t.token AS truth, {sql_token('g.field', 's.value', 'k.f')} AS token FROM grid g LEFT JOIN sf s USING (doc_id, field) LEFT JOIN truth t USING (doc_id, field) LEFT JOIN folded k ON k.v = s.value WHERE g.stage = 'Tier 1'),
x AS (SELECT count(*) FILTER (value IS NOT NULL AND coalesce(token = truth, false)) AS tp, count(*) FILTER (value IS NOT NULL AND NOT coalesce(token = truth, false)) AS fp, count(*) FILTER (truth IS NOT NULL AND NOT coalesce(token = truth, false)) AS fn,
  count(*) FILTER (value IS NULL AND truth IS NULL AND tier IS NOT NULL) AS blank FROM sc)
SELECT tp, fp, fn, blank, {RATES}, {F1.format(6)} FROM x""")
def rescored(spark: SparkSession, d: str) -> DataFrame:
    """The scores of all three readers once more, with reader 2's readings in the place of the strongest reader's."""
    truth = _truth(spark, d)
    a = table(spark, d, "field_attempts").join(truth.select("doc_id").distinct(), "doc_id", "left_semi")
    second = a.filter("tier = '2'").groupBy("doc_id", "field_name").agg(F.max("value").alias("value"), F.max("confidence").alias("confidence"))
    swapped = scoring.substituted(a.filter("not tier <=> '3b'"), second)
    forms = reconcile.reconcile(reconcile.route(reconcile.by_reader(swapped))).select(F.lit("s").alias("stage"), "doc_id", F.col("field_name").alias("field"), F.col("chosen").alias("value"), F.col("reader").alias("tier"))
    cells = scoring.score_cells(forms, truth, truth, scoring.SCORABLE, ["s"])
    return metrics.rated(cells.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in metrics.COUNTS]))


@query(f"""WITH {BASE}, {TRUTH} SELECT d.doc_id, d.field_name, nullif(d.chosen, '') AS original_value, t.token AS corrected_value, d.reader AS tier_that_produced_original
FROM done d JOIN truth_all t ON t.doc_id = d.doc_id AND t.field = d.field_name WHERE t.token <> '' AND (d.reader IS NULL OR (d.chosen IS NOT NULL AND d.confidence < 0.8))""")
def replayed_corrections(spark: SparkSession, d: str) -> DataFrame:
    """The truth of each field for which a document is parked."""
    return scoring.replayed_corrections(resolved(spark, d), _truth(spark, d, None))


@query(f"""WITH {RESOLVED}, e AS (SELECT doc_id, count(*) FILTER (coalesce(route = 'routed', false)) AS n FROM done GROUP BY doc_id)
SELECT count(*) AS docs, coalesce(sum(n), 0)::BIGINT AS routed, round(avg(n), 6) AS mean_routed, count(*) FILTER (n > 0) AS docs_with_any FROM e""")
def routed_per_document(spark: SparkSession, d: str) -> DataFrame:
    """Fields routed to the strongest reader, a document."""
    return scoring.routed_per_document(reconcile.route(reconcile.by_reader(table(spark, d, "field_attempts"), values=False)))


@query(f"""WITH {RESOLVED}, x AS (SELECT d.*, CASE WHEN w.t3_read THEN w.t3_tier WHEN w.t2_read THEN '2' WHEN w.t1_read THEN '1' END AS last FROM done d JOIN w USING (doc_id, field_name))
SELECT doc_id, max(last) AS final_tier, round(coalesce(avg(CASE WHEN chosen IS NOT NULL THEN confidence END), 1.0), 6) AS final_confidence,
  CASE WHEN count(*) FILTER (reader IS NULL OR coalesce(chosen IS NOT NULL AND confidence < 0.8, false)) > 0 THEN 'review_queue' ELSE 'extracted' END AS status FROM x GROUP BY doc_id""")
def run_records(spark: SparkSession, d: str) -> DataFrame:
    """The run of each document through all stages."""
    return reconcile.run_records(resolved(spark, d, values=False))


@query(f"""WITH {RESOLVED} SELECT field_name, CASE WHEN field_name NOT IN ({", ".join(f"'{f}'" for f in reconcile.COVERED)}) AND t2_value IS NOT NULL THEN 'uncovered' ELSE route END AS route, count(*) AS n FROM done GROUP BY ALL""")
def covered_routes(spark: SparkSession, d: str) -> DataFrame:
    """Routes where reader 1 covers the fields of a health form only."""
    w = reconcile.route(reconcile.by_reader(table(spark, d, "field_attempts"), values=False), reconcile.COVERED)
    return w.groupBy("field_name", "route").agg(F.count("*").alias("n"))


FORMATS = ", ".join("('{0}', '{1}', '{2}')".format(k, a, b) for k, pairs in training.FORMATS.items() for a, b in pairs)


@query(f"""WITH {FORMS}, m AS (SELECT doc_id, bool_and(coalesce(lower(trim(split)) IN ('train', 'training'), true)) AND count(split) > 0 AND bool_or(coalesce(vertical = 'healthcare', false)) AS ok FROM manifest_entries WHERE doc_id IS NOT NULL GROUP BY doc_id),
x AS (SELECT c.field, CASE WHEN c.field IN ('date_of_birth', 'date_signed') THEN 'date' WHEN c.field IN ('sex', 'signature') THEN c.field ELSE 'str' END AS kind, token AS got, truth AS response, 'seeded_correction' AS source
  FROM cells c JOIN m USING (doc_id) WHERE m.ok AND stage = 'Tier 1+2+3' AND truth IS NOT NULL AND token IS DISTINCT FROM truth
  UNION ALL SELECT '<' || kind || '_field>', kind, noisy, clean, 'synthetic_format_kind' FROM (VALUES {FORMATS}) v(kind, noisy, clean))
SELECT '{training.INSTRUCTION}' AS instruction, 'Field: ' || field || chr(10) || 'Field type: ' || kind || chr(10) || 'Cascade extracted: ' || coalesce(got, '<BLANK>') AS input, response, source, 'train' AS split FROM x""")
def training_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Examples for a corrector: of train documents where what was chosen isn't the truth, and the fixed ones."""
    truth = _truth(spark, d)
    some = table(spark, d, "field_attempts").filter(F.col("field_name").isin(*scoring.SCORABLE)).join(truth.select("doc_id").distinct(), "doc_id", "left_semi")
    forms = reconcile.reconcile(reconcile.route(reconcile.by_reader(some))).select("doc_id", F.col("field_name").alias("field"), F.col("chosen").alias("value"))
    return training.examples(table(spark, d, "manifest_entries"), truth, forms)

