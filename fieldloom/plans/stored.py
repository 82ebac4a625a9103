"""Registered queries of what is written to the store, asked of readers, shown, and fanned out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import dictionary as D
from fieldloom.operators import forms, layout, metrics, pages, reconcile, retrieval, store
from fieldloom.plans import folding
from fieldloom.plans.catalogue import ALIASES, RESOLVED, query, resolved
from fieldloom.runtime import table
from fieldloom.sources import writers

ATTEMPTS = """att AS (SELECT doc_id, field_name, tier, value, confidence, latency_ms FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, field_name, tier ORDER BY confidence DESC NULLS LAST, value DESC NULLS LAST, latency_ms DESC NULLS LAST) AS rn
  FROM (SELECT DISTINCT doc_id, field_name, tier, value, confidence, CASE WHEN NOT isnan(latency_ms) THEN latency_ms END AS latency_ms FROM field_attempts)) WHERE rn = 1)"""


def attempts(spark: SparkSession, d: str) -> DataFrame:
    """One reading of each document, field and tier: the most confident; latencies that are no numbers are none."""
    a = table(spark, d, "field_attempts").select("doc_id", "field_name", "tier", "confidence", "value", F.when(~F.isnan("latency_ms"), F.col("latency_ms")).alias("latency_ms"))
    return store.keep_latest(a, ["doc_id", "field_name", "tier"], ["confidence", "value", "latency_ms"])


# ---- forms

@query(f"WITH {ATTEMPTS} SELECT doc_id, field_name AS name, coalesce(value, '') AS value, confidence, tier AS tier_used, (value IS NOT NULL AND coalesce(confidence < 0.8, false)) AS below_gate, value IS NULL AS blank FROM att WHERE tier = '2'")
def field_rows(spark: SparkSession, d: str) -> DataFrame:
    """Reader 2's forms, as they are shown."""
    return forms.field_rows(attempts(spark, d).filter("tier = '2'"), "field_name")


@query(f"""WITH {ATTEMPTS} SELECT doc_id, field_name, tier, value, confidence, CASE WHEN value IS NOT NULL AND coalesce(confidence < 0.85, false) THEN 'low_confidence' END AS escalation_reason, latency_ms FROM att WHERE tier = '1'""")
def attempt_rows(spark: SparkSession, d: str) -> DataFrame:
    """Reader 1's forms, as the store keeps them."""
    return forms.attempt_rows(attempts(spark, d).filter("tier = '1'"), F.col("latency_ms"))


@query(f"""WITH {RESOLVED}, v AS (SELECT canonical_name, min(vertical) AS vertical FROM alias_dictionary GROUP BY canonical_name)
SELECT doc_id, string_agg(field_name, ',' ORDER BY vertical, field_name) AS fields FROM done JOIN v ON canonical_name = field_name WHERE route = 'routed' GROUP BY doc_id""")
def narrowed_requests(spark: SparkSession, d: str) -> DataFrame:
    """What the strongest reader is asked for, document by document, of the fields that the dictionary has."""
    known = table(spark, d, "alias_dictionary")
    routed = reconcile.route(reconcile.by_reader(table(spark, d, "field_attempts"), values=False)).filter("route = 'routed'")
    routed = routed.join(F.broadcast(known.select(F.col("canonical_name").alias("field_name")).distinct()), "field_name", "left_semi")
    return forms.narrowed(routed, known).select("doc_id", F.array_join("fields", ",").alias("fields"))


@query("""SELECT vertical, '{"type": "object", "properties": {' || string_agg('"' || canonical_name || '": {"type": ["' || CASE data_type WHEN 'boolean' THEN 'boolean' WHEN 'integer' THEN 'integer' WHEN 'float' THEN 'number' ELSE 'string' END || '", "null"]}', ', ' ORDER BY canonical_name)
  || '}, "required": [' || string_agg('"' || canonical_name || '"', ', ' ORDER BY canonical_name) || '], "additionalProperties": false}' AS schema FROM alias_dictionary WHERE data_type IN ('string', 'enum', 'boolean', 'integer', 'float', 'date') GROUP BY vertical""")
def response_schemas(spark: SparkSession, d: str) -> DataFrame:
    return forms.response_schema(table(spark, d, "alias_dictionary"))


@query("SELECT doc_id, 'stage' || router_stage || ':' || vertical AS routing_decision, count(*) AS n FROM runs GROUP BY ALL")
def stamped_runs(spark: SparkSession, d: str) -> DataFrame:
    return forms.stamped(table(spark, d, "runs")).groupBy("doc_id", "routing_decision").agg(F.count("*").alias("n"))


WANTED = ["first_name", "last_name", "address_street", "address_city", "address_state", "address_zip", "phone", "reason_for_visit", "date_of_birth", "date_signed", "sex"]


@query(f"""WITH j AS (SELECT doc_id, CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT' THEN list_sort(list_distinct(json_keys(text))) END AS keys FROM documents)
SELECT keys IS NOT NULL AS is_object, coalesce(keys = list_sort([{", ".join(f"'{w}'" for w in WANTED)}]), false) AS exact, count(*) AS n, coalesce(sum(len(keys)), 0)::BIGINT AS keys FROM j GROUP BY 1, 2""")
def reply_adherence(spark: SparkSession, d: str) -> DataFrame:
    """How many documents are, as a whole, a JSON object, and how many have exactly the keys of a health form that were asked for."""
    keys = forms.object_keys(F.col("text"))
    j = table(spark, d, "documents").select(keys.isNotNull().alias("is_object"), forms.adheres(F.col("text"), WANTED).alias("exact"), F.size(keys).alias("k"))
    return j.groupBy("is_object", "exact").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("is_object"), F.col("k"))), F.lit(0)).cast("long").alias("keys"))


@query("""SELECT correction_id, replace(replace(replace(replace(replace(corrected_value, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped, coalesce(alias_learned::VARCHAR, '') AS shown FROM correction_outcomes""")
def escaped_values(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "correction_outcomes")
    return c.select("correction_id", forms.xml_escaped(F.col("corrected_value")).alias("escaped"), forms.shown(F.col("alias_learned")).alias("shown"))


# ---- what is written

@query(f"""WITH {RESOLVED}, b AS (SELECT doc_id, field_name, coalesce(reader, 'none') AS tier FROM done WHERE reader IS NULL OR (chosen IS NOT NULL AND confidence < 0.8))
SELECT doc_id, '[' || string_agg('{{"tier":"' || tier || '","error":"below the gate: ' || field_name || '"}}', ',' ORDER BY field_name, tier) || ']' AS error_history FROM b GROUP BY doc_id""")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    """The review queue's rows of parked documents, with what they are parked for as their history."""
    b = reconcile.below_gate(resolved(spark, d, values=False))
    return writers.review_rows(b.select("doc_id", F.col("field_name").alias("pos"), F.coalesce("reader", F.lit("none")).alias("tier"), F.concat(F.lit("below the gate: "), "field_name").alias("error")))


@query(f"""WITH {RESOLVED}, new AS (SELECT doc_id, field_name, chosen AS original_value FROM done WHERE chosen IS NOT NULL AND confidence < 0.8), m AS (SELECT max(correction_id) AS m FROM correction_outcomes)
SELECT true AS appended, count(*) AS n, min(m) + 1 AS first_id, min(m) + count(*) AS last_id, count(*) AS ids FROM new, m
UNION ALL SELECT false, count(*), min(correction_id), max(correction_id), count(DISTINCT correction_id) FROM correction_outcomes""")
def appended_corrections(spark: SparkSession, d: str) -> DataFrame:
    """The corrections with one more for each doubtful value, under ids that go on from the largest."""
    old = table(spark, d, "correction_outcomes").select("correction_id", "doc_id", "field_name", "original_value")
    new = reconcile.below_gate(resolved(spark, d)).filter("chosen is not null").select("doc_id", "field_name", F.col("chosen").alias("original_value"))
    every, _ = writers.append_corrections(old, new, table(spark, d, "runs"))
    last = old.agg(F.max("correction_id").alias("m"))
    j = every.crossJoin(F.broadcast(last)).withColumn("appended", F.col("correction_id") > F.col("m"))  # one row
    return j.groupBy("appended").agg(F.count("*").alias("n"), F.min("correction_id").alias("first_id"), F.max("correction_id").alias("last_id"), F.count_distinct("correction_id").alias("ids"))


@query("SELECT label::VARCHAR AS doc_id, count(*) AS rows, (12 + 4 * sum(len(embedding)))::BIGINT AS bytes FROM embeddings GROUP BY label")
def embedding_matrices(spark: SparkSession, d: str) -> DataFrame:
    """The packed matrix of each label's vectors, upserted over an empty table: its rows as they are unpacked, and its size."""
    m = writers.matrices(table(spark, d, "embeddings"), "label", "vec_id", "embedding")
    kept = store.upsert(m.limit(0), m, ["doc_id"])
    return kept.select("doc_id", F.size(retrieval.unpacked("matrix")).cast("long").alias("rows"), F.length("matrix").cast("long").alias("bytes"))


@query("SELECT vec_id, label FROM embeddings WHERE label NOT IN (0, 3)")
def other_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """The corpus without two documents."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("doc_id"), "label")
    return writers.corpus(e, ["0", "3"]).select("vec_id", "label")


@query("""SELECT doc_id, m.vertical AS vertical, m.split AS split, m.image_sha256 AS image_sha256 FROM (SELECT doc_id, max(struct_pack(vertical := coalesce(vertical, ''), split := coalesce(split, ''), image_sha256 := coalesce(image_sha256, ''))) AS m
  FROM manifest_entries WHERE doc_id IS NOT NULL GROUP BY doc_id)""".replace("m.vertical AS", "nullif(m.vertical, '') AS").replace("m.split AS", "nullif(m.split, '') AS").replace("m.image_sha256 AS", "nullif(m.image_sha256, '') AS"))
def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as it is written, one row a document."""
    return writers.manifest_rows(table(spark, d, "manifest_entries"))


@query("SELECT status, status IN ('extracted', 'review_queue', 'failed') AS known, count(*) AS n FROM runs WHERE status IS NOT NULL GROUP BY ALL")
def run_statuses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "runs").filter("status is not null").groupBy("status", writers.status_ok(F.col("status")).alias("known")).agg(F.count("*").alias("n"))


# ---- pages, manifests, splits

@query("""WITH s AS (SELECT doc_id, min(image_sha256) AS image_sha256 FROM sidecars WHERE doc_id IS NOT NULL GROUP BY doc_id), k AS (SELECT *, regexp_replace(doc_id, '-[^-]*$', '') AS partition_key FROM s),
h AS (SELECT *, ('0x' || substr(sha256('intake-v1:' || partition_key), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS x FROM k)
SELECT doc_id, 'healthcare' AS vertical, partition_key, CASE WHEN x < 0.7 THEN 'train' WHEN x < 0.85 THEN 'dev' ELSE 'test' END AS split, image_sha256 FROM h""")
def sidecar_manifest(spark: SparkSession, d: str) -> DataFrame:
    return pages.manifest_of(table(spark, d, "sidecars"), "healthcare")


@query("""SELECT doc_id, coalesce(list_filter(fields, lambda f: f.name = 'patient_name' AND trim(f.value) <> '')[1].value, doc_id) AS label, count(*) AS n, coalesce(page.width_px > 0 AND page.height_px > 0, false) AS sized FROM sidecars GROUP BY ALL""")
def sidecar_labels(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sidecars")
    return s.groupBy("doc_id", pages.label_of(F.col("fields"), F.col("doc_id")).alias("label"), pages.has_size(F.col("page")).alias("sized")).agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT DISTINCT doc_id FROM manifest_entries WHERE lower(trim(split)) = 'test'), s AS (SELECT doc_id, min(image_sha256) AS image_sha256 FROM sidecars GROUP BY doc_id) SELECT doc_id, image_sha256 FROM m JOIN s USING (doc_id)""")
def split_scan(spark: SparkSession, d: str) -> DataFrame:
    """The test documents whose sidecar there is, in order."""
    return pages.of_split(table(spark, d, "manifest_entries"), "test", table(spark, d, "sidecars"), refuse=False)


@query("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 14")
def first_documents(spark: SparkSession, d: str) -> DataFrame:
    """The first 14 documents of each source."""
    return pages.first_of(table(spark, d, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", 14)


# ---- dictionary

@query("SELECT count(*) AS records, sum(len(aliases))::BIGINT AS aliases FROM alias_dictionary")
def dictionary_totals(spark: SparkSession, d: str) -> DataFrame:
    return D.totals(table(spark, d, "alias_dictionary"))


@query("""SELECT canonical_name, vertical, data_type, description, data_class, sensitivity, source_standard, array_to_string(aliases, '|') AS aliases, CASE vertical WHEN 'base' THEN 0 WHEN 'insurance' THEN 1 WHEN 'healthcare' THEN 2 WHEN 'hr' THEN 3 ELSE 4 END::INTEGER AS rank FROM alias_dictionary
UNION ALL SELECT canonical_name, 'hr', data_type, description || ' at work', data_class, sensitivity, source_standard, array_to_string(aliases, '|'), 3 FROM alias_dictionary WHERE vertical = 'base' AND canonical_name LIKE '%name'""")
def alias_seed(spark: SparkSession, d: str) -> DataFrame:
    """The dictionary built anew: every base field is taken over by the hr form, the names with another description, so only these become records of their own, with the base's aliases."""
    a = table(spark, d, "alias_dictionary")
    over = a.filter("vertical = 'base'").withColumn("vertical", F.lit("hr")).withColumn("description", F.when(F.col("canonical_name").endswith("name"), F.concat("description", F.lit(" at work"))).otherwise(F.col("description")))
    return D.build_seed(a.unionByName(over), a.select("canonical_name", "vertical", "aliases")).withColumn("aliases", F.array_join("aliases", "|"))


@query(f"""WITH {ALIASES}, b AS (SELECT unnest(range(1, (SELECT max(len(aliases)) FROM alias_dictionary) + 1)) AS batch), e AS (SELECT DISTINCT batch, field, vertical, upper(trim(alias)) AS alias FROM al JOIN b ON alias_pos < batch),
v AS (SELECT batch, alias, 1.0::DOUBLE / count(*) AS weight FROM e WHERE vertical = 'healthcare' AND (batch, alias) NOT IN (SELECT (batch, alias) FROM e WHERE vertical IN ('base', 'insurance', 'hr')) GROUP BY ALL),
s AS (SELECT batch, doc_id, sum(weight) AS score FROM documents JOIN v ON contains(upper(text), alias) GROUP BY ALL)
SELECT batch::INTEGER AS batch, count(*) AS docs, count(*) FILTER (score >= 1.0) AS routed, round(sum(score), 4) AS score FROM s GROUP BY batch""")
def sweep_scores(spark: SparkSession, d: str) -> DataFrame:
    """How many documents are routed at once with the first n aliases of each record, for every n."""
    s = D.sweep(table(spark, d, "documents"), table(spark, d, "alias_dictionary"))
    return s.groupBy("batch").agg(F.count("*").alias("docs"), F.count_if(F.col("score") >= D.ROUTE_AT).alias("routed"), F.round(F.sum("score"), 4).alias("score"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) SELECT doc_id, count(*) AS n_lines FROM l WHERE trim(line) <> '' GROUP BY doc_id""")
def line_counts(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "documents").select("doc_id", F.lit("text").alias("label"), F.col("text").alias("content"))
    return layout.lines(b, ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("n_lines"))


@query("""WITH m AS (SELECT DISTINCT doc_id FROM manifest_entries WHERE doc_id IS NOT NULL), s AS (SELECT DISTINCT doc_id FROM sidecars WHERE doc_id IS NOT NULL)
SELECT true AS has_image, false AS has_sidecar, count(*) AS n FROM m WHERE doc_id NOT IN (SELECT doc_id FROM s) HAVING count(*) > 0 UNION ALL SELECT false, true, count(*) FROM s WHERE doc_id NOT IN (SELECT doc_id FROM m) HAVING count(*) > 0""")
def sidecar_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Manifest documents without a sidecar, and the other way round."""
    from fieldloom.sources import files

    p = files.pairs(table(spark, d, "manifest_entries").filter("doc_id is not null"), table(spark, d, "sidecars").filter("doc_id is not null"), "doc_id")
    return p.groupBy("has_image", "has_sidecar").agg(F.count("*").alias("n"))


@query(f"""WITH t AS (SELECT doc_id, CASE WHEN contains(value, ',') THEN trim(split_part(value, ',', 1)) END AS part FROM (SELECT doc_id, f.name AS name, f.value AS value FROM (SELECT doc_id, unnest(fields) AS f FROM sidecars)) WHERE name = 'patient_name'),
{folding.folded("SELECT part AS v FROM t")} SELECT f AS last_name, count(DISTINCT doc_id) AS docs FROM t JOIN folded ON v = part WHERE f IS NOT NULL GROUP BY f""")
def names_in_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """Documents by folded last name."""
    from fieldloom.operators import flatten

    t = flatten.sidecar_truth(table(spark, d, "sidecars")).filter("field = 'last_name'")
    return t.groupBy(F.col("token").alias("last_name")).agg(F.count_distinct("doc_id").alias("docs"))


@query("SELECT doc_id, count(*) AS n FROM (SELECT doc_id, split FROM manifest_entries WHERE doc_id IS NOT NULL AND split IS NOT NULL GROUP BY ALL) GROUP BY doc_id HAVING count(*) > 1")
def split_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents that stand in the manifest under several spellings or splits."""
    return metrics.mixed_keys(table(spark, d, "manifest_entries"), "doc_id", "split").select("doc_id", F.size("splits").cast("long").alias("n"))
