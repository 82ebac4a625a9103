"""Readings against truth: forms scored over the scorable fields, the three stages, substituted readings, coarse scores and replayed corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import full_form, iso_date, loose, sex_code, stripped
from fieldloom.operators import metrics, reconcile

# Fields of a health form that are scored, and those that are not compared as text.
SCORABLE = ["first_name", "last_name", "address_street", "address_city", "address_state", "address_zip", "phone", "reason_for_visit", "date_of_birth", "date_signed", "sex", "signature"]
DATES = ["date_of_birth", "date_signed"]
#: Coarse F1 from which a reader is kept as it is, and from which it is kept with its gap documented.
SHIP, GAP = 0.80, 0.65
STAGES = ["Tier 1", "Tier 1+2", "Tier 1+2+3"]


def token(field: Column, value: Column) -> Column:
    """What a reading is compared with truth by: a day, a sex, the presence of a signature, else the folded text; null where the value is none of its kind."""
    signed = F.when(full_form(value) == "absent", "absent").when(value.isNotNull(), "present")
    return F.when(field.isin(DATES), iso_date(value)).when(field == "sex", sex_code(value)).when(field == "signature", signed).otherwise(full_form(value))


def correction_truth(corrections: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """doc_id, field, value, token: what reviewers say is on a form, for the documents that have readings: the corrected value of the latest correction whose field name, in any case and with white space
    around, is exactly the name of a field (fields; None for all). Typed names that need mapping are left out, as are corrections without a value; of two of the same time the larger id counts."""
    name = F.lower(stripped(F.col("field_name")))
    c = corrections.select("doc_id", name.alias("field"), F.col("corrected_value").alias("value"), "created_at", "correction_id").filter("doc_id is not null and field is not null and value is not null")
    if fields is not None:
        c = c.filter(F.col("field").isin(*fields))
    last = c.groupBy("doc_id", "field").agg(F.max(F.struct("created_at", "correction_id", "value"))["value"].alias("value"))
    return last.withColumn("token", token(F.col("field"), F.col("value"))).filter("token is not null")


def form_funnel(forms: DataFrame, truth: DataFrame, docs: DataFrame, scorable: list[str] = SCORABLE) -> DataFrame:
    """tier1, tier2, tier3, missed, true_negative: each scorable cell of each document once, by the reader whose value stands, or by whether there was anything to be read. forms: doc_id, field, value, tier."""
    grid = docs.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[F.lit(n) for n in scorable])).alias("field"))
    j = grid.join(forms.select("doc_id", "field", "value", "tier"), ["doc_id", "field"], "left").join(truth.select("doc_id", "field", F.col("token").alias("truth")), ["doc_id", "field"], "left")
    there, known = F.col("value").isNotNull(), F.col("truth").isNotNull()
    n = lambda c, name: F.count_if(c).alias(name)
    return j.agg(n(there & (F.col("tier") == "1"), "tier1"), n(there & (F.col("tier") == "2"), "tier2"), n(there & ~F.col("tier").isin("1", "2"), "tier3"), n(~there & known, "missed"), n(~there & ~known, "true_negative"))


def score_cells(forms: DataFrame, truth: DataFrame, docs: DataFrame, scorable: list[str], stages: list[str]) -> DataFrame:
    """stage, doc_id, field and tp, fp, fn, blank of each scorable field of each document in each stage: all of them stand, whether or not there is a reading or a truth.

    forms: stage, doc_id, field, value, tier, a row a field. truth: doc_id, field, token, a row a field. docs: doc_id."""
    every = lambda names: F.explode(F.array(*[F.lit(n) for n in names]))
    grid = docs.select("doc_id").distinct().select("doc_id", every(scorable).alias("field")).join(truth.select("doc_id", "field", F.col("token").alias("truth")), ["doc_id", "field"], "left")
    read = forms.select("stage", "doc_id", "field", "value", "tier", token(F.col("field"), F.col("value")).alias("token"))
    j = grid.select("doc_id", "field", "truth", every(stages).alias("stage")).join(read, ["stage", "doc_id", "field"], "left")
    counts = metrics.cell_counts(F.col("value"), F.col("tier"), F.col("token"), F.col("truth"))
    return j.select("stage", "doc_id", "field", *[c.alias(n) for n, c in counts.items()])


def score_forms(forms: DataFrame, truth: DataFrame, docs: DataFrame, scorable: list[str] = SCORABLE, stages: list[str] = STAGES) -> DataFrame:
    """stage, tp, fp, fn, blank, precision, recall, f1, all stages in one pass."""
    cells = score_cells(forms, truth, docs, scorable, stages)
    return metrics.rated(cells.groupBy("stage").agg(*[F.sum(c).alias(c) for c in metrics.COUNTS]))


def stage_items(attempts: DataFrame) -> DataFrame:
    """doc_id, field, forms (array of stage, value, tier) of the three configurations: reader 1; readers 1 and 2, reader 2 in the place of the strongest too; all three. All are made of one row an item, in one pass."""
    extra = ["rule_no", "chosen", "chosen_key", "confidence", "reader"]
    every = reconcile.reconcile(reconcile.route(reconcile.by_reader(attempts)))
    every = every.withColumns({"_value": F.col("chosen"), "_tier": F.col("reader")}).drop(*extra)
    asked = F.coalesce(F.col("route") == "routed", F.lit(False))
    second = every.withColumns({f"t3_{c}": F.when(asked, F.col(f"t2_{c}")) for c in ("value", "conf", "key", "ok", "tier")} | {"t3_read": asked & F.col("t2_read")})
    done = reconcile.reconcile(second)
    one = lambda stage, value, tier, there: F.when(there, F.struct(F.lit(stage).alias("stage"), value.alias("value"), tier.alias("tier")))
    forms = F.array_compact(F.array(
        one(STAGES[0], F.col("t1_value"), F.lit("1"), F.col("t1_read")), one(STAGES[1], F.col("chosen"), F.col("reader"), F.lit(True)), one(STAGES[2], F.col("_value"), F.col("_tier"), F.lit(True)),
    ))
    return done.select("doc_id", F.col("field_name").alias("field"), forms.alias("forms"))


def stage_forms(attempts: DataFrame) -> DataFrame:
    """stage, doc_id, field, value, tier: stage_items(), a row a configuration."""
    return stage_items(attempts).select("doc_id", "field", F.inline("forms")).select("stage", "doc_id", "field", "value", "tier")


def stage_cells(attempts: DataFrame, truth: DataFrame, docs: DataFrame, scorable: list[str] = SCORABLE) -> DataFrame:
    """score_cells() of stage_forms(), for the scorable fields of the documents of docs only.

    Other readings are left out before anything is brought together; a document's items and truths, at most one a scorable field each, are then joined by document, and its cells are made where they lie."""
    some = docs.select("doc_id").distinct()
    items = stage_items(attempts.filter(F.col("field_name").isin(*scorable)).join(some, "doc_id", "left_semi"))
    of_doc = items.groupBy("doc_id").agg(F.collect_list(F.struct("field", "forms")).alias("items"))
    known = truth.filter(F.col("field").isin(*scorable)).groupBy("doc_id").agg(F.collect_list(F.struct("field", "token")).alias("truths"))
    j = some.join(known, "doc_id", "left").join(of_doc, "doc_id", "left")
    every = lambda names: F.explode(F.array(*[F.lit(n) for n in names]))
    first = lambda c, of, name: F.get(F.filter(c, lambda x: x[of] == F.col(name)), F.lit(0))
    j = j.select("doc_id", "items", "truths", every(scorable).alias("field"))
    j = j.select("doc_id", "field", first("items", "field", "field")["forms"].alias("forms"), first("truths", "field", "field")["token"].alias("truth"))
    j = j.select("doc_id", "field", "forms", "truth", every(STAGES).alias("stage")).withColumn("f", first("forms", "stage", "stage")).select("stage", "doc_id", "field", "truth", F.col("f.value").alias("value"), F.col("f.tier").alias("tier"))
    counts = metrics.cell_counts(F.col("value"), F.col("tier"), token(F.col("field"), F.col("value")), F.col("truth"))
    return j.select("stage", "doc_id", "field", *[c.alias(n) for n, c in counts.items()])


def substituted(attempts: DataFrame, readings: DataFrame, tier: str = "3a") -> DataFrame:
    """attempts with all readings of one tier replaced by others (doc_id, field_name, value, confidence)."""
    cols = ["doc_id", "field_name", "tier", "value", "confidence"]
    return attempts.filter(~F.col("tier").eqNullSafe(F.lit(tier))).select(*cols).unionByName(readings.withColumn("tier", F.lit(tier)).select(*cols))


def change(before: DataFrame, after: DataFrame) -> DataFrame:
    """baseline_f1, corrected_f1, delta_f1 of the summed counts of two scorings, to 4 digits."""
    f = lambda df, n: metrics.rated(df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]), digits=15).select(F.col("f1").alias(n))
    j = f(before, "b").crossJoin(f(after, "a"))
    return j.select(F.round("b", 4).alias("baseline_f1"), F.round("a", 4).alias("corrected_f1"), F.round(F.col("a") - F.col("b"), 4).alias("delta_f1"))


def coarse(forms: DataFrame, truth: DataFrame) -> DataFrame:
    """corpus (null for all together), docs, tp, fp, fn, precision, recall, f1, verdict. A field with truth counts once: right if the value is loosely any of its truths, a wrong value as false positive only, none as missed; ratios of nothing are 0.

    forms: doc_id, field, value, a row a field. truth: corpus, doc_id, field, value, several rows a field allowed."""
    known = truth.filter("value <> ''").groupBy("corpus", "doc_id", "field").agg(F.collect_set(F.coalesce(loose(F.col("value")), F.lit(""))).alias("expected"))
    j = known.join(forms.select("doc_id", "field", loose(F.col("value")).alias("got")), ["doc_id", "field"], "left")
    hit = F.coalesce(F.array_contains("expected", F.col("got")), F.lit(False))
    n = lambda c, name: F.count_if(c).alias(name)
    docs = truth.select("corpus", "doc_id").distinct().rollup("corpus").agg(F.count("*").alias("docs"), F.grouping("corpus").alias("g"))
    sums = j.rollup("corpus").agg(n(hit, "tp"), n(F.col("got").isNotNull() & ~hit, "fp"), n(F.col("got").isNull(), "fn"), F.grouping("corpus").alias("g"))
    both = docs.alias("d").join(sums.alias("s"), F.col("d.corpus").eqNullSafe(F.col("s.corpus")) & (F.col("d.g") == F.col("s.g")), "left")
    out = metrics.rated(both.select("d.corpus", "docs", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]), empty=0.0, digits=4)
    return out.withColumn("verdict", F.when(F.col("f1") >= SHIP, "ship").when(F.col("f1") >= GAP, "ship with gap").otherwise("fall back"))


def routed_per_document(wide: DataFrame) -> DataFrame:
    """docs, routed, mean_routed, docs_with_any: fields that go to the strongest reader (rows of reconcile.route)."""
    each = wide.groupBy("doc_id").agg(F.count_if(F.coalesce(F.col("route") == "routed", F.lit(False))).alias("n"))
    return each.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("routed"), F.round(F.avg("n"), 6).alias("mean_routed"), F.count_if(F.col("n") > 0).alias("docs_with_any"))


def tokens_per_second(count: Column, nanoseconds: Column) -> Column:
    """Tokens a second of a reply; null where either is missing or 0."""
    return F.when((count != 0) & (nanoseconds != 0), count / (nanoseconds / 1e9))


def replayed_corrections(resolved: DataFrame, truth: DataFrame) -> DataFrame:
    """doc_id, field_name, original_value, corrected_value, tier_that_produced_original: the truth of each field for which a document is parked; fields without one give no correction.

    truth: doc_id, field, token, a row a field."""
    known = truth.filter("token <> ''").select("doc_id", F.col("field").alias("field_name"), F.col("token").alias("corrected_value"))
    return reconcile.below_gate(resolved).join(known, ["doc_id", "field_name"]).select("doc_id", "field_name", F.nullif(F.col("chosen"), F.lit("")).alias("original_value"), "corrected_value", F.col("reader").alias("tier_that_produced_original"))
