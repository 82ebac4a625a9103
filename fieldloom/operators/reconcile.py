"""Escalation, routing to the strongest reader, reconciliation of three readers, parking and attribution, over the long form of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import comparable, same_reading, verdict

# Fields of a health form that reader 1 can read; gates and the confidences that agreement, a single reading and a disagreement give.
COVERED = ["first_name", "last_name", "address_street", "address_city", "address_state", "address_zip", "phone", "reason_for_visit", "date_of_birth", "date_signed", "sex"]
ESCALATE_BELOW, REVIEW_BELOW = 0.85, 0.80
AGREED, SINGLE, DISPUTED = 0.95, 0.85, 0.5


def escalates(tier: Column, value: Column, confidence: Column, gate: float = ESCALATE_BELOW) -> Column:
    """A field never attempted, or with a value of too little confidence; a confident blank does not."""
    return tier.isNull() | F.coalesce(value.isNotNull() & (confidence < gate), F.lit(False))


#: Readers 1 and 2, and the strongest ones, of which the last that read a field counts.
READERS = {"t1": ["1"], "t2": ["2"], "t3": ["3a", "3b"]}


def by_reader(attempts: DataFrame, values: bool = True) -> DataFrame:
    """doc_id, field_name and, for readers 1, 2 and the strongest as t1, t2 and t3: value, conf, key (what it is compared by), ok (its rule's verdict), tier and read.

    One aggregate in place of three joins; keys and verdicts are made once a reading. Keys are compared by 64-bit hashes, of which two different ones of an item would have to be equal, at 5e-20 a pair. Of several
    rows of a reader and field one with a value counts, the most confident; among equal ones the larger value. values: without it a value is its hash too, for what only asks whether there is one and
    whether it equals another; about half of the bytes are then shuffled."""
    tiers = [t for ts in READERS.values() for t in ts]
    hashed = lambda c: F.when(c.isNotNull(), F.xxhash64(c))
    a = attempts.filter(F.col("tier").isin(*tiers)).select("doc_id", "field_name", "tier", "confidence", "value", hashed(comparable(F.col("value"))).alias("key"), verdict(F.col("field_name"), F.col("value")).alias("ok"))
    a = a if values else a.withColumn("value", hashed(F.col("value")))
    mine = F.struct("tier", F.col("value").isNotNull(), "confidence", "value", "key", "ok")
    g = a.groupBy("doc_id", "field_name").agg(*[F.max(F.when(F.col("tier").isin(*ts), mine)).alias(n) for n, ts in READERS.items()])
    out = [F.col(f"{n}.{c}").alias(f"{n}_{k}") for n in READERS for c, k in (("value", "value"), ("confidence", "conf"), ("key", "key"), ("ok", "ok"), ("tier", "tier"))]
    return g.select("doc_id", "field_name", *out, *[F.col(n).isNotNull().alias(f"{n}_read") for n in READERS])


def route(wide: DataFrame, covered: list[str] | None = None) -> DataFrame:
    """wide with route: "uncovered" (kept at SINGLE), "agree" (readers 1 and 2 say the same) or "routed" to the strongest reader; null where reader 2 has nothing to settle.

    covered: fields that reader 1 can read, such as COVERED; None for all."""
    is_covered = F.lit(True) if covered is None else F.col("field_name").isin(covered)
    return wide.withColumn("route", F.when(~is_covered & F.col("t2_value").isNotNull(), "uncovered").when(F.col("t1_key") == F.col("t2_key"), "agree").when(F.col("t2_read"), "routed"))


def reconcile(wide: DataFrame, specific: Column | None = None) -> DataFrame:
    """wide with rule_no, chosen, chosen_key, confidence and reader of each field.

    F is the running value (reader 2, else 1), S the strongest reader's, A a reading of reader 1 that its validator does not refute.
    1: S says what A says, S at AGREED. 2: all blank and never stamped, blank. 3: both blank. 4: F and S are equal, letter for letter, AGREED. 5: S is blank or F is
    valid by a rule, F at DISPUTED. 6: else S at DISPUTED. 7: after 4 to 6, where A says something else than what was chosen, DISPUTED.
    A field that the strongest reader was not asked for keeps F, as rule 0. specific: whether reader 1 found its value under a label that is the field's own; where it is false, 7 does not apply."""
    second = F.col("t2_value").isNotNull()
    f, s = F.coalesce("t2_value", "t1_value"), F.col("t3_value")
    f_key, f_ok = F.when(second, F.col("t2_key")).otherwise(F.col("t1_key")), F.when(second, F.col("t2_ok")).otherwise(F.col("t1_ok"))
    a_key = F.when(F.coalesce("t1_ok", F.lit(True)), F.col("t1_key"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    rule = (
        F.when(~F.col("t3_read"), 0).when(yes(F.col("t3_key") == a_key), 1)
        .when(f.isNull() & s.isNull() & ~F.col("t2_read") & ~F.col("t1_read"), 2).when(f.isNull() & s.isNull(), 3)
        .when(yes(f == s), 4).when(s.isNull() | (f.isNotNull() & yes(f_ok)), 5).otherwise(6)
    )
    out = wide.withColumn("_rule", rule).withColumn("_third", F.col("_rule").isin(1, 2, 6))
    out = out.withColumn("chosen", F.when(F.col("_third"), s).otherwise(f)).withColumn("chosen_key", F.when(F.col("_third"), F.col("t3_key")).otherwise(f_key))
    has_a = F.coalesce("t1_ok", F.lit(True)) & F.col("t1_value").isNotNull() & (F.lit(True) if specific is None else F.coalesce(specific, F.lit(True)))
    against = F.col("_rule").isin(4, 5, 6) & has_a & ~yes(a_key == F.col("chosen_key"))
    out = out.withColumn("rule_no", F.when(against, 7).otherwise(F.col("_rule")))
    running = F.coalesce(F.when(F.col("t2_read"), F.col("t2_conf")), "t1_conf")
    confidence = F.when(F.col("rule_no").isin(1, 4), AGREED).when(F.col("rule_no").isin(5, 6, 7), DISPUTED).otherwise(running)
    reader = F.when(F.col("_third"), F.coalesce("t3_tier", F.lit("3a"))).when(F.col("t2_read"), "2").when(F.col("t1_read"), "1")
    return out.withColumn("confidence", confidence).withColumn("reader", reader).drop("_rule", "_third")


def below_gate(resolved: DataFrame) -> DataFrame:
    """The fields for which a document is parked: never read, or with a value below the review gate."""
    below = F.col("chosen").isNotNull() & (F.col("confidence") < REVIEW_BELOW)
    return resolved.filter(F.col("reader").isNull() | F.coalesce(below, F.lit(False)))


def parked(resolved: DataFrame) -> DataFrame:
    """doc_id, drivers (fields below the review gate, in order), lowest: documents with a field that was never read or has a value below the gate."""
    return below_gate(resolved).groupBy("doc_id").agg(F.sort_array(F.collect_list("field_name")).alias("drivers"), F.min("confidence").alias("lowest"))


def run_records(resolved: DataFrame) -> DataFrame:
    """doc_id, final_tier (the last reader that was asked), final_confidence (the mean over populated fields, 1 for none), status: a document's run through all stages. It is reviewed if any field is below the gate."""
    last = F.when(F.col("t3_read"), F.col("t3_tier")).when(F.col("t2_read"), "2").when(F.col("t1_read"), "1")
    low = F.col("reader").isNull() | F.coalesce(F.col("chosen").isNotNull() & (F.col("confidence") < REVIEW_BELOW), F.lit(False))
    mean = F.round(F.coalesce(F.avg(F.when(F.col("chosen").isNotNull(), F.col("confidence"))), F.lit(1.0)), 6)
    return resolved.groupBy("doc_id").agg(F.max(last).alias("final_tier"), mean.alias("final_confidence"), F.when(F.count_if(low) > 0, "review_queue").otherwise("extracted").alias("status"))


def park_after_failure(resolved: DataFrame, failed: Column) -> DataFrame:
    """Where the strongest reader failed, values that were to be settled by it fall to DISPUTED."""
    hit = F.coalesce(failed, F.lit(False)) & F.col("chosen").isNotNull() & (F.col("route") == "routed")
    return resolved.withColumn("confidence", F.when(hit, DISPUTED).otherwise(F.col("confidence")))


def attribution(resolved: DataFrame) -> DataFrame:
    """reason, n: why values of the strongest reader were kept: it matched reader 1, reader 2 was blank, free text, or reader 2's value failed its rule."""
    kept = resolved.filter(F.col("reader").isin(*READERS["t3"]) & F.col("chosen").isNotNull())
    second = F.col("t2_value").isNotNull()
    reason = (
        F.when(F.coalesce(F.col("chosen_key") == F.col("t1_key"), F.lit(False)), "matched").when(F.coalesce("t2_value", "t1_value").isNull(), "blank")
        .when(F.when(second, F.col("t2_ok")).otherwise(F.col("t1_ok")).isNull(), "free_text").otherwise("failed")
    )
    return kept.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def merge_fields(running: DataFrame, higher: DataFrame, names: DataFrame) -> DataFrame:
    """running (doc_id, field_name, value, confidence, tier) with the rows of higher put over it for the escalated (doc_id, field_name) of names, blanks included."""
    key = ["doc_id", "field_name"]
    over = higher.join(names.select(*key).distinct(), key, "left_semi").select(*key, F.struct("value", "confidence", "tier").alias("h"))
    return overlaid(running.join(over, key, "left"), F.lit(True))


def overlaid(both: DataFrame, escalated: Column) -> DataFrame:
    """doc_id, field_name, value, confidence, tier of both, whose h (value, confidence, tier; null where the higher reader has nothing) is put over them where the field is escalated, blanks included."""
    over = escalated & F.col("h").isNotNull()
    return both.select("doc_id", "field_name", *[F.when(over, F.col(f"h.{c}")).otherwise(F.col(c)).alias(c) for c in ("value", "confidence", "tier")])


def pair_agreement(attempts: DataFrame, a: str, b: str) -> DataFrame:
    """field_name, n, agree, rate of two readers over what both have read: both blank, or the same reading. One scan and one aggregate; of several values of a reader the largest counts."""
    one = lambda t, n: [F.max(F.when(F.col("tier") == t, F.col("value"))).alias(n), F.max(F.when(F.col("tier") == t, 1)).alias(f"{n}_read")]
    both = attempts.filter(F.col("tier").isin(a, b)).groupBy("doc_id", "field_name").agg(*one(a, "va"), *one(b, "vb")).filter("va_read = 1 and vb_read = 1")
    ok = (F.col("va").isNull() & F.col("vb").isNull()) | same_reading(F.col("va"), F.col("vb"))
    pairs = both.select("field_name", ok.alias("ok"))
    return pairs.groupBy("field_name").agg(F.count("*").alias("n"), F.count_if("ok").alias("agree"), F.round(F.count_if("ok") / F.count("*"), 6).alias("rate"))
