"""Forms in long form: rows for display and for the store, narrowed requests, typed replies, corrected values, and what a reply has to hold."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.text import plain_date, reply_fields
from fieldloom.operators.reconcile import REVIEW_BELOW, escalates

# Confidence of a value taken as it is and of one brought into a type, reason of an escalation, types that a reader can be asked for and their names in a JSON schema and in a prompt.
TAKEN, COERCED = 1.0, 0.5
LOW_CONFIDENCE = "low_confidence"
JSON_TYPES = {"string": "string", "enum": "string", "boolean": "boolean", "integer": "integer", "float": "number", "date": "string"}
HINTS = {"string": "string", "boolean": "boolean (true/false)", "integer": "integer", "float": "number", "date": "date in ISO 8601 (YYYY-MM-DD)"}


def unpivoted(wide: DataFrame, key: str, fields: list[str], confidence: str = "confidence", tier: str = "tier") -> DataFrame:
    """key, field, value, confidence, tier of a form with one column a field; each field is a struct of value, confidence and tier, or a value beside the common columns."""
    struct = lambda f: isinstance(wide.schema[f].dataType, T.StructType)
    one = lambda f: F.struct(
        F.lit(f).alias("field"), (F.col(f)["value"] if struct(f) else F.col(f)).cast("string").alias("value"),
        (F.col(f)["confidence"] if struct(f) else F.col(confidence)).cast("double").alias("confidence"), (F.col(f)["tier"] if struct(f) else F.col(tier)).cast("string").alias("tier"),
    )
    return wide.select(key, F.inline(F.array(*[one(f) for f in fields])))


def field_rows(form: DataFrame, field: str = "field", gate: float = REVIEW_BELOW) -> DataFrame:
    """form with value as shown (empty for none), below_gate (populated and of too little confidence) and blank."""
    blank = F.col("value").isNull()
    below = ~blank & F.coalesce(F.col("confidence") < gate, F.lit(False))
    return form.select("doc_id", F.col(field).alias("name"), F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), "confidence", F.col("tier").cast("string").alias("tier_used"), below.alias("below_gate"), blank.alias("blank"))


def attempt_rows(form: DataFrame, latency: Column, reason: str = LOW_CONFIDENCE) -> DataFrame:
    """doc_id, field_name, tier, value, confidence, escalation_reason, latency_ms of a reader's form, as the store keeps it: the reason stands with fields that are sent on only."""
    sent = escalates(F.col("tier"), F.col("value"), F.col("confidence"))
    return form.select("doc_id", "field_name", "tier", F.col("value").cast("string").alias("value"), "confidence", F.when(sent, reason).alias("escalation_reason"), latency.cast("double").alias("latency_ms"))


def narrowed(names: DataFrame, dictionary: DataFrame) -> DataFrame:
    """doc_id, fields: what each document's next reader is asked for: exactly the fields of names (doc_id, field_name), in the dictionary's order by vertical and name, each once.

    A field that the dictionary lacks raises; a document without any field has no row, as there is nothing to ask."""
    pos = dictionary.select(F.col("canonical_name").alias("field_name"), "vertical").groupBy("field_name").agg(F.min("vertical").alias("vertical"))
    j = names.select("doc_id", "field_name").distinct().join(F.broadcast(pos), "field_name", "left")
    known = F.when(F.col("vertical").isNull(), F.raise_error(F.concat(F.lit("no such field: "), F.coalesce("field_name", F.lit("null")))).cast("string")).otherwise(F.col("vertical"))
    ordered = F.array_sort(F.collect_list(F.struct(known.alias("vertical"), "field_name")))
    return j.groupBy("doc_id").agg(ordered["field_name"].alias("fields"))


def promptable(dictionary: DataFrame) -> DataFrame:
    """The records of fields that a reader can be asked for: plain texts, enums, booleans, numbers and dates."""
    return dictionary.filter(F.col("data_type").isin(*JSON_TYPES))


def response_schema(dictionary: DataFrame, by: str = "vertical") -> DataFrame:
    """by, schema: the JSON schema of the reply for the promptable fields of each group: every field required and nullable, nothing else allowed."""
    kinds = F.create_map(*[F.lit(x) for kv in JSON_TYPES.items() for x in kv])
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = F.concat(quoted(F.col("canonical_name")), F.lit(': {"type": ["'), F.element_at(kinds, F.col("data_type")), F.lit('", "null"]}'))
    d = promptable(dictionary).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("canonical_name", line.alias("line")))).alias("x"))
    names = F.array_join(F.transform("x.canonical_name", quoted), ", ")
    return d.select(by, F.concat(F.lit('{"type": "object", "properties": {'), F.array_join("x.line", ", "), F.lit('}, "required": ['), names, F.lit('], "additionalProperties": false}')).alias("schema"))


def cast_valid(kind: Column, value: Column, choices: Column | None = None) -> Column:
    """A text as its type would hold it, null where it is none of it: dates as days, numbers and booleans that can be read, one of choices for an enum that has some."""
    low = F.lower(value)
    return (
        F.when(kind == "date", plain_date(value)).when(kind == "integer", F.try_to_number(value, F.lit("S999999999999999999")).cast("string")).when(kind == "float", F.when(value.try_cast("double").isNotNull(), value))
        .when(kind == "boolean", F.when(low.isin("true", "false"), low)).when(kind == "enum", F.when(F.coalesce(F.array_contains(choices, value), F.lit(True)) if choices is not None else F.lit(True), value)).otherwise(value)
    )


def typed_replies(replies: DataFrame, dictionary: DataFrame, tier: str, key: str = "doc_id", content: str = "content") -> DataFrame:
    """key, field, value, confidence, tier for each promptable field of the dictionary: texts and enums as they are at TAKEN, values brought into another type at COERCED.

    Texts are trimmed. A field that the reply lacks, leaves null or blank, or fills with a value that its type can't hold is a blank that was tried: no value, confidence 0, with the tier.
    The dictionary's records travel as one literal with each reply; it is one form's."""
    kinds = promptable(dictionary).select("canonical_name", "data_type").distinct().orderBy("canonical_name", "data_type").collect()
    asked = F.array(*[F.struct(F.lit(r[0]).alias("field"), F.lit(r[1]).alias("kind")) for r in kinds]) if kinds else F.array().cast("array<struct<field string, kind string>>")
    each = replies.select(key, reply_fields(F.col(content)).alias("fields")).select(key, "fields", F.inline(asked))
    raw = F.nullif(F.trim(F.try_element_at("fields", F.col("field"))), F.lit(""))
    value = cast_valid(F.col("kind"), raw)
    confidence = F.when(value.isNull(), 0.0).when(F.col("kind").isin("string", "enum"), TAKEN).otherwise(COERCED)
    return each.select(key, "field", value.alias("value"), confidence.alias("confidence"), F.lit(tier).alias("tier"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _whole_keys(s: pd.Series) -> pd.Series:
    def keys(text: str | None) -> list[str] | None:
        try:
            whole = json.loads(text or "")
        except (ValueError, RecursionError):
            return None
        return list(whole) if isinstance(whole, dict) else None

    return s.map(keys, na_action=None)


def object_keys(content: Column) -> Column:
    """The different keys of a text that is a JSON object from end to end; null for anything else. The engine's own JSON functions pass over what follows an object, so texts between braces go to Python, and no others."""
    braced = F.coalesce(content.rlike(r"^\s*\{(?s:.*)\}\s*\z"), F.lit(False))
    return F.when(braced, _whole_keys(F.when(braced, content)))


def adheres(content: Column, wanted: list[str] | Column) -> Column:
    """Whether a reply is, as a whole, a JSON object of exactly the wanted keys; false for a null one."""
    want = F.array_sort(F.array(*[F.lit(w) for w in wanted])) if isinstance(wanted, list) else F.array_sort(wanted)
    return F.coalesce(F.array_sort(object_keys(content)) == want, F.lit(False))


def corrected(form: DataFrame, correct: Callable[[str, str], str] | None = None, field: str = "field") -> DataFrame:
    """form with each value as correct(field, value) puts it; tiers and nulls stay. Without a corrector values stay as they are, and nothing leaves the JVM."""
    if correct is None:
        return form

    @F.pandas_udf(T.StringType())
    def run(names: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else (correct(n, v) or v) for n, v in zip(names, values)], dtype=object)

    return form.withColumn("value", run(F.col(field), F.col("value").cast("string")))


def stamped(runs: DataFrame) -> DataFrame:
    """runs with routing_decision (stage2:business), null where stage or vertical is."""
    return runs.withColumn("routing_decision", F.concat(F.lit("stage"), F.col("router_stage").cast("string"), F.lit(":"), F.col("vertical")))


def xml_escaped(c: Column) -> Column:
    """A text as it may stand in markup."""
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def shown(c: Column) -> Column:
    """Any value as text for display; nothing for null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def sorted_json(obj: dict) -> str:
    """JSON with its keys in order, as caches keep replies."""
    return json.dumps(obj, sort_keys=True, indent=2)
