"""Nested documents to flat rows: sidecars, patient bundles and annotated documents; and training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import birth_and_sex, comparable, full_form, iso_date, last_first, plain_date, presence

# Fields of a sidecar and the scored fields that they hold.
SIDECAR_FIELDS = {
    "patient_address_line": "address_street", "patient_city": "address_city", "patient_state": "address_state", "patient_postal_code": "address_zip",
    "patient_phone": "phone", "diagnosis": "reason_for_visit",
}
BUNDLE = (
    "entry array<struct<resource struct<resourceType string, id string, birthDate string, gender string, name array<struct<family string, given array<string>>>,"
    " address array<struct<line array<string>, city string, state string, postalCode string>>, telecom array<struct<system string, value string>>,"
    " period struct<start string>, reasonCode array<struct<text string>>>>>"
)
ANNOTATION = (
    "metadata struct<document_id string, page_count int, page_sizes_at_200dpi array<array<int>>>,"
    " field_extractions array<struct<page int, bbox array<double>, fieldtype string, text string>>"
)


def sidecar_truth(sidecars: DataFrame) -> DataFrame:
    """doc_id, field, token of each known value: names and the box of birth date and sex taken apart, a signature field as present, tokens comparable, fields without a value left out.

    Repeated sidecars of a document give each field once, the smallest token counting."""
    f = sidecars.select("doc_id", F.explode(F.arrays_zip("fields.name", "fields.value")).alias("f")).select("doc_id", F.col("f.name").alias("name"), F.col("f.value").alias("value"))
    last, first = last_first(F.col("value"))
    born, sex = birth_and_sex(F.col("value"))
    row = lambda field, token: F.struct(F.lit(field).alias("field"), token.alias("token"))
    plain = F.coalesce(*[F.when(F.col("name") == n, F.array(row(t, full_form(F.col("value"))))) for n, t in SIDECAR_FIELDS.items()])
    out = (
        F.when(F.col("name") == "patient_name", F.array(row("last_name", full_form(last)), row("first_name", full_form(first))))
        .when(F.col("name") == "patient_birth_date", F.array(row("date_of_birth", plain_date(born)), row("sex", sex)))
        .when(F.col("name") == "date_signed", F.array(row("date_signed", iso_date(F.col("value")))))
        .when(F.col("name") == "signature", F.array(row("signature", presence(F.lit(True)))))
        .otherwise(plain)
    )
    return f.select("doc_id", F.inline(out)).filter("token is not null").groupBy("doc_id", "field").agg(F.min("token").alias("token"))


def sidecar_problems(sidecars: DataFrame) -> DataFrame:
    """doc_id, problem of sidecars that break a rule: schema version 1, a sha of 64 hexadecimal digits, a source, an image named after the document."""
    checks = {
        "schema_version": F.col("schema_version") == 1, "image_sha256": F.col("image_sha256").rlike("^[0-9a-f]{64}$"),
        "source_id": F.trim("source_id") != "", "image": F.col("image") == F.concat("doc_id", F.lit(".png")),
    }
    bad = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items()]), lambda x: x.isNotNull())
    return sidecars.select("doc_id", F.explode(bad).alias("problem")).distinct()


def _resources(bundles: DataFrame, kind: str, key: str) -> DataFrame:
    return bundles.select(key, F.posexplode("entry").alias("pos", "e")).filter(F.col("e.resource.resourceType") == kind).select(key, "pos", F.col("e.resource").alias("r"))


def patients(bundles: DataFrame, key: str = "bundle") -> DataFrame:
    """key and the flat patient of each bundle (columns of BUNDLE): first name, address and phone, and the start and reason of the latest encounter; malformed entries and times are skipped, and among equal starts the first entry counts."""
    p = _resources(bundles, "Patient", key).groupBy(key).agg(F.min_by("r", "pos").alias("r"))
    name, address = F.get("r.name", F.lit(0)), F.get("r.address", F.lit(0))
    phone = F.get(F.filter("r.telecom", lambda t: t["system"] == "phone"), F.lit(0))["value"]
    flat = p.select(
        key, F.col("r.id").alias("patient_id"), name["family"].alias("last_name"), F.get(name["given"], F.lit(0)).alias("first_name"), F.col("r.birthDate").alias("date_of_birth"), F.col("r.gender").alias("sex"),
        F.get(address["line"], F.lit(0)).alias("address_street"), address["city"].alias("address_city"), address["state"].alias("address_state"), address["postalCode"].alias("address_zip"), phone.alias("phone"),
    )
    at = F.try_to_timestamp(F.col("r.period.start"))
    e = _resources(bundles, "Encounter", key).withColumn("at", at).filter("at is not null")
    last = e.groupBy(key).agg(F.max_by("r", F.struct("at", -F.col("pos"))).alias("r"), F.max("at").alias("last_visit"))
    return flat.join(last.select(key, "last_visit", F.get("r.reasonCode", F.lit(0))["text"].alias("reason_for_visit")), key, "left")


def latest_encounters(bundles: DataFrame, n: int = 3, key: str = "bundle") -> DataFrame:
    """The n latest encounters of each bundle; those without a start come last."""
    e = _resources(bundles, "Encounter", key).withColumn("at", F.try_to_timestamp(F.col("r.period.start")))
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last("at"), "pos")
    return e.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select(key, "rank", F.col("r.id").alias("encounter_id"), "at")


def annotated_fields(docs: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """doc_id, page (from 1), fieldtype, text, box of the fields of annotated documents (columns of ANNOTATION). Boxes reach out of the page by tolerance at most and are clamped; others raise."""
    f = docs.select(F.col("metadata.document_id").alias("doc_id"), F.posexplode("field_extractions").alias("pos", "f"))
    b = F.col("f.bbox")
    ok = (F.size(b) == 4) & F.forall(b, lambda x: x.between(-tolerance, 1 + tolerance)) & (F.get(b, F.lit(0)) <= F.get(b, F.lit(2))) & (F.get(b, F.lit(1)) <= F.get(b, F.lit(3)))
    clamped = F.when(F.coalesce(ok, F.lit(False)), F.transform(b, lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))).otherwise(F.raise_error(F.concat(F.lit("bad box in "), F.col("doc_id"))).cast("array<double>"))
    return f.select("doc_id", "pos", (F.col("f.page") + 1).alias("page"), F.col("f.fieldtype").alias("fieldtype"), F.col("f.text").alias("text"), clamped.alias("box"))


def annotated_truth(fields: DataFrame, known: list[str]) -> DataFrame:
    """doc_id, field, token: the first text of each known field type that is comparable; a null text does not take the place."""
    t = fields.filter(F.col("fieldtype").isin(*known)).withColumn("token", comparable(F.col("text"))).filter("token is not null")
    return t.groupBy("doc_id", F.col("fieldtype").alias("field")).agg(F.min_by("token", "pos").alias("token"))


def prompt_lines(dictionary: DataFrame) -> Column:
    """The text that asks a reader for the fields of a form, in order of their names, as an aggregate."""
    line = F.concat(F.lit("- "), F.col("canonical_name"), F.lit(" ("), F.col("data_type"), F.lit("): "), F.col("description"))
    return F.array_join(F.array_sort(F.collect_list(line)), "\n")
