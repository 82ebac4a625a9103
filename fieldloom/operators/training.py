"""Training examples from corrections: real ones of train documents only, and fixed ones of formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.scoring import DATES, SCORABLE, token

# What a corrector is told, and pairs of each kind of field that hold no document's values.
INSTRUCTION = "Correct the extracted form field to its canonical value. Return only the corrected value."
FORMATS = {
    "date": [("01/02/2020", "2020-01-02"), ("March 5, 1991", "1991-03-05"), ("1991-03-05", "1991-03-05")],
    "sex": [("Male", "M"), ("female", "F"), ("M", "M")],
    "str": [("  jane   doe ", "jane doe"), ("ACME, INC.", "ACME, INC.")],
}
COLUMNS = ["instruction", "input", "response", "source", "split"]


def kind_of(field: Column) -> Column:
    """The kind of a scored field: date, sex, signature or str."""
    return F.when(field.isin(DATES), "date").when(field.isin("sex", "signature"), field).otherwise("str")


def shown_input(field: Column, kind: Column, value: Column) -> Column:
    """What the corrector is shown of a field; <BLANK> for no value."""
    return F.concat(F.lit("Field: "), field, F.lit("\nField type: "), kind, F.lit("\nCascade extracted: "), F.coalesce(value, F.lit("<BLANK>")))


def seeded(manifest: DataFrame, truth: DataFrame, forms: DataFrame) -> DataFrame:
    """COLUMNS with doc_id: an example for each scored field of a healthcare document, in the train split and in no other, whose token isn't the truth's.

    manifest: doc_id, vertical, split. truth: doc_id, field, token. forms: doc_id, field, value. A field without a reading counts as blank; one without truth gives none."""
    one = manifest.filter("doc_id is not null").groupBy("doc_id").agg(F.collect_set(F.lower(F.trim("split"))).alias("splits"), F.max(F.when(F.col("vertical") == "healthcare", 1)).alias("health"))
    # the guard: a document with any row of another split trains nothing
    train = one.filter((F.size("splits") > 0) & F.forall("splits", lambda s: s.isin("train", "training")) & (F.col("health") == 1)).select("doc_id")
    known = truth.filter(F.col("field").isin(*SCORABLE)).join(train, "doc_id", "left_semi")
    j = known.select("doc_id", "field", F.col("token").alias("truth")).join(forms.select("doc_id", "field", token(F.col("field"), F.col("value")).alias("got")), ["doc_id", "field"], "left")
    wrong = j.filter(~F.col("got").eqNullSafe(F.col("truth")))
    return wrong.select("doc_id", F.lit(INSTRUCTION).alias("instruction"), shown_input(F.col("field"), kind_of(F.col("field")), F.col("got")).alias("input"), F.col("truth").alias("response"), F.lit("seeded_correction").alias("source"), F.lit("train").alias("split"))


def synthetic(spark: SparkSession) -> DataFrame:
    """COLUMNS of the fixed examples of formats."""
    rows = [(f"<{kind}_field>", kind, noisy, clean) for kind, pairs in FORMATS.items() for noisy, clean in pairs]
    df = spark.createDataFrame(rows, "field string, kind string, noisy string, clean string")
    return df.select(F.lit(INSTRUCTION).alias("instruction"), shown_input(F.col("field"), F.col("kind"), F.col("noisy")).alias("input"), F.col("clean").alias("response"), F.lit("synthetic_format_kind").alias("source"), F.lit("train").alias("split"))


def examples(manifest: DataFrame, truth: DataFrame, forms: DataFrame) -> DataFrame:
    """All examples: the seeded ones and the fixed ones."""
    return seeded(manifest, truth, forms).select(*COLUMNS).unionByName(synthetic(manifest.sparkSession))
