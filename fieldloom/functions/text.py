"""Text functions as column expressions; Arrow UDFs only where the engine has no built-in (NFKC with case folding, brace spans)."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Codes of the states that a state field may hold.
STATES = (
    "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
# Names that no file may have, the number of a box before a label, words of a label.
RESERVED = ["con", "prn", "aux", "nul", *[f"{device}{i}" for device in ("com", "lpt") for i in range(10)]]
BOX_NUMBER = r"^\s*(?:[0-9][0-9A-Z]{0,2}|[A-Z][A-E])\s*[.,]\s*"
LABEL_WORD = "[A-Z0-9']+"
#: Dates outside are not taken for dates on a form.
FIRST_DAY, LAST_DAY = "1900-01-01", "2100-12-31"
#: Fixed value: salt of the hash that splits documents.
SPLIT_SALT = "intake-v1"


#: White space of any kind, as a pattern and as its characters.
SPACE = r"[\s\p{Z}]+"
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def squeezed(c: Column) -> Column:
    """Lower case, white space runs as one space, trimmed; null where nothing is left. Built in; for text that needs NFKC use folded()."""
    return F.nullif(F.trim(F.regexp_replace(F.translate(F.lower(c), "ς", "σ"), SPACE, " ")), F.lit(""))


def stripped(c: Column) -> Column:
    """A text without white space of any kind at its ends."""
    return F.btrim(c, F.lit(WHITE))


@F.pandas_udf(T.StringType())
def folded(s: pd.Series) -> pd.Series:
    """NFKC, white space runs as one space, trimmed, case folded; null for null and where nothing is left."""
    return s.map(lambda v: re.sub(r"\s+", " ", unicodedata.normalize("NFKC", v)).strip().casefold() or None, na_action="ignore")


def loose(c: Column) -> Column:
    """Lower-case letters and digits of ASCII only; null where none is left."""
    return F.nullif(F.regexp_replace(F.lower(c), "[^a-z0-9]+", ""), F.lit(""))


def full_form(c: Column) -> Column:
    """folded() of a text. Only texts with a character outside printable ASCII are handed to Python, the others as nulls; these have ordinary spaces only, and few have two in a row."""
    odd = c.rlike(r"[^\x20-\x7E]")
    low = F.lower(c)
    plain = F.nullif(F.trim(F.when(F.contains(low, F.lit("  ")), F.regexp_replace(low, " +", " ")).otherwise(low)), F.lit(""))
    return F.when(odd, folded(F.when(odd, c))).otherwise(plain)


def iso_date(c: Column) -> Column:
    """yyyy-MM-dd of a date written M/D/YYYY, YYYY-MM-DD or M-D-YYYY, after NFKC; null for anything else."""
    return _day(full_form(c))


def plain_date(c: Column) -> Column:
    """iso_date of a text as it is written, without NFKC, which validators don't apply."""
    return _day(F.trim(F.regexp_replace(c, SPACE, " ")))


def _day(t: Column) -> Column:
    """The day of a text without white space around. Only texts of a date's length are matched, and only matching ones parsed."""
    d = F.coalesce(F.try_to_date(t, "M/d/yyyy"), F.try_to_date(t, "yyyy-M-d"), F.try_to_date(t, "M-d-yyyy"))
    dated = F.length(t).between(8, 10) & t.rlike(r"^(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{1,2}-\d{1,2}|\d{1,2}-\d{1,2}-\d{4})\z")
    return F.when(dated, F.date_format(d, "yyyy-MM-dd"))


def sex_code(c: Column) -> Column:
    """M, F or U by the first letter after NFKC; else null."""
    first = F.upper(F.substring(full_form(c), 1, 1))
    return F.when(first.isin("M", "F", "U"), first)


def presence(c: Column) -> Column:
    """present or absent for a boolean; null stays null."""
    return F.when(c, "present").when(~c, "absent")


def last_first(c: Column) -> tuple[Column, Column]:
    """(last, first) of "last, first", split at the first comma; both null without a comma, and blank parts null."""
    has = F.instr(c, ",") > 0
    part = lambda x: F.when(has, F.nullif(F.trim(x), F.lit("")))
    return part(F.substring_index(c, ",", 1)), part(c.substr(F.instr(c, ",") + 1, F.length(c)))


def birth_and_sex(c: Column) -> tuple[Column, Column]:
    """(date of birth, sex) of a box with both: the first word, and the last one where it is M, F or U."""
    w = F.split(F.coalesce(full_form(c), F.lit("")), " ")
    last = F.upper(F.element_at(w, -1))
    return F.nullif(F.get(w, F.lit(0)), F.lit("")), F.when(last.isin("M", "F", "U"), last)


def without_box_number(c: Column) -> Column:
    """A label without the box number before it, once."""
    return F.regexp_replace(c, BOX_NUMBER, "")


def label_words(c: Column) -> Column:
    """The upper-case words of a label."""
    return F.regexp_extract_all(F.upper(c), F.lit(LABEL_WORD), F.lit(0))


def word_index(words: Column, phrase: Column) -> Column:
    """The first place (from 0) at which the words of phrase stand in words one after the other; null where they don't."""
    framed = lambda w: F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    at = F.call_function("locate", framed(phrase), framed(words))
    before = framed(words).substr(F.lit(1), at)
    return F.when(at > 0, F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit(""))) - 1)


def verdict(field: Column, value: Column) -> Column:
    """Whether a value, without white space at its ends, is valid for its field: dates within the range, zips, states and phones; null for fields without a rule, and for null values."""
    clean = stripped(value)
    date_field = field.startswith("date_") | field.endswith("_date") | field.endswith("_dob") | (field == "date")
    day = _day(clean)
    digits = F.regexp_replace(clean, r"[^0-9]", "")
    return (
        F.when(value.isNull(), F.lit(None).cast("boolean"))
        .when(field.endswith("zip"), clean.rlike(r"^\d{5}(-\d{4})?\z"))
        .when(field.endswith("state"), F.upper(clean).isin(*STATES))
        .when(field.endswith("phone"), F.length(digits) == 10)
        .when(date_field, F.coalesce(day.between(FIRST_DAY, LAST_DAY), F.lit(False)))
    )


def finalizes(field: Column, value: Column) -> Column:
    """True where a rule for dates, zips or states finds the value valid."""
    return F.coalesce(verdict(field, value) & ~field.endswith("phone"), F.lit(False))


def comparable(c: Column) -> Column:
    """What two readings are compared by, both after NFKC: the day of a date, else the folded text."""
    full = full_form(c)
    return F.coalesce(_day(full), full)


def same_reading(a: Column, b: Column) -> Column:
    """Equality of two readings; a null equals nothing."""
    return F.coalesce(comparable(a) == comparable(b), F.lit(False))


def patient_key(doc_id: Column) -> Column:
    return F.regexp_replace(doc_id, r"-[^-]*$", "")


def partition_key(doc_id: Column, vertical: Column) -> Column:
    """What documents that belong together share: the patient for healthcare, else the document itself."""
    return F.when(vertical == "healthcare", patient_key(doc_id)).otherwise(doc_id)


def hash_fraction(key: Column, salt: str = SPLIT_SALT) -> Column:
    """A number in [0, 1) from the first 64 bits of the SHA-256 of salt:key, in decimals, as 64 bits don't fit a long."""
    bits = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), key), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return bits.cast("double") / F.lit(float(2**64))


def hash_split(key: Column, salt: str = SPLIT_SALT) -> Column:
    """train below 0.70, dev below 0.85, else test."""
    x = hash_fraction(key, salt)
    return F.when(x < 0.70, "train").when(x < 0.85, "dev").otherwise("test")


def is_sha256(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def safe_stem(c: Column) -> Column:
    """A name fit for a file: other characters as underscores; a digest in place of a reserved or empty name (RESERVED, in any case), or one that ends in a dot; 8 digits of the digest at the end."""
    digest = F.sha2(c, 256)
    clean = F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")
    bad = (clean == "") | clean.endswith(".") | F.lower(clean).isin(*RESERVED)
    return F.concat(F.when(bad, F.substring(digest, 1, 16)).otherwise(clean), F.lit("-"), F.substring(digest, 1, 8))


def title(c: Column) -> Column:
    """Words of a field name, each with a capital."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def unit_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """A box in parts of the page, clamped to [0, 1]; pixels where any coordinate is above 1. Null where it lacks a number, a page size or its order."""
    pixels = (x1 > 1) | (y1 > 1) | (x2 > 1) | (y2 > 1)
    clamp = lambda v, n: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(pixels, F.try_divide(v, n.cast("double"))).otherwise(v)))
    whole = x1.isNotNull() & y1.isNotNull() & x2.isNotNull() & y2.isNotNull() & (x1 <= x2) & (y1 <= y2) & (~pixels | ((width > 0) & (height > 0)))
    return F.when(whole, F.struct(clamp(x1, width).alias("x1"), clamp(y1, height).alias("y1"), clamp(x2, width).alias("x2"), clamp(y2, height).alias("y2")))


_object = json.JSONDecoder().raw_decode


def _read_reply(text: str | None) -> dict:
    """The JSON object in a reply. A reply that is JSON as a whole counts only if it is an object; else the object that begins at the first brace within a code block counts, else the one at the very first brace."""
    try:
        whole = json.loads(text or "")
        return whole if isinstance(whole, dict) else {}
    except (ValueError, RecursionError):
        pass
    text = text or ""
    for at in (text.find("{", max(0, text.find("```"))) if "```" in text else -1, text.find("{")):
        try:
            if at >= 0:
                return _object(text, at)[0]
        except (ValueError, RecursionError):
            continue
    return {}


@F.pandas_udf(T.StringType())
def reply_object(s: pd.Series) -> pd.Series:
    """The JSON object in a reader's reply, as compact JSON; {} where there is none, for a null or empty reply, and for a reply that is other JSON."""
    return s.map(lambda t: json.dumps(_read_reply(t)), na_action=None)


def reply_fields(content: Column) -> Column:
    """The fields of a reply as a map of strings."""
    return F.coalesce(F.from_json(reply_object(content), "map<string,string>"), F.create_map().cast("map<string,string>"))
