"""Operators that once did less than the whole job, against brute force on the real tables."""

import json
import re
import unicodedata
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators import layout, metrics, packed, reconcile, scoring
from fieldloom.plans import catalogue, unchecked
from fieldloom.runtime import table

SF = "/root/testdata/sf0.001"
BOXES = {
    "patient_address_line": "address_street", "patient_city": "address_city", "patient_state": "address_state", "patient_postal_code": "address_zip", "patient_phone": "phone", "diagnosis": "reason_for_visit",
}
SCORED = {*BOXES.values(), "last_name", "first_name", "date_of_birth", "sex", "date_signed", "signature"}


def nfkc(v):
    return " ".join(unicodedata.normalize("NFKC", v or "").split())


def fold(v):
    return nfkc(v).casefold() or None


def day(v):
    for form in ("%m/%d/%Y", "%Y-%m-%d", "%m-%d-%Y"):
        try:
            return datetime.strptime(nfkc(v), form).date().isoformat()
        except ValueError:
            pass
    return None


def truth_of(fields):
    """The tokens of one sidecar, field by field."""
    raw, out = {f["name"]: f["value"] or "" for f in fields}, {}
    if "," in raw.get("patient_name", ""):
        last, _, first = raw["patient_name"].partition(",")
        out["last_name"], out["first_name"] = fold(last), fold(first)
    if words := nfkc(raw.get("patient_birth_date")).split():
        out["date_of_birth"], out["sex"] = day(words[0]), words[-1].upper() if words[-1].upper() in ("M", "F", "U") else None
    out |= {field: fold(raw.get(box)) for box, field in BOXES.items()}
    out["date_signed"], out["signature"] = day(raw.get("date_signed")), "present" if "signature" in raw else None
    return {k: v for k, v in out.items() if v}


def test_sidecar_truth_has_all_twelve_fields(spark):
    want = defaultdict(set)
    for r in table(spark, SF, "sidecars").collect():
        for k, v in truth_of(r["fields"]).items():
            want[r["doc_id"], k].add(v)
    assert {k for _, k in want} == SCORED
    assert {tuple(r) for r in catalogue.sidecar_truth(spark, SF).collect()} == {(*k, min(v)) for k, v in want.items()}


def comparable(v):
    return None if v is None else day(v) or fold(v)


SAME = [("Ａｎｎ", "ann"), ("Jose\u0301", "JOSÉ"), ("Straße", "STRASSE"), ("０４／０７／２０２０", "2020-04-07"), ("a\u00a0 b", "A B"), ("ﬁn", "FIN")]


@pytest.mark.parametrize("a, b", SAME)
def test_readings_equal_after_nfkc(spark, a, b):
    w = reconcile.by_reader(spark.createDataFrame([("d", "first_name", t, v, 1.0) for t, v in (("1", a), ("2", "other"), ("3a", b))], "doc_id string, field_name string, tier string, value string, confidence double"))
    r = reconcile.reconcile(reconcile.route(w)).first()
    assert (r["rule_no"], r["confidence"], r["reader"]) == (1, 0.95, "3a")
    df = spark.createDataFrame([("d", "f", "1", a), ("d", "f", "2", b)], "doc_id string, field_name string, tier string, value string")
    assert [tuple(x) for x in reconcile.pair_agreement(df, "1", "2").collect()] == [("f", 1, 1, 1.0)]
    assert reconcile.route(reconcile.by_reader(df.selectExpr("*", "1.0D AS confidence"))).first()["route"] == "agree"


def test_dates_and_sexes_after_nfkc(spark):
    r = spark.createDataFrame([("０４／０７／２０２０", "ｍ")], "d string, s string").select(X.iso_date(F.col("d")), X.sex_code(F.col("s"))).first()
    assert tuple(r) == ("2020-04-07", "M")


def test_readings_of_the_table_by_brute_force(spark):
    rows = table(spark, SF, "field_attempts").collect()
    n, filled, different, best = defaultdict(int), defaultdict(int), defaultdict(set), {}
    for r in rows:
        f, key = r["field_name"], comparable(r["value"])
        n[f] += 1
        if key is not None:
            filled[f] += 1
            different[f].add(key)
        at = (r["doc_id"], f, r["tier"])
        best[at] = max(best.get(at, ""), r["value"] or "")
    assert {tuple(r) for r in catalogue.tokens_by_field(spark, SF).collect()} == {(f, n[f], filled[f], len(different[f])) for f in n}
    pairs, agree = defaultdict(int), defaultdict(int)
    for (doc, f, t), v in best.items():
        if t == "2" and (doc, f, "3a") in best:
            w = best[doc, f, "3a"]
            pairs[f] += 1
            agree[f] += comparable(v) == comparable(w)
    assert {(r["field_name"], r["n"], r["agree"]) for r in catalogue.pair_agreement(spark, SF).collect()} == {(f, pairs[f], agree[f]) for f in pairs}


RULES = {1: 0.95, 4: 0.95, 5: 0.5, 6: 0.5, 7: 0.5}


def test_rules_and_routes_of_the_table_by_brute_force(spark):
    """Where all three readers have values and no rule for the field, the outcome follows from the comparisons alone."""
    read = defaultdict(dict)
    for r in table(spark, SF, "field_attempts").filter("field_name IN ('first_name', 'last_name', 'reason_for_visit', 'address_street', 'address_city')").collect():
        at = read[r["doc_id"], r["field_name"]]
        at[r["tier"]] = max(at.get(r["tier"], ""), r["value"] or "")
    want = {}
    for key, v in read.items():
        one, two, three = (v.get(t) or None for t in ("1", "2", "3b" if "3b" in v else "3a"))  # the last of the strongest readers counts
        if one and two and three:
            k1, k2, k3 = map(comparable, (one, two, three))
            rule = 1 if k3 == k1 else 4 if two == three else 6
            chosen = k2 if rule == 4 else k3
            rule = 7 if rule > 1 and k1 != chosen else rule
            want[key] = ("agree" if k1 == k2 else "routed", rule, RULES[rule])
    got = {(r["doc_id"], r["field_name"]): (r["route"], r["rule_no"], r["confidence"]) for r in catalogue.reconciled(spark, SF).collect()}
    assert len(want) > 100 and {k: got[k] for k in want} == want


def reply(text):
    """The fields of a reply, and whether it took a fallback."""
    try:
        whole = json.loads(text or "")
        return (whole if isinstance(whole, dict) else {}), False
    except ValueError:
        pass
    for m in [re.search(r"```(?:json)?\s*(\{.*?\})\s*```", text or "", re.S), re.search(r"\{.*", text or "", re.S)]:
        try:
            if m:
                return json.JSONDecoder().raw_decode(m.group(m.lastindex or 0))[0], True
        except ValueError:
            pass
    return {}, False


def test_replies_in_documents_are_read(spark):
    d = SF.replace("sf0.001", "sf0.01")
    want = {r["doc_id"]: reply(r["text"]) for r in table(spark, d, "documents").collect()}
    got = {r["doc_id"]: json.loads(r["fields"]) for r in unchecked.document_replies(spark, d).collect()}
    assert got == {k: v for k, (v, _) in want.items()}
    assert sum(f for _, f in want.values()) > 0 and sum(bool(v) for v in got.values()) > 20


READ = "doc_id string, field_name string, tier string, value string, confidence double"
TRUTH = "doc_id string, field string, token string"


def test_forms_are_scored_over_all_scorable_fields(spark):
    attempts = spark.createDataFrame(
        [
            ("d", "first_name", "1", "Al", 0.9), ("d", "first_name", "2", "Ann", 0.9), ("d", "first_name", "3a", "ＡＮＮ", 0.9), ("d", "sex", "1", "Female", 0.9), ("d", "sex", "2", "F", 0.9),
            ("d", "date_of_birth", "2", "4/7/1990", 0.9), ("d", "phone", "2", "1", 0.9), ("d", "phone", "3a", "1", 0.9), ("d", "address_city", "2", None, 0.9), ("d", "address_city", "3a", "Rye", 0.9), ("d", "reason_for_visit", "2", None, 0.9),
        ],
        READ,
    )
    truth = spark.createDataFrame([("d", "first_name", "ann"), ("d", "sex", "F"), ("d", "date_of_birth", "1990-04-07"), ("d", "address_city", "rye"), ("e", "phone", "2")], TRUTH)
    docs = spark.createDataFrame([("d",), ("e",)], "doc_id string")
    score = lambda a: {r["stage"]: (r["tp"], r["fp"], r["fn"], r["blank"]) for r in scoring.score_forms(scoring.stage_forms(a), truth, docs).collect()}
    assert score(attempts) == {"Tier 1": (1, 1, 4, 0), "Tier 1+2": (3, 1, 2, 1), "Tier 1+2+3": (4, 1, 1, 1)}
    other = spark.createDataFrame([("d", "first_name", "Bo", 0.9)], "doc_id string, field_name string, value string, confidence double")
    # the other reader's Bo is against reader 2's Ann, and it reads no city
    assert score(scoring.substituted(attempts, other)) == {"Tier 1": (1, 1, 4, 0), "Tier 1+2": (3, 1, 2, 1), "Tier 1+2+3": (2, 2, 3, 1)}
    assert scoring.score_cells(scoring.stage_forms(attempts), truth, docs, scoring.SCORABLE, scoring.STAGES).count() == 2 * 12 * 3
    counts = lambda *c: spark.createDataFrame([c], "tp long, fp long, fn long")
    assert tuple(scoring.change(counts(1, 1, 1), counts(2, 1, 0)).first()) == (0.5, 0.8, 0.3)


def test_coarse_scores_and_verdict(spark):
    forms = spark.createDataFrame([("a", "x", "A-1 "), ("a", "y", "wrong"), ("b", "x", "No. 2")], "doc_id string, field string, value string")
    truth = spark.createDataFrame([("m", "a", "x", "a1"), ("m", "a", "y", "right"), ("m", "a", "z", "gone"), ("n", "b", "x", "no 2"), ("n", "b", "x", "2"), ("n", "b", "w", "")], "corpus string, doc_id string, field string, value string")
    got = {r["corpus"]: tuple(r)[1:] for r in scoring.coarse(forms, truth).collect()}
    assert got == {"m": (1, 1, 1, 1, 0.5, 0.5, 0.5, "fall back"), "n": (1, 1, 0, 0, 1.0, 1.0, 1.0, "ship"), None: (2, 2, 1, 1, 0.6667, 0.6667, 0.6667, "ship with gap")}


def test_routed_fields_speed_and_replay(spark):
    w = reconcile.route(reconcile.by_reader(spark.createDataFrame([("d", "a", "1", "x", 0.3), ("d", "b", "2", "y", 0.9), ("d", "c", "2", "y", 0.5), ("e", "a", "1", "x", 0.9)], READ)))
    assert tuple(scoring.routed_per_document(w).first()) == (2, 2, 1.0, 1)
    truth = spark.createDataFrame([("d", "a", "z"), ("d", "b", "q"), ("d", "c", ""), ("e", "a", "z")], TRUTH)
    assert [tuple(r) for r in scoring.replayed_corrections(reconcile.reconcile(w), truth).collect()] == [("d", "a", "x", "z", "1")]
    t = spark.createDataFrame([(10, 2_000_000_000), (0, 5), (3, 0), (None, 1)], "n long, ns long").select(scoring.tokens_per_second(F.col("n"), F.col("ns")).alias("v"))
    assert [r["v"] for r in t.collect()] == [5.0, None, None, None]
    assert tuple(t.agg(*metrics.loose_stats("v")).first()) == (5.0, 5.0, 5.0)


WORDS = [
    ("last_name", ["Last name", "Last"]), ("first_name", ["First name", "First"]), ("date_of_birth", ["Birth date"]), ("sex", ["Sex"]), ("address_state", ["State"]), ("address_zip", ["ZIP code"]), ("date_signed", ["Signed date", "Date"]),
]


def dictionary(spark):
    return spark.createDataFrame([(f, "healthcare", a) for f, a in WORDS], "canonical_name string, vertical string, aliases array<string>")


def cell_reader():
    return packed.Cells([(f, a) for f, al in WORDS for a in al], {"date_of_birth": "date", "date_signed": "date"}, packed.LITERALS)


@pytest.mark.parametrize(
    "label, value, field, out",
    [
        ("NAME (LAST, FIRST)", "Doe, Jane", "last_name", [("last_name", "Doe"), ("first_name", "Jane")]), ("First name, last name", "Jane, Doe", "last_name", [("first_name", "Jane"), ("last_name", "Doe")]),
        ("Last name", "Doe, Jane", "last_name", [("last_name", "Doe, Jane")]), ("3. BIRTH DATE / SEX", "06/13/1955 f", "date_of_birth", [("date_of_birth", "06/13/1955"), ("sex", "F")]),
        ("Birth date sex", "F", "date_of_birth", [("sex", "F")]), ("ZIP code", "MA 02481", "address_zip", [("address_zip", "02481")]), ("State, ZIP code", "MA 02481", "address_zip", [("address_zip", "02481"), ("address_state", "MA")]),
        ("ZIP code", "02481 02482", "address_zip", [("address_zip", "02481 02482")]),
    ],
)
def test_readings_of_a_packed_value(label, value, field, out):
    assert cell_reader().of_pair(label, value, field) == out


@pytest.mark.parametrize(
    "cell, out",
    [
        ("3. BIRTH DATE / SEX\n06/28/1942\nM", [("date_of_birth", "06/28/1942"), ("sex", "M")]), ("SIGNED\nDATE\n04/01/2026", [("date_signed", "04/01/2026")]), ("A long paragraph below.\nSIGNED\nDATE\n04/02/2026", [("date_signed", "04/02/2026")]),
        ("DATE 03/01/2026", [("date_signed", "03/01/2026")]), ("UPDATED 03/01/2026", []), ("ZIP code here", []), ("Birth date", []), ("", []),
    ],
)
def test_readings_of_a_cell_with_its_label(cell, out):
    assert [r[:2] for r in cell_reader().of_cell(cell)] == out


def test_typed_values_mentions_and_literals():
    assert packed.typed("date", " 4/7/2020 ").isoformat() == packed.typed("date", "2020-04-07").isoformat() == "2020-04-07"
    assert packed.typed("date", "13/1/2020") is None and packed.typed("date", "x") is None and packed.typed(None, " x") == " x"
    assert cell_reader().mentions("Name (last name, first)") == {"last_name": 1, "first_name": 3} and packed.literal(("Self", "Child"), "SELF") == "Self"


def test_offers_take_packed_cells_apart(spark):
    html = "<table><tr><td>Birth date / sex</td><td>Last, first</td></tr><tr><td>06/13/1955 F</td><td>Doe, Jane</td></tr><tr><td>SIGNED<br>DATE<br>04/01/2026</td><td>ZIP code 02481</td></tr></table>"
    grid = layout.cells(spark.createDataFrame([("i", html)], "image string, content string"))
    best = layout.best_offers(layout.offers(layout.table_pairs(grid, ["image"]), dictionary(spark), ["image"], grid), ["image"])
    assert {r["field"]: r["value"] for r in best.collect()} == {"date_of_birth": "06/13/1955", "sex": "F", "last_name": "Doe", "first_name": "Jane", "date_signed": "04/01/2026", "address_zip": "02481"}


def test_verdicts_of_words_agree(spark):
    rows = [("address_zip", "02481"), ("address_zip", "2481"), ("address_state", "ma"), ("address_state", "QQ"), ("phone", "(212) 555-0100"), ("date_of_birth", "02-30-2024"), ("date_of_birth", "4/7/1990"), ("date_of_birth", "1899-01-01"), ("first_name", "x")]
    got = spark.createDataFrame(rows, "f string, v string").select("f", "v", X.verdict(F.col("f"), F.col("v")).alias("ok")).collect()
    assert [r["ok"] for r in got] == [packed.valid(f, v) for f, v in rows]


def test_summaries_hold_every_tier_field_stage_and_release(spark):
    from fieldloom.llm import queries, selection

    exact = {(r["kind"], r["grp"], r["q"]): (r["n"], r["value"]) for r in queries.p1_percentiles(spark, SF).collect()}
    rows = queries.p1_combined(spark, SF).collect()
    got = {(r["kind"], r["grp"], r["q"]): (r["n"], r["value"]) for r in rows if r["kind"] != "stage_seed_version"}
    assert got.keys() == exact.keys() and {k for k, _, _ in got} == {"tier", "field_name", "stage", "seed_version"}
    assert all(got[k][0] == n and abs(got[k][1] - v) <= selection.ALPHA * v * 1.000001 for k, (n, v) in exact.items())
    assert any(r["kind"] == "stage_seed_version" and r["grp2"] for r in rows)
