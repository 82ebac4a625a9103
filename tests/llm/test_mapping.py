import random

import pytest
from pyspark.sql import functions as F

from fieldloom.llm import mapping as M
from fieldloom.runtime import Scratch


@pytest.mark.parametrize("t", [0.3, 0.45, 0.8, 1.0])
def test_join_against_brute_force(spark, t):
    r = random.Random(7)
    sets = lambda n, p: [(f"{p}{i}", sorted(r.sample("abcdefghijklmnopqrst", r.randint(0, 9)))) for i in range(n)]
    a, b = sets(120, "l"), sets(40, "r")
    j = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x or y else 0
    want = {(x, y): j(p, q) for x, p in a for y, q in b if p and q and j(p, q) >= t - 1e-9}
    left, right = spark.createDataFrame(a, "l string, tokens array<string>"), spark.createDataFrame(b, "r string, tokens array<string>")
    got = M.similarity_join(left, right, t, Scratch(spark, "t")).collect()
    assert {(x["l"], x["r"]): pytest.approx(x["jaccard"]) for x in got} == want and len(got) == len(want)


REFS = [("first_name", ["Given name", "Forename"]), ("iban", ["IBAN of payee"]), ("phone", []), ("none", None)]
VALUES = {
    "Given nme": "first_name", "3. NAME, GIVEN": "first_name", "Gіven name (required)": "first_name", "firstName": "first_name", "form.first_name": "first_name", "ibn": "iban", "phnoe": "phone", "Shoe size": None, "": None, "???": None,
    "x" * 50_000: None, "Forename:": "first_name",
}


def test_values(spark):
    d = spark.createDataFrame(REFS, "canonical_name string, aliases array<string>")
    v = spark.createDataFrame([(x, "k") for x in [*VALUES, *VALUES, None]], "value string, entry string")
    got = M.map_values(v, M.references(d)).collect()
    assert {r["value"]: r["entry"] for r in got} == VALUES and len(got) == len(VALUES)
    assert {r["entry"] for r in M.map_values(v, M.references(d).limit(0)).collect()} == {None}
    assert M.map_values(v.limit(0), M.references(d)).count() == 0


def test_columns_are_judged_apart(spark, rows):
    d = spark.createDataFrame(REFS, "canonical_name string, aliases array<string>")
    o = spark.createDataFrame([(1, "Forename", "phone"), (1, "Forename", "phone"), (2, None, "Eye colour"), (3, "IBAN payee", None)], "correction_id long, learned_alias string, field_name string")
    assert rows(M.meant_entries(o, d)) == [(1, "field_name", "phone"), (1, "learned_alias", "first_name"), (3, "learned_alias", "iban")]
    assert rows(M.unmatched(o, d)) == [("field_name", "Eye colour", 1)]


def test_words_are_set_right_by_the_list(spark):
    refs = spark.createDataFrame([("a", "Bill no."), ("a", "Invoice number"), ("b", "Debtor account number"), ("c", "Street address")], "entry string, phrase string")
    known = M.list_words(refs.withColumn("canonical", F.col("phrase")))
    assert {r["v"]: r["rep"] for r in known.collect()}["no"] == "number"
    typed = ["number", "numebr", "nmber", "nuumber", "nunber", "nbr", "acct", "addr", "no", "kitchen", "x", "12"]
    got = {}
    for r in M.meant_words(spark.createDataFrame([(w,) for w in typed], "w string"), known).collect():
        got.setdefault(r["w"], set()).add(r["v"])
    assert all("number" in got[w] for w in typed[:6]) and got["no"] == {"number"} and got["acct"] == {"account"} and got["addr"] == {"address"}
    assert not got.keys() & {"kitchen", "x", "12"}


def test_word_join_against_brute_force(spark):
    r = random.Random(3)
    letters = [f"w{i}" for i in range(30)]
    left = [(f"l{i}", [r.choice([*letters, "other"]) for _ in range(r.randint(1, 6))]) for i in range(150)]
    right = [(f"r{i}", r.sample(letters, r.randint(1, 5))) for i in range(60)]
    meant = [(w, v) for w in letters for v in {w, *r.sample(letters, r.choice([0, 0, 1]))}]
    of = {}
    for w, v in meant:
        of.setdefault(w, set()).add(v)
    want = {}
    for a, x in left:
        for b, y in right:
            n, common = len(set(x)), len(set(y) & {v for w in x for v in of.get(w, ())})
            common = min(common, n)
            if (j := common / (n + len(y) - common)) >= 0.6 - 1e-9:
                want[a, b] = j
    df = lambda rows, names: spark.createDataFrame(rows, names)
    got = M.word_join(df(left, "l string, words array<string>"), df(right, "r string, words array<string>"), df(meant, "w string, v string"), 0.6, Scratch(spark, "t")).collect()
    assert {(x["l"], x["r"]): x["jaccard"] for x in got} == pytest.approx(want) and len(got) == len(want)


def test_few_pairs_are_looked_at(spark, monkeypatch):
    """On the real tables the two joins together look at less than a tenth of all pairs of a different value and a reference."""
    from fieldloom.runtime import table

    seen = []
    real = M.Scratch.write

    def write(self, df, *a, **k):
        out = real(self, df, *a, **k)
        seen.append((set(df.columns), out.told["rows"]))
        return out

    monkeypatch.setattr(M.Scratch, "write", write)
    d = "/root/testdata/sf0.01"
    refs = M.references(table(spark, d, "alias_dictionary"))
    values = M.typed_values(table(spark, d, "correction_outcomes")).select("value").distinct()
    M.map_values(values, refs)
    rest = next(n for c, n in seen if c == {"l", "words", "tokens"})
    assert rest * refs.count() < 0.10 * values.count() * refs.count()  # were the second join to look at all of its pairs
