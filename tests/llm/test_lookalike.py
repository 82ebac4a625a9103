import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fieldloom.llm import lookalike as L

CASES = [
    ("plain O0 text", "plain O0 text", ""), (None, None, ""), ("", "", ""), ("Café", "Café", ""), ("Café", "Café", "decomposed"), ("ＡＢ１", "AB1", "compat"), ("ﬁne", "fine", "compat"), ("a​b", "ab", "unseen"),
    ("a b", "a b", "space"), ("a\tb", "a b", "space"), ("Piet Oѕtiton", "Piet Ostiton", "lookalike"), ("СA-12", "CA-12", "lookalike"), ("С61", "C61", "lookalike"), ("Юрий", "Юрий", ""), ("Вера Щеглин", "Вера Щеглин", ""),
    ("Θάλεια", "Θάλεια", ""), ("Фиaлкин", "Фиалкин", "lookalike"), ("山ノ辺", "山ノ辺", ""), ("ｶﾅ", "カナ", "compat"), ("Maɑ", "Maa", "lookalike"), ("नमस्ते", "नमस्ते", ""), ("“q” – ok", "“q” – ok", ""), ("ЮРИЙ", "ЮРИЙ", "decomposed"),
]


@pytest.fixture(scope="module")
def table(spark):
    return L.shared(spark).value


@pytest.mark.parametrize("text, canonical, why", CASES)
def test_examine(table, text, canonical, why):
    assert table.examine(text) == (canonical, why)
    assert table.examine(canonical) == (canonical, "")  # the form is consistent


def test_no_latin_letter_becomes_another_scripts(table):
    """Whichever letter of the whole table stands beside two Latin ones, these stay, and so do those of any name in Latin letters."""
    assert len(table.latin) > 300
    for c in table.proto:
        for word in (f"{c}bc", f"b{c}c", f"bc{c}"):
            got = unicodedata.normalize("NFD", table.plainest(word))
            assert "b" in got and "c" in got, (c, got)
            assert table.skeleton(got) == table.skeleton(word), (c, got)
    assert table.examine("Ьbc")[0] == "bbc"
    assert [table.skeleton(t) for t in ("ı", "ꓮ", "\u01c0", "a\u2215b", "a\u2010b")] == ["i", "A", "l", "a/b", "a-b"]
    assert table.examine("Ørjan Łaski Æbelø ß") == ("Ørjan Łaski Æbelø ß", "")


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aOl1 аОІοΝѕɑ１ﬁé\u0301\u200b\u00a0")), max_size=12))
def test_the_plainest_text_is_of_the_same_class_and_stays(table, text):
    plain = table.plainest(text)
    assert table.skeleton(plain) == table.skeleton(text)
    assert table.plainest(plain) == plain


def test_mixed_scripts_are_found_without_a_plainer_form(table, spark, rows):
    assert table.examine("Пaypal") == ("Пaypal", "lookalike")
    a = spark.createDataFrame([("d", "f", "1", "Пaypal"), ("d", "f", "2", "Пётр"), ("d", "f", "3a", "O0l1")], "doc_id string, field_name string, tier string, value string")
    s = spark.createDataFrame([], "doc_id string, fields array<struct<name string, value string>>")
    assert rows(L.odd_values(a, s)) == [("field_attempts", "d", "f", "1")]


def test_equal_looks_have_equal_skeletons(table):
    assert len({table.skeleton(t) for t in ("Paolo", "Ｐａｏｌｏ", "Pа​olo", "Раοlo", "P­aolo")}) == 1
    assert table.skeleton("Café") == table.skeleton("Café") != table.skeleton("Cafe")
    assert table.skeleton("x" * 200_000 + "ѕ") == "x" * 200_000 + "s"


def test_jvm_filter_agrees(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, v string")
    got = {r["i"]: (r["canonical"], r["why"]) for r in L.with_forms(df, "v").collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}
    with pytest.raises(ValueError, match="there already"):
        L.with_forms(df.withColumnRenamed("i", "why"), "v")


def test_odd_values_and_groups(spark, rows):
    a = spark.createDataFrame([("d", "f", "1", "СA"), ("d", "f", "1", "СA"), ("d", "f", "2", "CA"), ("e", None, None, None), ("e", "g", "1", "")], "doc_id string, field_name string, tier string, value string")
    s = spark.createDataFrame([("d", [("n", "x​"), ("m", None)]), ("e", None), ("f", [])], "doc_id string, fields array<struct<name string, value string>>")
    assert rows(L.odd_values(a, s)) == [("field_attempts", "d", "f", "1"), ("sidecars", "d", "n", "")]
    assert L.odd_values(a.limit(0), s.limit(0)).count() == 0
    assert ("CA", 2, 3, "CA") in rows(L.skeleton_groups(a, "value"))
