import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import tokens as T

PATH = T.vocabulary_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary file")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {t: i for i, t in enumerate(T.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=T.PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_and_round_trip(text):
    enc = T.encoder(PATH)
    assert enc.decode(enc.encode(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_equal_a_public_library(reference, text):
    assert T.encoder(PATH).encode(text) == reference.encode_ordinary(text)


def test_hard_texts(spark, reference):
    texts = ["", None, "  ", "a" * 50_000, " \n" * 5000, "<|endoftext|> <unk> ▁", "日本語 テスト 🙂", "it's I'LL", "x\u0000y"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, ids int")
    got = {r["doc_id"]: r["ids"] for r in T.encode_documents(df).collect()}
    assert got == {i: reference.encode_ordinary(t) if t else [] for i, t in enumerate([*texts, texts[3]])}
    assert {r["doc_id"]: r["n_tokens"] for r in T.count_tokens(df).collect()} == {k: len(v) for k, v in got.items()}
    back = {r["doc_id"]: r["text"] for r in T.decode_documents(T.encode_documents(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate([*texts, texts[3]])}
    assert T.encode_documents(df.limit(0)).count() == 0
