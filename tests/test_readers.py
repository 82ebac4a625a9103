import pytest
from pyspark.sql import functions as F

from fieldloom.operators import retrieval
from fieldloom.sources import readers


def test_read(spark, rows):
    class Stub:  # within the test, so that tasks get it by value
        name, tier = "stub", "2"

        def extract(self, content, fields):
            if bytes(content) == b"bad":
                raise ValueError("unreadable")
            return {"a": (bytes(content).decode() or None, 0.9)}

    assert isinstance(Stub(), readers.Reader)
    d = spark.createDataFrame([("d", b"x", ["a", "b"]), ("e", b"bad", ["a"]), ("f", b"x", None), ("g", b"", ["a"])], "doc_id string, content binary, fields array<string>")
    got = readers.read(d, Stub).select("doc_id", "tier", "field_name", "value", "confidence", "error")
    assert rows(got) == [("d", "2", "a", "x", 0.9, None), ("d", "2", "b", None, 1.0, None), ("e", "2", None, None, None, "ValueError: unreadable"), ("g", "2", "a", None, 0.9, None)]
    assert readers.read(d.limit(0), Stub).count() == 0


@pytest.mark.parametrize("error, tries", [(TimeoutError(), 4), (ConnectionError(), 4), (ValueError(), 2)])
def test_tries(error, tries):
    calls, waits = [], []

    def call():
        calls.append(1)
        raise error

    assert readers.attempt(call, waits.append)[0] is None and len(calls) == tries and all(2**i <= w <= 2**i * 1.25 for i, w in enumerate(waits))


def test_server_errors_and_slow_answers():
    e = RuntimeError()
    e.status_code = 503
    assert readers.may_pass(e) and not readers.may_pass(RuntimeError())
    t = iter(range(0, 100_000, 500))
    assert "TimeoutError" in readers.attempt(dict, lambda s: None, lambda: next(t))[2]


def test_packed_matrices(spark):
    m = [[1.0, 2.5], [-3.0, 0.0]]
    assert retrieval.unpack(retrieval.pack(m)) == m and retrieval.pack(m)[:4] == b"CQV1"
    for blob in (b"", b"XXXX", retrieval.pack(m)[:-1]):
        with pytest.raises(ValueError):
            retrieval.unpack(blob)
    d = spark.createDataFrame([(m,), (None,)], "v array<array<float>>")
    assert [r[0] for r in d.select(retrieval.unpacked(retrieval.packed(F.col("v")))).collect()] == [m, None]
