"""The plug-in for live readers: any object with a name, a tier and extract() reads documents in Arrow batches, with retries."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol, runtime_checkable

import pandas as pd
from pyspark.sql import DataFrame

#: Retries of a failure that may pass, retries of another, first wait in seconds, longest time of a reading in seconds.
RETRIES, OTHER_RETRIES, WAIT, LONGEST = 3, 1, 1.0, 240.0

READINGS = "doc_id string, tier string, field_name string, value string, confidence double, latency_ms double, error string"


@runtime_checkable
class Reader(Protocol):
    """name and tier tell the reader apart; extract gives {field: (value or None, confidence)} for a document's content and the fields asked for."""

    name: str
    tier: str

    def extract(self, content: bytes, fields: list[str]) -> dict[str, tuple[str | None, float]]: ...


def may_pass(error: BaseException) -> bool:
    """A failure worth another try: a timeout, a lost connection, another failure of the system, or an answer with status 500 to 599."""
    status = getattr(error, "status_code", None) or getattr(getattr(error, "response", None), "status_code", None)
    return isinstance(error, (TimeoutError, ConnectionError, OSError)) or isinstance(status, int) and 500 <= status <= 599


def attempt(call: Callable[[], dict], sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> tuple[dict | None, float, str | None]:
    """(result, milliseconds, error) of a call, tried again up to RETRIES times after 1, 2 and 4 seconds with jitter; the result is null once the tries are used up.

    Among them, failures that can't pass are tried again OTHER_RETRIES times, whatever failed before. An answer that takes longer than LONGEST counts as a timeout."""
    n = others = 0
    while True:
        began = clock()
        try:
            out = call()
            took = clock() - began
            if took > LONGEST:
                raise TimeoutError(f"took {took:.0f} s")
            return out, took * 1000, None
        except Exception as e:  # noqa: BLE001  readers fail in their own ways
            others += not may_pass(e)
            if n >= RETRIES or others > OTHER_RETRIES and not may_pass(e):
                return None, (clock() - began) * 1000, f"{type(e).__name__}: {e}"
            sleep(WAIT * 2**n * (1 + random.random() / 4))
            n += 1


_made: dict[str, Reader] = {}


def once(name: str, make: Callable[[], Reader]) -> Callable[[], Reader]:
    """make, whose reader is made once a worker process and kept under name, for readers that are dear to make."""

    def kept() -> Reader:
        from fieldloom.sources import readers  # the worker's own module, whatever travelled there

        if name not in readers._made:
            readers._made[name] = make()
        return readers._made[name]

    return kept


def read(documents: DataFrame, make: Callable[[], Reader]) -> DataFrame:
    """READINGS of documents (doc_id, content, fields): a row a field asked for, or one row with the error and a null field where the reader gave up.

    make is called once a task, so models and connections are made on the executors. Ask only for what needs this reader: filter before. A null list of fields asks for nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = make()
        for b in batches:
            out = []
            for doc_id, content, fields in zip(b["doc_id"], b["content"], b["fields"]):
                asked = [] if fields is None else list(fields)
                if not asked:
                    continue
                got, ms, error = attempt(lambda: reader.extract(content, asked))
                if got is None:
                    out.append((doc_id, reader.tier, None, None, None, ms, error))
                else:
                    out += [(doc_id, reader.tier, f, *got.get(f, (None, 1.0)), ms, None) for f in asked]
            yield pd.DataFrame(out, columns=["doc_id", "tier", "field_name", "value", "confidence", "latency_ms", "error"])

    return documents.select("doc_id", "content", "fields").mapInPandas(run, READINGS)
