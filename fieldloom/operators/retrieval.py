"""Late-interaction retrieval over documents of several vectors."""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Query vectors of a block; each block is held by every task once.
BLOCK = 4096


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m, dtype=np.float64), where=n > 0)


def max_sim(tokens: DataFrame, queries: DataFrame) -> DataFrame:
    """query, doc, score: the sum over a query's vectors of the largest cosine with a vector of doc.

    tokens: doc, vector. queries: query, token, vector, the stated query set, taken in blocks of BLOCK vectors: each block is one matrix product a batch of tokens, where they lie; the
    largest value a batch, document and query vector is all that is shuffled. The length of the first query vector, by query and token, holds for all;
    null or empty vectors, and those of another length, take no part (unfit() counts them)."""
    spark = tokens.sparkSession
    some = queries.filter("vector is not null and size(vector) > 0").select("query", "token", "vector").orderBy("query", "token")
    head = some.select(F.size("vector")).first()
    dim = head[0] if head else 0
    q = some.filter(F.size("vector") == dim)
    schema = "query string, token long, doc string, best double"
    parts: DataFrame | None = None
    rows = q.toLocalIterator()
    while block := [r for _, r in zip(range(BLOCK), rows)]:
        shared = spark.sparkContext.broadcast(([str(r["query"]) for r in block], [int(r["token"]) for r in block], unit_rows(np.array([r["vector"] for r in block], dtype=np.float64))))

        def run(batches: Iterator[pd.DataFrame], shared=shared, dim=dim) -> Iterator[pd.DataFrame]:
            names, ids, qm = shared.value
            for b in batches:
                b = b[[v is not None and len(v) == dim for v in b["vector"]]]
                if not len(b):
                    continue
                docs, at = np.unique(b["doc"].astype(str).to_numpy(), return_inverse=True)
                sims = qm @ unit_rows(np.stack(b["vector"].to_numpy()).astype(np.float64)).T
                best = np.full((len(names), len(docs)), -np.inf)
                for d in range(len(docs)):
                    best[:, d] = sims[:, at == d].max(axis=1)
                yield pd.DataFrame({"query": np.repeat(names, len(docs)), "token": np.repeat(ids, len(docs)), "doc": np.tile(docs, len(names)), "best": best.ravel()})

        made = tokens.select(F.col("doc").cast("string").alias("doc"), "vector").mapInPandas(run, schema)
        parts = made if parts is None else parts.unionByName(made)
    if parts is None:
        return spark.createDataFrame([], "query string, doc string, score double")
    best = parts.groupBy("query", "token", "doc").agg(F.max("best").alias("best"))
    return best.groupBy("query", "doc").agg(F.sum("best").alias("score"))


def unfit(vectors: DataFrame, dim: int, vector: str = "vector") -> int:
    """How many rows have no vector of the length dim."""
    return vectors.filter(~F.coalesce(F.size(vector) == dim, F.lit(False))).count()


#: The first bytes of a packed matrix; then the numbers of rows and columns as 32-bit integers and the values as 32-bit floats, all little-endian, row by row.
MAGIC = b"CQV1"


def pack(rows: list[list[float]]) -> bytes:
    """A matrix as bytes; rows of unequal length raise."""
    m = np.array(rows, dtype="<f4").reshape(len(rows), -1)
    return MAGIC + np.array(m.shape, dtype="<u4").tobytes() + m.tobytes()


def unpack(blob: bytes) -> list[list[float]]:
    """The inverse of pack; bytes that are no whole packed matrix raise."""
    if blob[:4] != MAGIC or len(blob) < 12:
        raise ValueError("no packed matrix")
    rows, cols = (int(x) for x in np.frombuffer(blob, "<u4", 2, 4))
    if len(blob) != 12 + 4 * rows * cols:
        raise ValueError(f"{len(blob)} bytes for {rows} x {cols}")
    return np.frombuffer(blob, "<f4", rows * cols, 12).reshape(rows, cols).tolist()


packed = F.pandas_udf(lambda s: s.map(lambda v: None if v is None else pack([list(r) for r in v])), T.BinaryType())
unpacked = F.pandas_udf(lambda s: s.map(lambda v: None if v is None else unpack(v)), T.ArrayType(T.ArrayType(T.FloatType())))


def nearest_packed(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query, doc, score, rank of the k best documents of each query, ties by doc, where a document's vectors lie together: docs (doc_id, matrix, as pack() makes them) are scored whole where they are, and
    each batch passes on k documents a query only, so what is shuffled doesn't grow with the pairs. queries: query, token, vector, taken in blocks of BLOCK vectors, each of whole queries.

    A query of another length than a document's vectors has no score with it; zero vectors score 0; null matrices are left out; none come out for k below 1."""
    spark, parts = docs.sparkSession, []
    schema = "query string, doc string, score double"
    q = queries.filter("vector is not null and size(vector) > 0").groupBy(F.col("query").cast("string").alias("query")).agg(F.array_sort(F.collect_list(F.struct("token", "vector")))["vector"].alias("m")).orderBy("query")
    block: list[tuple[str, np.ndarray]] = []
    held = 0

    def scored(block: list[tuple[str, np.ndarray]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                best: dict[str, list[tuple[float, str]]] = {}
                for doc, blob in zip(b["doc_id"], b["matrix"]):
                    m = unit_rows(np.array(unpack(bytes(blob)), dtype=np.float64)) if blob is not None else None
                    for name, qm in shared.value if m is not None and m.size else ():
                        if qm.shape[1] == m.shape[1]:
                            best.setdefault(name, []).append((-float((qm @ m.T).max(axis=1).sum()), str(doc)))
                rows = [(name, doc, -s) for name, found in best.items() for s, doc in heapq.nsmallest(k, found)]
                yield pd.DataFrame(rows, columns=["query", "doc", "score"])

        return docs.select("doc_id", "matrix").mapInPandas(run, schema)

    for r in q.toLocalIterator() if k > 0 else ():
        try:
            m = np.array(r["m"], dtype=np.float64)
        except ValueError as e:
            raise ValueError(f"vectors of several lengths in query {r['query']}") from e
        if block and held + len(m) > BLOCK:
            parts.append(scored(block))
            block, held = [], 0
        block.append((r["query"], unit_rows(m)))
        held += len(m)
    if block:
        parts.append(scored(block))
    every = functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    return top_k(every, k)


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """The k best documents of each query, ties by doc; none for k below 1."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
