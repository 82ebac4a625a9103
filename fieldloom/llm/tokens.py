"""Encoding of a corpus with a public byte-level BPE vocabulary, by a sentencepiece model serialised from it."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.runtime import spread

#: Fixed value: how the vocabulary's makers cut a text into pre-tokens.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose ids a worker remembers; the memory is emptied when full.
REMEMBERED = 100_000
#: Characters up to which a pre-token is remembered.
SHORT = 40


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where a file of public_tokenizers lies; FIELDLOOM_TOKENIZERS names another folder."""
    folder = os.environ.get("FIELDLOOM_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


def byte_letters() -> list[str]:
    """For each byte a printable character of its own: itself where it prints, else the next free one from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = [], 0x100
    for b in range(256):
        if b in prints:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    """A protobuf field: a number as varint, bytes with their length."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    return _field(1, _field(1, text.encode()) + _varint(2 << 3 | 5) + np.float32(score).tobytes() + _field(3, kind))


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose id i is tokens[i]: pieces in byte letters, score minus the rank, identity normalisation.

    The piece after the last token is the unknown piece; it never comes out, as every byte is a token."""
    letters = byte_letters()
    if missing := {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError(f"{len(missing)} bytes are no tokens")
    pieces = [_piece("".join(letters[b] for b in t), -float(i), 1) for i, t in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, 2))
    bpe, unk = _field(3, 2), _field(40, len(tokens))
    none = b"".join(_varint(n << 3) + _varint(2**64 - 1) for n in (41, 42, 43))  # no bos, eos, pad: -1
    trainer = bpe + _field(4, len(pieces)) + _field(24, 0) + unk + none
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Encoder:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: str | list[bytes]):
        """vocabulary: the path of a rank file, or its tokens by rank."""
        import regex
        import sentencepiece

        self.tokens = read_ranks(vocabulary) if isinstance(vocabulary, str) else vocabulary
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self._cut = regex.compile(PRE_TOKENS).findall
        letters = byte_letters()
        self._letters = {b: letters[b] for b in range(256)}
        self._known: dict[str, list[int]] = {}

    def _ids(self, pre: str) -> list[int]:
        return self._model.encode(pre.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._letters), out_type=int)

    def encode(self, text: str | None) -> list[int]:
        """Ids without special tokens; none for an empty or a null text."""
        if not text:
            return []
        out: list[int] = []
        known = self._known
        for pre in self._cut(text):
            ids = known.get(pre)
            if ids is None:
                ids = self._ids(pre)
                if len(pre) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[pre] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder of a vocabulary file."""
    return Encoder(path)


_shared: dict[tuple[str, str], tuple] = {}
_of_worker: dict[int, Encoder] = {}


def shared(spark: SparkSession, path: str):
    """The vocabulary as a broadcast variable, read where the driver is, once an application: about a megabyte, whatever the corpus."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _shared:
        _shared[key] = spark.sparkContext.broadcast(read_ranks(path))
    return _shared[key]


def worker_encoder(vocabulary) -> Encoder:
    """One encoder a worker process, of the vocabulary that was broadcast."""
    tokens = vocabulary.value
    if id(tokens) not in _of_worker:
        _of_worker.clear()
        _of_worker[id(tokens)] = Encoder(tokens)
    return _of_worker[id(tokens)]


def _mapped(docs: DataFrame, id_col: str, text_col: str, path: str, name: str, only_count: bool) -> DataFrame:
    kind = T.LongType() if only_count else T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema[id_col], T.StructField(name, kind)])
    vocabulary = shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(vocabulary)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 500):  # bounds the ids held at once
                lists = [enc.encode(t) for t in texts.slice(at, 500).to_pylist()]
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                if only_count:
                    made = pa.array(sizes)
                else:
                    flat = np.fromiter((i for x in lists for i in x), np.int32, int(sizes.sum()))
                    made = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys.slice(at, 500), made], names=[id_col, name])

    return spread(docs.select(id_col, text_col)).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, name: str = "ids") -> DataFrame:
    """One row a row of docs: id_col and the list of token ids.

    Null and empty texts give an empty list, never null; repeated rows stay repeated; a null id stays null; other columns, whatever
    their names, are not read. A text of any length is encoded whole. No shuffle but where the table has fewer partitions than there are cores."""
    return _mapped(docs, id_col, text_col, path or vocabulary_path(), name, only_count=False)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, name: str = "n_tokens") -> DataFrame:
    """As encode_documents, with the number of tokens in place of the ids."""
    return _mapped(docs, id_col, text_col, path or vocabulary_path(), name, only_count=True)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None, name: str = "text") -> DataFrame:
    """The inverse mapping: the text of each list of ids; a null list gives null."""
    vocabulary = shared(encoded.sparkSession, path or vocabulary_path())

    @F.pandas_udf(T.StringType())
    def back(s: pd.Series) -> pd.Series:
        enc = worker_encoder(vocabulary)
        return s.map(lambda ids: None if ids is None else enc.decode(ids))

    return encoded.select(id_col, back(ids_col).alias(name))
