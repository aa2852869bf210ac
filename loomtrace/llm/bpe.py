"""Byte-level BPE encoding and decoding by the rank file of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.common import lean, small_batches
from loomtrace.llm.wordshuffle import apply_to_words


def read_ranks(path: str) -> bytes:
    """The rank file's content: read once on the driver and sent to the executors, which
    need not have the file. Its size is the vocabulary's, not the data's."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def token_bytes(ranks: bytes) -> dict[int, bytes]:
    return {int(b): base64.b64decode(a) for a, b in map(bytes.split, ranks.splitlines())}


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={t: i for i, t in token_bytes(ranks).items()}, special_tokens={})


def encode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words (pre-tokens) and ids (array of token ids).

    ``pattern`` cuts a text into pre-tokens, each of which is merged separately by rank;
    no string is a special token. Null and empty texts have no ids. Rows with equal or
    null ids stay apart. Every distinct pre-token of the table is encoded once.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def split(t: str) -> list[str]:
        return regex.findall(pattern, t)

    def work(words: list[bytes]) -> list[list[int]]:
        one = _encoder(ranks.value, pattern)._encode_single_piece
        return [one(w) for w in words]

    return apply_to_words(docs, split, work, text=text)


def decode(encoded: DataFrame, rank_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the concatenated bytes of its ids (null ids: null), by a
    join with the token-byte table, which every task holds: one entry a token, a fixed size."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    small_batches(encoded.sparkSession)
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks.value)
        for batch in batches:
            rows = [None if x is None else b"".join(map(table.__getitem__, x)) for x in map(_numbers, batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.binary())], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(lean(run), f"{fields}, decoded binary")


def _numbers(x: pa.Scalar) -> list[int] | None:
    return x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else None


def digests(encoded: DataFrame, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids (decimal, comma-joined) and of decoded bytes, and
    with ``keep_ids`` the ids."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    out = [F.col("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return encoded.select(*out, *(["ids"] if keep_ids else []))
