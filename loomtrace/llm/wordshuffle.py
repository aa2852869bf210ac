"""Global distinct-word shuffle: a function of words is applied once to each distinct
word of a table and its results are joined back to every position.

1. Documents are cut into pre-tokens. Blocks of whole documents (about ``block_chars``
   characters) become one row with the word codes of all positions in order, and, per
   word bucket, one row with the block's distinct words of that bucket.
2. Per bucket, the words of all blocks meet; each distinct one is worked out once, and
   every block gets its answers back in its own order.
3. Per block, answers are joined to the codes and the documents reassembled by position.

A row per position would be the same join but does not fit the disk that a corpus of
this size leaves for shuffles; blocks hold the same data in compressed columns. A very
frequent word is one entry a block, so no bucket or task is larger for it. Buckets grow
in number with the table; a block's memory does not.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.common import id_of, lean, small_batches, text_of
from loomtrace.llm.packed import gather, pack, pack_strings, unpack, unpack_strings

BLOCK, WORDS, ANSWERS = 0, 1, 2
ROW = "kind int, bucket int, block long, part int, payload binary"
ARROW_ROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("payload", pa.binary())])


#: Positions of a block that are worked on at a time.
STEP = 1 << 20


def buckets_for(docs: DataFrame, text: str = "text", chars: int = 1 << 23, least: int = 256) -> int:
    """A power of two, so that a bucket gets the words of about ``chars`` characters."""
    total = docs.select(F.sum(F.octet_length(text_of(docs, text)))).first()[0] or 0
    return max(least, 1 << max(0, (total // chars)).bit_length())


def blocks_of(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[int, list[int], list[str]]]:
    """Whole documents of about ``block_chars`` characters: (block, ids, texts).

    A block's number is a hash of its task's partition, its place there and its documents' ids
    and lengths. A repeated task that reads its documents in another order therefore makes
    other numbers, and what an earlier attempt has sent to some tasks is found without a head
    or a head without it, which raises: it can't be taken for another block's.
    """
    ids, texts, chars, place = [], [], 0, 0

    def number() -> int:
        known = np.array([TaskContext.get().partitionId(), place, *ids, *map(len, texts)], np.int64)
        return xxhash.xxh64_intdigest(known.tobytes()) >> 1

    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t)
            chars += len(t)
            if chars >= block_chars:
                yield number(), ids, texts
                ids, texts, chars, place = [], [], 0, place + 1
    if ids:
        yield number(), ids, texts


def whole_block(head, found: int) -> None:
    """Raises if a block's rows come from two attempts of a task; ``found`` rows came, without the head's."""
    if head is None or len(np.unique(head[-1])) != found:
        raise RuntimeError("a task was repeated over documents in another order: read them from files or a checkpoint")


def code_words(texts: list[str], split: Callable[[str], list]) -> tuple[list, np.ndarray, np.ndarray]:
    """(distinct words, codes of all positions, words a text)."""
    index: dict = defaultdict()
    index.default_factory = index.__len__
    codes = array("I")
    lens = []
    for t in texts:
        words = split(t)
        lens.append(len(words))
        codes.extend(map(index.__getitem__, words))
    return list(index), np.frombuffer(codes, np.uint32) if codes else np.zeros(0, np.uint32), np.array(lens, dtype=np.int64)


def _counts(codes: np.ndarray, words: int) -> np.ndarray:
    found = np.zeros(words, np.int64)
    for at in range(0, len(codes), STEP):
        found += np.bincount(codes[at : at + STEP], minlength=words)
    return found


def _blocks(split: Callable[[str], list], buckets: int, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts in blocks_of(batches, block_chars):
            words, codes, lens = code_words(texts, split)
            texts.clear()  # a block is large beside what else a task holds
            raw = [w if isinstance(w, bytes) else w.encode() for w in words]
            order = np.argsort(-_counts(codes, len(raw)), kind="stable")  # frequent words get small codes
            rank = np.empty(len(raw), np.uint32)
            rank[order] = np.arange(len(raw), dtype=np.uint32)
            raw = [raw[k] for k in order.tolist()]
            del words
            for at in range(0, len(codes), STEP):
                codes[at : at + STEP] = rank[codes[at : at + STEP]]
            bucket = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % np.uint32(buckets)
            home = xxhash.xxh64_intdigest(str(block)) % buckets
            out = [(BLOCK, home, block, -1, pack(np.array(ids, np.int64), lens, codes, bucket))]
            del codes
            by = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[by], prepend=-1))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by)], strict=True) if len(by) else ():
                out.append((WORDS, int(bucket[by[a]]), block, int(bucket[by[a]]), pack_strings([raw[k] for k in by[a:b].tolist()])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), ARROW_ROW, strict=True)], schema=ARROW_ROW)

    return run


def _answers(work: Callable[[list[bytes]], list[list[int]]]):
    def run(table: pa.Table) -> pa.Table:
        kinds, rows = table.column("kind").to_pylist(), []
        asked = [unpack_strings(p.as_py()) if k == WORDS else None for k, p in zip(kinds, table.column("payload"), strict=True)]
        distinct = sorted({w for words in asked if words for w in words})
        known = dict(zip(distinct, work(distinct), strict=True))
        for at, words in enumerate(asked):
            row = [table.column(c)[at].as_py() for c in ("kind", "bucket", "block", "part", "payload")]
            if words is not None:
                found = [known[w] for w in words]
                lens = np.fromiter(map(len, found), np.uint32, len(found))
                row = [ANSWERS, *row[1:4], pack(lens, np.array([x for f in found for x in f], np.uint32))]
            rows.append(row)
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), ARROW_ROW, strict=True)], schema=ARROW_ROW)

    return run


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, words a document, codes, answers' lengths by code, answers): lists of answers in code order."""
    parts, head = {}, None
    for kind, part, payload in zip(table.column("kind").to_pylist(), table.column("part").to_pylist(), table.column("payload"), strict=True):
        if kind == BLOCK:
            head = unpack(payload.as_py())
        else:
            parts[part] = unpack(payload.as_py())
    whole_block(head, len(parts))
    ids, lens, codes, bucket = head
    by = np.argsort(bucket, kind="stable")
    empty = np.zeros(0, np.uint32)
    answer_lens = np.concatenate([empty, *[parts[p][0] for p in sorted(parts)]]).astype(np.int64)
    flat = np.concatenate([empty, *[parts[p][1] for p in sorted(parts)]])
    starts = np.cumsum(answer_lens) - answer_lens
    by_code = np.empty(len(by), np.int64)
    by_code[by] = np.arange(len(by))
    n = answer_lens[by_code]
    return ids, lens, codes, n, flat[gather(starts, answer_lens, by_code)]


def _id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min)


def _lists(table: pa.Table) -> pa.Table:
    ids, lens, codes, n, flat = _joined(table)
    starts = np.cumsum(n) - n
    edges, ends = np.cumsum(lens), np.zeros(len(lens), np.int64)  # of documents: in positions, in numbers
    values, made = [np.zeros(0, np.int32)], 0
    for at in range(0, len(codes), STEP):
        some = codes[at : at + STEP]
        values.append(flat[gather(starts, n, some)].astype(np.int32))
        a, b = np.searchsorted(edges, [at, at + len(some)], side="right")
        ends[a:b] = made + np.cumsum(n[some])[edges[a:b] - at - 1]
        made += len(values[-1])
    flat_values = np.concatenate(values)
    del values, codes
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), pa.array(flat_values)).cast(pa.list_(pa.int32()))
    return pa.table({"doc_id": _id_array(ids), "n_words": pa.array(lens, pa.int64()), "ids": lists})


def _sums(table: pa.Table) -> pa.Table:
    ids, lens, codes, n, flat = _joined(table)
    first = flat[np.cumsum(n) - n].astype(np.int64) if len(n) else np.zeros(0, np.int64)
    so_far = np.concatenate([[0], np.cumsum(first[codes])])
    ends = np.cumsum(lens)
    return pa.table({"doc_id": _id_array(ids), "n_words": pa.array(lens, pa.int64()), "total": pa.array(so_far[ends] - so_far[ends - lens], pa.int64())})


def apply_to_words(docs: DataFrame, split: Callable[[str], list], work: Callable[[list[bytes]], list[list[int]]],
                   sums: bool = False, text: str = "text", block_chars: int = 16 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words and ``ids``, the words' results in order of
    position (``sums``: their sum as ``total``; each word's result is then one number).

    ``split`` cuts a text into words (str or bytes); ``work`` takes distinct words as sorted
    bytes and returns a list of unsigned 32-bit numbers for each. Null texts have no words.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(id_of(docs).alias("_lt_doc"), text_of(docs, text).alias("_lt_text"))
    blocks = rows.mapInArrow(lean(_blocks(split, buckets_for(docs, text), block_chars)), ROW)
    answers = blocks.groupBy("bucket").applyInArrow(_answers(work), ROW)
    if sums:
        return answers.groupBy("block").applyInArrow(_sums, "doc_id long, n_words long, total long")
    return answers.groupBy("block").applyInArrow(_lists, "doc_id long, n_words long, ids array<int>")
