"""Substring dedup: word windows that start in a smaller document are removed.

Every window of ``window`` words gets a Rabin-Karp hash, two polynomials modulo 2^64 in two
independent 64-bit hashes of the words, of which 96 bits are kept. Windows are counted by hash:
within a block of documents first, where all but the windows of the smallest document that holds
a hash are settled at once, and then per hash bucket over all blocks. A repeated passage is
therefore one entry a block however often it occurs. The windows found repeated return to their
block, where they merge into maximal removal intervals, and the intervals meet the texts by
document; texts without an interval are not shuffled.

Windows move in packed columns (about 13 bytes each): a row per window would need several
times the corpus in shuffle files. Two different windows of equal hash are taken as equal;
with n windows that happens with probability n^2 / 2^97: for the 10^13 windows of 100 TB, 0.0006.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.common import cut, id_of, shown_id, small_batches, text_of
from loomtrace.llm.keyfilter import key_filter, passes
from loomtrace.llm.packed import pack, unpack
from loomtrace.llm.wordshuffle import blocks_of, buckets_for, code_words

HEAD, LOCAL, SENT, FLAGGED = 0, 1, 2, 3
ROW = "kind int, bucket int, block long, payload binary"
ARROW_ROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
BASE = 0x9E3779B97F4A7C15 | 1


def _split(text: str) -> list[bytes]:
    return text.encode().split()


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of a sequence of word hashes, bits mixed at the end."""
    n = len(words) - window + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(window if n > 0 else 0):
        out += words[k : k + n] * np.uint64(pow(BASE, window - 1 - k, 1 << 64))
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def repeats(hashes: np.ndarray, more: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which windows, known by both hashes, occur in a smaller document too."""
    order = np.lexsort((docs, more, hashes))
    h, m, d = hashes[order], more[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (m[1:] != m[:-1])])) if len(h) else np.zeros(0, np.int64)
    least = np.repeat(d[first], np.diff(np.append(first, len(h))))
    out = np.zeros(len(h), bool)
    out[order] = d > least
    return out


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), ARROW_ROW, strict=True)], schema=ARROW_ROW)


def _blocks(window: int, buckets: int, block_chars: int):
    shift = np.uint64(buckets.bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts in blocks_of(batches, block_chars):
            words, codes, lens = code_words(texts, _split)
            own = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
            hashes = window_hashes(own[codes, 0] if len(words) else own[:, 0], window)
            more = (window_hashes(own[codes, 1] if len(words) else own[:, 1], window) >> np.uint64(32)).astype(np.uint32)
            ends = np.cumsum(lens)
            doc = np.repeat(np.arange(len(lens)), lens)[: len(hashes)]
            whole = np.arange(len(hashes)) + window <= ends[doc]  # windows stay within a document
            at = np.flatnonzero(whole).astype(np.uint32)
            ids = np.array(ids, np.int64)
            hashes, more, of = hashes[at], more[at], ids[doc[at]]
            known = repeats(hashes, more, of)
            text_keys = np.fromiter((xxhash.xxh64_intdigest(t.encode(), 42) for t in texts), np.uint64, len(texts))
            home = xxhash.xxh64_intdigest(str(block)) % buckets
            rows = [(HEAD, home, block, pack(ids, text_keys, lens)), (LOCAL, home, block, pack(np.diff(at[known], prepend=np.uint32(0))))]
            at, hashes, more, of = at[~known], hashes[~known], more[~known], of[~known]
            bucket = (hashes & np.uint64(buckets - 1)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            at, hashes, more, of, bucket = at[by], hashes[by] >> shift, more[by], of[by], bucket[by]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by)], strict=True) if len(by) else ():
                runs = np.flatnonzero(np.concatenate([[True], np.diff(of[a:b]) != 0]))
                payload = pack(np.diff(at[a:b], prepend=np.uint32(0)), hashes[a:b], more[a:b], of[a:b][runs], np.diff(np.append(runs, b - a)).astype(np.uint32))
                rows.append((SENT, int(bucket[a]), block, payload))
            yield _record(rows)

    return run


def _flag(table: pa.Table) -> pa.Table:
    rows, sent = [], []
    for kind, bucket, block, payload in zip(*[table.column(c).to_pylist() for c in ARROW_ROW.names], strict=True):
        if kind == SENT:
            steps, hashes, more, docs, runs = unpack(payload)
            sent.append((bucket, block, np.cumsum(steps, dtype=np.uint32), hashes, more, np.repeat(docs, runs)))
        else:
            rows.append((kind, bucket, block, payload))
    if sent:
        known = repeats(*(np.concatenate([s[k] for s in sent]) for k in (3, 4, 5)))
        a = 0
        for bucket, block, at, *_ in sent:
            own = at[known[a : a + len(at)]]
            a += len(at)
            if len(own):
                rows.append((FLAGGED, bucket, block, pack(np.diff(own, prepend=np.uint32(0)))))
    return pa.Table.from_batches([_record(rows)] if rows else [], schema=ARROW_ROW)


def _merge(window: int):
    def run(table: pa.Table) -> pa.Table:
        flagged, head = [], None
        for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload"), strict=True):
            if kind == HEAD:
                head = unpack(payload.as_py())
            else:
                flagged.append(np.cumsum(unpack(payload.as_py())[0], dtype=np.int64))
        if head is None:
            raise RuntimeError("a task was repeated over documents in another order: read them from files or a checkpoint")
        ids, keys, lens = head
        total = int(lens.sum())
        edge = np.zeros(total + window + 1, np.int32)
        for at in flagged:  # each position comes once
            edge[at] += 1
            edge[at + window] -= 1
        covered = np.cumsum(edge[:total]) > 0
        ends = np.cumsum(lens)
        starts = ends - lens
        change = np.diff(covered.astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        # an interval that runs on into the next document is cut at its start
        cuts = starts[(starts > 0) & (starts < total)]
        inner = cuts[covered[cuts] & covered[cuts - 1]] if total else cuts
        begin, end = np.sort(np.append(begin, inner)), np.sort(np.append(end, inner))
        doc = np.searchsorted(ends, begin, side="right")
        spans = [[] for _ in range(len(lens))]
        for d, a, b in zip(doc.tolist(), (begin - starts[doc]).tolist(), (end - starts[doc]).tolist(), strict=True):
            spans[d].append({"start": a, "end": b})
        some = [k for k, s in enumerate(spans) if s]
        return pa.table({
            "_lt_doc": pa.array(ids[some], pa.int64()), "_lt_key": pa.array(keys[some].view(np.int64), pa.int64()),
            "spans": pa.array([spans[k] for k in some], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        })

    return run


def removal_spans(docs: DataFrame, window: int = 13, block_chars: int = 4 << 20, buckets: int | None = None) -> DataFrame:
    """(_lt_doc, _lt_key, spans): for documents that lose words, maximal intervals of word
    positions (from 0, end exclusive). Rows are known by id and text hash."""
    small_batches(docs.sparkSession)
    rows = docs.select(id_of(docs).alias("_lt_doc"), text_of(docs).alias("_lt_text"))
    blocks = rows.mapInArrow(_blocks(window, buckets or buckets_for(docs, chars=1 << 24, least=64), block_chars), ROW)
    merged = blocks.groupBy("bucket").applyInArrow(_flag, ROW).groupBy("block").applyInArrow(_merge(window), "_lt_doc long, _lt_key long, spans array<struct<start:int,end:int>>")
    return merged.dropDuplicates(["_lt_doc", "_lt_key"])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, removed, kept = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = text.encode().split()
            totals.append(len(words))
            if spans:
                left = []
                last = 0
                for s in spans:
                    left += words[last : s["start"]]
                    last = s["end"]
                words = left + words[last:]
            removed.append(totals[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["_lt_doc", "n_words", "n_removed", "text"])


def dedup_substrings(docs: DataFrame, window: int = 13, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and ``text``, the words that
    stay, joined by one space.

    A word goes if a window of ``window`` words over it also starts, word for word, in a
    document of smaller doc_id; windows are those of the input. Null and empty texts have no
    words; documents shorter than a window lose nothing. Null ids count as one document
    smaller than any other; rows of equal id never cause each other's removal. An empty table
    gives none.
    """
    spans = cut(removal_spans(docs, window, **options))
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(spans, "_lt_key"))
    # XXH64 with seed 42 is also what the blocks have hashed the texts with
    rows = docs.select(id_of(docs).alias("_lt_doc"), text_of(docs).alias("_lt_text"))
    rows = rows.withColumn("_lt_key", F.xxhash64("_lt_text"))

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(bits.value, batch.column(2).to_numpy())))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = batch.filter(pa.array(~passes(bits.value, batch.column(2).to_numpy())))
            yield from _keep(iter([pa.RecordBatch.from_arrays([left.column(0), left.column(1), pa.nulls(len(left))], names=["_lt_doc", "_lt_text", "spans"])]))

    joined = rows.mapInArrow(hit, "_lt_doc long, _lt_text string, _lt_key long").join(spans, ["_lt_doc", "_lt_key"], "left").select("_lt_doc", "_lt_text", "spans")
    kept = "_lt_doc long, n_words long, n_removed long, text string"
    out = joined.mapInArrow(_keep, kept).unionByName(rows.mapInArrow(whole, kept))
    return out.select(shown_id("_lt_doc").alias("doc_id"), "n_words", "n_removed", "text")
