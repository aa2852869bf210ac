"""Exact top-k search by tiled matrix products.

Queries and candidates are packed into matrices, a block of queries and a shard of
candidates each. A tile is one block times one shard; it keeps the k best of the shard for
each query of the block. Lists of the same block are merged in a tree, FAN shards at a time,
so that no task ever holds more than FAN lists of a block however many shards there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 16
PACKED = "part long, size int, ids binary, vectors binary"
ARROW_PACKED = pa.schema([("part", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
BEST = "qpart long, spart long, rows binary"
ARROW_BEST = pa.schema([("qpart", pa.int64()), ("spart", pa.int64()), ("rows", pa.binary())])


def quantised(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, vec): floor(scale * x) of every component, x as double. Vectors that are null, empty,
    or hold null or non-finite components, and rows without an id, take no part."""
    x = F.col(column).cast("array<double>")
    rows = vectors.select(vectors[key].cast("long").alias("id"), F.transform(x, lambda v: v).alias("x")).where("id is not null and size(x) > 0")
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where(F.coalesce(fine, F.lit(False))).select("id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("vec"))


def _pack(table: pa.Table) -> pa.Table:
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    vectors = np.array(table.column("vec").to_pylist(), np.int64)[order]
    return pa.Table.from_arrays([pa.array([table.column("part")[0].as_py()]), pa.array([vectors.shape[1]], pa.int32()), pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary())], schema=ARROW_PACKED)


def packed(rows: DataFrame, parts: int) -> DataFrame:
    """Matrices of rows by hash of the id and by dimension, ids ascending within each."""
    part = F.pmod(F.xxhash64("id"), F.lit(parts)) * 100_003 + F.size("vec")
    return rows.withColumn("part", part).groupBy("part").applyInArrow(_pack, PACKED)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by floating point where every sum fits its mantissa."""
    if not (len(a) and len(b)):
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < float(1 << 62):
        return a @ b.T
    raise OverflowError("inner products don't fit 64 bits")


def _rows(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> bytes:
    return np.stack([query, vec, score]).astype(np.int64).tobytes()


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query's rows, by score, ties to smaller ids."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    keep = order[place < k]
    return query[keep], vec[keep], score[keep]


def _tile(k: int, step: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                d = row["size"]
                qids, sids = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q, s = np.frombuffer(row["qvectors"], np.int64).reshape(-1, d), np.frombuffer(row["vectors"], np.int64).reshape(-1, d)
                found = []
                for a in range(0, len(q), step):  # a product at a time holds step rows
                    scores, own = products(q[a : a + step], s), qids[a : a + step]
                    mine = sids[None, :] == own[:, None]
                    n = min(k + int(mine.sum(axis=1).max(initial=0)), len(s))
                    # unique keys: by score, ties to the earlier, that is smaller, id
                    keys = scores * np.int64(len(s)) + np.arange(len(s) - 1, -1, -1)
                    if np.abs(scores).max(initial=0) >= (1 << 62) // max(1, len(s)):
                        top = np.argsort(-scores, axis=1, kind="stable")[:, :n]
                    else:
                        top = np.argpartition(keys, len(s) - n, axis=1)[:, len(s) - n :]
                    at = np.repeat(np.arange(len(own)), n)
                    cols = top.ravel()
                    other = ~mine[at, cols]
                    found.append(best(own[at[other]], sids[cols[other]], scores[at[other], cols[other]], k))
                rows = _rows(*(np.concatenate(x) for x in zip(*found, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array([row["qpart"]], pa.int64()), pa.array([row["spart"]], pa.int64()), pa.array([rows], pa.binary())], schema=ARROW_BEST)

    return run


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        parts = np.concatenate([np.frombuffer(r.as_py(), np.int64).reshape(3, -1) for r in table.column("rows")], axis=1)
        rows = _rows(*best(*parts, k))
        return pa.Table.from_arrays([table.column("qpart")[:1], table.column("spart")[:1], pa.array([rows], pa.binary())], schema=ARROW_BEST)

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.column("rows").to_pylist():
            q, v, s = np.frombuffer(row, np.int64).reshape(3, -1)
            first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
            rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) + 1
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(rank, pa.int32()), pa.array(v), pa.array(s)], names=["query_id", "rank", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, shard: int = 8192, block: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products over all
    candidates of other ids and equal dimension, ties to the smaller id; fewer if there are fewer.

    Both inputs are (id, vec) of integers, as from ``quantised``. Repeated ids are candidates
    each; a repeated query is answered for its smallest vector. No candidates or no queries give no rows.
    """
    queries = queries.groupBy("id").agg(F.min("vec").alias("vec"))
    spark = candidates.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    sparts = max(1, -(-candidates.count() // shard))
    qparts = max(1, -(-queries.count() // block))
    s = packed(candidates, sparts).withColumnRenamed("part", "spart")
    q = packed(queries, qparts).select(F.col("part").alias("qpart"), "size", F.col("ids").alias("qids"), F.col("vectors").alias("qvectors"))
    # every block meets every shard of its dimension, by an explicit tile number
    shards = s.select("*", F.explode(F.sequence(F.lit(0), F.lit(qparts - 1))).alias("b"))
    tiles = shards.join(q.withColumn("b", F.floor(F.col("qpart") / 100_003).cast("int")), ["b", "size"])
    tiles = tiles.select("qpart", "spart", "size", "qids", "qvectors", "ids", "vectors")
    found = tiles.repartition("qpart", "spart").mapInArrow(_tile(k), BEST)
    left = sparts
    while left > 1:
        left = -(-left // FAN)
        found = found.withColumn("spart", F.floor(F.col("spart") / 100_003)).withColumn("spart", F.floor(F.col("spart") / FAN) * 100_003)
        found = found.groupBy("qpart", "spart").applyInArrow(_merge(k), BEST)
    return found.mapInArrow(_unpack, "query_id long, rank int, vec_id long, score long")
