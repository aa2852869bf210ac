"""Connected components of a graph of links, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.common import cut

#: Links that one task contracts at a time.
BLOCK = 1 << 18


def _least(pairs: DataFrame) -> DataFrame:
    """Per node u of (u, v): the least of u and its neighbours, joined to its rows. The least
    is aggregated on the map side first; a node of many links is split in the join."""
    return pairs.join(pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), "u")


def least_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links that are not the least of their component, and those least ones."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        u, v = least_of(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(links: DataFrame, most_rounds: int = 60, block: int = BLOCK) -> DataFrame:
    """(node, root): each node of the links (u, v), two longs, with its component's least node.
    Links of a node to itself and repeated ones don't count; those with a null are left out.

    Blocks of about ``block`` links are contracted first, each to links from its nodes to the
    least one reachable within it, of which there are fewer than nodes. Of a single block that is
    the result. Several go on with alternating large-star and small-star rounds: every round
    points nodes at the least neighbour they know of, so that chains shorten by a factor each
    time, and the number of links never grows. Each round is checkpointed and compared with the
    one before by a count and a checksum, which is all that reaches the driver.
    """
    edges = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    blocks = max(1, -(-edges.count() // block))
    edges = cut(edges.repartition(blocks).mapInArrow(_contract, "u long, v long"))
    mark = None
    for _ in range(most_rounds):
        if blocks == 1:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"links are not settled after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
