"""Length-balanced partitions, bin packing and batch schedules.

These are sequential by nature; each runs within one group (a step, a rank) as a pandas
function, and groups run in parallel.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.operators.sampling import numbered


def greedy_partition(lengths: list[int], k: int) -> list[int]:
    """The bin of each item in input order: the least loaded, the first of equal ones."""
    load = [(0, b) for b in range(k)]
    out = []
    for n in lengths:
        total, b = heapq.heappop(load)
        out.append(b)
        heapq.heappush(load, (total + n, b))
    return out


def differencing(lengths: list[int], k: int, equal_size: bool = False) -> list[int]:
    """The bin of each item by largest differencing: partial partitions are merged, largest spread
    first, the heaviest part of one with the lightest of the other. ``equal_size`` starts from
    runs of k neighbours by length, so all bins get equally many items."""
    order = sorted(range(len(lengths)), key=lambda i: (lengths[i], i))
    blocks = [order[i : i + k] for i in range(0, len(order), k)] if equal_size else [[i] for i in order]
    if equal_size and len(lengths) % k:
        raise ValueError("the number of items is not a multiple of the number of bins")

    def state(parts: list[tuple[int, list[int]]], tie: int):
        parts = sorted(parts, key=lambda p: (-p[0], -len(p[1]), p[1]))
        return (parts[-1][0] - parts[0][0], -parts[0][0], tie, parts)

    heap = [state([(lengths[i], [i]) for i in b] + [(0, [])] * (k - len(b)), t) for t, b in enumerate(blocks)]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[3], heapq.heappop(heap)[3]
        merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b), strict=True)]
        heapq.heappush(heap, state(merged, tie))
        tie += 1
    out = [0] * len(lengths)
    for b, (_, items) in enumerate(heap[0][3] if heap else []):
        for i in items:
            out[i] = b
    return out


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each item: the first with room; an oversized item is alone in one of its own."""
    sums: list[int] = []
    out = []
    for n in lengths:
        b = next((j for j, s in enumerate(sums) if s + n <= capacity), len(sums))
        if b == len(sums):
            sums.append(0)
        sums[b] += n
        out.append(b)
    return out


def split_bins(bins: list[int], lengths: list[int], target: int) -> list[int]:
    """More bins, by halving the heaviest that holds several items until there are enough."""
    out = list(bins)
    count = max(out, default=-1) + 1
    while count < target:
        members: dict[int, list[int]] = {}
        for i, b in enumerate(out):
            members.setdefault(b, []).append(i)
        able = [(sum(lengths[i] for i in m), b) for b, m in members.items() if len(m) > 1]
        if not able:
            break
        halves = [0, 0]
        for i in sorted(members[max(able)[1]], key=lambda i: -lengths[i]):
            side = int(halves[0] > halves[1])
            halves[side] += lengths[i]
            if side:
                out[i] = count
        count += 1
    return out


def pack(df: DataFrame, group: list[str], order: str, length: str, method: str = "first_fit", capacity: int = 0, bins: int = 1, equal_size: bool = False) -> DataFrame:
    """``df`` with ``bin``: items of each group packed by first_fit, greedy or differencing."""
    names, schema = df.columns, ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), "bin int"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        lengths = [int(x) for x in pdf[length]]
        if method == "first_fit":
            got = first_fit(lengths, capacity)
        elif method == "greedy":
            got = greedy_partition(lengths, bins)
        else:
            got = differencing(lengths, bins, equal_size)
        return pdf.assign(bin=np.array(got, np.int32))[[*names, "bin"]]

    return df.groupBy(*group).applyInPandas(run, schema)


def schedule(df: DataFrame, rollout: str, order: str, length: str, per_step: int, ranks: int, capacity: int) -> DataFrame:
    """Steps of ``per_step`` rollouts (a tail of fewer is dropped), packed within each step to
    micro-batches of at most ``capacity`` tokens, as many as a multiple of ``ranks``, dealt in turn:
    (step, bin, rank) for every kept sample, each placed once."""
    place = numbered(df.groupBy(rollout).agg(F.min(order).alias("_first")), ["_first"], "_place")
    place = place.withColumn("step", F.floor((F.col("_place") - 1) / per_step))
    full = place.groupBy("step").agg(F.count("*").alias("_n")).where(F.col("_n") == per_step)
    rows = df.join(place.join(full, "step").select(rollout, "step"), rollout)
    names, schema = rows.columns, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "bin int", "rank int"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        lengths = [int(x) for x in pdf[length]]
        got = first_fit(lengths, capacity)
        count = max(got, default=-1) + 1
        got = split_bins(got, lengths, -(-count // ranks) * ranks)
        return pdf.assign(bin=np.array(got, np.int32), rank=np.array([b % ranks for b in got], np.int32))[[*names, "bin", "rank"]]

    return rows.groupBy("step").applyInPandas(run, schema)


def size_batches(df: DataFrame, group: list[str], order: str, size: str, most: int) -> DataFrame:
    """Consecutive batches of each group within a size; an item over it is alone (oversize = true)."""
    names, schema = df.columns, ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), "batch int", "oversize boolean"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        batch, total, out, over = -1, most + 1, [], []
        for n in pdf[size].astype(int):
            big = n > most
            if big or total + n > most:
                batch, total = batch + 1, 0
            total = most + 1 if big else total + n
            out.append(batch)
            over.append(big)
        return pdf.assign(batch=np.array(out, np.int32), oversize=over)[[*names, "batch", "oversize"]]

    return df.groupBy(*group).applyInPandas(run, schema)
