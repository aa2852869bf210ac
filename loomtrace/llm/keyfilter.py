"""A filter of fixed size that tells most rows of a large table which no small table refers to.

It spares them a shuffle. Its size is set here and not by the data: when it is full it lets
everything pass, and the join after it decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 1 MB on the driver and in each task.
BITS = 1 << 23


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """The filter of a column of hashes: at most BITS / 64 rows reach the driver, summed on the map side."""
    place = f"pmod({column}, {BITS})"
    rows = keys.where(F.col(column).isNotNull()).select(F.expr(f"cast({place} div 64 as int)").alias("w"), F.expr(f"shiftleft(1L, cast({place} % 64 as int))").alias("b"))
    words = rows.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of the filter's."""
    at = hashes % BITS
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
