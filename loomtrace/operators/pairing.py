"""Joins that pair calls with results, facts with preferred rows, spans with their ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fifo_pairs(calls: DataFrame, results: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Calls with results: the n-th call of each key (say session and name) with its n-th result."""
    w = Window.partitionBy(*keys).orderBy(order)
    a = calls.withColumn("_n", F.row_number().over(w))
    b = results.withColumn("_n", F.row_number().over(w)).select(*keys, "_n", *[F.col(c).alias(f"result_{c}") for c in results.columns if c not in keys])
    return a.join(b, [*keys, "_n"], "left").drop("_n")


def answered(calls: DataFrame, results: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(calls with a recorded result, orphans)."""
    known = results.select(*key).distinct()
    return calls.join(known, key, "left_semi"), calls.join(known, key, "left_anti")


def preferred_row(df: DataFrame, keys: list[str], preference: list[Column]) -> DataFrame:
    """The first row of each key by preference: a correlated ORDER BY ... LIMIT 1 as one rank pass."""
    w = Window.partitionBy(*keys).orderBy(*preference)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def star_top(facts: DataFrame, dims: list[tuple[DataFrame, str]], order: list[Column], limit: int) -> DataFrame:
    """Facts joined to dimensions by equal names, best first; the limit is held within 1 to 50."""
    rows = facts
    for dim, key in dims:
        rows = rows.join(dim, key)
    return rows.orderBy(*order).limit(max(1, min(50, limit)))


def first_hit(ids: DataFrame, key: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Each id with the first table that holds it; null where none does."""
    hits = None
    for place, (name, t) in enumerate(tables.items()):
        t = t.select(F.col(key), F.struct(F.lit(place).alias("p"), F.lit(name).alias("name")).alias("_t")).distinct()
        hits = t if hits is None else hits.unionByName(t)
    found = hits.groupBy(key).agg(F.min("_t").alias("_t"))
    return ids.join(found, key, "left").withColumn("found_in", F.col("_t.name")).drop("_t")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], a: tuple[str, str], b: tuple[str, str], bin_size: float) -> DataFrame:
    """Pairs of overlapping intervals (start < other end and end > other start) of equal keys.

    Each interval is dealt to the bins it covers, so that the join is on equal bins; a pair is
    kept in the first bin that both cover, which makes it one row however many they share."""
    bins = lambda s, e: F.sequence(F.floor(F.col(s) / bin_size), F.floor(F.col(e) / bin_size))
    x = left.withColumn("_bin", F.explode(bins(*a)))
    y = right.withColumn("_bin", F.explode(bins(*b)))
    rows = x.join(y, [*keys, "_bin"]).where((F.col(a[0]) < F.col(b[1])) & (F.col(a[1]) > F.col(b[0])))
    return rows.where(F.col("_bin") == F.greatest(F.floor(F.col(a[0]) / bin_size), F.floor(F.col(b[0]) / bin_size))).drop("_bin")


def spans(events: DataFrame, key: str) -> DataFrame:
    """Intervals from start and end events (key, span_id, parent_id, kind, ts): a span that is
    never ended ends where its siblings' next one starts, or its row's last event is, whichever is
    first (clipped_by says which), never before its start; an end without a start is kept."""
    s = events.where("kind = 'start'").groupBy(key, "span_id").agg(F.min("ts").alias("start"), F.min("parent_id").alias("parent_id"))
    e = events.where("kind = 'end'").groupBy(key, "span_id").agg(F.max("ts").alias("end"))
    last = events.groupBy(key).agg(F.max("ts").alias("_last"))
    rows = s.join(e, [key, "span_id"], "full_outer").join(last, key)
    w = Window.partitionBy(key, "parent_id").orderBy("start", "span_id")
    rows = rows.withColumn("_next", F.lead("start").over(w))
    bound = F.least(F.col("_last"), F.coalesce("_next", "_last"))
    clipped = F.when(F.col("end").isNull(), F.when(F.coalesce(F.col("_next") < F.col("_last"), F.lit(False)), "sibling").otherwise("row_end"))
    end = F.coalesce("end", F.greatest("start", bound))
    return rows.select(key, "span_id", "parent_id", "start", end.alias("end"), clipped.alias("clipped_by"))


def nearest_before(left: DataFrame, right: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """An as-of join by one sort of both sides together: the last right value at or before each left row."""
    a = left.select(*left.columns, F.lit(1).alias("_s"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(*keys, ts, F.lit(0).alias("_s"), F.col(value).alias("_v"))
    w = Window.partitionBy(*keys).orderBy(ts, "_s").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True)
    return both.withColumn(f"last_{value}", F.last("_v", ignorenulls=True).over(w)).where("_s = 1").drop("_s", "_v")
