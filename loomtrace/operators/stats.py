"""Aggregations: the three quantile definitions, diversity, transitions, pass rates, group norms."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.functions import sets
from loomtrace.operators import tiles

LINEAR = (0.25, 0.5, 0.75, 0.9, 0.95)
RANKED = (0.5, 0.9, 0.95, 0.99)


def distribution(value: str) -> list[Column]:
    """count, min, linear-interpolated quantiles, max, mean; nulls left out, all null when there are none."""
    q = [F.percentile(value, p).alias(f"p{round(p * 100)}") for p in LINEAR]
    return [F.count(value).alias("count"), F.min(value).alias("min"), *q, F.max(value).alias("max"), F.avg(value).alias("mean")]


def nearest_rank(value: str) -> list[Column]:
    """count, total, mean, min, max and quantiles that are values of the data (rank ceil(f * n))."""
    q = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})").alias(f"p{round(p * 100)}") for p in RANKED]
    return [F.count(value).alias("count"), F.sum(value).alias("total"), F.round(F.avg(value), 2).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), *q]


def floor_quantiles(df: DataFrame, keys: list[str], value: str, fractions: tuple[float, ...] = LINEAR) -> DataFrame:
    """Quantiles at index floor((n - 1) * f) of the sorted values: one rank pass, no arrays."""
    w = Window.partitionBy(*keys).orderBy(value)
    ranked = df.where(F.col(value).isNotNull()).select(*keys, value, F.row_number().over(w).alias("_r"), F.count("*").over(Window.partitionBy(*keys)).alias("_n"))
    at = [F.max(F.when(F.col("_r") == F.floor((F.col("_n") - 1) * F.lit(f)) + 1, F.col(value))).alias(f"p{round(f * 100)}") for f in fractions]
    return ranked.groupBy(*keys).agg(F.count("*").alias("count"), *at)


def over_limits(value: str, limits: tuple[int, ...] = (4096, 8192, 16384)) -> list[Column]:
    return [F.count_if(F.col(value) > n).alias(f"gt_{n}") for n in limits]


def diversity(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """From a row per category with its count: entropy in nats, normalised, Simpson, effective numbers."""
    total = F.sum(n).over(Window.partitionBy(*keys)) if keys else F.sum(n).over(Window.partitionBy())
    p = counts.where(F.col(n) > 0).withColumn("_p", F.col(n) / total)
    out = p.groupBy(*keys).agg(
        F.sum(n).alias("total"), F.count("*").alias("category_count"), (-F.sum(F.col("_p") * F.ln("_p"))).alias("shannon_entropy"),
        F.sum(F.col("_p") * F.col("_p")).alias("simpson_concentration"), F.count_if(F.col(n) == 1).alias("singletons"), F.max("_p").alias("top_share"),
    )
    return out.withColumns({
        "normalized_shannon_entropy": F.when(F.col("category_count") > 1, F.col("shannon_entropy") / F.ln("category_count")).otherwise(0.0),
        "simpson_diversity": 1 - F.col("simpson_concentration"), "effective_shannon": F.exp("shannon_entropy"), "effective_simpson": 1 / F.col("simpson_concentration"),
    })


def usage(calls: DataFrame, doc: str, tool: str, batch: str, batches: list[str]) -> DataFrame:
    """A row a tool: calls, share, documents, coverage, and calls per batch."""
    per = [F.count_if(F.col(batch) == b).alias(f"n_{b}") for b in batches]
    out = calls.groupBy(tool).agg(F.count("*").alias("calls"), F.count_distinct(doc).alias("documents"), *per)
    docs = calls.agg(F.count_distinct(doc).alias("_docs"))
    out = out.withColumn("share", F.col("calls") / F.sum("calls").over(Window.partitionBy()))
    return out.join(F.broadcast(docs)).withColumn("coverage", F.col("documents") / F.col("_docs")).drop("_docs")  # docs: one row


def transitions(events: DataFrame, keys: list[str], order: list[str], tool: str, collapse: bool = True) -> DataFrame:
    """Counts and documents of adjacent pairs (source, target) in ordered sequences, by default
    after dropping consecutive repeats."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = events.select(*keys, *order, tool)
    if collapse:
        rows = rows.withColumn("_b", F.lag(tool).over(w)).where(~F.col("_b").eqNullSafe(F.col(tool))).drop("_b")
    pairs = rows.select(*keys, F.col(tool).alias("source"), F.lead(tool).over(w).alias("target")).where(F.col("target").isNotNull())
    return pairs.groupBy("source", "target").agg(F.count("*").alias("n"), F.count_distinct(*keys).alias("documents"))


def js_similarity(counts: DataFrame, key: str, side: str, left, right, n: str = "n") -> DataFrame:
    """1 - Jensen-Shannon divergence (base 2) of two sides' count vectors: one row. Both empty: 1; one: 0."""
    pivot = counts.groupBy(key).agg(F.sum(F.when(F.col(side) == left, F.col(n)).otherwise(0)).alias("l"), F.sum(F.when(F.col(side) == right, F.col(n)).otherwise(0)).alias("r"))
    w = Window.partitionBy()
    rows = pivot.withColumns({"p": F.col("l") / F.nullif(F.sum("l").over(w), F.lit(0)), "q": F.col("r") / F.nullif(F.sum("r").over(w), F.lit(0))})
    half = lambda a, b: F.when(F.col(a) > 0, 0.5 * F.col(a) * F.log2(F.col(a) / ((F.col(a) + F.col(b)) / 2))).otherwise(0.0)
    total = F.sum(half("p", "q") + half("q", "p"))
    lone = F.coalesce(F.sum("l"), F.lit(0)) * F.coalesce(F.sum("r"), F.lit(0)) == 0
    return rows.agg(F.when(F.coalesce(F.sum(F.col("l") + F.col("r")), F.lit(0)) == 0, 1.0).when(lone, 0.0).otherwise(1 - total).alias("similarity"))


def pass_at_k(df: DataFrame, group: str, reward: Column, ks: tuple[int, ...] = (1, 2, 4, 8)) -> DataFrame:
    """Mean over groups of the unbiased 1 - C(n - c, k) / C(n, k); groups with fewer than k rows have no pass@k."""
    g = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(reward == 1).alias("c"))

    def one(k: int) -> Column:
        n, c = F.col("n"), F.col("c")
        miss = F.aggregate(F.sequence(n - c + 1, n), F.lit(1.0), lambda a, i: a * (1 - k / i))
        return F.avg(F.when(n < k, None).when(n - c < k, 1.0).when(c == 0, 0.0).otherwise(1 - miss)).alias(f"pass_at_{k}")

    return g.agg(F.count("*").alias("groups"), *[one(k) for k in ks])


def group_normalised(df: DataFrame, group: list[str], reward: str, by_std: bool = True, eps: float = 1e-6) -> DataFrame:
    """``df`` with advantage: reward - group mean, over sample deviation + eps. A single row's is 0."""
    w = Window.partitionBy(*group)
    centred = F.col(reward) - F.avg(reward).over(w)
    return df.withColumn("advantage", centred / (F.coalesce(F.stddev_samp(reward).over(w), F.lit(0.0)) + eps) if by_std else centred)


def reward_groups(df: DataFrame, group: list[str], reward: str) -> DataFrame:
    """A row a group: size, mean, sample deviation, whether it is kept (deviation above 1e-6; a
    single row's is undefined and not kept), and its class at the policy's boundary."""
    g = df.groupBy(*group).agg(F.count("*").alias("n"), F.avg(reward).alias("mean"), F.stddev_samp(reward).alias("std"), F.min(reward).alias("low"), F.max(reward).alias("high"))
    kept = F.coalesce(F.col("std") > 1e-6, F.lit(False))
    cls = F.when(F.col("low") >= 0.999, "mastered_all_correct").when(F.col("high") <= -0.399, "too_hard_all_wrong").when(~kept, "zero_reward_variance").otherwise("boundary")
    reason = F.when(~kept, F.concat(F.lit("zero_std_"), F.round("mean", 1).cast("string")))
    return g.withColumns({"kept": kept, "reason": reason, "boundary_class": cls})


def role_metrics(df: DataFrame, role: str, group: str, reward: str, truncated: Column) -> DataFrame:
    """A row a role: count, mean, population deviation, truncated ratio, share of groups with spread."""
    per = df.groupBy(role, group).agg((F.max(reward) - F.min(reward) > 1e-12).alias("_spread"))
    spread = per.groupBy(role).agg(F.avg(F.col("_spread").cast("double")).alias("nonzero_std_group_ratio"))
    out = df.groupBy(role).agg(F.count("*").alias("count"), F.avg(reward).alias("reward_mean"), F.stddev_pop(reward).alias("reward_std"), F.avg(truncated.cast("double")).alias("truncated_ratio"))
    return out.join(spread, role)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of sums, 0 without a denominator."""
    return F.coalesce(F.try_divide(F.sum(numerator), F.sum(denominator)), F.lit(0.0))


def bucket_shares(value: Column, cap: float, parts: int = 4) -> list[Column]:
    """Share of values in each of equal buckets up to a cap; what is above counts in none."""
    bucket = F.ceil(value / cap * parts)
    return [F.avg(F.when(F.greatest(bucket, F.lit(1)) == i, 1.0).otherwise(0.0)).alias(f"bucket_{i}") for i in range(1, parts + 1)]


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Unions of overlapping or touching intervals of each key: islands over the running maximal end."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.select(*keys, start, end).withColumn("_new", F.when(F.col(start) <= before, 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def gaps(merged: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The idle times between merged intervals."""
    w = Window.partitionBy(*keys).orderBy(start)
    return merged.select(*keys, F.col(end).alias("gap_start"), F.lead(start).over(w).alias("gap_end")).where("gap_end > gap_start")


def set_pairs(rows: DataFrame, block: str, items: str, most_sets: int = 8192) -> DataFrame:
    """(block_a, block_b, pairs, mean_distance, least, equal): Jaccard distances of every unordered
    pair of rows by their blocks, those across blocks included, the smaller block first.

    Distances are computed once for two distinct sets, and counted for all rows that have them. Parts of
    about ``most_sets`` sets meet each other once, and leave a row for two of their blocks."""
    counts = rows.groupBy(F.array_sort(F.array_distinct(items)).alias("t"), F.col(block).alias("block")).agg(F.count("*").alias("n"))
    held = counts.groupBy("t").agg(F.collect_list(F.struct("block", "n")).alias("held"))
    parts = max(8, -(-held.count() // most_sets))
    dealt = tiles.packed(held, parts, F.xxhash64("t"))
    kind = dict(counts.dtypes)["block"]

    def work(i: int, j: int, a: pa.Table, b: pa.Table) -> Iterator[pa.RecordBatch]:
        return tiles.set_distances(i == j, a, b).to_batches()

    met = tiles.meeting(dealt, dealt, parts, F.sequence(F.col("part"), F.lit(parts - 1).cast("long")), work, f"x {kind}, y {kind}, pairs long, total double, least double, equal long")
    out = met.groupBy(F.least("x", "y").alias("block_a"), F.greatest("x", "y").alias("block_b"))
    return out.agg(F.sum("pairs").alias("pairs"), (F.sum("total") / F.sum("pairs")).alias("mean_distance"), F.min("least").alias("least"), F.sum("equal").alias("equal"))


def nearest_sets(left: DataFrame, right: DataFrame, items: str, parts: int = 16) -> DataFrame:
    """(t, n, best, same): each distinct set of ``left`` with its number of rows, its highest Jaccard
    similarity to a set of ``right``, and whether one is equal. Distinct sets of ``right`` are dealt over
    ``parts``, which every set of ``left`` meets, so that no task holds all of them."""
    a = left.groupBy(F.array_sort(items).alias("t")).agg(F.count("*").alias("n")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    b = right.select(F.array_sort(items).alias("t2")).distinct().withColumn("i", F.pmod(F.xxhash64("t2"), F.lit(parts)).cast("int"))
    near = a.join(b, "i").withColumn("s", 1 - sets.jaccard_distance(F.col("t"), F.col("t2")))
    return near.groupBy("t", "n").agg(F.max("s").alias("best"), F.bool_or(F.col("t") == F.col("t2")).alias("same"))
