"""Selection: by rank, by hash, by quota, to batch multiples; all reproducible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.functions.lineage import cut
from loomtrace.functions.names import jitter


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with its rows' places in an order, from 1 in ``name``: partitioned by ranges of the order,
    numbered within each partition and moved on by the sizes of those before, so no task has more
    than a range. The driver gets one count a partition. Rows equal in the order, or null in part of
    it, are numbered in any order, which the checkpoint keeps."""
    ranged = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_own", own).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_own") + F.col("_before")).drop("_part", "_own", "_before")


def stratum_winners(df: DataFrame, strata: list[str], key: str, seed: str = "0") -> DataFrame:
    """One row a stratum: of the smallest SHA-256(seed:key); an aggregation, no sort of the table."""
    rank = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256)
    return df.groupBy(*[F.col(s).alias(f"_{i}") for i, s in enumerate(strata)]).agg(F.min_by(F.struct(*df.columns), F.struct(rank, F.col(key))).alias("_r")).select("_r.*")


def per_group(df: DataFrame, group: list[str], order: list[Column | str], k: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def pad_to_multiple(df: DataFrame, order: list[Column | str], multiple: int) -> DataFrame:
    """``df`` with its first rows in the order repeated until the count is a multiple of a batch;
    repeated rows have padding = true. The rows repeated are fewer than a batch: a top-N."""
    missing = -df.count() % multiple
    kept = df.withColumn("padding", F.lit(False))
    return kept.unionByName(df.orderBy(*order).limit(missing).withColumn("padding", F.lit(True))) if missing else kept


def hash_order(key: Column, seed: int, epoch: int = 0) -> Column:
    """A seeded permutation's sort key."""
    return F.xxhash64(F.lit(seed + epoch), key)


def wrapped_batch(df: DataFrame, order: str, offset: int, n: int, copies: int = 1) -> DataFrame:
    """``n`` rows from a cursor, wrapping around, each as ``copies`` rows with group_index and index."""
    total = df.count()
    if not total:
        return df.withColumns({"group_index": F.lit(0).cast("long"), "index": F.lit(0).cast("long")}).limit(0)
    rows = numbered(df, [order], "_p").withColumn("_p", F.col("_p") - 1)
    picks = df.sparkSession.range(n).select(F.col("id").alias("group_index"), ((F.col("id") + offset) % total).alias("_p"))
    rows = rows.join(F.broadcast(picks), "_p").drop("_p")  # n rows, a batch
    return rows.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("index", F.col("group_index") * copies + F.col("_c")).drop("_c")


def quota_choice(df: DataFrame, quotas: dict[str, int], key: str, seed: str) -> DataFrame:
    """Rows among the first of each quota column by hash: at most quota rows a value."""
    rows = df.withColumn("_j", jitter(seed, F.col(key).cast("string")))
    for column, most in quotas.items():
        w = Window.partitionBy(column).orderBy("_j", key)
        rows = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")
    return rows.drop("_j")


def rank_with_unscored(df: DataFrame, scores: DataFrame, key: str, score: str, place: str) -> DataFrame:
    """Scored rows by their least score, then unscored ones; ties and unscored keep their place."""
    best = scores.groupBy(key).agg(F.min(score).alias("best_score"))
    return numbered(df.join(best, key, "left"), [F.col("best_score").asc_nulls_last(), F.col(place)], "new_place")


def length_probes(df: DataFrame, length: str, key: str, fractions: tuple[float, ...] = (0.0, 0.5, 0.95, 1.0), width: int = 1) -> DataFrame:
    """Rows around rank round((n - 1) * f) by length, ``width`` on either side, with the tier."""
    n = df.count()
    ranked = numbered(df, [length, key], "_r").withColumn("_r", F.col("_r") - 1)
    at = F.explode(F.array(*[F.struct(F.lit(f).alias("tier"), F.lit(round((n - 1) * f)).alias("mid")) for f in fractions]))
    return ranked.withColumn("_t", at).where(F.abs(F.col("_r") - F.col("_t.mid")) <= width).withColumn("tier", F.col("_t.tier")).drop("_t", "_r")


def coverage_view(df: DataFrame, key: str, trajectory: str, tool: str, anchor: Column, per_tool: int, per_trajectory: int, seed: str) -> DataFrame:
    """Anchors, then at least some rows of every tool, rare tools first under a cap per trajectory."""
    rare = 1 / F.sqrt(F.count("*").over(Window.partitionBy(tool)))
    rows = df.withColumns({"anchor": anchor, "_w": rare, "_j": jitter(seed, F.col(key).cast("string"))})
    t = Window.partitionBy(tool, "anchor").orderBy("_j", key)
    rows = rows.withColumn("_rank", F.row_number().over(t))
    g = Window.partitionBy(trajectory, "anchor").orderBy(F.col("_rank") > per_tool, F.col("_w").desc(), "_j", key)
    rows = rows.withColumn("_in", F.row_number().over(g))
    return rows.where(F.col("anchor") | ((F.col("_rank") <= per_tool) & (F.col("_in") <= per_trajectory))).drop("_w", "_j", "_rank", "_in")


def upsample(df: DataFrame, target: int, key: str, seed: int) -> DataFrame:
    """Whole repetitions up to a number of rows, and a hash sample for the rest."""
    n = df.count()
    if not n:
        return df
    whole, rest = divmod(target, n)
    out = df.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(whole)))).drop("_c") if whole else df.limit(0)
    return out.unionByName(df.orderBy(hash_order(F.col(key), seed), key).limit(rest)) if rest else out


def log_normal(mean: float, high: float, seed: int) -> Column:
    """Draws whose logarithm is normal, from a mean and a value three deviations above it."""
    sigma = (F.sqrt(F.lit(9.0) + 2 * F.log(F.lit(high / mean))) - 3)
    return F.exp(F.log(F.lit(mean)) - sigma * sigma / 2 + sigma * F.randn(seed))


def shuffled_case(df: DataFrame, group: list[str], positive: Column, k_true: int, k_all: int, key: str, seed: str) -> DataFrame:
    """Per group ``k_true`` positives and the rest negatives, in hash order."""
    rows = df.withColumns({"_p": positive, "_j": jitter(seed, F.col(key).cast("string"))})
    w = Window.partitionBy(*group, "_p").orderBy("_j", key)
    rows = rows.withColumn("_r", F.row_number().over(w)).where(F.when(F.col("_p"), F.col("_r") <= k_true).otherwise(F.col("_r") <= k_all - k_true))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy("_j", key))).drop("_r", "_j").withColumnRenamed("_p", "positive")
