"""Decision rows of trajectories: history-only state, repeats, outcomes, islands of one role."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def decisions(messages: DataFrame, key: str, order: str, role: str = "assistant") -> DataFrame:
    """A row per action with everything before it as ``state``: never itself, never later rows."""
    w = Window.partitionBy(key).orderBy(order)
    state = F.collect_list(F.struct(order, "role", "text")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = messages.withColumn("state", state).where(F.col("role") == role)
    return rows.withColumns({"ordinal": F.row_number().over(w) - 1, "n_decisions": F.count("*").over(Window.partitionBy(key))})


def no_progress_repeats(actions: DataFrame, key: str, order: list[str], signature: str, success: str) -> DataFrame:
    """Actions with what they repeat: the most recent one of equal signature, whether that succeeded,
    whether an action in between succeeded, and no_progress: it did and none did."""
    w = Window.partitionBy(key).orderBy(*order)
    s = Window.partitionBy(key, signature).orderBy(*order)
    so_far = F.sum(F.col(success).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = actions.withColumns({"ordinal": F.row_number().over(w) - 1, "_ok": so_far})
    rows = rows.withColumns({"repeat_of": F.lag("ordinal").over(s), "_was": F.lag(success).over(s), "_then": F.lag("_ok").over(s)})
    between = F.coalesce(F.col("_ok") - F.col(success).cast("int") - F.col("_then") > 0, F.lit(False))
    rows = rows.withColumns({"prior_success": F.coalesce("_was", F.lit(False)), "intervening_success": between})
    return rows.withColumn("no_progress", F.col("repeat_of").isNotNull() & F.col("prior_success") & ~F.col("intervening_success")).drop("_ok", "_was", "_then")


def previous_status(rows: DataFrame, key: str, order: list[str], status: str) -> DataFrame:
    """The last known status strictly before each row; ``none`` without one."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("previous_status", F.coalesce(F.last(status, ignorenulls=True).over(w), F.lit("none")))


def merge_turns(messages: DataFrame, key: str, order: str, by: str = "\n\n") -> DataFrame:
    """Consecutive messages of one role as one, texts joined in order."""
    w = Window.partitionBy(key).orderBy(order)
    rows = messages.withColumn("_new", F.when(F.col("role").eqNullSafe(F.lag("role").over(w)), 0).otherwise(1))
    rows = rows.withColumn("_turn", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct(order, "text")))
    return rows.groupBy(key, "_turn", "role").agg(F.min(order).alias(order), F.count("*").alias("n_messages"), F.array_join(F.transform(parts, lambda p: p["text"]), by).alias("text")).withColumnRenamed("_turn", "merged_turn")


def fit_context(turns: DataFrame, key: str, order: str, length: str, compact: str, budget: int, keep_recent: int = 4) -> DataFrame:
    """How each conversation fits a token budget: unchanged; with turns before the recent ones
    compacted; or from the first turn whose compacted suffix fits; else over_budget."""
    back = Window.partitionBy(key).orderBy(F.col(order).desc())
    rows = turns.withColumn("_r", F.row_number().over(back))
    small = F.when(F.col("_r") <= keep_recent, F.col(length)).otherwise(F.least(length, compact))
    rows = rows.withColumn("_small", small).withColumn("_tail", F.sum("_small").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    g = rows.groupBy(key).agg(F.sum(length).alias("full"), F.sum("_small").alias("compacted"), F.min(F.when(F.col("_tail") <= budget, F.col(order))).alias("first_kept"))
    tier = F.when(F.col("full") <= budget, "unchanged").when(F.col("compacted") <= budget, "compacted").when(F.col("first_kept").isNotNull(), "suffix").otherwise("over_budget")
    return g.withColumn("tier", tier).withColumn("first_kept", F.when(F.col("tier") == "suffix", F.col("first_kept")))


def conversion_skips(rows: DataFrame, checks: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): skipped rows carry the first reason of the ladder that holds."""
    reason = F.coalesce(*[F.when(c, F.lit(r)) for c, r in checks])
    tagged = rows.withColumn("skip_reason", reason)
    return tagged.where("skip_reason is null").drop("skip_reason"), tagged.where("skip_reason is not null")


def tool_sequences(calls: DataFrame, key: str, order: list[str], tool: str, failed: str) -> DataFrame:
    """Per session: ordered tools, distinct failed ones in order, the first failure."""
    seq = F.array_sort(F.collect_list(F.struct(*order, tool, failed)))
    bad = F.filter(seq, lambda c: c[failed])
    return calls.groupBy(key).agg(
        F.transform(seq, lambda c: c[tool]).alias("tools"), F.array_distinct(F.transform(bad, lambda c: c[tool])).alias("failed_tools"), F.get(F.transform(bad, lambda c: c[tool]), 0).alias("first_failure"),
    )


def fan_out(samples: DataFrame, segments: str, reward: str) -> DataFrame:
    """A sample as its segments: the reward divided among them, with index and number."""
    rows = samples.select("*", F.posexplode(segments).alias("segment_idx", "segment"), F.size(segments).alias("num_segments"))
    return rows.withColumn(reward, F.col(reward) / F.col("num_segments")).drop(segments)


def head_and_tail(tokens: str, head: int, most: int):
    """Oversize token arrays keep their first ``head`` and as many last ones as fit."""
    t = F.col(tokens)
    return F.when(F.size(t) <= most, t).otherwise(F.concat(F.slice(t, 1, head), F.slice(t, F.size(t) - (most - head) + 1, F.lit(most - head))))
