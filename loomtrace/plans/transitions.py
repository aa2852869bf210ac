"""Tool transitions of event trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtrace.plans.registry import query


@query("""
WITH s AS (SELECT user_id, ts, event_id, event_type, lag(event_type) OVER w AS prev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT * FROM s WHERE prev IS NULL OR prev <> event_type),
b AS (SELECT user_id, event_type AS source, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target FROM c),
g AS (SELECT source, target, count(*) AS n, count(DISTINCT user_id) AS n_trajectories FROM b WHERE target IS NOT NULL GROUP BY ALL)
SELECT source, target, n, n_trajectories, round(n / sum(n) OVER (), 9) AS share, source = target AS self_loop FROM g
""")
def q_transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    runs = events.withColumn("prev", F.lag("event_type").over(w)).where(F.col("prev").isNull() | (F.col("prev") != F.col("event_type")))
    pairs = runs.select("user_id", F.col("event_type").alias("source"), F.lead("event_type").over(w).alias("target")).where(F.col("target").isNotNull())
    counts = pairs.groupBy("source", "target").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_trajectories"))
    whole = Window.partitionBy()
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(whole), 9)).withColumn("self_loop", F.col("source") == F.col("target"))
