"""Tables of a data folder, and the sequences that queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, chain): each user's event types in order."""
    e = table(spark, sf_dir, "events")
    rows = F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type")))
    return e.groupBy("user_id").agg(F.transform(rows, lambda r: r["event_type"]).alias("chain"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day, chain): the same a day."""
    e = table(spark, sf_dir, "events")
    rows = F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type")))
    return e.groupBy("user_id", F.dayofmonth("ts").cast("long").alias("day")).agg(F.transform(rows, lambda r: r["event_type"]).alias("chain"))


def joined(c: Column | str) -> Column:
    return F.array_join(c, ",")


def r6(c: Column) -> Column:
    return F.round(c, 6)


#: The same for DuckDB, to begin a query with.
CHAINS = "chains AS (SELECT user_id, list(event_type ORDER BY ts, event_id) AS chain FROM events GROUP BY user_id)"
DAILY = "daily AS (SELECT user_id, CAST(day(ts) AS BIGINT) AS day, list(event_type ORDER BY ts, event_id) AS chain FROM events GROUP BY ALL)"
