"""Sinks and provenance: atomic publish, manifests, progress, retention."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.functions.names import prompt_hash


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> int:
    """Writes JSON lines and returns their number, counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).json(path)
    return seen.get["n"]


def publish(df: DataFrame, path: str, form: str = "json") -> None:
    """Replaces ``path`` as a whole: written beside it, the old one renamed aside, the new one into its
    place, and only then the old one deleted. At no time are both lost: a run that ends between the
    renames leaves the old rows in ``path``.old, and the next call puts them back before it begins."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    staging, target, old = fs_path(f"{path}.staging"), fs_path(path), fs_path(f"{path}.old")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        elif not fs.rename(old, target):
            raise OSError(f"cannot restore {path}")
    df.write.mode("overwrite").format(form).save(f"{path}.staging")
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(staging, target):
        fs.rename(old, target)
        raise OSError(f"cannot publish {path}")
    fs.delete(old, True)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header of the sorted column names."""
    df.select(*sorted(df.columns)).write.mode(mode).option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, key: str) -> None:
    """A folder per value of a key; rows with a blank key are left out."""
    df.where(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "").write.mode("overwrite").partitionBy(key).json(path)


def summarise(df: DataFrame, key: str, text: str, version: str) -> DataFrame:
    """One row: records, unique keys and prompts, and the versions' histogram as a map."""
    versions = df.groupBy(version).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(version), F.lit("")), "n")))).alias("versions"))
    return df.agg(F.count("*").alias("records"), F.count_distinct(key).alias("unique_ids"), F.count_distinct(prompt_hash(F.col(text))).alias("unique_prompts")).join(versions)


def manifest(step: str, source: str, commit: str | None = None, **more) -> dict:
    return {"step": step, "created_at": datetime.now(UTC).isoformat(), "source": source, "commit": commit, **more}


def progress(tasks: DataFrame, suite: str = "suite", status: str = "status", reason: str = "done_reason") -> DataFrame:
    """Counts by suite, by status, by reason and in all, from one pass."""
    sets = tasks.groupingSets([[F.col(suite)], [F.col(status)], [F.col(reason)], []], F.col(suite), F.col(status), F.col(reason))
    return sets.agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.count_if(F.col(status) == "completed").alias("completed"), F.count_if(F.col(status) == "failed").alias("retryable"))


def publish_tables(tables: dict[str, DataFrame], root: str) -> dict:
    """Publishes non-empty tables under a folder; an empty one is an error before anything is written."""
    for name, t in tables.items():
        if t.isEmpty():
            raise ValueError(f"{name} is empty")
    for name, t in tables.items():
        publish(t, f"{root}/{name}")
    return manifest("publish", root, tables=sorted(tables))


def file_stats(df: DataFrame) -> DataFrame:
    """From Spark's binaryFile rows: bytes, hash, and how many lines parse as JSON objects."""
    lines = F.split(F.decode("content", "UTF-8"), "\r?\n")
    objects = F.size(F.filter(lines, lambda x: F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json(x)), F.lit("OBJECT")), F.lit(False))))
    return df.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), objects.alias("events"), (objects > 0).alias("valid"))
