"""Sources: JSON lines with rejected rows kept, session logs, run folders, tables by suffix."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value), numbered from 1 within each file.

    Files are read in splits: a row's place within its split comes from its id, and the splits'
    numbers of lines, one row a split, give what comes before. No file is read by one task."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_id"), "value")
    splits = rows.groupBy("path", "_b").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return rows.join(splits, ["path", "_b"]).select("path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value")


def divert_json(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the parsed object as ``v``, rejected lines with a reason); blank lines are neither."""
    parsed = lines.where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    reason = F.when(F.col("v").isNull(), "invalid_json").when(~F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), "not_an_object")
    tagged = parsed.withColumn("reason", reason)
    return tagged.where("reason is null").drop("reason", "value"), tagged.where("reason is not null").select("path", "line_no", "reason")


def read_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return divert_json(numbered_lines(spark, path))


def read_jsonl_strict(spark: SparkSession, path: str) -> DataFrame:
    """Any bad line is an error that names its file and number."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    fine = F.col("v").isNotNull() & F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
    return lines.where(F.assert_true(F.coalesce(fine, F.lit(False)), F.concat_ws(":", "path", F.col("line_no").cast("string"))).isNull()).drop("value")


def read_jsonl_objects(spark: SparkSession, path: str) -> DataFrame:
    """Bad JSON is an error; values that aren't objects are left out."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("v", F.parse_json("value"))
    return lines.where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))).drop("value")


def read_jsonl_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a schema; a missing file is an empty table, a malformed row an error when it is read."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def split_slice(path: str) -> tuple[str, int | None, int | None]:
    """``path@[start:end]`` -> (path, start, end); negative places are not supported."""
    m = re.fullmatch(r"(.*)@\[(-?\d*):(-?\d*)\]", path)
    if not m:
        return path, None, None
    start, end = (int(x) if x else None for x in m.groups()[1:])
    if (start or 0) < 0 or (end or 0) < 0:
        raise ValueError(f"negative place in {path}")
    return m[1], start, end


def read_table(spark: SparkSession, path: str, schema: str | None = None, order: str | None = None) -> DataFrame:
    """A .jsonl or .parquet file, optionally a slice of its rows in an order."""
    base, start, end = split_slice(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if base.endswith(".jsonl"):
        rows = reader.option("mode", "DROPMALFORMED").json(base)
    elif base.endswith(".parquet"):
        rows = reader.parquet(base)
    else:
        raise ValueError(f"unknown suffix: {base}")
    if start is None and end is None:
        return rows
    rows = rows.orderBy(order) if order else rows
    return rows.offset(start or 0) if end is None else rows.offset(start or 0).limit(max(0, end - (start or 0)))


def session_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events with line numbers, per file: malformed lines and whether the last line is the runner's error)."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    events, _ = divert_json(lines)
    bad = F.try_parse_json("value").isNull()
    summary = lines.groupBy("path").agg(F.count_if(bad).alias("malformed"), F.startswith(F.max_by(F.trim("value"), "line_no"), F.lit("[runner-error]")).alias("runner_error"))
    return events, summary


def run_dirs(spark: SparkSession, root: str, marker: str = "run_config.json") -> DataFrame:
    """Folders that hold a marker file, at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", marker).load(root)
    return files.select(F.regexp_replace("path", "/[^/]+$", "").alias("run_dir")).distinct()


def rollout_key(path: Column) -> Column:
    """struct(row_number, dataset_index, rollout_index) from ``rowN_idxM/rolloutK`` in a path; no rollout part is 0."""
    number = lambda pattern: F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).cast("int")
    return F.struct(number(r"/row(\d+)_idx").alias("row_number"), number(r"/row\d+_idx(\d+)").alias("dataset_index"), F.coalesce(number(r"/rollout(\d+)"), F.lit(0)).alias("rollout_index"))


def rollout_samples(spark: SparkSession, run_dir: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(run_dir)
    rows = files.select(F.regexp_extract("path", r"^(.*/row\d+_idx\d+(?:/rollout\d+)?)/", 1).alias("sample_dir")).where("sample_dir <> ''").distinct()
    return rows.withColumn("k", rollout_key(F.concat("sample_dir", F.lit("/")))).select("sample_dir", "k.*")


def json_or_empty(value: Column) -> Column:
    return F.coalesce(F.try_parse_json(value), F.parse_json(F.lit("{}")))


def records(spark: SparkSession, path: str) -> DataFrame:
    """.json documents and .jsonl rows of a folder as (name, v); a row's name is ``stem__NNNNNN.jsonl``."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    docs = reader.text(path, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), "value")
    lines = numbered_lines(spark, f"{path}/*.jsonl").where(F.trim("value") != "")
    stem = F.regexp_extract("path", r"([^/]+)\.jsonl$", 1)
    rows = lines.select(F.format_string("%s__%06d.jsonl", stem, "line_no").alias("name"), "value")
    return docs.unionByName(rows).select("name", F.parse_json("value").alias("v"))


def csv_mapped(spark: SparkSession, path: str, mapping: dict[str, list[str]], sep: str = ",") -> DataFrame:
    """A CSV's columns under the names of a mapping, the first one not blank of each; a BOM is no part of a name."""
    raw = spark.read.csv(path, header=True, multiLine=True, sep=sep, escape='"')
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    blank = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
    return raw.select(*[F.coalesce(*([blank(c) for c in sources if c in raw.columns] or [F.lit(None).cast("string")])).alias(name) for name, sources in mapping.items()])


def clean_numeric(df: DataFrame, required: list[str], numeric: list[str], key: list[str]) -> DataFrame:
    """Numbers where they parse, rows without a required value left out, one row a key."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    out = df.withColumns({c: F.col(c).try_cast("double") for c in numeric})
    return out.na.drop(subset=required).dropDuplicates(key)


def inverted_limits(limits: DataFrame, expected: int | None = None) -> DataFrame:
    """(limit, tools[]) as (tool, limit); a tool under two limits, or another number of tools than expected, is an error."""
    rows = limits.select("limit", F.explode("tools").alias("tool"))
    counts = rows.agg(F.count("*").alias("n"), F.count_distinct("tool").alias("d")).first()
    if counts["n"] != counts["d"] or (expected is not None and counts["n"] != expected):
        raise ValueError(f"{counts['n']} limits for {counts['d']} tools")
    return rows.select("tool", "limit")


def decision_edges(decisions: DataFrame, kind: str | None = None) -> DataFrame:
    """A row an edge type of each decision."""
    rows = decisions.select("*", F.explode("edge_types").alias("edge_type")).drop("edge_types")
    return rows if kind is None else rows.where(F.col("edge_type") == kind)


# --- knowledge base imports: dimensions are first-wins, facts are capped ---


def import_sequences(rows: DataFrame, key: str, sequence: str, order: str, least: int = 40) -> DataFrame:
    """Rows with a sequence long enough, the first of each key."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.where(F.char_length(sequence) >= least).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def split_ids(value: Column, by: str = ";") -> Column:
    return F.filter(F.transform(F.split(value, by), lambda x: F.trim(x)), lambda x: x != "")


def first_activity(row: list[tuple[str, str]], most: float = 1e9) -> Column:
    """struct(type, value) of the first column holding a number from 0 to ``most``; relation signs are dropped."""
    each = []
    for kind, column in row:
        v = F.regexp_extract(F.coalesce(F.col(f"`{column}`"), F.lit("")), r"([0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)", 1).try_cast("double")
        each.append(F.when(v.between(0, most), F.struct(F.lit(kind).alias("type"), v.alias("value"))))
    return F.coalesce(*each)


def import_pairs(facts: DataFrame, targets: DataFrame, compounds: DataFrame, target: str, compound: str, order: list[str], most: int) -> DataFrame:
    """Facts whose both ends are known, the first ``most`` in an order."""
    rows = facts.join(targets.select(target).distinct(), target, "left_semi").join(compounds.select(compound).distinct(), compound, "left_semi")
    return rows.orderBy(*order).limit(most)
