"""Tool graphs: candidate pairs under a taxonomy, edge tables, simple paths, span depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.functions.lineage import cut
from loomtrace.functions.names import jitter


def candidate_pairs(stages: DataFrame, allowed: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """Ordered pairs of tools with an allowed stage transition, by equi-joins on the stages; the
    complement is never built. ``stages`` is (tool, stage), ``allowed`` (source_stage,
    target_stage), ``clusters`` (tool, cluster) of alternatives."""
    a = stages.select(F.col("tool").alias("source"), F.col("stage").alias("source_stage"))
    b = stages.select(F.col("tool").alias("target"), F.col("stage").alias("target_stage"))
    pairs = a.join(allowed, "source_stage").join(b, "target_stage").where("source <> target")
    supports = F.array_sort(F.collect_set(F.concat_ws(">", "source_stage", "target_stage")))
    out = pairs.groupBy("source", "target").agg(supports.alias("supports"))
    if clusters is None:
        return out
    return out.join(alternatives(clusters).withColumn("alternative", F.lit(True)), ["source", "target"], "left").na.fill(False, ["alternative"])


def alternatives(clusters: DataFrame) -> DataFrame:
    """All ordered pairs within each cluster."""
    a = clusters.select(F.col("tool").alias("source"), "cluster")
    return a.join(clusters.select(F.col("tool").alias("target"), "cluster"), "cluster").where("source <> target").select("source", "target").distinct()


def edge_rows(decisions: DataFrame) -> DataFrame:
    """Valid and eligible decisions as one row an edge type, with a two-digit ordinal from 1."""
    rows = decisions.where("valid and eligible").select("*", F.posexplode("edge_types").alias("_i", "edge_type"))
    return rows.withColumn("edge_id", F.concat_ws("::", "source", "target", F.lpad((F.col("_i") + 1).cast("string"), 2, "0"))).drop("_i", "edge_types")


def edge_pool(edges: DataFrame, catalog: DataFrame, tool: str = "tool") -> DataFrame:
    """Edges without self-loops whose ends are both in the catalog."""
    known = catalog.select(F.col(tool).alias("_t")).distinct()
    rows = edges.where("source <> target")
    return rows.join(known, rows["source"] == known["_t"], "left_semi").join(known, rows["target"] == known["_t"], "left_semi")


def simple_paths(edges: DataFrame, hops: int) -> DataFrame:
    """All simple paths of exactly ``hops`` edges, as arrays; one join a hop."""
    e = edges.select("source", "target").distinct()
    paths = e.select(F.array("source", "target").alias("path"))
    for _ in range(hops - 1):
        step = paths.withColumn("source", F.element_at("path", -1)).join(e, "source")
        paths = step.where(~F.array_contains("path", F.col("target"))).select(F.concat("path", F.array("target")).alias("path"))
    return paths


def sample_paths(edges: DataFrame, hops: int, n: int, seed: str) -> DataFrame:
    paths = simple_paths(edges, hops)
    key = F.array_join("path", ">")
    return paths.orderBy(jitter(seed, key), key).limit(n)


def expected_trajectory(df: DataFrame, chain: str) -> DataFrame:
    """A chain of names as nodes ``tool::NN::name`` and the edges between them."""
    nodes = F.transform(chain, lambda x, i: F.format_string("tool::%02d::%s", i, x))
    links = F.transform(F.slice(F.col("nodes"), F.lit(1), F.greatest(F.size("nodes") - 1, F.lit(0))), lambda n, i: F.struct(n.alias("source"), F.get("nodes", i + 1).alias("target")))
    return df.withColumn("nodes", nodes).withColumn("edges", links)


def depths(spans: DataFrame, key: str, most: int = 64) -> DataFrame:
    """Depth by parent links: 0 for spans whose parent isn't in the table; spans on or under a
    cycle, or deeper than ``most``, get none. Ancestors double each round, so the rounds are the
    logarithm of the depth; each is checkpointed, so that it is one join."""
    ids = spans.select(key, "span_id", "parent_id")
    known = ids.select(key, F.col("span_id").alias("parent_id"), F.lit(1).alias("_there")).distinct()
    rows = ids.join(known, [key, "parent_id"], "left").select(key, "span_id", F.when(F.col("_there") == 1, F.col("parent_id")).alias("up"), F.coalesce("_there", F.lit(0)).alias("depth"))
    for _ in range(max(1, most.bit_length())):
        rows = cut(rows)
        above = rows.select(key, F.col("span_id").alias("up"), F.col("up").alias("_up2"), F.col("depth").alias("_more"))
        rows = rows.join(above, [key, "up"], "left").select(key, "span_id", F.col("_up2").alias("up"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"))
    return rows.where("up is null").select(key, "span_id", "depth")


def schema_slots(schemas: DataFrame, column: str, depth: int = 4) -> DataFrame:
    """JSON Schemas as slot rows (path, type, required): properties by dots, array items by [*]."""
    rows = schemas.select("*", F.lit("").alias("path"), F.parse_json(column).alias("_s"), F.lit(True).alias("required"))
    out, keep = None, [c for c in schemas.columns if c != column]
    for _ in range(depth):
        props = F.explode(F.map_entries(F.try_variant_get("_s", "$.properties", "map<string,variant>"))).alias("p")
        req = F.coalesce(F.try_variant_get("_s", "$.required", "array<string>"), F.array().cast("array<string>"))
        level = rows.select(*keep, F.col("path").alias("_p"), req.alias("_r"), props)
        path = F.when(F.col("_p") == "", F.col("p.key")).otherwise(F.concat_ws(".", "_p", "p.key"))
        kind = F.try_variant_get("p.value", "$.type", "string")
        level = level.select(*keep, path.alias("path"), kind.alias("type"), F.array_contains("_r", F.col("p.key")).alias("required"), F.col("p.value").alias("_s"))
        shown = level.select(*keep, "path", "type", "required")
        out = shown if out is None else out.unionByName(shown)
        inner = F.when(F.col("type") == "array", F.try_variant_get("_s", "$.items", "variant")).otherwise(F.col("_s"))
        rows = level.select(*keep, F.when(F.col("type") == "array", F.concat("path", F.lit("[*]"))).otherwise(F.col("path")).alias("path"), inner.alias("_s")).where("_s is not null")
    return out
