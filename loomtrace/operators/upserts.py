"""Keyed merges, uniqueness, set operations over tables, decontamination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key; rows with a null or blank key are left out. One aggregation, no sort."""
    rows = df.where(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "")
    return rows.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def first_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; rows with a null key all stay."""
    known = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")
    return known.unionByName(df.where(F.col(key).isNull()))


def upsert(existing: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``existing`` overridden by ``updates`` key by key."""
    both = existing.withColumn("_p", F.lit(0)).unionByName(updates.withColumn("_p", F.lit(1)))
    return latest_by_key(both, key, ["_p", *order]).drop("_p")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that break uniqueness: (key, n) with n over 1, or blank ones."""
    blank = F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == ""
    return df.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | blank)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    bad = duplicate_keys(df, key)
    if not bad.isEmpty():
        raise ValueError(f"{key} is not unique: {bad.first()}")
    return df


def require_disjoint(tables: list[DataFrame], keys: dict[str, Column]) -> DataFrame:
    """The union of tables none of whose keys (name -> expression) occur in two of them."""
    for name, expression in keys.items():
        tagged = [t.select(expression.alias("k")).distinct().withColumn("_t", F.lit(i)) for i, t in enumerate(tables)]
        both = tagged[0]
        for t in tagged[1:]:
            both = both.unionByName(t)
        if not both.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"tables overlap in {name}")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def tagged_union(tables: dict[str, DataFrame], tag: str = "kind") -> DataFrame:
    """All rows with their table's name; columns that a table lacks are null."""
    out = None
    for name, t in tables.items():
        t = t.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def decontaminate(rows: DataFrame, held_out: DataFrame, key_of) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded): rows whose key, such as a prompt hash, no held-out row has, and the others."""
    known = held_out.select(key_of(held_out).alias("_key")).distinct()
    keyed = rows.withColumn("_key", key_of(rows))
    return keyed.join(known, "_key", "left_anti").drop("_key"), keyed.join(known, "_key", "left_semi").drop("_key")


def audit_counts(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys not consumed exactly once: (key, expected, actual, problem)."""
    e, a = expected.groupBy(key).agg(F.count("*").alias("expected")), actual.groupBy(key).agg(F.count("*").alias("actual"))
    both = e.join(a, key, "full_outer").na.fill(0, ["expected", "actual"])
    problem = F.when(F.col("expected") == 0, "unexpected").when(F.col("actual") == 0, "omitted").when(F.col("actual") != 1, "non_unit")
    return both.withColumn("problem", problem).where("problem is not null")


def changed_facts(before: DataFrame, after: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """Per key: whether any fact changed, nulls equal, and which."""
    rows = before.alias("b").join(after.alias("a"), key)
    return rows.select(key, F.array_compact(F.array(*[F.when(~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), F.lit(f)) for f in facts])).alias("changed"))


def patch(segments: DataFrame, patches: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Segments with keep, replace or delete applied by key: patches have action and ``new_text``.
    A patch of a key that isn't there reverts its whole record, as does a repeated one."""
    counted = patches.groupBy(*keys).agg(F.count("*").alias("_n"), F.first("action").alias("action"), F.first("new_text").alias("new_text"))
    bad = counted.join(segments.select(*keys).distinct().withColumn("_here", F.lit(True)), keys, "left").where("_n > 1 or _here is null").select(keys[0]).distinct()
    good = counted.join(bad, keys[0], "left_anti").drop("_n")
    rows = segments.join(good, keys, "left").where(F.coalesce(F.col("action") != "delete", F.lit(True)))
    return rows.withColumn(text, F.when(F.col("action") == "replace", F.col("new_text")).otherwise(F.col(text))).drop("action", "new_text")


def reassemble(segments: DataFrame, keys: list[str], order: str, text: str = "text", by: str = "") -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return segments.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p[text]), by).alias(text))


def newest(df: DataFrame, keep: int, order: str) -> DataFrame:
    """The newest versions; the sort is a top-N."""
    return df.orderBy(F.col(order).desc()).limit(keep)


def positional_join(left: DataFrame, right: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of two tables by place within each key; a place on one side only has nulls for the other."""
    w = Window.partitionBy(*key).orderBy(order)
    a = left.withColumn("_i", F.row_number().over(w))
    b = right.withColumn("_i", F.row_number().over(w)).select(*key, "_i", *[F.col(c).alias(f"right_{c}") for c in right.columns if c not in key])
    return a.join(b, [*key, "_i"], "full_outer").withColumnRenamed("_i", "place")
