"""Releases of training data: prompts, schemas with paths, protocol parts, registries, pair rows, cursors."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtrace.operators.curation import blocks

# --- tools and prompts ---


def tool_class(raw: Column, prefix: str, local: tuple[str, ...], only_domain: Column, refused: Column) -> Column:
    """struct(name, kind, reason) of a call: a domain tool by its prefix, else a local one unless only domain
    tools count or its arguments are refused (``refused`` is null for fine ones)."""
    bare = F.trim(F.substring(raw, len(prefix) + 1, 1 << 30))
    domain = F.startswith(raw, F.lit(prefix)) & (bare != "")
    reason = F.when(domain, None).when(~raw.isin(*local), "unsupported_tool").when(only_domain, "only_domain_tools").otherwise(refused)
    kind = F.when(domain, "domain").when(reason.isNull(), "local")
    return F.struct(F.when(domain, bare).when(reason.isNull(), raw).alias("name"), kind.alias("kind"), reason.alias("reason"))


def within_tokens(rows: DataFrame, text: str, most: int, count: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows of at most ``most`` tokens, by words if no counter is given."""
    length = count(F.col(text)) if count else F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))
    return rows.where(length <= most)


def prose_findings(messages: DataFrame, key: str, order: str, text: str, rules: dict[str, str]) -> DataFrame:
    """(key, order, place, reasons): assistant thoughts that hold a rule's pattern, with its code; others are absent."""
    thoughts = F.transform(F.filter(blocks(F.col(text)), lambda b: b["kind"] == "thought"), lambda b: b["body"])
    rows = messages.where("role = 'assistant'").select(key, order, F.posexplode(thoughts).alias("place", "_t"))
    reasons = F.array_compact(F.array(*[F.when(F.col("_t").rlike(p), code) for code, p in rules.items()]))
    return rows.select(key, order, "place", reasons.alias("reasons")).where(F.size("reasons") > 0)


def placed_media(text: Column, media: dict[str, Column]) -> Column:
    """A prompt's parts in order, array of struct(type, value): text between placeholders such as <image>,
    and in place of the n-th placeholder of a kind the n-th of its list."""
    names = "|".join(media)
    marks = F.regexp_extract_all(text, F.lit(f"<({names})>"), F.lit(1))
    between = F.split(text, f"<(?:{names})>", -1)
    part = lambda kind, value: F.struct(kind.alias("type"), value.alias("value"))

    def at(i: Column) -> Column:
        kind = F.get(marks, i)
        nth = F.size(F.filter(F.slice(marks, F.lit(1), i), lambda m: m == kind))
        return part(kind, F.coalesce(*[F.when(kind == n, F.get(c, nth)) for n, c in media.items()]))

    both = F.transform(between, lambda t, i: F.array(part(F.lit("text"), t), F.when(i < F.size(marks), at(i))))
    return F.filter(F.flatten(both), lambda p: p.isNotNull() & ((p["type"] != "text") | (p["value"] != "")))


def canonical_task(rows: DataFrame, run: str) -> DataFrame:
    """A task's row under its canonical names: id, type, nodes, start and end tool, hops, run. Rows have
    sample_id, id, task_type and nodes (array)."""
    none = F.array().cast("array<string>")
    nodes = F.coalesce("nodes", none)
    return rows.select(
        F.coalesce("sample_id", "id", F.lit("")).alias("id"), F.coalesce("task_type", F.lit("toolchain_derived")).alias("task_type"), nodes.alias("nodes"),
        F.get(nodes, 0).alias("start_tool"), F.get(nodes, F.size(nodes) - 1).alias("end_tool"), F.greatest(F.lit(0), F.size(nodes) - 1).alias("hops"), F.lit(run).alias("run_id"),
    )


# --- schemas ---


def schema_findings(value: Column, schema: dict) -> Column:
    """What breaks a JSON schema, as a sorted array of "path: code". The schema is compiled to one
    expression; it may use type, properties, required, additionalProperties, items, enum, minimum,
    maximum and minLength. Text that is not JSON breaks the root."""
    return F.array_sort(F.array_distinct(_findings(F.try_parse_json(value), schema, F.lit("$"))))


_TYPES = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN"}


def _findings(v: Column, schema: dict, path: Column) -> Column:
    code = lambda condition, name: F.when(condition, F.concat(path, F.lit(f": {name}")))
    kind = F.schema_of_variant(v)
    number = kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|SMALLINT|TINYINT)")
    wanted = schema.get("type")
    fits = {"integer": kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT)"), "number": number, "null": kind == "VOID"}.get(wanted)
    if fits is None:
        fits = F.startswith(kind, F.lit(_TYPES[wanted])) if wanted else F.lit(True)
    fits = F.coalesce(fits, F.lit(False))
    text, real = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    own = [code(~fits, "type")]
    if "enum" in schema:
        own.append(code(fits & ~F.coalesce(text.isin(*map(str, schema["enum"])), F.lit(False)), "enum"))
    for key, test in (("minimum", lambda x: real < x), ("maximum", lambda x: real > x), ("minLength", lambda x: F.char_length(text) < x)):
        if key in schema:
            own.append(code(fits & F.coalesce(test(schema[key]), F.lit(False)), key))
    lists = [F.array_compact(F.array(*own))]
    nothing = F.array().cast("array<string>")
    parts = schema.get("properties", {})
    members = F.try_variant_get(v, "$", "map<string,variant>")
    inner = lambda f: F.when(fits, f).otherwise(nothing)
    if wanted == "object":
        lists.append(inner(F.array_compact(F.array(*[code(~F.map_contains_key(members, F.lit(k)), f"required {k}") for k in schema.get("required", [])]).cast("array<string>"))))
        if schema.get("additionalProperties") is False:
            extra = F.filter(F.map_keys(members), lambda k: ~k.isin(*parts) if parts else F.lit(True))
            lists.append(inner(F.transform(extra, lambda k: F.concat(path, F.lit("."), k, F.lit(": additional")))))
        for name, sub in parts.items():
            below = _findings(F.try_variant_get(v, f"$.{name}", "variant"), sub, F.concat(path, F.lit(f".{name}")))
            lists.append(inner(F.when(F.map_contains_key(members, F.lit(name)), below).otherwise(nothing)))
    if wanted == "array" and "items" in schema:
        items = F.try_variant_get(v, "$", "array<variant>")
        lists.append(inner(F.flatten(F.transform(items, lambda x, i: _findings(x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))))
    return F.concat(*[F.coalesce(x, nothing) for x in lists])


# --- protocol ---


def protocol_parts(messages: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Per key: calls, observations and finals whose payload is a JSON object, as arrays in order, and codes
    of malformed ones. Assistants make calls and finals, users observations."""
    rows = messages.select(key, order, "role", F.posexplode(blocks(F.col(text))).alias("_p", "b")).select(key, order, "role", "_p", "b.*")
    own = ((F.col("role") == "assistant") & F.col("kind").isin("tool_call", "final_answer")) | ((F.col("role") == "user") & (F.col("kind") == "observation"))
    rows = rows.where(own).withColumn("_ok", F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json("body")), F.lit("OBJECT")), F.lit(False)))
    ordered = F.array_sort(F.collect_list(F.struct(order, "_p", "kind", "tool_name", "body", "_ok")))
    got = rows.groupBy(key).agg(ordered.alias("_all"))
    pick = lambda kind: F.transform(F.filter("_all", lambda x: (x["kind"] == kind) & x["_ok"]), lambda x: x["body"])
    bad = F.transform(F.filter("_all", lambda x: ~x["_ok"]), lambda x: F.concat_ws("_", F.lit("message"), x[order].cast("string"), x["kind"], F.lit("json_invalid")))
    made = got.select(key, pick("tool_call").alias("calls"), pick("observation").alias("observations"), pick("final_answer").alias("finals"), bad.alias("malformed"))
    none = F.array().cast("array<string>")
    return messages.select(key).distinct().join(made, key, "left").select(key, *[F.coalesce(c, none).alias(c) for c in ("calls", "observations", "finals", "malformed")])


def nested_values(name: str):
    """A function of JSON texts: all values of a key at any depth, parents before children, as JSON."""

    def walk(v):
        for k, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
            if k == name:
                yield json.dumps(x, ensure_ascii=False, sort_keys=True)
            yield from walk(x)

    def one(t: str | None) -> list[str]:
        try:
            return list(walk(json.loads(t or "null")))
        except ValueError:
            return []

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def values(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return values


# --- registries, facts, attempts ---


def registered(uses: DataFrame, key: str, order: str, path: str, prefix: str = "artifact") -> DataFrame:
    """Uses of paths with a logical id per key and path, numbered from 1 by first use: a dictionary encoding.
    The dictionary is aggregated first, so a path of many uses is one row of it."""
    first = uses.groupBy(key, path).agg(F.min(order).alias("_first"))
    ids = first.withColumn("logical_id", F.concat_ws("_", F.lit(prefix), F.row_number().over(Window.partitionBy(key).orderBy("_first", path))))
    return uses.join(ids.drop("_first"), [key, path])


def grounding_facts(seed: DataFrame, found: DataFrame, key: str, record: str, order: str, k: int) -> DataFrame:
    """Per key at most ``k`` facts: seeds before found ones, each record once, by ``order``."""
    both = seed.withColumn("_p", F.lit(0)).unionByName(found.withColumn("_p", F.lit(1)))
    once = both.groupBy(key, record).agg(F.min_by(F.struct(*[c for c in both.columns if c not in (key, record)]), F.struct("_p", order)).alias("_r")).select(key, record, "_r.*")
    w = Window.partitionBy(key).orderBy("_p", order, record)
    return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("_p")


def attempts(tries: DataFrame, order: str, failure: str, wanted: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(successes, failures): the first ``wanted`` successful tries among the first ``most``, and the number
    of each failure among tries up to the last of those. Two top-Ns; no more than ``most`` rows are ordered."""
    tried = tries.orderBy(order).limit(most)
    good = tried.where(F.col(failure).isNull()).orderBy(order).limit(wanted)
    last = good.agg(F.when(F.count("*") >= wanted, F.max(order)).alias("_last"))
    bad = tried.where(F.col(failure).isNotNull()).withColumn("_1", F.lit(1)).join(F.broadcast(last.withColumn("_1", F.lit(1))), "_1")
    return good, bad.where(F.col("_last").isNull() | (F.col(order) < F.col("_last"))).groupBy(failure).agg(F.count("*").alias("n"))


def first_present(*shapes: Column) -> Column:
    """The first of several arrays that isn't null or empty, else an empty one."""
    return F.coalesce(*[F.when(F.size(s) > 0, s) for s in shapes], F.array().cast("array<string>"))


def current_arguments(arguments: Column, renames: dict[str, str], lists: tuple[str, ...] = (), dropped: tuple[str, ...] = ()) -> Column:
    """A map of arguments under current keys: renamed unless the new key is there too, compatibility keys
    dropped, and values of list keys made JSON lists."""
    new = lambda k: F.coalesce(*[F.when(k == a, b) for a, b in renames.items()], k)
    kept = F.map_filter(arguments, lambda k, _: ~(k.isin(*dropped) if dropped else F.lit(False)) & ((new(k) == k) | ~F.map_contains_key(arguments, new(k))))
    listed = lambda k, v: F.when((k.isin(*lists) if lists else F.lit(False)) & ~F.startswith(F.trim(v), F.lit("[")), F.to_json(F.array(v))).otherwise(v)
    return F.map_from_entries(F.transform(F.map_entries(kept), lambda e: F.struct(new(e["key"]), listed(new(e["key"]), e["value"]))))


def task_document(columns: list[str], version: str) -> Column:
    """A row as a nested task document in JSON; nulls are left out."""
    return F.to_json(F.struct(F.lit(version).alias("schema_version"), *columns))


# --- rows for training ---


def pair_rows(decisions: DataFrame, key: list[str], prompt: str, teacher: str, student: DataFrame, response: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, skipped): a decision's prompt with the teacher's and a student's response, one a response of
    the student, and keys that lack one or whose teacher's text is blank, with the reason."""
    rows = decisions.join(student.select(*key, response), key, "left")
    reason = F.when(F.trim(F.coalesce(teacher, F.lit(""))) == "", "blank_teacher").when(F.col(response).isNull(), "no_response").when(F.col(response) == F.col(teacher), "same_response")
    judged = rows.withColumn("reason", reason)
    return judged.where("reason is null").select(*key, prompt, F.col(teacher).alias("chosen"), F.col(response).alias("rejected")), judged.where("reason is not null").select(*key, "reason")


def release_problems(rows: DataFrame, key: str, checks: dict[str, Column], stored: DataFrame | None = None) -> DataFrame:
    """(problem, n): keys that are repeated, rows that break a check, and rows more or fewer than stored."""
    repeated = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").agg(F.count("*").alias("n")).select(F.lit("repeated_key").alias("problem"), "n")
    sums = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()], F.count("*").alias("_rows"))
    broken = sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("problem"), F.col(k).alias("n")) for k in checks])).alias("x")).select("x.*")
    out = repeated.unionByName(broken)
    if stored is not None:
        both = sums.select("_rows", F.lit(1).alias("_1")).join(stored.select(F.col("rows").alias("_s"), F.lit(1).alias("_1")), "_1")
        out = out.unionByName(both.select(F.lit("stored_count").alias("problem"), F.abs(F.col("_rows") - F.col("_s")).alias("n")))
    return out.where("n > 0")


def saved_results(tasks: DataFrame, results: DataFrame, key: str, suite: str) -> DataFrame:
    """Per suite: tasks, completed, failed and missing, and the rate of all tasks that succeeded."""
    rows = tasks.join(results.select(key, "status", "score"), key, "left")
    done = F.col("status") == "completed"
    return rows.groupBy(suite).agg(
        F.count("*").alias("tasks"), F.count_if(done).alias("completed"), F.count_if(F.col("status").isNotNull() & ~done).alias("failed"),
        F.count_if(F.col("status").isNull()).alias("missing"), (F.sum(F.when(done, F.col("score")).otherwise(0.0)) / F.count("*")).alias("score"),
    )


def timelines(events: DataFrame, sample: str, start: str, end: str) -> DataFrame:
    """Each sample's first and last time and spans, beside those of all (sample null), in one pass."""
    return events.groupingSets([[F.col(sample)], []], F.col(sample)).agg(F.min(start).alias("begin"), F.max(end).alias("end"), F.count("*").alias("spans"))


def span_events(spans: DataFrame, keys: list[str], start: str, end: str, error: str) -> DataFrame:
    """The start and end events of spans; an end carries the span's error."""
    made = F.array(F.struct(F.lit("span_start").alias("type"), F.col(start).alias("ts"), F.lit(None).cast("string").alias("error")), F.struct(F.lit("span_end").alias("type"), F.col(end).alias("ts"), F.col(error).cast("string").alias("error")))
    return spans.select(*keys, F.explode(made).alias("e")).select(*keys, "e.*").where("ts is not null")


def gap_cases(ranked: DataFrame, query: str, candidate: str, score: str, band: tuple[float, float] = (0.20, 0.98), gap: float = 0.02) -> DataFrame:
    """(query, best, margin, difficulty): queries whose best candidate is within a band and ahead of the second
    by more than a gap, the harder the smaller the margin."""
    top = F.slice(F.sort_array(F.collect_list(F.struct(score, F.col(candidate))), asc=False), 1, 2)
    rows = ranked.where(F.col(score).between(*band)).groupBy(query).agg(top.alias("t")).where(F.size("t") == 2)
    margin = F.get("t", 0)[score] - F.get("t", 1)[score]
    difficulty = F.when(margin > 0.2, "easy").when(margin > 0.08, "medium").otherwise("hard")
    return rows.select(query, F.get("t", 0)[candidate].alias("best"), margin.alias("margin"), difficulty.alias("difficulty")).where(F.col("margin") > gap)


# --- cursors, queues, providers, services ---


def save_cursor(spark: SparkSession, path: str, offset: int, epoch: int, step: int) -> None:
    """Adds the state of a data source after a step; earlier ones stay, so that a run resumes at any step."""
    spark.createDataFrame([(step, offset, epoch)], "step long, sample_offset long, epoch_id long").write.mode("append").parquet(path)


def load_cursor(spark: SparkSession, path: str, step: int | None = None) -> tuple[int, int] | None:
    """(offset, epoch) as saved last, or last at or before a step; None without one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    rows = spark.read.schema("step long, sample_offset long, epoch_id long").parquet(path)
    rows = rows if step is None else rows.where(F.col("step") <= step)
    last = rows.agg(F.max_by(F.struct("sample_offset", "epoch_id"), "step").alias("s")).first()["s"]
    return None if last is None else (last["sample_offset"], last["epoch_id"])


def drained(groups: DataFrame, taken: DataFrame, key: str, finished: str, now) -> DataFrame:
    """Groups finished by ``now`` that were not taken before, in order of finishing: what a completion queue gives."""
    return groups.where(F.col(finished) <= now).join(taken.select(key), key, "left_anti").orderBy(finished, key)


def provided_patches(records: DataFrame, provider: Callable[[DataFrame], DataFrame], key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(patches, fallbacks): what a provider of patches returns for records, and records it leaves out,
    repeats or returns blank, which keep their text."""
    made = provider(records).select(key, *columns)
    fine = made.groupBy(key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in columns])
    blank = F.lit(False)
    for c in columns:
        blank = blank | (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "")
    good = fine.where((F.col("_n") == 1) & ~blank).drop("_n").join(records.select(key), key, "left_semi")
    return good, records.join(good.select(key), key, "left_anti")


def serve(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "kb_") -> list[str]:
    """Registers tables as views that SQL can query by name, and returns the names."""
    for name, t in tables.items():
        t.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in tables]
