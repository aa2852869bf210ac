"""Episodes: counters over actions and observations, summaries by batch, sequence audits, releases
and their checks, spans, grounding. Tables in, tables out; nothing is collected."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _any(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# --- counters ---


def tool_stats(results: DataFrame, key: str) -> DataFrame:
    """Per key: how tool results ended. ``results`` has schema_ok, transport_ok, executed, meant and
    unknown (booleans). A result that fails its schema is not counted further, nor one that never
    arrived; both are semantic errors."""
    schema_ok, arrived = F.col("schema_ok"), F.col("schema_ok") & F.col("transport_ok")
    return results.groupBy(key).agg(
        F.count("*").alias("total"), F.count_if(~schema_ok).alias("schema_fail"), F.count_if(schema_ok & ~F.col("transport_ok")).alias("transport_error"),
        F.count_if(arrived).alias("attempts"), F.count_if(arrived & F.col("executed")).alias("executed"), F.count_if(arrived & F.col("meant")).alias("semantic_success"),
        F.count_if(~(arrived & F.col("meant"))).alias("semantic_error"), F.count_if(arrived & F.col("unknown")).alias("semantic_unknown"),
    )


def action_stats(actions: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """Per key: steps, valid, recovered and invalid actions. ``actions`` has parsed_ok and recovered;
    ``declared`` has a row a key with num_steps, strict_valid, recovered_valid and num_invalid.
    Declared counters of valid actions win over counted ones; steps are the larger of both, and
    what a declaration leaves open is invalid."""
    ok, again = F.col("parsed_ok"), F.col("recovered")
    counted = actions.groupBy(key).agg(F.count("*").alias("_n"), F.count_if(ok & ~again).alias("_s"), F.count_if(ok & again).alias("_r"))
    rows = declared.join(counted, key, "left").na.fill(0)
    told = (F.col("strict_valid") + F.col("recovered_valid") > 0) | (F.col("_n") == 0)
    strict, back = F.when(told, F.col("strict_valid")).otherwise(F.col("_s")), F.when(told, F.col("recovered_valid")).otherwise(F.col("_r"))
    steps = F.greatest("num_steps", "_n", strict + back)
    invalid = F.when(told, F.when(F.col("num_invalid") > 0, F.col("num_invalid")).otherwise(F.greatest("num_steps", "_n") - strict - back)).otherwise(F.col("num_invalid") + F.col("_n") - F.col("_s") - F.col("_r"))
    return rows.select(key, steps.alias("steps"), strict.alias("strict_valid"), back.alias("recovered_valid"), (strict + back).alias("valid"), F.greatest(F.lit(0), invalid).alias("invalid"))


def throughput(samples: DataFrame, seconds: float, workers: int, length: str, idle: str) -> DataFrame:
    """One row: tokens a worker and second, and of the longest samples their tokens a second, with
    and without the mean time that they were idle."""
    top = samples.agg(F.max(length).alias("_top"), F.sum(length).alias("_all"))
    rows = samples.groupBy(F.col(length).alias("_len")).agg(F.avg(idle).alias("_idle"))
    longest = rows.groupBy().agg(F.max_by(F.struct("_len", "_idle"), "_len").alias("m"))
    per = top.select((F.col("_all") / seconds / workers).alias("tokens_per_worker_second"), (F.col("_top") / seconds).alias("longest_tokens_per_second"), F.lit(1).alias("_1"))
    idle_of = longest.select(F.col("m._idle").alias("longest_idle"), (F.col("m._len") / (F.lit(seconds) - F.col("m._idle"))).alias("longest_tokens_per_busy_second"), F.lit(1).alias("_1"))
    return per.join(idle_of, "_1").drop("_1")


def mask_sums(samples: DataFrame, group: str, mask: str) -> DataFrame:
    """Every sample with the sum of its group's loss masks, as its loss is divided by it. The sums are
    aggregated first, so a group of any size is one row where they are joined."""
    own = F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + x)
    rows = samples.withColumn("mask_sum", own)
    return rows.join(rows.groupBy(group).agg(F.sum("mask_sum").alias("group_mask_sum")), group)


def weighted_mean(value: Column, weight: Column) -> Column:
    """An aggregate that partial results of any split combine to: sum and count, not a mean of means."""
    return F.sum(value * weight) / F.nullif(F.sum(weight), F.lit(0))


def by_batch(records: DataFrame, batch: str, measures: dict[str, Column]) -> DataFrame:
    """Measures of all records (batch null) and of each batch, in one pass."""
    sets = records.groupingSets([[F.col(batch)], []], F.col(batch)).agg(F.grouping(F.col(batch)).alias("overall"), *[c.alias(k) for k, c in measures.items()])
    return sets


def set_similarity_within(records: DataFrame, group: str, items: str) -> DataFrame:
    """(group, records, pairs, mean_jaccard) over unordered pairs of records of a group. Equal sets are
    one row with a count, so that copies cost nothing."""
    sets = records.groupBy(group, F.array_sort(F.array_distinct(items)).alias("s")).agg(F.count("*").alias("c"))
    a, b = sets.select(group, F.col("s").alias("x"), F.col("c").alias("m")), sets.select(group, F.col("s").alias("y"), F.col("c").alias("n"))
    union = F.size(F.array_union("x", "y"))
    likeness = F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect("x", "y")) / union)
    apart = a.join(b, group).where("x < y").groupBy(group).agg(F.sum(F.col("m") * F.col("n")).alias("p"), F.sum(F.col("m") * F.col("n") * likeness).alias("s"))
    alike = sets.groupBy(group).agg(F.sum("c").alias("records"), F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("q"))
    rows = alike.join(apart, group, "left").na.fill(0, ["p", "s"])
    pairs = F.col("p") + F.col("q")
    return rows.select(group, "records", pairs.cast("long").alias("pairs"), F.when(pairs > 0, (F.col("s") + F.col("q")) / pairs).alias("mean_jaccard"))


def eligible_summary(results: DataFrame, group: str, metric: str, eligible: str, reasons: str) -> DataFrame:
    """(group, samples, scored, mean, reason, n): the mean over eligible rows only, 0 without any, beside
    each reason's number over all rows (a group without reasons has one row with a null reason)."""
    ok = F.col(eligible)
    sums = results.groupBy(group).agg(F.count("*").alias("samples"), F.count_if(ok).alias("scored"), F.coalesce(F.avg(F.when(ok, F.col(metric))), F.lit(0.0)).alias("mean"))
    why = results.select(group, F.explode(reasons).alias("reason")).groupBy(group, "reason").agg(F.count("*").alias("n"))
    return sums.join(why, group, "left")


def status_totals(rows: DataFrame, status: str, flags: dict[str, Column], means: dict[str, Column]) -> DataFrame:
    """Per status: rows, how many have each flag, and means over values that are not null."""
    return rows.groupBy(status).agg(F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in flags.items()], *[F.avg(c).alias(k) for k, c in means.items()])


# --- selection ---


def rounded_quantile(value: Column, q: float) -> Column:
    """An exact quantile to two places, halves to even."""
    return F.bround(F.percentile(value, F.lit(q)), 2)


def within_limits(rows: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """Rows that meet every limit (column -> operator and threshold); null values meet none."""
    tests = {">=": lambda c, t: c >= t, "<=": lambda c, t: c <= t, ">": lambda c, t: c > t, "<": lambda c, t: c < t, "==": lambda c, t: c == t}
    return rows.where(reduce(lambda a, b: a & b, [tests[op](F.col(c), t) for c, (op, t) in limits.items()], F.lit(True)))


def first_admissible(pending: Column, active: Column) -> Column:
    """The place (from 0) of the first pending set of claims that shares none with active ones; null if none does."""
    taken = F.flatten(active)
    places = F.filter(F.transform(pending, lambda p, i: F.when(~F.arrays_overlap(p, taken) | (F.size(p) == 0), i)), lambda i: i.isNotNull())
    return F.get(places, 0)


def largest_reductions(before: DataFrame, after: DataFrame, key: str, order: str, text: str, most: int = 10) -> DataFrame:
    """(key, reduction, changed): the records whose texts shrank most, ties to smaller keys, with the
    places of their messages that changed. The choice is a top-N; only chosen records are compared."""
    size = lambda t, name: t.groupBy(key).agg(F.sum(F.char_length(text)).alias(name))
    both = size(before, "_b").join(size(after, "_a"), key).select(key, (F.col("_b") - F.col("_a")).alias("reduction"))
    top = both.orderBy(F.desc("reduction"), key).limit(most)
    pairs = before.select(key, order, F.col(text).alias("_x")).join(top, key).join(after.select(key, order, F.col(text).alias("_y")), [key, order], "left")
    changed = F.array_sort(F.collect_list(F.when(~F.col("_x").eqNullSafe(F.col("_y")), F.col(order))))
    return pairs.groupBy(key).agg(F.first("reduction").alias("reduction"), changed.alias("changed"))


def by_prefix(rows: DataFrame, key: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Rows with the columns of the longest prefix that their key begins with, null without one: an
    equality join on the key cut to each length that prefixes have."""
    lengths = prefixes.select(F.char_length(prefix).alias("_l")).distinct().agg(F.collect_set("_l").alias("_ls"))  # as few as lengths
    cut = rows.select(key).distinct().withColumn("_1", F.lit(1)).join(F.broadcast(lengths.withColumn("_1", F.lit(1))), "_1")
    cut = cut.select(key, F.explode("_ls").alias("_l")).where(F.char_length(key) >= F.col("_l")).select(key, "_l", F.col(key).substr(F.lit(1), F.col("_l")).alias(prefix))
    best = cut.join(prefixes, prefix).groupBy(key).agg(F.max_by(F.struct(*prefixes.columns), "_l").alias("_p"))
    return rows.join(best, key, "left").select(*rows.columns, *[F.col(f"_p.{c}").alias(c) for c in prefixes.columns])


def keys_missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one of the tables has; none if they are a bijection."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def differing_rows(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(key, problem): keys missing on a side, repeated, or whose columns differ (nulls equal)."""
    n = lambda t, s: t.groupBy(*key).agg(F.count("*").alias(f"_n{s}"), *[F.min(c).alias(f"_{s}_{c}") for c in columns])
    both = n(left, "l").join(n(right, "r"), key, "full_outer")
    differ = _any(*[~F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}")) for c in columns])
    problem = F.when(F.col("_nl").isNull(), "missing_left").when(F.col("_nr").isNull(), "missing_right").when((F.col("_nl") > 1) | (F.col("_nr") > 1), "repeated").when(differ, "differs")
    return both.withColumn("problem", problem).where("problem is not null").select(*key, "problem")


# --- sequences ---


def sequence_audit(messages: DataFrame, key: str, order: str) -> DataFrame:
    """Per key: (turns, calls, answered, unpaired_results, after_final, repeated_assistant).

    ``messages`` has role, kind (text, call, result or final) and name. A result answers the oldest
    open call of its name that stands before it; the pairing is first in, first out, so the n-th
    result of a name answers the n-th call if that many calls came before it. What follows a final
    answer, and assistant turns without another's in between, are counted as findings."""
    w = Window.partitionBy(key).orderBy(order)
    so_far = w.rowsBetween(Window.unboundedPreceding, -1)
    named = Window.partitionBy(key, "name").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = messages.withColumns({
        "_late": F.coalesce(F.max(F.col("kind") == "final").over(so_far), F.lit(False)),
        "_again": (F.col("role") == "assistant") & F.coalesce(F.lag("role").over(w) == "assistant", F.lit(False)),
        "_calls": F.count_if(F.col("kind") == "call").over(named), "_results": F.count_if(F.col("kind") == "result").over(named),
    })
    # open calls: a result without one is lost, so the balance of a name never falls below what is open
    balance = F.col("_calls") - F.col("_results")
    low = F.least(F.lit(0), F.min(balance).over(named))
    lost_before = F.least(F.lit(0), F.coalesce(F.min(balance).over(Window.partitionBy(key, "name").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("_lost", (F.col("kind") == "result") & (low < lost_before))
    return rows.groupBy(key).agg(
        F.count("*").alias("turns"), F.count_if(F.col("kind") == "call").alias("calls"), F.count_if((F.col("kind") == "result") & ~F.col("_lost")).alias("answered"),
        F.count_if("_lost").alias("unpaired_results"), F.count_if("_late").alias("after_final"), F.count_if("_again").alias("repeated_assistant"),
    )


PLAN = "struct<subgoals:array<struct<step:int,objective:string>>>"


def plan_problem(assistant_turns: Column, content: Column) -> Column:
    """Why a plan sample is not one assistant message of one plan block with typed steps; null if it is."""
    body = F.regexp_extract(content, r"(?s)^\s*<plan>(.*)</plan>\s*$", 1)
    parsed = F.from_json(body, PLAN)["subgoals"]
    bad = F.exists(parsed, lambda s: s.isNull() | s["step"].isNull() | (F.trim(F.coalesce(s["objective"], F.lit(""))) == ""))
    return (
        F.when(assistant_turns != 1, "not_one_assistant_turn").when(body == "", "no_plan_block").when(F.try_parse_json(body).isNull(), "invalid_json")
        .when(parsed.isNull() | (F.size(parsed) == 0), "no_subgoals").when(bad, "invalid_subgoal")
    )


def training_row_reasons(roles: Column, decision: Column, calls: Column, final: Column, allowed: Column) -> Column:
    """Sorted distinct codes of what makes a training row unusable. ``roles`` are its prompt's, ``calls``
    its target calls' names, ``final`` its target answer; with no ``allowed`` names any is."""
    unknown = F.exists(calls, lambda c: (F.size(allowed) > 0) & ~F.array_contains(allowed, c))
    known = F.coalesce(decision.isin("tool_call", "final_answer"), F.lit(False))
    checks = [
        (F.coalesce(F.size(roles), F.lit(0)) <= 0, "missing_prompt_messages"), (F.coalesce((F.size(roles) > 0) & ~F.array_contains(roles, "user"), F.lit(False)), "prompt_missing_user_turn"),
        (~known, "invalid_decision_type"), ((decision == "tool_call") & (F.coalesce(F.size(calls), F.lit(0)) <= 0), "missing_target_tool_calls"),
        ((decision == "tool_call") & unknown, "unknown_tool"), ((decision == "final_answer") & final.isNull(), "missing_target_final_answer"),
    ]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in checks]))))


def validated(rows: DataFrame, reasons: Column, key: str, most: int = 200) -> tuple[DataFrame, DataFrame]:
    """(report, errors): numbers of rows and of each code, and the first ``most`` bad rows by key."""
    judged = rows.withColumn("reasons", reasons)
    total = judged.agg(F.count("*").alias("n")).select(F.lit("total_rows").alias("code"), "n")
    bad = judged.where(F.size("reasons") > 0)
    report = total.unionByName(bad.agg(F.count("*").alias("n")).select(F.lit("invalid_rows").alias("code"), "n"))
    report = report.unionByName(bad.select(F.explode("reasons").alias("code")).groupBy("code").agg(F.count("*").alias("n")))
    return report, bad.orderBy(key).limit(most)


def segment_targets(messages: DataFrame, key: str, order: str, segments: Column) -> DataFrame:
    """(key, order, place, prefix, target): for messages of several action segments, each segment with
    the text of those before it, which is what a target's loss leaves out."""
    rows = messages.withColumn("_s", segments).where(F.size("_s") > 1)
    before = lambda i: F.array_join(F.slice("_s", F.lit(1), i), "\n")
    each = F.transform("_s", lambda t, i: F.struct(F.when(i == 0, "").otherwise(F.concat(before(i), F.lit("\n"))).alias("prefix"), t.alias("target")))
    return rows.select(key, order, F.posexplode(each).alias("place", "_t")).select(key, order, "place", "_t.prefix", "_t.target")


def editable_segments(messages: DataFrame, key: str, order: str, text: str, observation: Column, parts: Column) -> DataFrame:
    """(key, order, place, segment, previous): every editable part of assistant messages with the
    observation that came last before its message."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = messages.withColumn("previous", F.last(observation, ignorenulls=True).over(w)).where("role = 'assistant'")
    return rows.select(key, order, "previous", F.posexplode(parts).alias("place", "segment")).select(key, order, "place", "segment", "previous")


def inferred_parents(events: DataFrame, trace: str, order: str) -> DataFrame:
    """Span events (kind start, end or other; span) with the innermost span open before each as ``parent``.

    An end closes the last open span of its name, also one that is not innermost. A trace's events are
    walked in one task: they are as many as one sample's steps."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        opened, parents = [], []
        for kind, span in zip(pdf.sort_values(order)["kind"], pdf.sort_values(order)["span"], strict=True):
            parents.append(opened[-1] if opened else None)
            if kind == "start":
                opened.append(span)
            elif kind == "end" and span in opened:
                del opened[len(opened) - 1 - opened[::-1].index(span)]
        return pdf.sort_values(order).assign(parent=parents)

    return events.groupBy(trace).applyInPandas(walk, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema) + ", parent string")


# --- grounding ---


def ungrounded(claims: DataFrame, sources: DataFrame, key: str, place: str) -> DataFrame:
    """(key, place, event, problem): claims of a summary that their cited source doesn't hold.

    ``claims`` has event (its number), name and value; ``sources`` has name and text by key and place.
    A claim's tool must be one of the source's and its value occur in its text; and no event may cite
    a place before the latest of the event before it."""
    cited = sources.groupBy(key, place).agg(F.collect_set("name").alias("_names"), F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("_text"))
    rows = claims.join(cited, [key, place], "left")
    problem = F.when(~F.coalesce(F.array_contains("_names", F.col("name")), F.lit(False)), "ungrounded_tool").when(~F.coalesce(F.contains("_text", F.col("value")), F.lit(False)), "ungrounded_value")
    found = rows.withColumn("problem", problem).where("problem is not null").select(key, place, "event", "problem")
    span = claims.groupBy(key, "event").agg(F.min(place).alias("_lo"), F.max(place).alias("_hi"))
    span = span.withColumn("_before", F.lag("_hi").over(Window.partitionBy(key).orderBy("event"))).where(F.col("_lo") < F.col("_before"))
    return found.unionByName(span.select(key, F.col("_lo").alias(place), "event", F.lit("event_order").alias("problem")))


# --- tools and schemas ---


def requirement_sets(tools: DataFrame, key: str) -> DataFrame:
    """(key, set_no, condition, required, optional): the sets of inputs that satisfy a tool.

    ``tools`` has required (array), variants (array of arrays, null without) and inputs (all names).
    Each variant is a set of the common and its own requirements; without any there is one default set."""
    whole = F.when(F.size("variants") > 0, F.transform("variants", lambda v: F.struct(F.lit("variant").alias("condition"), F.array_distinct(F.concat("required", v)).alias("required"))))
    sets = F.coalesce(whole, F.array(F.struct(F.lit("default").alias("condition"), F.array_distinct("required").alias("required"))))
    rows = tools.select(key, "inputs", F.posexplode(sets).alias("set_no", "_s"))
    return rows.select(key, (F.col("set_no") + 1).alias("set_no"), "_s.condition", "_s.required", F.array_except("inputs", F.col("_s.required")).alias("optional"))


def annotated(base: DataFrame, patch: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Slots with a patch's values where it has some; a patch of a slot that isn't there raises."""
    unknown = patch.join(base.select(*key).distinct(), key, "left_anti")
    if not unknown.isEmpty():
        raise ValueError(f"unknown slot: {unknown.select(*key).first()}")
    new = patch.select(*key, *[F.col(c).alias(f"_p_{c}") for c in columns])
    rows = base.join(new, key, "left")
    return rows.select(*[F.coalesce(f"_p_{c}", c).alias(c) if c in columns else F.col(c) for c in base.columns])


def open_alerts(log: DataFrame, key: str, order: str, fine: str = "ok") -> DataFrame:
    """The latest row of each key, if its status is not ``fine``: a later good state clears an alert."""
    last = log.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*log.columns), order).alias("_r")).select("_r.*")
    return last.where(~F.col("status").eqNullSafe(F.lit(fine)))


def connectable(inputs: Column, preconditions: Column) -> Column:
    """Inputs and preconditions that other tools may feed: arrays of struct(name, kind, state)."""
    return F.filter(F.concat(inputs, preconditions), lambda s: ~(s["kind"].eqNullSafe(F.lit("control")) | s["state"].eqNullSafe(F.lit("no"))))


def adapted_calls(calls: DataFrame, renames: DataFrame, catalog: DataFrame, name: str = "name") -> DataFrame:
    """Calls under current names: (columns of ``calls``, status). ``renames`` is (old, new), ``catalog``
    has the names that exist; a failed call keeps its name, as history."""
    rows = calls.join(renames.select(F.col("old").alias(name), "new"), name, "left").withColumn("_now", F.coalesce("new", name))
    rows = rows.join(catalog.select(F.col("name").alias("_now"), F.lit(True).alias("_known")), "_now", "left")
    status = F.when(F.col("failed"), "kept_failed").when(F.col("_known").isNull(), "unknown").when(F.col("new").isNotNull(), "renamed").otherwise("same")
    rows = rows.withColumn("status", status)
    return rows.select(*[F.when(F.col("status") == "kept_failed", F.col(name)).otherwise(F.col("_now")).alias(name) if c == name else F.col(c) for c in calls.columns], "status")


def edge_problems(rows: DataFrame, ontology: DataFrame, key: str) -> DataFrame:
    """(key, problem): decisions that break the ontology, whose rows are (edge_type, allowed_status,
    needs_slots). ``rows`` has relation_status and edge_types, an array of struct(type, source_slot,
    target_slot). The rules are a table, so another ontology is another table."""
    each = rows.select(key, "relation_status", F.explode("edge_types").alias("e")).select(key, "relation_status", F.col("e.type").alias("edge_type"), "e.source_slot", "e.target_slot")
    known = ontology.groupBy("edge_type").agg(F.collect_set("allowed_status").alias("_allowed"), F.max("needs_slots").alias("_needs"))
    judged = each.join(known, "edge_type", "left")
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    problem = (
        F.when(F.col("_allowed").isNull(), "unknown_edge_type").when(~F.array_contains("_allowed", F.col("relation_status")), "status_not_allowed")
        .when(F.col("_needs") & (blank("source_slot") | blank("target_slot")), "missing_slot")
    )
    return judged.withColumn("problem", problem).where("problem is not null").select(key, "problem").distinct()


def edge_evidence(edge_types: Column) -> Column:
    """Sorted distinct evidence ids over a decision's edge types; blank ones left out."""
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform(edge_types, lambda e: F.coalesce(e["evidence_ids"], F.array().cast("array<string>")))), lambda x: x.isNotNull() & (x != ""))))


def chain_problem(tools: Column, edges: Column, hops: Column) -> Column:
    """Why an expected chain is inconsistent: its edges (struct(source, target)) must be its consecutive
    pairs, and its hops one less than its tools; null if they are."""
    pairs = F.arrays_zip(F.slice(tools, F.lit(1), F.greatest(F.size(tools) - 1, F.lit(0))).alias("source"), F.slice(tools, F.lit(2), F.greatest(F.size(tools) - 1, F.lit(0))).alias("target"))
    return F.when(F.size(tools) == 0, "empty").when(~(pairs == edges), "edges_differ").when(hops != F.size(tools) - 1, "hops_differ")


def uncovered(mapping: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """(key, problem): numbers from ``first`` to ``last`` that a mapping lacks or repeats, and others it has."""
    wanted = mapping.sparkSession.range(first, last + 1).select(F.col("id").alias(key), F.lit(True).alias("_w"))
    n = mapping.groupBy(F.col(key).cast("long").alias(key)).agg(F.count("*").alias("_n"))
    both = wanted.join(n, key, "full_outer")
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_w").isNull(), "unexpected").when(F.col("_n") > 1, "repeated")
    return both.withColumn("problem", problem).where("problem is not null").select(key, "problem")


# --- payloads and rewards ---


def evidence(observations: Column, last: int = 8) -> Column:
    """The last observations as (tool_name, status): what a final answer rests on."""
    return F.transform(F.slice(observations, F.greatest(F.lit(1), F.size(observations) - last + 1), F.lit(last)), lambda o: F.struct(o["tool_name"].alias("tool_name"), o["status"].alias("status")))


def final_payload(task: Column, values: Column, result: Column, observations: Column) -> Column:
    """A final answer's JSON by task: ranked, single or selected values, else the result as it is."""
    first = F.coalesce(F.get(values, 0), F.lit(""))
    seen = F.when(F.size(observations) > 0, evidence(observations))
    shapes = {"vs": {"ranked_smiles": values, "selected_smiles": first}, "ac": {"answer_smiles": first}, "pf": {"selected_smiles": values}}
    out = None
    for name, parts in shapes.items():
        made = F.to_json(F.struct(F.lit(name).alias("task_type"), *[c.alias(k) for k, c in parts.items()], seen.alias("evidence")))
        out = F.when(task == name, made) if out is None else out.when(task == name, made)
    return out.otherwise(F.to_json(F.struct(task.alias("task_type"), result.alias("result"), seen.alias("evidence"))))


def last_artifact(results: DataFrame, key: str, order: str) -> DataFrame:
    """(key, artifact): the last reference under a preferred key, else the last of all, of results
    without an error. ``results`` has artifact, preferred and is_error."""
    fine = results.where(~F.col("is_error") & F.col("artifact").isNotNull())
    last = lambda c: F.max_by("artifact", F.when(c, F.col(order)))
    return fine.groupBy(key).agg(F.coalesce(F.when(F.bool_or("preferred"), last(F.col("preferred"))), last(F.lit(True))).alias("artifact"))


def staged_reward(valid: Column, pairs: Column, predicted: Column, gold: Column, f1: Column, required: Column, critical: Column, configurable: Column, exact: Column) -> Column:
    """struct(score, gate): a call decision's score by the first stage it doesn't pass: its envelope, its
    tools, their required, critical and configurable arguments; a full match is 1."""
    stages = (
        (~valid, F.lit(-0.5), "invalid_react_tool_envelope"), (pairs == 0, F.lit(-0.4), "wrong_tool"), ((pairs != predicted) | (pairs != gold), 0.35 * f1 - 0.05, "partial_tool_set"),
        (required < 1, 0.30 + 0.20 * required, "missing_required_arguments"), (critical < 1, 0.55 + 0.15 * critical, "critical_argument_mismatch"),
        (configurable < 1, 0.72 + 0.13 * configurable, "invalid_configurable_arguments"), (exact, F.lit(1.0), "teacher_equivalent"),
    )
    score = gate = None
    for fails, value, name in stages:
        score, gate = (F.when(fails, value), F.when(fails, name)) if score is None else (score.when(fails, value), gate.when(fails, name))
    return F.struct(F.least(F.lit(1.0), F.greatest(F.lit(-0.5), score.otherwise(0.9))).alias("score"), gate.otherwise("valid_alternative_configuration").alias("gate"))


def final_reward(only_final: Column, predicted: Column, target: Column) -> Column:
    """1 for the target answer in a valid final decision, else -0.5. Answers are maps; ``summary`` doesn't count."""
    bare = lambda m: F.map_filter(m, lambda k, _: k != "summary")
    pairs = lambda m: F.array_sort(F.map_entries(bare(m)))
    return F.when(only_final & F.coalesce(pairs(predicted) == pairs(target), F.lit(False)), 1.0).otherwise(-0.5)


def rule_score(parse_ok: Column, decision: Column, has_final: Column, supported: Column, unsupported: Column) -> Column:
    """Half for the format, half for a decision of the expected kind."""
    final = has_final & (supported + unsupported == 0)
    calls = (supported > 0) & (unsupported == 0) & ~has_final
    fits = parse_ok & F.when(decision == "final_answer", final).otherwise(calls)
    return 0.5 * parse_ok.cast("double") + 0.5 * fits.cast("double")


def tool_component(predicted: Column, gold: Column, f1: Column, names: Column, keys: Column, values: Column) -> Column:
    """The weighted score of a call set from its pairs' mean scores; two empty sets agree."""
    mixed = 0.2 * f1 + 0.35 * names + 0.2 * keys + 0.25 * values
    return F.when((predicted == 0) & (gold == 0), 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), mixed)))


def reward_by_mode(mode: Column, scores: dict[str, Column], truncated: Column, most_if_truncated: float = 0.0) -> Column:
    """The score of a row's mode, held to a limit for truncated responses; an unknown mode is null."""
    out = F.lit(None).cast("double")
    for name, score in scores.items():
        out = F.when(mode == name, score).otherwise(out)
    return F.when(truncated, F.least(out, F.lit(most_if_truncated))).otherwise(out)


def sequence_kl(old: Column, new: Column, mask: Column) -> Column:
    """The mean of old minus new log-probabilities over unmasked tokens, for every token of the sequence."""
    parts = F.arrays_zip(old.alias("o"), new.alias("n"), mask.alias("m"))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + (x["o"] - x["n"]) * x["m"])
    weight = F.aggregate(mask, F.lit(0.0), lambda a, x: a + x)
    return F.transform(new, lambda _: total / F.greatest(weight, F.lit(1.0)))


def teacher_tail(log_probs: Column, response_length: Column) -> Column:
    """The last ``response_length`` of a sequence's log-probabilities."""
    return F.when(response_length <= 0, F.array().cast("array<double>")).otherwise(F.slice(log_probs, F.greatest(F.lit(1), F.size(log_probs) - response_length + 1), response_length))


def spoken(events: DataFrame, key: str, order: str, role: str = "assistant") -> DataFrame:
    """(key, text): a session's texts of one role, in order."""
    parts = F.array_sort(F.collect_list(F.struct(order, "text")))
    return events.where((F.col("role") == role) & (F.trim(F.coalesce("text", F.lit(""))) != "")).groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))


def tool_sequence(calls: Column, local: tuple[str, ...]) -> Column:
    """struct(domain, n_local, local): the calls of other than local tools in order, and the local ones' number by name."""
    is_local = lambda c: c.isin(*local)
    own = F.filter(calls, is_local)
    counts = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(own)), lambda n: F.struct(n, F.size(F.filter(own, lambda c: c == n)))))
    return F.struct(F.filter(calls, lambda c: ~is_local(c)).alias("domain"), F.size(own).alias("n_local"), counts.alias("local"))


def toolchain(nodes: Column, edges: Column) -> Column:
    """struct(tools, edges) of a workflow graph: its tools' names sorted, and the edges between tool
    nodes. Nodes are struct(id, type, tool), edges struct(source, target, relation)."""
    tool_nodes = F.filter(nodes, lambda n: (n["type"] == "tool") & (F.trim(F.coalesce(n["id"], F.lit(""))) != "") & (F.trim(F.coalesce(n["tool"], F.lit(""))) != ""))
    names = F.map_from_entries(F.transform(tool_nodes, lambda n: F.struct(n["id"], n["tool"])))
    inner = F.filter(edges, lambda e: F.map_contains_key(names, e["source"]) & F.map_contains_key(names, e["target"]))
    kind = lambda e: F.coalesce(F.nullif(F.trim(e["relation"]), F.lit("")), F.lit("workflow_transition"))
    made = F.transform(inner, lambda e: F.struct(F.element_at(names, e["source"]).alias("source_tool"), F.element_at(names, e["target"]).alias("target_tool"), kind(e).alias("edge_type")))
    return F.struct(F.array_sort(F.array_distinct(F.map_values(names))).alias("tools"), made.alias("edges"))
