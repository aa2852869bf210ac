"""Validity gates: reasons are ordered arrays, rejected rows stay rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Status words of observations and tool results, as their producers write them.
ERROR_WORDS = ("error", "failed", "failure", "timeout", "timed_out", "cancelled")
SUCCESS_WORDS = ("ok", "success", "succeeded", "completed")


def reasons(*checks: tuple[Column, str | Column]) -> Column:
    """The codes of the checks that hold, in order, each once."""
    codes = [F.when(c, F.lit(r) if isinstance(r, str) else r) for c, r in checks]
    return F.array_distinct(F.array_compact(F.array(*codes)))


def final_status(execution: Column, answer: Column, trace: Column) -> Column:
    """struct(status, reasons): accepted if all three gates hold."""
    why = reasons((~execution, "execution_invalid"), (~answer, "task_answer_invalid"), (~trace, "training_trace_invalid"))
    return F.struct(F.when(F.size(why) == 0, "accepted").otherwise("rejected").alias("status"), why.alias("reasons"))


def terminal_findings(events: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Findings of each session's last ``result`` event only; sessions without one have none.

    Events have type, is_error, api_error_status, subtype and terminal_reason."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    fields = F.struct("is_error", "api_error_status", low("subtype").alias("subtype"), low("terminal_reason").alias("reason"))
    last = events.groupBy(*keys).agg(F.max_by(F.when(low("type") == "result", fields), F.when(low("type") == "result", F.col(order))).alias("t"))
    status, subtype, reason = F.col("t.api_error_status").cast("string"), F.col("t.subtype"), F.col("t.reason")
    found = reasons(
        (F.col("t.is_error"), "terminal_result_error"), (status != "", F.concat(F.lit("terminal_api_error:"), status)),
        (subtype.rlike("^(error|fail)"), F.concat(F.lit("terminal_subtype:"), subtype)), (reason.rlike("^(abort|error|fail)"), F.concat(F.lit("terminal_reason:"), reason)),
    )
    return last.select(*keys, found.alias("findings"))


def failure_type(completed: Column, used_tool: Column, failed: Column) -> Column:
    return (
        F.when(completed & used_tool & (failed == 0), "success").when(~completed, "execution_failure")
        .when(failed > 0, "tool_call_failure").when(~used_tool, "no_tool_use").otherwise("execution_failure")
    )


def recommendation(failure: Column, coverage: Column) -> Column:
    return (
        F.when(failure == "success", F.when(coverage < 0.5, "downweight").otherwise("keep")).when(failure == "no_tool_use", "reject")
        .when(failure == "tool_call_failure", "downweight").otherwise("needs_manual_review")
    )


def observation_status(outer: Column, content: Column, payload_error: Column, event_error: Column, error: Column) -> Column:
    """struct(is_error, status, conflict) from all signals of an observation."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    no = F.lit(False)
    o, c = low(outer), low(content)
    bad = o.isin(*ERROR_WORDS) | c.isin(*ERROR_WORDS) | F.coalesce(payload_error, no) | F.coalesce(event_error, no) | (low(error) != "")
    good = o.isin(*SUCCESS_WORDS) | c.isin(*SUCCESS_WORDS) | F.coalesce(~payload_error, no) | F.coalesce(~event_error, no)
    status = F.when(bad, "error").otherwise(F.coalesce(F.nullif(c, F.lit("")), F.nullif(o, F.lit("")), F.lit("success")))
    return F.struct(bad.alias("is_error"), status.alias("status"), (bad & good).alias("conflict"))


def tool_success(transport: Column, schema: Column, is_error: Column, status: Column, unknown_fails: bool = True) -> Column:
    """struct(execution, semantic, unknown, error_type): transport, then schema, then the error flag, then the status."""
    low = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    kind = (
        F.when(~transport, "TransportError").when(~schema, "ToolValidationError").when(F.coalesce(is_error, F.lit(False)), "ToolRuntimeError")
        .when(low.isin(*ERROR_WORDS), "ToolStatusError").when(low.isin(*SUCCESS_WORDS), F.lit("")).otherwise("ToolSemanticUnknown")
    )
    fails = [k for k in ("TransportError", "ToolValidationError", "ToolRuntimeError", "ToolStatusError")]
    unknown = kind == "ToolSemanticUnknown"
    semantic = (kind == "") | (unknown & F.lit(not unknown_fails))
    shown = F.when((kind != "") & (~unknown | F.lit(unknown_fails)), kind)
    return F.struct((~kind.isin(*fails)).alias("execution"), semantic.alias("semantic"), unknown.alias("unknown"), shown.alias("error_type"))


def observation_outcome(ok: Column, status: Column) -> Column:
    """Aggregate over an action's observations: success, failure, unknown, or missing without any."""
    low = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    bad, good = F.bool_or(F.coalesce(~ok, F.lit(False)) | low.isin(*ERROR_WORDS)), F.bool_or(F.coalesce(ok, F.lit(False)) | low.isin(*SUCCESS_WORDS))
    return F.when(F.count(F.coalesce(ok.cast("string"), status)) == 0, "missing").when(bad, "failure").when(good, "success").otherwise("unknown")


def leaks(text: Column, names: Column) -> Column:
    """The names that a text holds as whole names, in any case: no letter or digit next to them."""
    low = F.lower(text)
    spot = lambda n: F.regexp_like(low, F.concat(F.lit(r"(?<![a-z0-9])\Q"), F.lower(n), F.lit(r"\E(?![a-z0-9])")))
    return F.filter(names, spot)


def holds_any(text: Column, phrases: tuple[str, ...]) -> Column:
    """Whether the text holds any phrase, in any case."""
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(F.lower(text), F.lit(p.lower()))
    return out


def denied_local_access(strings: Column, denied: tuple[str, ...]) -> Column:
    """Whether a command's words, by base name, hold a denied program."""
    base = lambda t: F.element_at(F.split(t, "/"), -1)
    return F.exists(strings, lambda s: F.exists(F.split(F.lower(s), r"[\s|;&<>\"']+"), lambda t: base(t).isin(*denied)))


def sequence_findings(messages: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per conversation: consecutive assistant turns, unsanitised paths, missing final assistant turn."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = messages.withColumn("_prev", F.lag("role").over(w)).withColumn("_next", F.lead("role").over(w))
    twice = F.bool_or((F.col("role") == "assistant") & (F.col("_prev") == "assistant"))
    path = F.bool_or(F.col("text").rlike(r"(?<![\w:/<])/(?:[\w.@-]+/)+[\w.@-]+"))
    ends = F.bool_or(F.col("_next").isNull() & (F.col("role") == "assistant"))
    found = reasons((twice, "consecutive_assistant_messages"), (path, "unsanitized_path"), (~ends, "missing_final_answer"))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_messages"), found.alias("findings"))


def numbers_known(final: Column, observed: Column, tolerance: float = 1e-9) -> Column:
    """Whether every final number is within a tolerance of an observed one."""
    return F.forall(final, lambda n: F.exists(observed, lambda o: F.abs(o - n) <= tolerance))


def run_gate(log: DataFrame, keys: list[str], order: str, value: str, least: int, zeros: int = 6) -> DataFrame:
    """A metric's log per key: too few updates, non-finite, all zero, or a run of zeros."""
    w = Window.partitionBy(*keys).orderBy(order)
    zero = F.coalesce(F.col(value) == 0, F.lit(False))
    rows = log.withColumn("_i", F.row_number().over(w) - F.sum(zero.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy(*keys, "_i").agg(F.count("*").alias("n"), F.sum(zero.cast("int")).alias("z"), F.count_if(F.isnan(value) | F.col(value).isNull() | (F.abs(value) == float("inf"))).alias("bad"))
    g = runs.groupBy(*keys).agg(F.sum("n").alias("updates"), F.sum("z").alias("zeros"), F.max("z").alias("longest"), F.sum("bad").alias("bad"))
    why = reasons((F.col("updates") < least, "too_few_updates"), (F.col("bad") > 0, "non_finite"), (F.col("zeros") == F.col("updates"), "all_zero"), (F.col("longest") >= zeros, "zero_run"))
    return g.select(*keys, "updates", "zeros", F.col("longest").alias("longest_zero_run"), why.alias("reasons"))


def coverage_errors(rows: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: (key, side) with side unknown (not in the catalog) or uncovered."""
    a, b = rows.select(key).distinct(), catalog.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("unknown")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("uncovered")))


def schema_valid(value: Column, schema: dict) -> Column:
    """A JSON-schema subset over a JSON string column: type, enum, minimum, maximum, minLength,
    maxLength, items and properties with required ones, compiled to one expression."""

    def check(v: Column, s: dict) -> Column:
        kinds = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DECIMAL|DOUBLE)", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY"}
        out = F.regexp_like(F.schema_of_variant(v), F.lit(f"^{kinds[s['type']]}")) if "type" in s else F.lit(True)
        text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
        if "enum" in s:
            out = out & text.isin(*[str(x) for x in s["enum"]])
        for k, rule in (("minimum", lambda x: number >= x), ("maximum", lambda x: number <= x), ("minLength", lambda x: F.char_length(text) >= x), ("maxLength", lambda x: F.char_length(text) <= x)):
            if k in s:
                out = out & rule(s[k])
        if "items" in s:
            out = out & F.forall(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.coalesce(check(x, s["items"]), F.lit(False)))
        for name, sub in s.get("properties", {}).items():
            inner = F.try_variant_get(v, f"$.{name}", "variant")
            out = out & F.when(inner.isNull(), F.lit(name not in s.get("required", []))).otherwise(F.coalesce(check(inner, sub), F.lit(False)))
        return out

    return F.coalesce(check(F.try_parse_json(value), schema), F.lit(False))
