"""Episode operators against plain versions and hand-computed values."""

import pytest
from pyspark.sql import functions as F

from loomtrace.functions import kinds
from loomtrace.operators import curation, episodes


def test_inferred_parents(spark):
    """A stack walked in Python, with ends that are not innermost, unknown, and repeated names."""
    events = [("start", "a"), ("other", None), ("start", "b"), ("start", "a"), ("end", "b"), ("other", None), ("end", "a"), ("other", None), ("end", "x"), ("end", "a"), ("other", None)]
    want, stack = [], []
    for kind, span in events:
        want.append(stack[-1] if stack else None)
        if kind == "start":
            stack.append(span)
        elif kind == "end" and span in stack:
            at = max(i for i, s in enumerate(stack) if s == span)
            stack = stack[:at] + stack[at + 1 :]
    df = spark.createDataFrame([("t", i, k, s) for i, (k, s) in enumerate(events)], "t string, i int, kind string, span string")
    got = episodes.inferred_parents(df, "t", "i").orderBy("i").collect()
    assert [r.parent for r in got] == want
    assert episodes.inferred_parents(df.limit(0), "t", "i").count() == 0


def test_sequence_audit(spark):
    """First in, first out by name, walked in Python."""
    import random

    rng = random.Random(5)
    rows = [(k, i, rng.choice(["user", "assistant"]), rng.choice(["call", "call", "result", "result", "text", "final"]), rng.choice("ab")) for k in range(12) for i in range(rng.randint(1, 25))]
    want = {}
    for k in {r[0] for r in rows}:
        queue, answered, lost, late, again, final, before = {"a": 0, "b": 0}, 0, 0, 0, 0, False, None
        for _, _, role, kind, name in sorted(r for r in rows if r[0] == k):
            late += final
            again += role == before == "assistant"
            before, final = role, final or kind == "final"
            if kind == "call":
                queue[name] += 1
            elif kind == "result" and queue[name]:
                queue[name] -= 1
                answered += 1
            elif kind == "result":
                lost += 1
        want[k] = (answered, lost, late, again)
    got = episodes.sequence_audit(spark.createDataFrame(rows, "k int, i int, role string, kind string, name string"), "k", "i").collect()
    assert {r.k: (r.answered, r.unpaired_results, r.after_final, r.repeated_assistant) for r in got} == want


def test_plan_problem(spark):
    plan = '<plan>{"subgoals":[{"step":1,"objective":"go"}]}</plan>'
    cases = {(1, plan): None, (2, plan): "not_one_assistant_turn", (1, "go"): "no_plan_block", (1, "<plan>{</plan>"): "invalid_json", (1, '<plan>{"subgoals":[]}</plan>'): "no_subgoals", (1, '<plan>{"subgoals":[{"step":1,"objective":" "}]}</plan>'): "invalid_subgoal"}
    df = spark.createDataFrame(list(cases), "n int, c string")
    assert {(r.n, r.c): r.p for r in df.withColumn("p", episodes.plan_problem(F.col("n"), F.col("c"))).collect()} == cases


def test_values(spark):
    cases = {("is_on", " Yes "): ("bool", "true"), ("x", "1.23456789"): ("number", "1.234568"), ("smiles", "C C\tO"): ("smiles", "CCO"), ("out_file", "/a/b//c.txt"): ("artifact", "b/c.txt"), ("note", " a \n b "): ("string", "a b"), ("note", None): ("string", None)}
    df = spark.createDataFrame(list(cases), "n string, v string")
    df = df.withColumn("k", kinds.value_kind(F.col("n"), F.col("v"))).withColumn("c", kinds.canonical_value(F.col("v"), F.col("k")))
    assert {(r.n, r.v): (r.k, r.c) for r in df.collect()} == cases
    names = {"ncclAllReduce": "NCCL Communication", "deep_ep_combine_x": "DeepEP Combine (MoE)", "flash_fwd_attn": "Flash Attention", "fmha": "Attention (other)", "batched_cat": "Concat/Cat", "zzz": "Other Compute"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.c for r in df.withColumn("c", kinds.kernel_class(F.col("n"))).collect()} == names


def test_guards(spark):
    base = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "slot string, n int, unit string")
    with pytest.raises(ValueError):
        episodes.annotated(base, spark.createDataFrame([("c", 3, "y")], base.schema), ["slot"], ["unit"])
    got = episodes.annotated(base, spark.createDataFrame([("a", None, "y")], base.schema), ["slot"], ["n", "unit"]).orderBy("slot").collect()
    assert [tuple(r) for r in got] == [("a", 1, "y"), ("b", 2, "x")]
    rows = spark.createDataFrame([(["system"], "tool_call", ["x"], None, ["y"]), (["user"], "final_answer", [], "a", []), ([], None, None, None, [])], "roles array<string>, d string, calls array<string>, f string, allowed array<string>")
    got = [r[0] for r in rows.select(episodes.training_row_reasons(F.col("roles"), F.col("d"), F.col("calls"), F.col("f"), F.col("allowed"))).collect()]
    assert got == [["prompt_missing_user_turn", "unknown_tool"], [], ["invalid_decision_type", "missing_prompt_messages"]]


def test_compaction_keys(spark):
    """Objects keep preferred keys first and say how many they leave out; text that isn't JSON is null."""
    import json

    value = {f"k{i:02}": i for i in range(40)} | {"artifact_id": "a", "error_message": "e"}
    got = json.loads(curation._compacted(json.dumps(value)))
    assert {"artifact_id", "error_message", "k00", "k29"} <= set(got) and "k30" not in got and got["_omitted_keys"] == 10
    deep = {"a": {"b": {"c": {"d": {"e": 1}}}}}
    assert json.loads(curation._compacted(json.dumps(deep)))["a"]["b"]["c"]["d"]["e"]["type"] == "int"
    assert curation._compacted("no json") is None and curation._compacted(None) is None


def test_nested_values(spark):
    """Parents before children, in lists too; text that isn't JSON has none."""
    from loomtrace.operators import releases

    df = spark.createDataFrame([('{"k":{"k":1},"a":[{"k":"x"}]}',), ("no",), (None,), ("3",)], "t string")
    assert [r[0] for r in df.select(releases.nested_values("k")("t")).collect()] == [['{"k": 1}', "1", '"x"'], [], [], []]


def test_cursor(spark, tmp_path):
    from loomtrace.operators import releases

    path = f"{tmp_path}/cursor"
    assert releases.load_cursor(spark, path) is None
    for step in (1, 3, 2):
        releases.save_cursor(spark, path, step * 7, step, step)
    assert releases.load_cursor(spark, path) == (21, 3) and releases.load_cursor(spark, path, 2) == (14, 2) and releases.load_cursor(spark, path, 0) is None


def test_numbered(spark):
    """Places over many partitions are those of one sort."""
    from loomtrace.operators.sampling import numbered

    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 37) % 1009).alias("v"))
    got = {r.v: r.n for r in numbered(df, [F.col("v").desc()], "n").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(got, reverse=True))}
    assert numbered(df.limit(0), ["v"], "n").count() == 0
