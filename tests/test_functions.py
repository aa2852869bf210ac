"""Hand-computed values for functions and operators."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from loomtrace.functions import names, registry, sequences, sets, text
from loomtrace.operators import decisions, gates, graph, packing, pairing, retrieval, rewards, sampling, stats, upserts


def one(spark, column, **values):
    df = spark.range(1)
    return df.select(column).first()[0]


def arr(*items, kind="string"):
    return F.array(*[F.lit(x) for x in items]).cast(f"array<{kind}>")


CHAINS = {  # id: (actual, alignment class, lcs)
    "exact": (["a", "b"], "exact", 2), "subsequence": (["a", "x", "b"], "expected_subsequence_with_extras", 2), "order": (["b", "a"], "full_coverage_order_deviation", 1),
    "partial": (["a", "x"], "partial_overlap", 1), "none": (["x"], "no_overlap", 0), "empty": ([], "no_overlap", 0),
}


def test_chains(spark):
    df = spark.createDataFrame([(k, ["a", "b"], a) for k, (a, _, _) in CHAINS.items()], "id string, e array<string>, a array<string>")
    e, a = F.col("e"), F.col("a")
    out = df.select("id", sequences.lcs_length(e, a).alias("lcs"), sets.chain_scores(e, a).alias("m"), sequences.edit_similarity(e, a).alias("s"), sequences.precedence_kept(a, F.lit("a"), F.lit("b")).alias("p"), sequences.adjacency_kept(a, F.lit("a"), F.lit("b")).alias("adj"))
    out = {r.id: r for r in out.join(df, "id").withColumn("cls", sequences.alignment_class(e, a, F.col("lcs"))).collect()}
    for k, (_, cls, lcs) in CHAINS.items():
        assert (out[k].cls, out[k].lcs) == (cls, lcs)
    assert abs(out["subsequence"].m.precision - 2 / 3) < 1e-12 and abs(out["subsequence"].s - 2 / 3) < 1e-12
    assert out["subsequence"].p and not out["subsequence"].adj
    assert out["order"].s == 0.0 and out["partial"].m.recall == 0.5 and out["empty"].m.precision == 0.0


def test_lcs_plain(spark):
    rng = random.Random(1)
    pairs = [([rng.choice("abc") for _ in range(rng.randint(0, 9))], [rng.choice("abc") for _ in range(rng.randint(0, 9))]) for _ in range(60)]

    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    got = {r[0]: r[1] for r in df.select("i", sequences.lcs_length(F.col("a"), F.col("b"))).collect()}
    assert all(got[i] == plain(a, b) for i, (a, b) in enumerate(pairs))


def test_sets(spark):
    m = one(spark, sets.set_scores(arr(), arr()))
    assert (m.precision, m.recall, m.f1, m.exact) == (1.0, 1.0, 1.0, True)
    assert abs(one(spark, sets.jaccard_distance(arr("a", "b"), arr("b", "c"))) - 2 / 3) < 1e-12
    assert one(spark, sets.jaccard_distance(arr(), arr())) == 0.0
    assert one(spark, sets.multiset_jaccard(arr("a", "a"), arr("a"))) == 0.5
    assert one(spark, sets.paragraphs_kept(F.lit("One  two\n\nthree\n\nThree\n\nknown"), arr("x\n\nKnown"))) == "One  two\n\nthree"


def test_js(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 1)], "k string, s int, n int")
    assert stats.js_similarity(df, "k", "s", 0, 1).first()[0] == 1.0
    df = spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], "k string, s int, n int")
    assert stats.js_similarity(df, "k", "s", 0, 1).first()[0] == 0.0
    assert stats.js_similarity(df.limit(0), "k", "s", 0, 1).first()[0] == 1.0
    assert stats.js_similarity(df.where("s = 0"), "k", "s", 0, 1).first()[0] == 0.0


def test_nearest_rank(spark):
    r = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 100)], "v long").agg(*stats.nearest_rank("v")).first()
    assert (r["count"], r["total"], r["mean"], r["p50"], r["p90"], r["p95"], r["p99"]) == (5, 110, 22.0, 3, 100, 100, 100)


def test_text(spark):
    assert one(spark, text.normal_answer(F.lit("An apple, a day"))) == "apple day"
    assert one(spark, text.normal_answer(F.lit("a.b,c!"))) == "abc" and one(spark, text.normal_answer(F.lit("the"))) == ""
    f = one(spark, text.token_f1(F.lit("the brown fox"), F.lit("a quick brown fox")))
    assert abs(f.f1 - 0.8) < 1e-12 and f.precision == 1.0 and abs(f.recall - 2 / 3) < 1e-12
    assert one(spark, text.token_f1(F.lit("yes"), F.lit("yes sir"))).f1 == 0.0
    df = spark.createDataFrame([(r"x \boxed{a{b}c} y",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(text.boxed_answer("t")).collect()] == ["a{b}c", None, None]
    df = spark.createDataFrame([('{"a":[1,{"b":2.5}],"c":true}',), ("bad",)], "t string")
    assert [r[0] for r in df.select(text.nested_numbers("t")).collect()] == [[1.0, 2.5], []]
    df = spark.createDataFrame([("ab" * 6000,), ("short",)], "t string")
    assert [r[0] for r in df.select(text.has_repetition(F.col("t"))).collect()] == [True, False]


def test_names(spark):
    assert one(spark, names.bare_name(F.lit("mcp__x__run"), "mcp__x__")) == "run" and one(spark, names.bare_name(F.lit("run"), "mcp__x__")) is None
    assert one(spark, names.content_hash(F.lit('{"b":1,"a":2}'))) == one(spark, names.content_hash(F.lit('{"a":2,"b":1}')))
    assert [one(spark, names.retry_delay(F.lit(n))) for n in (1, 2, 3, 9)] == [30, 60, 120, 300]
    assert 0 <= one(spark, names.jitter("s", F.lit("k"))) < 1


def test_pass_at_k(spark):
    df = spark.createDataFrame([(g, 1 if i < c else 0) for g, c in ((0, 0), (1, 2), (2, 8)) for i in range(8)], "g int, r int")
    got = stats.pass_at_k(df, "g", F.col("r")).first()
    for k in (1, 2, 4, 8):
        want = sum(1 - math.comb(8 - c, k) / math.comb(8, k) for c in (0, 2, 8)) / 3
        assert abs(got[f"pass_at_{k}"] - want) < 1e-12


def test_reward_groups(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, -0.4), (1, -0.5), (2, 0.2), (2, 0.2), (3, 0.0), (3, 1.0), (4, 0.3)], "g int, r double")
    got = {r.g: (r.kept, r.boundary_class) for r in stats.reward_groups(df, ["g"], "r").collect()}
    assert got == {0: (False, "mastered_all_correct"), 1: (True, "too_hard_all_wrong"), 2: (False, "zero_reward_variance"), 3: (True, "boundary"), 4: (False, "zero_reward_variance")}


def test_returns(spark):
    got = one(spark, rewards.discounted_returns(arr(1.0, 2.0, 3.0, kind="double"), 0.5))
    assert got == [2.75, 3.5, 3.0]
    r, v, gamma, lam = [1.0, 0.0, 2.0], [0.5, 0.25, 1.0], 0.9, 0.8
    want, after, nxt = [], 0.0, 0.0
    for x, y in zip(reversed(r), reversed(v)):
        after = x + gamma * nxt - y + gamma * lam * after
        want.insert(0, after)
        nxt = y
    got = one(spark, rewards.gae(arr(*r, kind="double"), arr(*v, kind="double"), gamma, lam))
    assert all(abs(a - b) < 1e-12 for a, b in zip(got, want))


def test_packing():
    assert packing.first_fit([5, 6, 5, 20, 4], 10) == [0, 1, 0, 2, 1]
    assert packing.greedy_partition([4, 3, 3, 1], 2) == [0, 1, 1, 0]
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.randint(1, 50) for _ in range(24)]
        bins = packing.differencing(lengths, 4)
        loads = [sum(x for x, b in zip(lengths, bins) if b == k) for k in range(4)]
        assert max(loads) - min(loads) <= max(lengths)
        equal = packing.differencing(lengths, 4, equal_size=True)
        assert all(equal.count(k) == 6 for k in range(4))
        split = packing.split_bins(packing.first_fit(lengths, 100), lengths, 12)
        assert max(split) + 1 >= 12 and len(split) == 24


def test_schedule(spark):
    df = spark.createDataFrame([(i // 2, i, 10) for i in range(34)], "rollout int, pos int, n int")
    out = packing.schedule(df, "rollout", "pos", "n", per_step=8, ranks=4, capacity=20).collect()
    assert len(out) == 32 and len({r.pos for r in out}) == 32  # the tail of one rollout is dropped
    for step in (0, 1):
        own = [r for r in out if r.step == step]
        assert all(len({r.bin for r in own if r.rank == k}) == 2 for k in range(4))


def test_assignment(spark):
    assert rewards.best_assignment([[0.9, 0.8], [0.85, 0.1]]) == [(0, 1), (1, 0)]
    big = [[1.0 if r == c else 0.0 for c in range(10)] for r in range(10)]
    assert rewards.best_assignment(big) == [(k, k) for k in range(10)]
    call = lambda n, **a: {"tool_name": n, "arguments": a}
    df = spark.createDataFrame([(json.dumps([call("a", x=1), call("b")]), json.dumps([call("b"), call("a", x=1)])), ("[]", "[]"), (json.dumps([call("a")]), "[]")], "p string, g string")
    got = [r[0] for r in df.select(rewards.call_pairing("p", "g")).collect()]
    assert (got[0].pairs, got[0].f1, got[0].mean_score) == (2, 1.0, 1.0) and got[1].f1 == 1.0 and got[2].f1 == 0.0
    assert rewards.score_value([1, 2], [2, 3]) == 0.5 and rewards.score_value(9.0, 10.0) == 0.9


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (1, 1)], "source int, target int")
    assert {tuple(r.path) for r in graph.simple_paths(e.where("source <> target"), 3).collect()} == {(1, 2, 3, 4)}
    s = spark.createDataFrame([("x", 1, None), ("x", 2, 1), ("x", 3, 2), ("x", 4, 9), ("x", 5, 6), ("x", 6, 5), ("x", 7, 5)], "k string, span_id int, parent_id int")
    assert {r.span_id: r.depth for r in graph.depths(s, "k").collect()} == {1: 0, 2: 1, 3: 2, 4: 0}


def test_gates(spark):
    assert one(spark, gates.final_status(F.lit(True), F.lit(False), F.lit(False))).reasons == ["task_answer_invalid", "training_trace_invalid"]
    schema = {"type": "object", "properties": {"n": {"type": "integer", "minimum": 1}, "t": {"type": "array", "items": {"type": "string", "minLength": 2}}}, "required": ["n"]}
    df = spark.createDataFrame([('{"n":1}',), ('{"n":0}',), ('{"t":[]}',), ('{"n":2,"t":["ab","c"]}',), ('{"n":2,"t":["ab"]}',), ("bad",)], "v string")
    assert [r[0] for r in df.select(gates.schema_valid(F.col("v"), schema)).collect()] == [True, False, False, False, True, False]


def test_repeats(spark):
    rows = [("c", 0, "a", True), ("c", 1, "a", False), ("c", 2, "a", True), ("c", 3, "b", True), ("c", 4, "a", True), ("c", 5, "a", True)]
    df = spark.createDataFrame(rows, "k string, i int, sig string, ok boolean")
    got = {r.i: (r.repeat_of, r.no_progress) for r in decisions.no_progress_repeats(df, "k", ["i"], "sig", "ok").collect()}
    assert got == {0: (None, False), 1: (0, True), 2: (1, False), 3: (None, False), 4: (2, False), 5: (4, True)}


def test_history_only(spark):
    df = spark.createDataFrame([("c", i, r, f"t{i}") for i, r in enumerate(("system", "user", "assistant", "user", "assistant"))], "k string, turn int, role string, text string")
    got = {r.turn: [m.text for m in r.state] for r in decisions.decisions(df, "k", "turn").collect()}
    assert got == {2: ["t0", "t1"], 4: ["t0", "t1", "t2", "t3"]}


def test_upserts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4), ("b", 5)], "k string, i int")
    assert {(r.k, r.i) for r in upserts.latest_by_key(df, "k", ["i"]).collect()} == {("a", 2), ("b", 5)}
    assert {(r.k, r.i) for r in upserts.first_by_key(df.where("k is null or k <> ''"), "k", ["i"]).collect()} == {("a", 1), ("b", 5), (None, 4)}
    with pytest.raises(ValueError):
        upserts.require_unique(df, "k")
    with pytest.raises(ValueError):
        upserts.require_disjoint([df, df], {"k": F.col("k")})


def test_pairing(spark):
    a = spark.createDataFrame([("x", 0.0, 5.0), ("x", 9.0, 10.0)], "k string, s double, e double")
    b = spark.createDataFrame([("x", 4.0, 9.5), ("x", 20.0, 21.0)], "k string, s2 double, e2 double")
    assert {(r.s, r.s2) for r in pairing.overlaps(a, b, ["k"], ("s", "e"), ("s2", "e2"), 1.0).collect()} == {(0.0, 4.0), (9.0, 4.0)}
    assert pairing.overlaps(a, b, ["k"], ("s", "e"), ("s2", "e2"), 1.0).count() == 2


def test_sampling(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "i int, g int")
    assert sampling.pad_to_multiple(df, ["i"], 4).count() == 12 and sampling.pad_to_multiple(df, ["i"], 5).count() == 10
    assert sampling.upsample(df, 23, "i", 1).count() == 23
    assert sampling.stratum_winners(df, ["g"], "i").count() == 3
    mean = spark.range(20000).select(sampling.log_normal(10.0, 30.0, 3).alias("x")).agg(F.avg("x")).first()[0]
    assert abs(mean - 10) < 0.3


def test_retrieval(spark):
    a, b = arr(0b1100, kind="bigint"), arr(0b0110, kind="bigint")
    assert abs(one(spark, retrieval.tanimoto(a, b)) - 1 / 3) < 1e-12


def test_registry(spark):
    assert registry.load_function("loomtrace.functions.names.jitter") is names.jitter
    out = spark.createDataFrame([("a",), ("b",)], "t string").select(registry.dispatch(F.col("t"), {"a": F.lit(1.0), "b": F.lit(2.0)}).alias("r"))
    assert [r.r for r in out.collect()] == [1.0, 2.0]
