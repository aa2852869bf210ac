"""Operators over all pairs of rows against plain versions."""

import math
import random
from collections import defaultdict
from itertools import combinations

import pyarrow as pa

from loomtrace.operators import retrieval, stats, tiles


def test_set_pairs(spark):
    """Pairs across blocks count like those within; equal sets, in one block or two, are pairs too."""
    rows = [(0, ["a", "b"]), (0, ["b", "a"]), (1, ["a", "b"]), (1, ["b", "c"]), (2, ["c"]), (2, ["c"]), (2, ["c"]), (0, ["d"])]
    want = defaultdict(list)
    for (i, x), (j, y) in combinations(rows, 2):
        want[min(i, j), max(i, j)].append(1 - len(set(x) & set(y)) / len(set(x) | set(y)))
    got = stats.set_pairs(spark.createDataFrame(rows, "block long, t array<string>"), "block", "t").collect()
    assert sum(r.pairs for r in got) == 28
    assert {(r.block_a, r.block_b): (r.pairs, round(r.mean_distance, 9), r.least, r.equal) for r in got} == {k: (len(v), round(sum(v) / len(v), 9), min(v), v.count(0)) for k, v in want.items()}


def test_dense_top_blocks(spark):
    """More queries than a block holds give what one block gives."""
    rows = [(i, [float((i * k) % 11 - 5) for k in range(1, 9)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    one = {tuple(r) for r in retrieval.dense_top(df, df, 3, "id", "v").collect()}
    assert len(one) == 180
    assert {tuple(r) for r in retrieval.dense_top(df, df, 3, "id", "v", most_queries=7).collect()} == one


def test_set_pairs_parts(spark):
    """Many parts and tiles, blocks without order, large sets; no row a pair of blocks of a pair of sets."""
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.sample(range(9), rng.randint(1, 4))) for _ in range(120)] + [("d", list(range(k, k + 5000))) for k in (0, 10)]
    want = defaultdict(list)
    for (i, x), (j, y) in combinations(rows, 2):
        want[min(i, j), max(i, j)].append(1 - len(set(x) & set(y)) / len(set(x) | set(y)))
    out = stats.set_pairs(spark.createDataFrame(rows, "block string, t array<int>"), "block", "t", most_sets=5)
    got = {(r.block_a, r.block_b): (r.pairs, round(r.mean_distance, 9), round(r.least, 9), r.equal) for r in out.collect()}
    assert got == {k: (len(v), round(sum(v) / len(v), 9), round(min(v), 9), v.count(0)) for k, v in want.items()}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode") == 1  # of a part over the parts it meets


def test_set_distances_tiles():
    """Tiles of a few sets give what one tile gives."""
    rng = random.Random(6)
    known = {tuple(sorted(rng.sample(range(12), rng.randint(0, 5)))) for _ in range(60)}
    held = [[{"block": b, "n": rng.randint(1, 3)} for b in rng.sample(range(4), rng.randint(1, 4))] for _ in known]
    kind = pa.list_(pa.struct([("block", pa.int64()), ("n", pa.int64())]))
    table = pa.table({"t": pa.array([list(t) for t in known], pa.list_(pa.int64())), "held": pa.array(held, kind)})
    for a, b, same in ((table, table, True), (table.slice(0, 20), table.slice(20), False)):
        one, some = ({r["x"] * 10 + r["y"]: tuple(round(v, 9) for v in r.values()) for r in tiles.set_distances(same, a, b, tile).to_pylist()} for tile in (1024, 7))
        assert one == some and one


def test_dense_top_odd_vectors(spark):
    """Nulls, other lengths, infinities, copies and ties, against a plain version; a pair is no row of a join."""
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(40)] + [(40 + i, [1.0, 2.0, 0.5, 0.0]) for i in range(9)]
    rows += [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [1.0, 2.0]), (53, []), (54, [float("inf"), 1.0, 1.0, 1.0]), (55, [float("nan")] * 4), (56, [1e-7, 0.0, 0.0, 0.0])]

    def product(a, b):
        if a is None or b is None or len(a) != len(b) or None in a or None in b:
            return None
        s = 0.0
        for x, y in zip(a, b, strict=True):
            s += x * y
        return s if math.isinf(s) or math.isnan(s) else round(s, 6)

    high = lambda s: (2, 0) if s is None else (0, 0) if math.isnan(s) else (1, -s)
    want = {}
    for q, a in rows:
        scores = sorted((high(product(a, b)), key) for key, b in rows)[:6]
        want.update({(q, n + 1): key for n, (_, key) in enumerate(scores)})
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for most in (7, 4096):
        out = retrieval.dense_top(df, df, 6, "id", "v", most_queries=most)
        assert {(r.query_id, r["rank"]): r.id for r in out.collect()} == want
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_jaccard_pairs_by_parts(spark, sf_dir):
    """Users of a block are not joined with each other."""
    from loomtrace.plans import registry

    plan = registry.queries()["q_jaccard_pairs"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "user_id < v" not in plan
