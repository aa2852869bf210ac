"""Rewards, returns and losses over rows and arrays."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRING = T.StructType([T.StructField("pairs", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("precision", "recall", "f1", "mean_score"))])


def discounted_returns(rewards: Column, gamma: float) -> Column:
    """G_t = r_t + gamma * G_{t+1}, from the end."""
    back = F.aggregate(
        F.reverse(rewards), F.array().cast("array<double>"),
        lambda a, r: F.concat(a, F.array(r + gamma * F.coalesce(F.element_at(F.concat(F.array(F.lit(0.0)), a), -1), F.lit(0.0)))),
    )
    return F.reverse(back)


def gae(rewards: Column, values: Column, gamma: float, lam: float) -> Column:
    """Generalised advantages: delta_t + gamma * lam * A_{t+1}, the value after the last being 0."""
    after = F.concat(F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0))), F.array(F.lit(0.0)))
    deltas = F.transform(rewards, lambda r, i: r + gamma * F.get(after, i) - F.get(values, i))
    return discounted_returns(deltas, gamma * lam)


def approx_kl(log_p: Column, log_q: Column, kind: str) -> Column:
    """Estimators of the divergence: k1, k2, k3 and low_var_kl (k3 held within 10)."""
    d = log_p - log_q
    if kind == "k1":
        return d
    if kind == "k2":
        return d * d / 2
    k3 = F.exp(-d) - 1 + d
    return F.least(F.lit(10.0), F.greatest(F.lit(-10.0), k3)) if kind == "low_var_kl" else k3


def policy_loss(kl: Column, advantage: Column, low: float, high: float, dual: float | None = None) -> Column:
    """The clipped ratio loss, with an upper bound for negative advantages where ``dual`` is given."""
    ratio = F.exp(-kl)
    one, two = -ratio * advantage, -F.least(F.lit(1 + high), F.greatest(F.lit(1 - low), ratio)) * advantage
    loss = F.greatest(one, two)
    return loss if dual is None else F.when(advantage < 0, F.least(-dual * advantage, loss)).otherwise(loss)


def importance_weights(log_p: Column, log_q: Column, mask: Column, level: str, low: float | None, high: float) -> Column:
    """Per token exp of the log-ratio held within 20: its own, the sequence's sum, or its mean;
    truncated at ``high``, from below too where ``low`` is given, and 0 where masked."""
    ratios = F.zip_with(log_p, log_q, lambda a, b: a - b)
    total = F.aggregate(F.zip_with(ratios, mask, lambda r, m: r * m), F.lit(0.0), lambda s, x: s + x)
    n = F.greatest(F.aggregate(mask, F.lit(0), lambda s, x: s + x.cast("int")), F.lit(1))
    clip = lambda x: F.exp(F.least(F.lit(20.0), F.greatest(F.lit(-20.0), x)))
    each = {"token": lambda r: clip(r), "sequence": lambda r: clip(total), "geometric": lambda r: clip(total / n)}[level]
    bound = lambda w: F.least(F.lit(high), w if low is None else F.greatest(F.lit(low), w))
    return F.zip_with(ratios, mask, lambda r, m: F.when(m == 1, bound(each(r))).otherwise(0.0))


def decision_reward(valid: Column, name_f1: Column, predicted: Column, wanted: Column, param_name: Column, param_value: Column, matched: Column) -> Column:
    """A tool decision on a scale from -0.5 to 1, names first: 0.10 for the format, 0.55 for the
    names' F1, 0.10 for the number of calls, 0.10 and 0.15 for parameters' names and values. An
    invalid envelope or no name right is -0.5 whatever else holds."""
    most = F.greatest(predicted, wanted)
    complete = F.when(most > 0, 1 - F.abs(predicted - wanted) / most).otherwise(1.0)
    quality = 0.10 * valid.cast("double") + 0.55 * name_f1 + 0.10 * complete + 0.10 * param_name + 0.15 * param_value
    return F.when(~valid | (matched == 0), -0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(-0.5), 1.5 * quality - 0.5)))


def scaled_score(score: Column, local_max: Column) -> Column:
    return 6.0 * score / local_max - 3.0


def _within(x: Column) -> Column:
    return F.least(F.lit(0.1), F.greatest(F.lit(-0.2), x))


def efficiency(done: Column, steps: Column, most: int | None = None) -> Column:
    """A tenth for a final answer, minus a tenth for running out, minus up to 0.15 for steps over half the most."""
    base = F.when(done == "final_answer", 0.1).when(done.isin("length", "max_steps", "fatal_error", "abort"), -0.1).otherwise(0.0)
    over = F.least(F.lit(0.15), F.greatest(F.lit(0), steps - most // 2) * 0.01) if most else F.lit(0.0)
    return _within(base - over)


def progress(actions: Column, observations: Column) -> Column:
    """0.05 for any observation, minus 0.05 (0.2 at most) for each action equal to the one before it."""
    repeats = F.size(F.filter(actions, lambda x, i: (i > 0) & (x == F.get(actions, i - 1))))
    return _within(F.when(F.size(observations) > 0, 0.05).otherwise(0.0) - F.least(F.lit(0.2), repeats * 0.05))


def em_reward(valid: Column, answer: Column, golds: Column, retrieved: Column, structure: float = 0.2, final: float = 0.1, retrieval: float = 0.1, full: float = 1.0) -> Column:
    """A ladder over (valid format, exact match, retrieval hit): a match without the format loses the
    structure's share, an invalid format without an answer is 0."""
    from loomtrace.functions.text import exact_match

    fair = F.when(retrieved, structure + retrieval).otherwise(F.lit(structure))
    match = F.coalesce(exact_match(answer, golds), F.lit(False))
    return F.when(answer.isNull(), F.when(valid, fair).otherwise(0.0)).when(match, F.when(valid, full).otherwise(full - structure)).when(valid, fair).otherwise(F.lit(final))


def score_value(p, g, tolerance: float = 1e-6) -> float:
    """How far a predicted JSON value agrees with the wanted one, 0 to 1."""
    if p == g:
        return 1.0
    if isinstance(p, dict) and isinstance(g, dict):
        shared = p.keys() & g.keys()
        f1 = 2 * len(shared) / (len(p) + len(g))
        return 0.35 * f1 + 0.65 * (sum(score_value(p[k], g[k], tolerance) for k in shared) / len(shared) if shared else 0.0)
    if isinstance(p, list) and isinstance(g, list):
        left = [json.dumps(x, sort_keys=True) for x in g]
        hits = 0
        for x in (json.dumps(x, sort_keys=True) for x in p):
            if x in left:
                left.remove(x)
                hits += 1
        return 2 * hits / (len(p) + len(g))
    number = lambda x: isinstance(x, (int, float))
    if number(p) and number(g):
        gap = abs(p - g)
        return 1.0 if gap <= tolerance else max(0.0, 1 - gap / max(abs(p), abs(g), 1.0))
    if isinstance(p, str) and isinstance(g, str):
        return float(" ".join(p.split()).lower() == " ".join(g.split()).lower())
    return 0.0


def score_call(p: dict, g: dict) -> float:
    """0.45 for the name, 0.25 for the keys' F1, 0.30 for the shared keys' values; 0 for another name."""
    if p.get("tool_name") != g.get("tool_name"):
        return 0.0
    a, b = p.get("arguments") or {}, g.get("arguments") or {}
    shared = a.keys() & b.keys()
    f1 = 2 * len(shared) / (len(a) + len(b)) if a or b else 1.0
    values = sum(score_value(a[k], b[k]) for k in shared) / len(shared) if shared else float(not a and not b)
    return 0.45 + 0.25 * f1 + 0.30 * values


def best_assignment(scores: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of the largest total: exactly for up to 8 a side, else best pair first."""
    rows, cols = len(scores), len(scores[0]) if scores else 0
    if max(rows, cols, 0) > 8:
        pairs, used_r, used_c = [], set(), set()
        for s, r, c in sorted(((-scores[r][c], r, c) for r in range(rows) for c in range(cols))):
            if s < 0 and r not in used_r and c not in used_c:
                pairs.append((r, c))
                used_r.add(r)
                used_c.add(c)
        return sorted(pairs)
    best: dict[tuple[int, int], tuple[float, tuple]] = {}

    def solve(r: int, used: int) -> tuple[float, tuple]:
        if r == rows:
            return 0.0, ()
        if (r, used) not in best:
            options = [solve(r + 1, used)]
            for c in range(cols):
                if not used >> c & 1 and scores[r][c] > 0:
                    total, rest = solve(r + 1, used | 1 << c)
                    options.append((total + scores[r][c], ((r, c), *rest)))
            best[r, used] = max(options, key=lambda o: o[0])
        return best[r, used]

    return sorted(solve(0, 0)[1])


@F.pandas_udf(PAIRING)
def call_pairing(predicted: pd.Series, gold: pd.Series) -> pd.DataFrame:
    """Optimal pairing of two JSON lists of calls; two empty lists score 1."""

    def one(p: str, g: str) -> tuple:
        p, g = json.loads(p or "[]"), json.loads(g or "[]")
        if not p and not g:
            return 0, 1.0, 1.0, 1.0, 1.0
        matrix = [[score_call(a, b) for b in g] for a in p]
        pairs = best_assignment(matrix) if p and g else []
        precision, recall = len(pairs) / len(p) if p else 0.0, len(pairs) / len(g) if g else 0.0
        f1 = 2 * precision * recall / (precision + recall) if pairs else 0.0
        return len(pairs), precision, recall, f1, sum(matrix[r][c] for r, c in pairs) / len(pairs) if pairs else 0.0

    return pd.DataFrame([one(p, g) for p, g in zip(predicted, gold, strict=True)], columns=["pairs", "precision", "recall", "f1", "mean_score"])
