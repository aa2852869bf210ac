"""Set and multiset scores of arrays, each with its own convention for empty sides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_scores(prediction: Column, truth: Column) -> Column:
    """struct(precision, recall, f1, exact) of two arrays as sets; two empty ones score 1."""
    p, t = F.array_distinct(prediction), F.array_distinct(truth)
    both = F.size(F.array_intersect(p, t))
    empty = (F.size(p) == 0) & (F.size(t) == 0)
    ratio = lambda n: F.when(empty, 1.0).when(F.size(n) == 0, 0.0).otherwise(both / F.size(n))
    precision, recall = ratio(p), ratio(t)
    f1 = F.when(empty, 1.0).when(precision + recall == 0, 0.0).otherwise(2 * precision * recall / (precision + recall))
    exact = (F.size(F.array_except(p, t)) == 0) & (F.size(F.array_except(t, p)) == 0)
    return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), exact.alias("exact"))


def chain_scores(expected: Column, actual: Column) -> Column:
    """struct(recall, precision, f1, jaccard): recall 1 without anything expected, precision 0 without
    anything actual, Jaccard 1 for two empty arrays."""
    e, a = F.array_distinct(expected), F.array_distinct(actual)
    both = F.size(F.array_intersect(e, a))
    recall = F.when(F.size(e) > 0, both / F.size(e)).otherwise(1.0)
    precision = F.when(F.size(a) > 0, both / F.size(a)).otherwise(0.0)
    f1 = F.when(recall + precision > 0, 2 * recall * precision / (recall + precision)).otherwise(0.0)
    union = F.size(F.array_union(e, a))
    jaccard = F.when(union > 0, both / union).otherwise(1.0)
    return F.struct(recall.alias("recall"), precision.alias("precision"), f1.alias("f1"), jaccard.alias("jaccard"))


def jaccard_distance(left: Column, right: Column) -> Column:
    """1 - intersection / union; 0 for two empty arrays."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(0.0)).otherwise(1 - F.size(F.array_intersect(left, right)) / union)


def counts_of(items: Column) -> Column:
    """Element -> number of occurrences."""
    return F.map_from_entries(F.transform(F.array_distinct(items), lambda x: F.struct(x, F.size(F.filter(items, lambda y: y == x)))))


def multiset_jaccard(left: Column, right: Column) -> Column:
    """Shared occurrences over all: 1 for equal arrays, 0 if one is empty."""
    count = lambda items, x: F.size(F.filter(items, lambda y: y == x))
    shared = F.aggregate(F.array_intersect(left, right), F.lit(0), lambda n, x: n + F.least(count(left, x), count(right, x)))
    union = F.size(left) + F.size(right) - shared
    return F.when(left == right, 1.0).when((F.size(left) == 0) | (F.size(right) == 0), 0.0).otherwise(shared / union)


def hits_at(ranking: Column, truth: Column, k: int) -> Column:
    """How many of the first k ranked items are true; repeats count."""
    return F.size(F.filter(F.slice(ranking, 1, k), lambda x: F.array_contains(truth, x)))


def surplus(expected: Column, actual: Column) -> Column:
    """Calls of expected elements beyond their expected number."""
    count = lambda items, x: F.size(F.filter(items, lambda y: y == x))
    return F.aggregate(F.array_distinct(expected), F.lit(0), lambda n, x: n + F.greatest(F.lit(0), count(actual, x) - count(expected, x)))


def paragraphs_kept(summary: Column, thoughts: Column) -> Column:
    """Paragraphs of a summary that no thought holds, each once, in order; compared with white
    space collapsed and in lower case."""
    key = lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
    parts = F.filter(F.split(summary, r"\n\s*\n"), lambda x: key(x) != "")
    known = F.flatten(F.transform(thoughts, lambda t: F.transform(F.split(t, r"\n\s*\n"), key)))
    fresh = F.filter(parts, lambda x: ~F.array_contains(known, key(x)))
    first = F.filter(fresh, lambda x, i: ~F.exists(F.slice(fresh, F.lit(1), i), lambda y: key(y) == key(x)))
    return F.array_join(F.transform(first, lambda x: F.trim(x)), "\n\n")
