"""Ordered sequences as arrays: collapse, common subsequence, edit distance, alignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_length_collapse(seq: Column) -> Column:
    """The array without consecutive repeats."""
    return F.filter(seq, lambda x, i: (i == 0) | (x != F.get(seq, i - 1)))


def ordered_unique(seq: Column) -> Column:
    return F.array_distinct(seq)


def bigrams(seq: Column) -> Column:
    """Adjacent pairs as structs (source, target); empty for arrays of fewer than two."""
    starts = F.slice(seq, F.lit(1), F.greatest(F.size(seq) - 1, F.lit(0)))
    return F.transform(starts, lambda x, i: F.struct(x.alias("source"), F.get(seq, i + 1).alias("target")))


def lcs_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence, row by row of the usual table."""
    empty = F.transform(right, lambda _: F.lit(0))

    def row(before: Column, x: Column) -> Column:
        def cell(now: Column, j: Column) -> Column:
            best = F.when(F.get(right, j) == x, F.coalesce(F.get(before, j - 1), F.lit(0)) + 1).otherwise(
                F.greatest(F.get(before, j), F.coalesce(F.try_element_at(now, F.lit(-1)), F.lit(0)))
            )
            return F.concat(now, F.array(best))

        places = F.transform(right, lambda _, j: j)
        return F.aggregate(places, F.array().cast("array<int>"), cell)

    last = F.aggregate(left, empty, row)
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0)).otherwise(F.element_at(last, -1))


def edit_distance(left: Column, right: Column) -> Column:
    """Levenshtein distance of arrays: elements become one character each, by their place in the
    rows' distinct elements, and the built-in distance of strings does the rest."""
    names = F.array_distinct(F.concat(left, right))

    def coded(seq: Column) -> Column:
        char = lambda x: F.decode(F.unhex(F.lpad(F.hex(F.array_position(names, x) + 0x4E00), 4, "0")), "UTF-16BE")
        return F.array_join(F.transform(seq, char), "")

    return F.levenshtein(coded(left), coded(right))


def edit_similarity(left: Column, right: Column) -> Column:
    """1 - distance / longer length; 1 for two empty arrays."""
    longer = F.greatest(F.size(left), F.size(right))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - edit_distance(left, right) / longer)


def alignment_class(expected: Column, actual: Column, lcs: Column) -> Column:
    """How an actual sequence relates to the expected one: the first class that holds."""
    return (
        F.when(expected == actual, "exact")
        .when(lcs == F.size(expected), "expected_subsequence_with_extras")
        .when(F.size(F.array_except(expected, actual)) == 0, "full_coverage_order_deviation")
        .when(F.arrays_overlap(expected, actual), "partial_overlap")
        .otherwise("no_overlap")
    )


def precedence_kept(seq: Column, source: Column, target: Column) -> Column:
    """Whether some source comes before some target."""
    first = F.array_position(seq, source)
    last = F.size(seq) - F.array_position(F.reverse(seq), target) + 1
    return (first > 0) & F.array_contains(seq, target) & (first < last)


def adjacency_kept(seq: Column, source: Column, target: Column) -> Column:
    return F.exists(bigrams(seq), lambda p: (p["source"] == source) & (p["target"] == target))


def response_length(mask: Column) -> Column:
    """From the first 1 of a loss mask to its end; 0 without one."""
    at = F.array_position(mask, 1)
    return F.when(at > 0, F.size(mask) - at + 1).otherwise(F.lit(0)).cast("int")


def turn_mask(lengths: Column, flags: Column) -> Column:
    """Per token: its turn's flag, from the turns' lengths and flags."""
    return F.flatten(F.zip_with(lengths, flags, lambda n, f: F.array_repeat(f, n)))


def depth_decile(ordinal: Column, count: Column) -> Column:
    """min(9, floor(10 * ordinal / (count - 1))), 0 for a single one."""
    return F.least(F.lit(9), F.floor(10 * ordinal / F.greatest(count - 1, F.lit(1)))).cast("int")


def depth_third(ordinal: Column, count: Column) -> Column:
    """early, middle or late: the ratio of ordinal to count - 1 below a quarter, three quarters, or more."""
    ratio = ordinal / F.greatest(count - 1, F.lit(1))
    return F.when(ratio < 0.25, "early").when(ratio < 0.75, "middle").otherwise("late")


def longest_equal_run(items: Column) -> Column:
    """Length of the longest run of equal elements."""
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("now"), F.lit(None).cast("string").alias("last"))

    def step(a: Column, x: Column) -> Column:
        now = F.when(x == a["last"], a["now"] + 1).otherwise(F.lit(1))
        return F.struct(F.greatest(a["best"], now).alias("best"), now.alias("now"), x.alias("last"))

    return F.aggregate(items, start, step)["best"]


def repeat_ngram_fraction(tokens: Column, n: int = 32) -> Column:
    """(n-grams - distinct ones) / n-grams; 0 for shorter arrays."""
    count = F.size(tokens) - n + 1
    grams = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(tokens, i, n)))  # arrays of longs are told apart in linear time
    return F.when(count < 1, F.lit(0.0)).otherwise((count - F.size(F.array_distinct(grams))) / count)
