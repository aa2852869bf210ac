"""Quality rules whose cutoffs are chosen under a bound on false rejection.

Every rule rejects a document whose measure exceeds a cutoff. Cutoffs come from a fixed
grid. Labelled holdouts give, per stratum, rule and cutoff, how many good documents
there are (n) and how many it would reject (r). A cutoff is safe if the hypothesis
"the false rejection rate is above ``risk``" is rejected by the exact binomial test,
P(Bin(n, risk) <= r) <= alpha / families, with ``families`` the number of strata times rules.
Within a family cutoffs are tested in a fixed sequence, from the one that rejects least, up to
the first that isn't safe; so each family errs with probability alpha / families at most however
long its grid is, and with probability 1 - alpha all cutoffs in force are safe at once. The last
safe cutoff of each stratum and rule is applied; where the first is not safe (too few labels),
the rule rejects nothing in that stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.common import WHITE, WORD, cut, let, text_of

SYMBOLS = "#*$%&|<>"
SPAN = 5
# The grid of cutoffs of each measure, in order.
GRID = {
    "symbols": (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5),
    "dup_lines": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "repeats": (0.02, 0.05, 0.1, 0.15, 0.2),
    "long_words": (8.0, 10.0, 12.0, 16.0, 24.0),
}


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """How many words lie in a window of ``span`` words found twice or more in the array."""

    def covered(keys: Column) -> Column:
        order = F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            near = lambda e, k: ((k > 0) & (F.get(s, k - 1)["h"] == e["h"])) | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, near), lambda e: e["i"]))

        total = lambda at: F.aggregate(
            at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-span).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(span), i - a["last"])).alias("n"), i.alias("last")),
        )["n"]
        return let(let(order, twice), total)

    def on_keys(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(covered(keys))

    def on_words(w: Column) -> Column:
        window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(span)])
        return let(F.transform(F.sequence(F.lit(0), F.size(w) - span), window), on_keys)

    return F.when(F.size(words) < span, F.lit(0).cast("long")).otherwise(let(words, on_words))


def measures(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words in struct ``_lt_m``. Null texts have none of anything."""
    text = text_of(docs)
    rows = docs.withColumn("_lt_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    real = F.filter(F.split(text, "\n"), lambda x: F.char_length(F.btrim(x, F.lit(WHITE))) > 0)
    dup = let(real, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    chars = F.char_length(F.translate(text, WHITE, ""))
    symbols = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    of = F.struct(
        F.size("_lt_words").cast("long").alias("n_words"), chars.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"), repeated_words(F.col("_lt_words")).alias("n_repeat_words"),
    )
    return rows.withColumn("_lt_m", of).drop("_lt_words")


def base_failed(m: str = "_lt_m") -> Column:
    return (F.col(f"{m}.n_words") < 10) | (100 * F.col(f"{m}.n_repeat_words") > 20 * F.col(f"{m}.n_words"))


def ratios(m: str = "_lt_m") -> dict[str, Column]:
    words = F.greatest(F.col(f"{m}.n_words"), F.lit(1))
    return {
        "symbols": F.col(f"{m}.n_symbols") / F.greatest(F.col(f"{m}.word_chars"), F.lit(1)),
        "dup_lines": F.col(f"{m}.n_dup_lines") / words * 10,
        "repeats": F.col(f"{m}.n_repeat_words") / words,
        "long_words": F.col(f"{m}.word_chars") / words,
    }


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 9, where its first terms have the precision of a double."""
    x = n + 9.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    below = n + 1.0
    for k in range(2, 9):
        below = below * (n + float(k))
    return series - F.log(below)


def log_binomial_tail(n: Column, r: Column, rate: float) -> Column:
    """ln P(Bin(n, rate) <= r); 0 from r >= rate * n on, where the tail cannot be small.

    Terms are summed from the largest, that of r, downwards, each from the one before. Below the
    mean they fall faster than those of a normal distribution, so that all beyond 12 standard
    deviations are below the precision of a double: their number is bounded by that and by r.
    """
    odds = math.log1p(-rate) - math.log(rate)
    largest = log_factorial(n) - log_factorial(r) - log_factorial(n - r) + r * math.log(rate) + (n - r) * math.log1p(-rate)
    count = F.least(r.cast("double"), F.ceil(12 * F.sqrt(n * rate * (1 - rate))) + 64).cast("long")

    def step(a: Column, j: Column) -> Column:
        k = r - j + 1  # from the term of k to that of k - 1
        term = a["t"] + F.log(k / (n - k + 1)) + odds
        return F.struct(term.alias("t"), (a["s"] + F.exp(term)).alias("s"))

    steps = F.when(count >= 1, F.sequence(F.lit(1).cast("long"), count)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(F.lit(0.0).alias("t"), F.lit(1.0).alias("s")), step)["s"]
    return F.when(r >= rate * n, F.lit(0.0)).otherwise(largest + F.log(total))


def safe_cutoffs(scored: DataFrame, stratum: str, good: str, risk: float = 0.02, alpha: float = 0.05, grid=None) -> DataFrame:
    """(stratum, rule, cutoff): the last safe cutoff of the sequence, from labelled rows with a column
    per rule of ``grid`` and a boolean ``good``. Strata without a safe cutoff are absent. Null
    measures exceed nothing; rows whose ``good`` is null are no labels."""
    grid = grid or GRID
    pairs = [(rule, c) for rule, cutoffs in grid.items() for c in cutoffs]
    sums = [F.sum(F.when(F.col(good) & (F.col(rule) > c), 1).otherwise(0)).cast("long").alias(f"r{i}") for i, (rule, c) in enumerate(pairs)]
    counts = scored.groupBy(F.col(stratum).alias("stratum")).agg(F.sum(F.when(F.col(good), 1).otherwise(0)).cast("long").alias("n"), *sums)
    counts = cut(counts)
    families = max(1, counts.count() * len(grid))
    each = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"r{i}").alias("r")) for i, (rule, c) in enumerate(pairs)]))
    rows = counts.withColumn("e", each).select("stratum", "n", "e.*")
    rows = rows.withColumn("safe", log_binomial_tail(F.col("n"), F.col("r"), risk) <= math.log(alpha / families))
    sequence = Window.partitionBy("stratum", "rule").orderBy(F.desc("cutoff")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("safe", F.every("safe").over(sequence)).where("safe").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, alpha: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``_lt_text`` (the text's hash), ``_lt_m`` (the
    measures), ``_lt_base_failed`` and ``_lt_kept``.

    ``labels`` has doc_id and quality (1 good, 0 bad); other values and rows with a null
    id are no labels. Where an id is labelled twice the larger quality counts. The stratum
    is a column of ``docs``; null counts with the empty string. Rows failing the base rules
    are never kept. An empty table gives an empty table; without labels only base rules reject.
    """
    of = docs.select(docs["doc_id"], docs[stratum].cast("string").alias("_lt_st"), docs["text"])
    rows = measures(of).select("doc_id", F.coalesce("_lt_st", F.lit("")).alias("_lt_st"), F.xxhash64(text_of(of)).alias("_lt_text"), "_lt_m")
    rows = cut(rows)  # measured once, used for the cutoffs and for the verdicts
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_lt_id")).agg(F.max("quality").alias("_lt_q"))
    held = rows.where(~base_failed()).join(known, F.col("doc_id") == F.col("_lt_id"))
    held = held.select("_lt_st", (F.col("_lt_q") == 1).alias("_lt_good"), *[c.alias(k) for k, c in ratios().items()])
    # strata are as many as the data has: their cutoffs are joined, not collected
    limits = safe_cutoffs(held, "_lt_st", "_lt_good", risk, alpha).groupBy("stratum").pivot("rule", list(GRID)).agg(F.min("cutoff"))
    limits = limits.select(F.col("stratum").alias("_lt_st"), *[F.col(k).alias(f"_lt_max_{k}") for k in GRID])
    out = rows.join(limits, "_lt_st", "left")
    kept = ~base_failed()
    for k, c in ratios().items():
        kept = kept & ~F.coalesce(c > F.col(f"_lt_max_{k}"), F.lit(False))
    return out.select("doc_id", "_lt_text", "_lt_m", base_failed().alias("_lt_base_failed"), kept.alias("_lt_kept"))
