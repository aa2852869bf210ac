"""Mixing sources to target weights with Pareto order sampling.

Each source has a target in words. A document's certain copies are the whole part of the target
over the source's words. The words that the source still lacks are a sample with unequal
probabilities: a document's inclusion probability ``p`` is proportional to its size class (sizes
are classed by eighths of a power of two), so that a sample holds its words in few documents, which
are whole ones. Classes for which that would exceed 1 are taken for certain and the others scaled
up, until the expected words of the sample are those that lack. Documents are ranked by
``odds(u) / odds(p)`` with ``u`` a hash of the document, and taken in that order until the sample's
words are reached. The size is fixed in words, not in documents, because the targets are; what the
last whole document leaves open is given to the one document whose size is closest to it.

Only DataFrame functions run. No source is ever collected or ordered in one task: the
place where a source's cumulative words cross its quota is found by refining a
histogram of the rank (LEVELS times 256 bins a source, each with map-side sums), and
only the documents of the last bin are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.common import WORD, cut, hashed, numbered, text_of

BINS, LEVELS = 256, 3
CLASSES = 8  # size classes a power of two
SALTS = 64  # a source's rows are dealt over so many keys where they meet its one row


def _to_sources(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Rows joined to the one row of their source, on (source, salt)."""
    return rows.join(sources.withColumn("_lt_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["_lt_s", "_lt_salt"], how)


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """From (source, source_size): the same with ``target``.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of
    all sizes; no target exceeds ``cap`` times its source's size, and the excess goes
    to the others by weight until none is above. Closed form: with sources ordered by
    cap over weight, the first whose share of what its predecessors' caps leave is
    within its own cap fixes the level of all later ones. One row a source.
    """
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = totals.withColumn("_lt_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    rows = rows.withColumn("_lt_cap", cap * F.col("source_size")).withColumn("_lt_at", F.col("_lt_cap") / F.col("_lt_w"))
    order = Window.orderBy("_lt_at", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_lt_cap").over(before), F.lit(0.0))
    weight = F.sum("_lt_w").over(whole) - F.coalesce(F.sum("_lt_w").over(before), F.lit(0.0))
    rows = rows.withColumn("_lt_level", left / weight)
    level = F.min(F.when(F.col("_lt_level") <= F.col("_lt_at"), F.struct("_lt_at", "_lt_level"))).over(whole)["_lt_level"]
    return rows.withColumn("target", F.least("_lt_cap", level * F.col("_lt_w"))).select("source", "source_size", "target")


def size_class(size: Column) -> Column:
    """The class of a size above 0, by eighths of a power of two."""
    return F.floor(F.log2(size) * CLASSES).cast("int")


def inclusion(sums: DataFrame) -> DataFrame:
    """From (_lt_s, _lt_class, _lt_words, _lt_open), a row a source and size class with its words and
    the words that the source's sample shall have: (_lt_s, _lt_ps), the probabilities by class.

    They are min(1, c * 2^(class / 8)) with c such that the expected words are _lt_open. With
    classes from the largest, the first at which what the larger ones leave, if they are taken
    for certain, gives no probability above 1 fixes c. A row a class, of which a source has few.
    """
    of = Window.partitionBy("_lt_s").orderBy(F.desc("_lt_class"))
    before, rest = of.rowsBetween(Window.unboundedPreceding, -1), of.rowsBetween(0, Window.unboundedFollowing)
    rows = sums.withColumn("_lt_z", F.pow(F.lit(2.0), F.col("_lt_class") / CLASSES))
    c = (F.col("_lt_open") - F.coalesce(F.sum("_lt_words").over(before), F.lit(0))) / F.sum(F.col("_lt_z") * F.col("_lt_words")).over(rest)
    rows = rows.withColumn("_lt_c", c)
    level = F.max(F.when(F.col("_lt_c") * F.col("_lt_z") <= 1, F.struct("_lt_class", "_lt_c"))).over(Window.partitionBy("_lt_s"))["_lt_c"]
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(level * F.col("_lt_z"), F.lit(1.0))))
    return rows.withColumn("_lt_p", p).groupBy("_lt_s").agg(F.map_from_entries(F.collect_list(F.struct("_lt_class", "_lt_p"))).alias("_lt_ps"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 9) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, p, copies, taken.

    ``size`` counts words (null text: 0); ``copies`` is how often the mix takes the
    document, ``taken`` = copies * size. ``copies`` never exceeds ``ceil(cap)``. ``p`` is the
    document's inclusion probability beyond its certain copies.
    A null source is a source of its own. Documents without words get the whole part
    of their source's expected copies and no sampled one. Equal rows are told apart
    only by chance but are interchangeable, so reruns agree. An empty table gives none.
    """
    words = F.regexp_count(text_of(docs), F.lit(WORD)).cast("long")
    u = (F.shiftrightunsigned(hashed(docs["doc_id"], docs["text"], seed=seed), 11) + F.lit(0.5)) / F.lit(float(2**53))
    rows = cut(docs.select(
        docs["doc_id"], docs["source"].cast("string").alias("source"), words.alias("size"), u.alias("_lt_u"),
        hashed(docs["doc_id"], docs["text"], seed=seed + 1).alias("_lt_row"),
    ).withColumn("_lt_id", F.monotonically_increasing_id()))
    key = F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s"))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("_lt_whole", F.floor(share)).withColumn("_lt_quota", F.greatest(F.lit(0.0), F.col("target") - F.col("_lt_whole") * F.col("source_size")))
    targets = targets.withColumn("_lt_s", key).drop("source")
    sums = rows.where("size > 0").groupBy(key.alias("_lt_s"), size_class(F.col("size")).alias("_lt_class")).agg(F.sum("size").alias("_lt_words"))
    rates = inclusion(sums.join(targets.select("_lt_s", F.col("_lt_quota").alias("_lt_open")), "_lt_s"))
    targets = cut(targets.join(rates, "_lt_s", "left"))

    ranked = _to_sources(rows.withColumns({"_lt_s": key, "_lt_salt": F.pmod("_lt_row", F.lit(SALTS)).cast("int")}), targets)
    p = F.when(F.col("size") > 0, F.coalesce(F.element_at("_lt_ps", size_class(F.col("size"))), F.lit(0.0))).otherwise(F.lit(0.0))
    ranked = ranked.withColumn("_lt_p", p).drop("_lt_ps")
    p = F.col("_lt_p")
    odds = (F.col("_lt_u") / (1 - F.col("_lt_u"))) / (p / (1 - p))
    ranked = ranked.withColumn("_lt_rank", F.when(p >= 1, 0.0).when(p > 0, odds / (1 + odds)))  # in [0, 1), increasing in the odds; certain ones first
    pool = ranked.where((p > 0) & (F.col("size") > 0)).select("_lt_s", "_lt_salt", "_lt_id", "_lt_row", "size", "_lt_rank")

    # where the cumulative words cross the quota: (bin, words before it) a source, refined level by level
    state = targets.where("_lt_quota > 0").select("_lt_s", F.lit(0).cast("long").alias("_lt_bin"), F.col("_lt_quota").alias("_lt_left"))
    for level in range(1, LEVELS + 1):
        at = F.floor(F.col("_lt_rank") * float(BINS**level)).cast("long")
        inside = _to_sources(pool.withColumn("_lt_fine", at), state).where(F.floor(F.col("_lt_fine") / BINS) == F.col("_lt_bin"))
        sums = inside.groupBy("_lt_s", "_lt_fine").agg(F.sum("size").alias("_lt_sum"), F.first("_lt_left").alias("_lt_left"))
        w = Window.partitionBy("_lt_s").orderBy("_lt_fine")
        sums = sums.withColumn("_lt_to", F.sum("_lt_sum").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        crossed = F.min(F.when(F.col("_lt_to") > F.col("_lt_left"), F.struct("_lt_fine", (F.col("_lt_left") - F.col("_lt_to") + F.col("_lt_sum")).alias("_lt_rest"))))
        end = F.struct((F.max("_lt_fine") + 1).alias("_lt_fine"), (F.max("_lt_left") - F.max("_lt_to")).alias("_lt_rest"))
        found = sums.groupBy("_lt_s").agg(F.coalesce(crossed, end).alias("_lt_x"))
        state = cut(state.join(found, "_lt_s", "left").select(
            "_lt_s",
            F.coalesce("_lt_x._lt_fine", F.col("_lt_bin") * BINS).alias("_lt_bin"),  # no rows there: all before it are in
            F.coalesce("_lt_x._lt_rest", "_lt_left").alias("_lt_left"),
        ))

    at = F.floor(F.col("_lt_rank") * float(BINS**LEVELS)).cast("long")
    near = _to_sources(pool, state).withColumn("_lt_side", F.signum(at - F.col("_lt_bin")))
    w = Window.partitionBy("_lt_s").orderBy("_lt_rank", "_lt_row", "_lt_id")
    edge = near.where("_lt_side = 0").withColumn("_lt_to", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    edge = cut(edge.where(F.col("_lt_to") <= F.col("_lt_left")).select("_lt_s", "_lt_id", "_lt_to"))
    filled = edge.groupBy("_lt_s").agg(F.max("_lt_to").alias("_lt_used"))
    rest = _to_sources(near.join(edge.select("_lt_id"), "_lt_id", "left_anti").where("_lt_side >= 0"), filled, "left")
    gap = F.col("_lt_left") - F.coalesce("_lt_used", F.lit(0))
    best = rest.where(F.abs(gap - F.col("size")) < gap).groupBy("_lt_s", "_lt_salt").agg(F.min(F.struct(F.abs(gap - F.col("size")).alias("d"), "_lt_rank", "_lt_row", "_lt_id")).alias("b"))
    best = best.groupBy("_lt_s").agg(F.min("b").alias("b"))
    extra = edge.select("_lt_id").unionByName(best.select(F.col("b._lt_id").alias("_lt_id"))).withColumn("_lt_in", F.lit(1))

    out = _to_sources(ranked, state.select("_lt_s", "_lt_bin"), "left").join(extra, "_lt_id", "left")
    drawn = F.when((p > 0) & (F.col("size") > 0) & ((at < F.col("_lt_bin")) | F.col("_lt_in").isNotNull()), 1).otherwise(0)
    copies = (F.col("_lt_whole") + drawn).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", p.alias("p"), copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "_lt_row", "_lt_id")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept.

    Rows meet their number of copies by (doc_id, text); rows equal in both share theirs evenly,
    those first by a hash of all columns getting what is left over, so that reruns agree. Columns
    may have any names and types that can be hashed.
    """
    seed = options.get("seed", 9)
    copies = mix_sources(docs, **options).groupBy(F.col("_lt_row").alias("_lt_key")).agg(F.sum("copies").cast("long").alias("_lt_copies"), F.count("*").alias("_lt_rows"))
    rows, of, back = numbered(docs)
    keyed = rows.withColumn("_lt_key", hashed(rows[of["doc_id"]], rows[of["text"]], seed=seed + 1)).join(copies, "_lt_key")
    whole = hashed(*[F.col(f"c{i}") for i in range(len(back))], seed=seed + 2)
    place = F.row_number().over(Window.partitionBy("_lt_key").orderBy(whole))  # the join has dealt by the key
    own = F.floor(F.col("_lt_copies") / F.col("_lt_rows")) + F.when(place <= F.col("_lt_copies") % F.col("_lt_rows"), 1).otherwise(0)
    keyed = keyed.withColumn("_lt_own", own).where("_lt_own > 0")
    return keyed.withColumn("_lt_copy", F.explode(F.expr("sequence(1L, _lt_own)"))).select(*back)
