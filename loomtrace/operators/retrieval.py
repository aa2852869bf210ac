"""Retrieval: inner-product and BM25 top-k, keyword search."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.operators import tiles


def dot(a: Column, b: Column) -> Column:
    """Inner product in double, summed in order of place."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def dense_top(queries: DataFrame, corpus: DataFrame, k: int, key: str, vector: str, most_queries: int = 4096) -> DataFrame:
    """(query_id, key, score, rank): each query's best rows of the corpus, ties to the smaller key.

    Parts of at most about ``most_queries`` queries meet parts of the corpus, each once. Per query only
    the best of each part, and what ties with them to the sixth decimal, are shuffled."""
    blocks, parts = (max(1, -(-rows.count() // most)) for rows, most in ((queries, most_queries), (corpus, 1 << 14)))
    q, c = (tiles.packed(rows.select(key, vector), n, F.xxhash64(key)) for rows, n in ((queries, blocks), (corpus, parts)))
    kinds = [t for name, t in corpus.dtypes if name == key]

    def work(i: int, j: int, some: pa.Table, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        return tiles.best_products(k, key, vector, some, rows)

    near = tiles.meeting(q, c, parts, F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")), work, f"query_id {kinds[0]}, key {kinds[0]}, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    best = near.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("key").alias(key), "score", "rank")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda w: w != "")


def bm25_top(queries: DataFrame, corpus: DataFrame, k: int, key: str, text: str, k1: float = 0.9, b: float = 0.4, most_terms: int = 1000) -> DataFrame:
    """(query_id, key, score, rank) by BM25 with ln(1 + (N - df + .5) / (df + .5)). Only terms of the
    queries are counted; queries are (query_id, query). Up to ``most_terms`` distinct terms are looked
    up within each text, so that no word is shuffled but those; more are joined."""
    docs = corpus.select(key, tokens(F.col(text)).alias("_w")).withColumn("_len", F.size("_w"))
    stats = docs.agg(F.count("*").alias("_n"), F.avg("_len").alias("_avg"))
    terms = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    wanted = terms.select("term").distinct()
    if wanted.limit(most_terms + 1).count() <= most_terms:  # a checked size: texts are cut to these terms where they are read
        known = F.array(*[F.lit(r["term"]) for r in wanted.collect()]).cast("array<string>")
        hits = docs.withColumn("_hit", F.array_intersect("_w", known)).where(F.size("_hit") > 0)
        tf = hits.select(key, "_len", "_w", F.explode("_hit").alias("term"))
        tf = tf.select(key, "_len", "term", F.size(F.filter("_w", lambda w: w == F.col("term"))).cast("long").alias("tf"))
    else:
        tf = docs.select(key, "_len", F.explode("_w").alias("term")).join(wanted, "term", "left_semi").groupBy(key, "_len", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    rows = tf.join(df, "term").join(F.broadcast(stats))  # stats: one row
    idf = F.log(1 + (F.col("_n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") / (F.col("tf") + k1 * (1 - b + b * F.col("_len") / F.col("_avg")))
    scores = terms.join(rows.select("term", key, weight.alias("_s")), "term").groupBy("query_id", key).agg(F.round(F.sum("_s"), 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def keyword_search(df: DataFrame, columns: list[str], query: str, key: str, limit: int, present: list[str] = ()) -> DataFrame:
    """Rows one of whose columns holds the query in any case, with all of ``present`` not blank, by key."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(query.lower()))
    for c in present:
        hit = hit & (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    return df.where(hit).orderBy(key).limit(max(1, min(50, limit)))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared over joint set bits of two fingerprints held as arrays of longs."""
    bits = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.bit_count(x))
    both = bits(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))
    either = bits(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    return F.when(either == 0, 0.0).otherwise(both / either)
