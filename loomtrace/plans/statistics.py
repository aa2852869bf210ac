"""Distributions, diversity, usage, group rewards, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtrace.functions import sets
from loomtrace.functions.sequences import bigrams
from loomtrace.operators import gates
from loomtrace.operators import stats as A
from loomtrace.plans.base import CHAINS, DAILY, chains, daily, joined, r6, table
from loomtrace.plans.registry import query

LEVELS = [0.25, 0.5, 0.75, 0.9, 0.95]


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(f"""
SELECT event_type, count(value) AS "count", round(min(value), 6) AS "min", {", ".join(f"round(quantile_cont(value, {q}), 6) AS p{round(q * 100)}" for q in LEVELS)},
  round(max(value), 6) AS "max", round(avg(value), 6) AS mean FROM events GROUP BY GROUPING SETS ((event_type), ())
""")
def q_distribution_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return _rounded(e.groupingSets([[F.col("event_type")], []], F.col("event_type")).agg(*A.distribution("value")))


@query("""
SELECT role, count(n) AS "count", CAST(sum(n) AS BIGINT) AS total, round(avg(n), 2) AS mean, min(n) AS "min", max(n) AS "max",
  quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.9) AS p90, quantile_disc(n, 0.95) AS p95, quantile_disc(n, 0.99) AS p99,
  count(*) FILTER (WHERE n > 128) AS gt_128, count(*) FILTER (WHERE n > 256) AS gt_256 FROM (SELECT role, length(text) AS n FROM conversations) GROUP BY role
""")
def q_quantile_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("role", F.char_length("text").cast("long").alias("n"))
    out = rows.groupBy("role").agg(*A.nearest_rank("n"), *A.over_limits("n", (128, 256)))
    return out.withColumns({c: F.col(c).cast("long") for c in ("p50", "p90", "p95", "p99")})


@query(f"""
SELECT lang, count(*) AS "count", {", ".join(f"list_sort(list(n))[CAST(floor((count(*) - 1) * {q}) AS BIGINT) + 1] AS p{round(q * 100)}" for q in LEVELS)}
FROM (SELECT lang, length(text) AS n FROM documents) GROUP BY lang
""")
def q_quantile_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("lang", F.char_length("text").cast("long").alias("n"))
    return A.floor_quantiles(rows, ["lang"], "n")


DIVERSITY = """SELECT {keys} CAST(sum(n) AS BIGINT) AS total, count(*) AS category_count, round(-sum(p * ln(p)), 6) AS shannon_entropy,
  round(sum(p * p), 6) AS simpson_concentration, count(*) FILTER (WHERE n = 1) AS singletons, round(max(p), 6) AS top_share,
  round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END, 6) AS normalized_shannon_entropy, round(1 - sum(p * p), 6) AS simpson_diversity,
  round(exp(-sum(p * ln(p))), 6) AS effective_shannon, round(1 / sum(p * p), 6) AS effective_simpson FROM p {group}"""


@query("WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c) " + DIVERSITY.format(keys="user_id,", group="GROUP BY user_id"))
def q_shannon_simpson(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return _rounded(A.diversity(counts, ["user_id"]))


@query(f"WITH {DAILY}, c AS (SELECT array_to_string(chain, ',') AS s, count(*) AS n FROM daily GROUP BY 1), p AS (SELECT *, n / sum(n) OVER () AS p FROM c) " + DIVERSITY.format(keys="", group=""))
def q_signature_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = daily(spark, sf_dir).groupBy(joined("chain").alias("s")).agg(F.count("*").alias("n"))
    return _rounded(A.diversity(counts, []))


@query("""
WITH u AS (SELECT event_type AS tool, count(*) AS calls, count(DISTINCT user_id) AS documents, count(*) FILTER (WHERE b = 'first') AS n_first, count(*) FILTER (WHERE b = 'second') AS n_second
  FROM (SELECT *, CASE WHEN day(ts) <= 15 THEN 'first' ELSE 'second' END AS b FROM events) GROUP BY event_type)
SELECT *, round(calls / sum(calls) OVER (), 6) AS share, round(documents / (SELECT count(DISTINCT user_id) FROM events), 6) AS coverage FROM u
""")
def q_tool_usage_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("tool"), F.when(F.dayofmonth("ts") <= 15, "first").otherwise("second").alias("b"))
    return _rounded(A.usage(calls, "user_id", "tool", "b", ["first", "second"]))


@query("""
WITH c AS (SELECT event_type, count(*) FILTER (WHERE user_id % 2 = 0) AS l, count(*) FILTER (WHERE user_id % 2 = 1) AS r FROM events GROUP BY 1),
p AS (SELECT l / sum(l) OVER () AS p, r / sum(r) OVER () AS q FROM c)
SELECT round(1 - sum(CASE WHEN p > 0 THEN 0.5 * p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(q / ((p + q) / 2)) ELSE 0 END), 9) AS similarity FROM p
""")
def q_js_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 2).alias("side")).agg(F.count("*").alias("n"))
    return A.js_similarity(counts, "event_type", "side", 0, 1).select(F.round("similarity", 9).alias("similarity"))


@query("""
WITH g AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS c FROM events GROUP BY user_id),
e AS (SELECT k, n, c, CASE WHEN n < k THEN NULL WHEN n - c < k THEN 1.0 WHEN c = 0 THEN 0.0 ELSE 1 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1 - k / i)) END AS p FROM g, (VALUES (1), (2), (4), (8)) AS v(k))
SELECT count(*) FILTER (WHERE k = 1) AS groups, round(avg(p) FILTER (WHERE k = 1), 6) AS pass_at_1, round(avg(p) FILTER (WHERE k = 2), 6) AS pass_at_2,
  round(avg(p) FILTER (WHERE k = 4), 6) AS pass_at_4, round(avg(p) FILTER (WHERE k = 8), 6) AS pass_at_8 FROM e
""")
def q_pass_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    return _rounded(A.pass_at_k(table(spark, sf_dir, "events"), "user_id", reward))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, round((l_discount - avg(l_discount) OVER w) / (coalesce(stddev_samp(l_discount) OVER w, 0) + 1e-6), 4) + 0::DOUBLE AS advantage
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)
""")
def q_group_norm_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    out = A.group_normalised(rows, ["l_orderkey"], "l_discount")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", (F.round("advantage", 4) + 0.0).alias("advantage"))


@query("""
WITH g AS (SELECT l_orderkey, count(*) AS n, avg(r) AS mean, stddev_samp(r) AS std, min(r) AS low, max(r) AS high FROM (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN -0.5 WHEN l_linestatus = 'F' THEN 0.5 ELSE 1.0 END AS r FROM lineitem) GROUP BY l_orderkey)
SELECT l_orderkey, n, round(mean, 6) AS mean, round(std, 6) AS std, coalesce(std > 1e-6, false) AS kept,
  CASE WHEN low >= 0.999 THEN 'mastered_all_correct' WHEN high <= -0.399 THEN 'too_hard_all_wrong' WHEN NOT coalesce(std > 1e-6, false) THEN 'zero_reward_variance' ELSE 'boundary' END AS boundary_class FROM g
""")
def q_reward_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.when(F.col("l_returnflag") == "R", -0.5).when(F.col("l_linestatus") == "F", 0.5).otherwise(1.0)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", r.cast("double").alias("r"))
    return _rounded(A.reward_groups(rows, ["l_orderkey"], "r").select("l_orderkey", "n", "mean", "std", "kept", "boundary_class"))


@query("""
WITH g AS (SELECT l_orderkey, min(l_tax) = max(l_tax) AS z, round(avg(l_tax), 1) AS r FROM lineitem GROUP BY l_orderkey)
SELECT r AS reward, count(*) AS n FROM g WHERE z GROUP BY r
""")
def q_zero_std_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.min("l_tax") == F.max("l_tax")).alias("z"), F.round(F.avg("l_tax"), 1).alias("reward"))
    return g.where("z").groupBy("reward").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT event_type, user_id, max(value) - min(value) > 1e-12 AS x FROM events GROUP BY ALL)
SELECT event_type, count(*) AS "count", round(avg(value), 6) AS reward_mean, round(stddev_pop(value), 6) AS reward_std, round(avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END), 6) AS truncated_ratio,
  (SELECT round(avg(CASE WHEN x THEN 1.0 ELSE 0.0 END), 6) FROM s WHERE s.event_type = e.event_type) AS nonzero_std_group_ratio FROM events e GROUP BY event_type
""")
def q_role_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(A.role_metrics(table(spark, sf_dir, "events"), "event_type", "user_id", "value", F.col("value") > 100))


@query("""
SELECT l_returnflag, round(coalesce(sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0), 0), 6) AS discount_ratio, round(count(*) / sum(count(*)) OVER (), 6) AS share,
  round(avg(CASE WHEN greatest(ceil(l_quantity / 40.0 * 4), 1) = 1 THEN 1.0 ELSE 0.0 END), 6) AS bucket_1, round(avg(CASE WHEN greatest(ceil(l_quantity / 40.0 * 4), 1) = 2 THEN 1.0 ELSE 0.0 END), 6) AS bucket_2,
  round(avg(CASE WHEN greatest(ceil(l_quantity / 40.0 * 4), 1) = 3 THEN 1.0 ELSE 0.0 END), 6) AS bucket_3, round(avg(CASE WHEN greatest(ceil(l_quantity / 40.0 * 4), 1) = 4 THEN 1.0 ELSE 0.0 END), 6) AS bucket_4
FROM lineitem GROUP BY l_returnflag
""")
def q_ratio_and_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        A.ratio(F.col("l_extendedprice") * F.col("l_discount"), F.col("l_extendedprice")).alias("discount_ratio"), F.count("*").alias("n"), *A.bucket_shares(F.col("l_quantity"), 40.0),
    )
    return _rounded(g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).drop("n"))


SPANS = "s AS (SELECT user_id, epoch(ts) AS a, epoch(ts) + abs(value) * 60 AS b FROM events)"


def _busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, sf_dir, "events").select("user_id", at.alias("a"), (at + F.abs("value") * 60).alias("b"))


MERGED = f"""{SPANS}, n AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM s),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM n), m AS (SELECT user_id, k, min(a) AS a, max(b) AS b FROM i GROUP BY user_id, k)"""


@query(f"""
WITH {MERGED}, g AS (SELECT user_id, lead(a) OVER (PARTITION BY user_id ORDER BY a) - b AS gap FROM m)
SELECT m.user_id, count(*) AS islands, round(sum(b - a), 3) AS busy, round(sum(b - a) / (max(b) - min(a)), 6) AS utilisation, (SELECT round(max(gap), 3) FROM g WHERE g.user_id = m.user_id) AS longest_gap FROM m GROUP BY m.user_id
""")
def q_busy_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = A.merged_intervals(_busy(spark, sf_dir), ["user_id"], "a", "b")
    longest = A.gaps(merged, ["user_id"], "a", "b").groupBy("user_id").agg(F.round(F.max(F.col("gap_end") - F.col("gap_start")), 3).alias("longest_gap"))
    busy = F.sum(F.col("b") - F.col("a"))
    out = merged.groupBy("user_id").agg(F.count("*").alias("islands"), F.round(busy, 3).alias("busy"), F.round(busy / (F.max("b") - F.min("a")), 6).alias("utilisation"))
    return out.join(longest, "user_id", "left")


@query("""
WITH l AS (SELECT user_id, event_id, value, row_number() OVER w AS i, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS v FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, i - sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM l),
g AS (SELECT user_id, k, count(*) AS n, sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS z FROM r GROUP BY user_id, k)
SELECT user_id, CAST(sum(n) AS BIGINT) AS updates, CAST(sum(z) AS BIGINT) AS zeros, CAST(max(z) AS BIGINT) AS longest_zero_run,
  concat_ws(',', CASE WHEN sum(n) < 60 THEN 'too_few_updates' END, CASE WHEN sum(z) = sum(n) THEN 'all_zero' END, CASE WHEN max(z) >= 3 THEN 'zero_run' END) AS reasons FROM g GROUP BY user_id
""")
def q_log_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")))
    out = gates.run_gate(log, ["user_id"], "event_id", "v", 60, zeros=3)
    return out.select("user_id", "updates", "zeros", "longest_zero_run", joined("reasons").alias("reasons"))


@query(f"""
WITH {CHAINS}, s AS (SELECT user_id, user_id % 10 AS block, list_distinct(list_transform(range(1, len(chain)), lambda i: chain[i] || '>' || chain[i + 1])) AS t FROM chains WHERE len(chain) > 1),
p AS (SELECT a.block, a.user_id AS u, b.user_id AS v, 1 - len(list_intersect(a.t, b.t)) / len(list_distinct(a.t || b.t)) AS d FROM s a JOIN s b ON a.block = b.block AND a.user_id < b.user_id)
SELECT block, count(*) AS pairs, round(avg(d), 6) AS mean_distance, round(min(d), 6) AS least, count(*) FILTER (WHERE d = 0) AS equal FROM p GROUP BY block
""")
def q_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unordered pairs within blocks only; q_jaccard_block_pairs has those of all blocks. Blocks share
    most of their sets, so that each two distinct ones are compared once for all blocks."""
    steps = F.array_distinct(F.transform(bigrams(F.col("chain")), lambda p: F.concat_ws(">", p["source"], p["target"])))
    s = chains(spark, sf_dir).select((F.col("user_id") % 10).alias("block"), steps.alias("t")).where(F.size("t") > 0)
    out = A.set_pairs(s, "block", "t").where("block_a = block_b")
    return out.select(F.col("block_a").alias("block"), "pairs", r6(F.col("mean_distance")).alias("mean_distance"), r6(F.col("least")).alias("least"), "equal")


@query(f"""
WITH {CHAINS}, s AS (SELECT user_id, user_id % 10 AS block, list_distinct(list_transform(range(1, len(chain)), lambda i: chain[i] || '>' || chain[i + 1])) AS t FROM chains WHERE len(chain) > 1),
p AS (SELECT least(a.block, b.block) AS block_a, greatest(a.block, b.block) AS block_b, 1 - len(list_intersect(a.t, b.t)) / len(list_distinct(a.t || b.t)) AS d FROM s a JOIN s b ON a.user_id < b.user_id)
SELECT block_a, block_b, count(*) AS pairs, round(avg(d), 6) AS mean_distance, round(min(d), 6) AS least, count(*) FILTER (WHERE d = 0) AS equal FROM p GROUP BY ALL
""")
def q_jaccard_block_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All unordered pairs of users by their blocks, over distinct sets of transitions and how many users of a block have each."""
    steps = F.array_distinct(F.transform(bigrams(F.col("chain")), lambda p: F.concat_ws(">", p["source"], p["target"])))
    s = chains(spark, sf_dir).select((F.col("user_id") % 10).alias("block"), steps.alias("t")).where(F.size("t") > 0)
    out = A.set_pairs(s, "block", "t")
    return out.withColumns({"mean_distance": r6(F.col("mean_distance")), "least": r6(F.col("least"))})


@query(f"""
WITH {CHAINS}, s AS (SELECT user_id, user_id % 2 AS side, list_sort(list_distinct(list_transform(range(1, len(chain)), lambda i: chain[i] || '>' || chain[i + 1]))) AS t FROM chains WHERE len(chain) > 1),
p AS (SELECT a.user_id AS u, max(len(list_intersect(a.t, b.t)) / len(list_distinct(a.t || b.t))) AS best, bool_or(a.t = b.t) AS same FROM s a JOIN (SELECT DISTINCT t FROM s WHERE side = 1) b ON true WHERE a.side = 0 GROUP BY a.user_id)
SELECT count(*) AS n, round(avg(best), 6) AS mean_best, round(avg(CASE WHEN same THEN 1.0 ELSE 0.0 END), 6) AS exact_rate FROM p
""")
def q_group_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest neighbours of one group's users in another's by their sets of transitions."""
    steps = F.array_distinct(F.transform(bigrams(F.col("chain")), lambda p: F.concat_ws(">", p["source"], p["target"])))
    s = chains(spark, sf_dir).select((F.col("user_id") % 2).alias("side"), steps.alias("t")).where(F.size("t") > 0)
    near = A.nearest_sets(s.where("side = 0"), s.where("side = 1"), "t")
    total = F.sum("n")
    return near.agg(total.cast("long").alias("n"), r6(F.sum(F.col("n") * F.col("best")) / total).alias("mean_best"), r6(F.sum(F.when(F.col("same"), F.col("n")).otherwise(0)) / total).alias("exact_rate"))
