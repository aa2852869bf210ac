"""Ordered sequences: collapse, similarity, alignment, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtrace.functions import sequences as S
from loomtrace.functions import sets
from loomtrace.functions.names import prompt_hash
from loomtrace.operators import decisions as D
from loomtrace.plans.base import CHAINS, DAILY, chains, daily, joined, r6, table
from loomtrace.plans.registry import query

COLLAPSED = "list_filter(list_transform(range(1, len(chain) + 1), lambda i: CASE WHEN i = 1 OR chain[i] <> chain[i - 1] THEN chain[i] END), lambda x: x IS NOT NULL)"


@query(f"WITH {CHAINS} SELECT user_id, CAST(len(chain) AS BIGINT) AS n, CAST(len(c) AS BIGINT) AS n_collapsed, array_to_string(c, ',') AS collapsed FROM (SELECT *, {COLLAPSED} AS c FROM chains)")
def q_run_length_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chains(spark, sf_dir).withColumn("c", S.run_length_collapse(F.col("chain")))
    return rows.select("user_id", F.size("chain").cast("long").alias("n"), F.size("c").cast("long").alias("n_collapsed"), joined("c").alias("collapsed"))


@query("""
WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS first FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS tools FROM f GROUP BY user_id
""")
def q_ordered_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains(spark, sf_dir).select("user_id", joined(S.ordered_unique(F.col("chain"))).alias("tools"))


def _halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).where(F.size("chain") >= 2)
    half = F.floor(F.size("chain") / 2).cast("int")
    return rows.select("user_id", "day", F.slice("chain", F.lit(1), half).alias("e"), F.slice("chain", half + 1, F.size("chain")).alias("a"))


DAY_HALVES = DAILY + ", h AS (SELECT user_id, day, chain[:len(chain) // 2] AS e, chain[len(chain) // 2 + 1:] AS a FROM daily WHERE len(chain) >= 2)"


@query(f"""
WITH {DAY_HALVES}, s AS (SELECT *, len(list_distinct(e)) AS ne, len(list_distinct(a)) AS na, len(list_intersect(e, a)) AS b, len(list_distinct(e || a)) AS u FROM h)
SELECT user_id, day, round(b / na, 6) AS "precision", round(b / ne, 6) AS recall, round(CASE WHEN b = 0 THEN 0 ELSE 2 * (b / na) * (b / ne) / (b / na + b / ne) END, 6) AS f1,
  ne = b AND na = b AS "exact", round(1 - b / u, 6) AS jaccard_distance FROM s
""")
def q_set_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _halves(spark, sf_dir).withColumn("m", sets.set_scores(F.col("a"), F.col("e")))
    return rows.select("user_id", "day", r6(F.col("m.precision")).alias("precision"), r6(F.col("m.recall")).alias("recall"), r6(F.col("m.f1")).alias("f1"), F.col("m.exact").alias("exact"), r6(sets.jaccard_distance(F.col("a"), F.col("e"))).alias("jaccard_distance"))


@query(f"""
WITH {DAY_HALVES}, e1 AS (SELECT user_id, day, t, count(*) AS n FROM (SELECT user_id, day, unnest(e) AS t FROM h) GROUP BY ALL),
a1 AS (SELECT user_id, day, t, count(*) AS n FROM (SELECT user_id, day, unnest(a) AS t FROM h) GROUP BY ALL),
j AS (SELECT e1.user_id, e1.day, sum(least(e1.n, coalesce(a1.n, 0))) AS shared, sum(greatest(0, coalesce(a1.n, 0) - e1.n)) AS surplus FROM e1 LEFT JOIN a1 USING (user_id, day, t) GROUP BY ALL)
SELECT user_id, day, round(shared / (len(e) + len(a) - shared), 6) AS multiset_jaccard, CAST(surplus AS BIGINT) AS surplus FROM h JOIN j USING (user_id, day)
""")
def q_multiset_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sort = lambda c: F.array_sort(F.col(c))
    return _halves(spark, sf_dir).select("user_id", "day", r6(sets.multiset_jaccard(sort("e"), sort("a"))).alias("multiset_jaccard"), sets.surplus(F.col("e"), F.col("a")).cast("long").alias("surplus"))


@query(f"""
WITH {DAY_HALVES}, c AS (SELECT user_id, day, e, a, array_to_string(list_transform(e, lambda x: upper(x[1])), '') AS x, array_to_string(list_transform(a, lambda x: upper(x[1])), '') AS y FROM h)
SELECT user_id, day, CAST(levenshtein(x, y) AS BIGINT) AS distance, round(1 - levenshtein(x, y) / greatest(len(e), len(a)), 6) AS similarity FROM c
""")
def q_edit_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, a = F.col("e"), F.col("a")
    return _halves(spark, sf_dir).select("user_id", "day", S.edit_distance(e, a).cast("long").alias("distance"), r6(S.edit_similarity(e, a)).alias("similarity"))


@query()
def q_lcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common subsequence and alignment class; SQL has no such recurrence, tests hold it against a plain one."""
    rows = _halves(spark, sf_dir).withColumn("lcs", S.lcs_length(F.col("e"), F.col("a")))
    return rows.select("user_id", "day", F.col("lcs").cast("long").alias("lcs"), r6(F.col("lcs") / F.size("e")).alias("ordered_coverage"), S.alignment_class(F.col("e"), F.col("a"), F.col("lcs")).alias("alignment"))


@query("""
WITH s AS (SELECT user_id, event_type AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events),
g AS (SELECT user_id, t, min(p) AS lo, max(p) AS hi FROM s GROUP BY ALL),
e AS (SELECT col0 AS source, col1 AS target FROM (VALUES ('view', 'click'), ('click', 'purchase'), ('signup', 'error'))),
r AS (SELECT u.user_id, source, target, coalesce(a.lo < b.hi, false) AS kept, EXISTS (SELECT 1 FROM s WHERE s.user_id = u.user_id AND s.t = source AND s.nxt = target) AS adjacent
  FROM (SELECT DISTINCT user_id FROM events) u, e LEFT JOIN g a ON a.user_id = u.user_id AND a.t = source LEFT JOIN g b ON b.user_id = u.user_id AND b.t = target)
SELECT source, target, count(*) AS n, count(*) FILTER (WHERE kept) AS precedence, count(*) FILTER (WHERE adjacent) AS adjacency, round(count(*) FILTER (WHERE kept) / count(*), 6) AS recall
FROM r GROUP BY GROUPING SETS ((source, target), ())
""")
def q_edge_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(t).alias("target")) for s, t in (("view", "click"), ("click", "purchase"), ("signup", "error"))])
    rows = chains(spark, sf_dir).select("chain", F.explode(edges).alias("e")).select("chain", "e.source", "e.target")
    c, s, t = F.col("chain"), F.col("source"), F.col("target")
    rows = rows.withColumns({"kept": S.precedence_kept(c, s, t), "adjacent": S.adjacency_kept(c, s, t)})
    out = rows.groupingSets([[s, t], []], s, t).agg(F.count("*").alias("n"), F.count_if("kept").alias("precedence"), F.count_if("adjacent").alias("adjacency"))
    return out.withColumn("recall", r6(F.col("precedence") / F.col("n")))


@query("""
SELECT conv_id, turn, CAST(count(*) OVER w AS BIGINT) AS n_before, CAST(coalesce(sum(length(text)) OVER w, 0) AS BIGINT) AS chars_before,
  CAST(row_number() OVER (PARTITION BY conv_id, role = 'assistant' ORDER BY turn) - 1 AS BIGINT) AS ordinal FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) QUALIFY role = 'assistant'
""")
def q_history_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.decisions(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    chars = F.aggregate("state", F.lit(0).cast("long"), lambda n, m: n + F.char_length(m["text"]))
    return rows.select("conv_id", "turn", F.size("state").cast("long").alias("n_before"), chars.alias("chars_before"), F.col("ordinal").cast("long").alias("ordinal"))


@query("""
WITH a AS (SELECT user_id, event_id, ts, event_type, event_type <> 'error' AND value > 0 AS ok, row_number() OVER w - 1 AS ordinal FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, lag(ordinal) OVER s AS repeat_of, lag(ok) OVER s AS was FROM a WINDOW s AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
c AS (SELECT *, EXISTS (SELECT 1 FROM a WHERE a.user_id = b.user_id AND a.ok AND a.ordinal > b.repeat_of AND a.ordinal < b.ordinal) AS between_ok FROM b)
SELECT user_id, event_id, CAST(ordinal AS BIGINT) AS ordinal, CAST(repeat_of AS BIGINT) AS repeat_of, coalesce(was, false) AS prior_success, between_ok AS intervening_success,
  repeat_of IS NOT NULL AND coalesce(was, false) AND NOT between_ok AS no_progress FROM c
""")
def q_no_progress_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ok", (F.col("event_type") != "error") & (F.col("value") > 0))
    rows = D.no_progress_repeats(e, "user_id", ["ts", "event_id"], "event_type", "ok")
    return rows.select("user_id", "event_id", F.col("ordinal").cast("long"), F.col("repeat_of").cast("long"), "prior_success", "intervening_success", "no_progress")


@query("""
SELECT user_id, event_id, coalesce(last_value(CASE event_type WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'success' END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'none') AS previous_status FROM events
""")
def q_prev_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("status", F.when(F.col("event_type") == "error", "failure").when(F.col("event_type") == "purchase", "success"))
    return D.previous_status(e, "user_id", ["ts", "event_id"], "status").select("user_id", "event_id", "previous_status")


@query("""
WITH d AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
b AS (SELECT least(9, CAST(floor(10 * i / greatest(n - 1, 1)) AS BIGINT)) AS decile, CASE WHEN i / greatest(n - 1, 1) < 0.25 THEN 'early' WHEN i / greatest(n - 1, 1) < 0.75 THEN 'middle' ELSE 'late' END AS third FROM d)
SELECT decile, third, count(*) AS n FROM b GROUP BY ALL
""")
def q_depth_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id")
    rows = table(spark, sf_dir, "events").select((F.row_number().over(w.orderBy("ts", "event_id")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    return rows.groupBy(S.depth_decile(F.col("i"), F.col("n")).cast("long").alias("decile"), S.depth_third(F.col("i"), F.col("n")).alias("third")).agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn), false) AS same FROM conversations),
i AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS merged_turn FROM r)
SELECT conv_id, CAST(merged_turn AS BIGINT) AS merged_turn, role, min(turn) AS turn, count(*) AS n_messages, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_sha256 FROM i GROUP BY conv_id, merged_turn, role
""")
def q_merge_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.merge_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return rows.select("conv_id", F.col("merged_turn").cast("long"), "role", "turn", "n_messages", F.sha2("text", 256).alias("text_sha256"))


@query("""
WITH t AS (SELECT conv_id, turn, length(text) AS n, least(length(text), 80) AS small, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations),
s AS (SELECT *, CASE WHEN r <= 2 THEN n ELSE least(n, small) END AS c FROM t),
u AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS tail FROM s),
g AS (SELECT conv_id, CAST(sum(n) AS BIGINT) AS "full", CAST(sum(c) AS BIGINT) AS compacted, min(turn) FILTER (WHERE tail <= 600) AS f FROM u GROUP BY conv_id),
x AS (SELECT *, CASE WHEN "full" <= 600 THEN 'unchanged' WHEN compacted <= 600 THEN 'compacted' WHEN f IS NOT NULL THEN 'suffix' ELSE 'over_budget' END AS tier FROM g)
SELECT conv_id, "full", compacted, tier, CASE WHEN tier = 'suffix' THEN f END AS first_kept FROM x
""")
def q_fit_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.char_length("text").cast("long").alias("n"))
    rows = D.fit_context(t.withColumn("small", F.least("n", F.lit(80))), "conv_id", "turn", "n", "small", 600, keep_recent=2)
    return rows.select("conv_id", "full", "compacted", "tier", "first_kept")


@query("""
WITH c AS (SELECT user_id, ts, event_id, event_type, value < 0 OR event_type = 'error' AS bad FROM events),
f AS (SELECT user_id, event_type, min((ts, event_id)) AS first FROM c WHERE bad GROUP BY ALL)
SELECT u.user_id, u.n, coalesce(g.failed, '') AS failed_tools, g.first_failure FROM (SELECT user_id, count(*) AS n FROM c GROUP BY ALL) u
LEFT JOIN (SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS failed, arg_min(event_type, first) AS first_failure FROM f GROUP BY ALL) g USING (user_id)
""")
def q_failed_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "events").withColumn("bad", (F.col("value") < 0) | (F.col("event_type") == "error"))
    rows = D.tool_sequences(c, "user_id", ["ts", "event_id"], "event_type", "bad")
    return rows.select("user_id", F.size("tools").cast("long").alias("n"), joined("failed_tools").alias("failed_tools"), "first_failure")


@query("""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\\n'), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents),
u AS (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM p), b AS (SELECT *, CASE WHEN x = lag(x) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM u),
g AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b) GROUP BY doc_id, k)
SELECT doc_id, max(n) AS longest FROM g GROUP BY doc_id
""")
def q_paragraph_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" "))), lambda x: x != "")
    rows = table(spark, sf_dir, "documents").select("doc_id", lines.alias("l")).where(F.size("l") > 0)
    return rows.select("doc_id", S.longest_equal_run(F.col("l")).cast("long").alias("longest"))


@query("""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, len(w) - 7 AS n, CASE WHEN len(w) >= 8 THEN len(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))) END AS d FROM t)
SELECT doc_id, CASE WHEN n < 1 THEN 0.0 ELSE round((n - d) / n, 6) END AS repeated FROM g
""")
def q_ngram_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    rows = table(spark, sf_dir, "documents").select("doc_id", words.alias("w"))
    return rows.select("doc_id", r6(S.repeat_ngram_fraction(F.col("w"), 8)).alias("repeated"))


@query("""
WITH x AS (SELECT user_id, list(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END ORDER BY ts, event_id) AS m FROM events GROUP BY user_id)
SELECT user_id, CAST(CASE WHEN list_position(m, 1) > 0 THEN len(m) - list_position(m, 1) + 1 ELSE 0 END AS BIGINT) AS response_length FROM x
""")
def q_response_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.transform("chain", lambda t: F.when(t == "click", 1).otherwise(0))
    return chains(spark, sf_dir).select("user_id", S.response_length(mask).cast("long").alias("response_length"))


@query("""
SELECT conv_id, turn, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS prompt_sha256 FROM conversations
""")
def q_prompt_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", prompt_hash(F.col("text")).alias("prompt_sha256"))
