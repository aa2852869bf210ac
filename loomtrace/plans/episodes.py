"""Counters, summaries, audits, releases, payloads and rewards over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions import kinds as K
from loomtrace.operators import episodes as E
from loomtrace.plans.base import CHAINS, DAILY, chains, daily, joined, r6, table
from loomtrace.plans.registry import query

NAMES = {"user": "input_path", "assistant": "smiles", "system": "note"}


@query(r"""
WITH w AS (SELECT role, unnest(string_split(text, ' ')) AS v FROM conversations),
k AS (SELECT v, CASE WHEN lower(trim(v)) IN ('true', '1', 'yes', 'false', '0', 'no') THEN 'bool' WHEN try_cast(trim(v) AS DOUBLE) IS NOT NULL THEN 'number' WHEN role = 'assistant' THEN 'smiles' WHEN role = 'user' THEN 'artifact' ELSE 'string' END AS kind FROM w),
c AS (SELECT kind, CASE kind WHEN 'bool' THEN CASE WHEN lower(trim(v)) IN ('true', '1', 'yes') THEN 'true' ELSE 'false' END WHEN 'number' THEN CAST(round(CAST(trim(v) AS DOUBLE), 6) AS VARCHAR) WHEN 'smiles' THEN regexp_replace(v, '\s+', '', 'g')
  WHEN 'artifact' THEN array_to_string(list_filter(string_split_regex(trim(v), '[/\\]'), lambda x: x <> '')[-2:], '/') ELSE trim(regexp_replace(v, '\s+', ' ', 'g')) END AS t FROM k)
SELECT kind, count(*) AS n, count(DISTINCT t) AS texts, CAST(sum(length(t)) AS BIGINT) AS chars FROM c GROUP BY kind
""")
def q_value_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of a conversation as a parameter's value, named by its speaker."""
    rows = table(spark, sf_dir, "conversations").select("role", F.explode(F.split("text", " ")).alias("v"))
    name = F.coalesce(*[F.when(F.col("role") == r, n) for r, n in NAMES.items()], F.lit("note"))
    rows = rows.withColumn("kind", K.value_kind(name, F.col("v"))).withColumn("t", K.canonical_value(F.col("v"), F.col("kind")))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("t").alias("texts"), F.sum(F.char_length("t")).alias("chars"))


@query(r"""
WITH t AS (SELECT conv_id, turn, role, text, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS s, len(list_filter(string_split(text, ' '), lambda w: regexp_matches(trim(w), '[A-Za-z]') AND NOT regexp_full_match(trim(w), '[A-Za-z_]+') AND regexp_matches(trim(w), '[\[\]()=#@\\/+\-.0-9]'))) AS tokens FROM conversations),
p AS (SELECT *, s <> '' AND s NOT IN ('analysis complete', 'analysis completed', 'completed', 'completed successfully', 'done', 'task complete', 'task completed') AND NOT starts_with(s, 'i cannot ') AND NOT starts_with(s, 'i can''t ') AND NOT starts_with(s, 'unable to ') AND NOT starts_with(s, 'no result') AS says FROM t)
SELECT conv_id, turn, tokens, says, array_to_string(list_filter([CASE WHEN role = 'system' THEN 'parse_error' END, CASE WHEN trim(text) = '' THEN 'empty_prediction' END, CASE WHEN trim(text) <> '' AND NOT says THEN 'missing_result_content' END,
  'missing_required_final_fields:' || CASE WHEN trim(text) = '' THEN 'answer,result' ELSE 'result' END], lambda x: x IS NOT NULL), '|') AS reasons FROM p
""")
def q_answer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    tokens = F.size(F.filter(F.split(t, " "), K.structural_token)).cast("long")
    reasons = K.answer_reasons(t, F.col("role") == "system", F.create_map(F.lit("answer"), t), ("answer", "result"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tokens.alias("tokens"), K.says_something(t).alias("says"), F.array_join(reasons, "|").alias("reasons"))


@query(f"""
WITH {DAILY}, g AS (SELECT user_id, day, list_sort(list_distinct(chain)) AS p, lag(list_sort(list_distinct(chain))) OVER (PARTITION BY user_id ORDER BY day) AS e FROM daily),
s AS (SELECT user_id, day, p, coalesce(e, []) AS e FROM g)
SELECT user_id, day, CASE WHEN len(p) > 0 AND len(e) > 0 AND p[1] = e[1] THEN 1.0 ELSE 0.0 END::DOUBLE AS acc, array_to_string(list_filter([CASE WHEN len(p) > 1 THEN 'invalid_prediction_count:' || len(p) END, CASE WHEN len(e) = 0 THEN 'empty_ground_truth' WHEN len(e) > 1 THEN 'invalid_ground_truth_count:' || len(e) END], lambda x: x IS NOT NULL), '|') AS reasons FROM s
""")
def q_single_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's event types against those of the user's day before."""
    from pyspark.sql import Window

    rows = daily(spark, sf_dir).select("user_id", "day", F.array_sort(F.array_distinct("chain")).alias("p"))
    rows = rows.withColumn("e", F.coalesce(F.lag("p").over(Window.partitionBy("user_id").orderBy("day")), F.array().cast("array<string>")))
    s = K.single_answer(F.col("p"), F.col("e"))
    return rows.select("user_id", "day", s["acc"].alias("acc"), F.array_join(s["reasons"], "|").alias("reasons"))


@query(r"""
WITH w AS (SELECT unnest(string_split(text, ' ')) AS v FROM conversations), l AS (SELECT lower(v) AS v FROM w)
SELECT CASE WHEN contains(v, 'th') AND contains(v, 'in') THEN 'both' WHEN contains(v, 'er') OR contains(v, 'on') THEN 'either' WHEN contains(v, 'norm') THEN 'Normalization' WHEN contains(v, 'index') OR contains(v, 'scatter') OR contains(v, 'gather') THEN 'Index/Gather/Scatter' ELSE 'other' END AS class, count(*) AS n FROM l GROUP BY ALL
""")
def q_kernel_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by rules of the kernel classifier's form, two of its own among them."""
    own = tuple(r for r in K.KERNELS if r[1] in ("Normalization", "Index/Gather/Scatter"))
    words = table(spark, sf_dir, "conversations").select(F.explode(F.split("text", " ")).alias("v"))
    return words.groupBy(K.kernel_class(F.col("v"), (("th&in", "both"), ("er|on", "either"), *own), "other").alias("class")).agg(F.count("*").alias("n"))


@query("""
WITH o AS (SELECT user_id, event_type <> 'error' AS s, value > 10 AS t, value > 30 AS e, event_type IN ('click', 'purchase') AS m, value > 90 AS u FROM events)
SELECT user_id, count(*) AS total, count(*) FILTER (WHERE NOT s) AS schema_fail, count(*) FILTER (WHERE s AND NOT t) AS transport_error, count(*) FILTER (WHERE s AND t) AS attempts, count(*) FILTER (WHERE s AND t AND e) AS executed,
  count(*) FILTER (WHERE s AND t AND m) AS semantic_success, count(*) FILTER (WHERE NOT (s AND t AND m)) AS semantic_error, count(*) FILTER (WHERE s AND t AND u) AS semantic_unknown FROM o GROUP BY user_id
""")
def q_tool_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, v = F.col("event_type"), F.col("value")
    rows = table(spark, sf_dir, "events").select("user_id", (t != "error").alias("schema_ok"), (v > 10).alias("transport_ok"), (v > 30).alias("executed"), t.isin("click", "purchase").alias("meant"), (v > 90).alias("unknown"))
    return E.tool_stats(rows, "user_id")


@query("""
WITH a AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type <> 'error' AND value >= 20) AS s, count(*) FILTER (WHERE event_type <> 'error' AND value < 20) AS r FROM events WHERE value > 5 GROUP BY user_id),
d AS (SELECT user_id, count(*) AS num_steps, (user_id % 2) * count(*) FILTER (WHERE event_type = 'purchase') AS sv, (user_id % 2) * count(*) FILTER (WHERE event_type = 'click') AS rv, user_id % 3 AS ni FROM events GROUP BY user_id),
x AS (SELECT d.*, coalesce(n, 0) AS n, coalesce(s, 0) AS s, coalesce(r, 0) AS r, sv + rv > 0 OR coalesce(n, 0) = 0 AS told FROM d LEFT JOIN a USING (user_id)),
y AS (SELECT *, CASE WHEN told THEN sv ELSE s END AS strict, CASE WHEN told THEN rv ELSE r END AS back FROM x)
SELECT user_id, greatest(num_steps, n, strict + back) AS steps, strict AS strict_valid, back AS recovered_valid, strict + back AS valid, greatest(0, CASE WHEN told THEN CASE WHEN ni > 0 THEN ni ELSE greatest(num_steps, n) - strict - back END ELSE ni + n - s - r END) AS invalid FROM y
""")
def q_action_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    t, odd = F.col("event_type"), F.col("user_id") % 2
    actions = e.where("value > 5").select("user_id", (t != "error").alias("parsed_ok"), (F.col("value") < 20).alias("recovered"))
    declared = e.groupBy("user_id").agg(F.count("*").alias("num_steps"), (F.first(odd) * F.count_if(t == "purchase")).alias("strict_valid"), (F.first(odd) * F.count_if(t == "click")).alias("recovered_valid"), F.first(F.col("user_id") % 3).alias("num_invalid"))
    return E.action_stats(actions, declared, "user_id")


@query("""
WITH s AS (SELECT length(text) AS l, turn * 1.5::DOUBLE AS t FROM conversations), m AS (SELECT max(l) AS top, sum(l) AS total FROM s), i AS (SELECT avg(t) AS idle FROM s, m WHERE l = top)
SELECT round(total / 3600.0::DOUBLE / 8, 6) AS tokens_per_worker_second, round(top / 3600.0::DOUBLE, 6) AS longest_tokens_per_second, round(idle, 6) AS longest_idle, round(top / (3600 - idle), 6) AS longest_tokens_per_busy_second FROM m, i
""")
def q_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.char_length("text").cast("long").alias("l"), (F.col("turn") * F.lit(1.5)).alias("t"))
    out = E.throughput(rows, 3600.0, 8, "l", "t")
    return out.select(*[r6(F.col(c)).alias(c) for c in out.columns])


@query("""
WITH m AS (SELECT event_id, user_id, 1 + CASE WHEN value > 50 THEN 1 ELSE 0 END + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS s FROM events)
SELECT event_id, s::BIGINT AS mask_sum, sum(s) OVER (PARTITION BY user_id)::BIGINT AS group_mask_sum FROM m
""")
def q_mask_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.array(F.lit(1), (F.col("value") > 50).cast("int"), (F.col("event_type") == "click").cast("int"))
    return E.mask_sums(table(spark, sf_dir, "events").select("event_id", "user_id", mask.alias("mask")), "user_id", "mask").select("event_id", "mask_sum", "group_mask_sum")


@query("""
SELECT l_returnflag AS batch, CAST(grouping(l_returnflag) AS TINYINT) AS overall, count(*) AS n, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS price, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())
""")
def q_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "batch")
    measures = {"n": F.count("*"), "price": F.round(E.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")), 4), "suppliers": F.count_distinct("l_suppkey")}
    return E.by_batch(rows, "batch", measures)


@query(f"""
WITH {DAILY}, s AS (SELECT day, user_id, list_distinct(chain) AS s FROM daily),
p AS (SELECT a.day, len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s)))::DOUBLE AS j FROM s a JOIN s b ON a.day = b.day AND a.user_id < b.user_id),
n AS (SELECT day, count(*) AS records FROM s GROUP BY day)
SELECT n.day, records, count(j) AS pairs, round(avg(j), 6) AS mean_jaccard FROM n LEFT JOIN p USING (day) GROUP BY ALL
""")
def q_similarity_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' sets of event types of a day, all pairs of a day."""
    out = E.set_similarity_within(daily(spark, sf_dir), "day", "chain")
    return out.select("day", "records", "pairs", r6(F.col("mean_jaccard")).alias("mean_jaccard"))


@query("""
WITH r AS (SELECT event_type, value, value > 20 AS ok, list_filter([CASE WHEN value < 10 THEN 'low' END, CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'weekend' END], lambda x: x IS NOT NULL) AS why FROM events),
s AS (SELECT event_type, count(*) AS samples, count(*) FILTER (WHERE ok) AS scored, round(coalesce(avg(value) FILTER (WHERE ok), 0), 4) AS mean FROM r GROUP BY event_type),
w AS (SELECT event_type, reason, count(*) AS n FROM (SELECT event_type, unnest(why) AS reason FROM r) GROUP BY ALL)
SELECT s.*, reason, n FROM s LEFT JOIN w USING (event_type)
""")
def q_eligible_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = F.array_compact(F.array(F.when(F.col("value") < 10, "low"), F.when(F.dayofweek("ts").isin(1, 7), "weekend")))
    rows = table(spark, sf_dir, "events").select("event_type", "value", (F.col("value") > 20).alias("ok"), why.alias("why"))
    return E.eligible_summary(rows, "event_type", "value", "ok", "why").withColumn("mean", F.round("mean", 4))


@query(r"""
SELECT role, count(*) AS rows, count(*) FILTER (WHERE contains(text, chr(10))) AS many_lines, count(*) FILTER (WHERE length(text) > 500) AS long, round(avg(CASE WHEN regexp_matches(text, '[0-9]') THEN length(text) END), 4) AS mean_with_digits FROM conversations GROUP BY role
""")
def q_status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    out = E.status_totals(table(spark, sf_dir, "conversations"), "role", {"many_lines": F.contains(t, F.lit("\n")), "long": F.char_length(t) > 500}, {"mean_with_digits": F.when(t.rlike("[0-9]"), F.char_length(t))})
    return out.withColumn("mean_with_digits", F.round("mean_with_digits", 4))


@query("""
SELECT l_returnflag, round_even(quantile_cont(l_extendedprice, 0.9), 2) AS threshold, count(*) FILTER (WHERE l_quantity >= 10 AND l_discount <= 0.05 AND l_tax < 0.06) AS selected FROM lineitem GROUP BY l_returnflag
""")
def q_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    chosen = E.within_limits(rows, {"l_quantity": (">=", 10), "l_discount": ("<=", 0.05), "l_tax": ("<", 0.06)}).groupBy("l_returnflag").agg(F.count("*").alias("selected"))
    return rows.groupBy("l_returnflag").agg(E.rounded_quantile(F.col("l_extendedprice"), 0.9).alias("threshold")).join(chosen, "l_returnflag")


@query(f"""
WITH {DAILY}, d AS (SELECT user_id, list(list_distinct(chain) ORDER BY day) AS days FROM daily GROUP BY user_id)
SELECT user_id, CAST(list_position(list_transform(days[2:], lambda p: NOT list_has_any(p, days[1])), true) - 1 AS INTEGER) AS first_free FROM d
""")
def q_first_admissible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first later day whose event types share none with the user's first day."""
    sets = F.transform(F.array_sort(F.collect_list(F.struct("day", F.array_distinct("chain").alias("s")))), lambda x: x["s"])
    rows = daily(spark, sf_dir).groupBy("user_id").agg(sets.alias("d"))
    return rows.select("user_id", E.first_admissible(F.expr("slice(d, 2, size(d))"), F.slice("d", 1, 1)).cast("int").alias("first_free"))


@query(r"""
WITH a AS (SELECT conv_id, turn, text AS b, regexp_replace(text, '^[^\n]*\n', '') AS a FROM conversations),
t AS (SELECT conv_id, CAST(sum(length(b) - length(a)) AS BIGINT) AS reduction FROM a GROUP BY conv_id ORDER BY reduction DESC, conv_id LIMIT 10)
SELECT conv_id, reduction, array_to_string(list(turn ORDER BY turn) FILTER (WHERE a <> b), ',') AS changed FROM t JOIN a USING (conv_id) GROUP BY ALL
""")
def q_largest_reductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that lose most if every message loses its first line."""
    before = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    after = before.withColumn("text", F.regexp_replace("text", r"\A[^\n]*\n", ""))
    return E.largest_reductions(before, after, "conv_id", "turn", "text").withColumn("changed", F.array_join(F.col("changed").cast("array<string>"), ","))


@query("""
WITH p AS (SELECT DISTINCT p_brand AS prefix, 'brand' AS level FROM part UNION ALL SELECT DISTINCT p_brand || ' ' || split_part(p_type, ' ', 1), 'type' FROM part WHERE p_size > 25),
r AS (SELECT p_partkey, p_brand || ' ' || p_type || ' ' || p_size AS k FROM part)
SELECT p_partkey, arg_max(prefix, length(prefix)) AS prefix, arg_max(level, length(prefix)) AS level FROM r JOIN p ON starts_with(k, prefix) GROUP BY p_partkey
""")
def q_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    brands = part.select(F.col("p_brand").alias("prefix")).distinct().withColumn("level", F.lit("brand"))
    kinds = part.where("p_size > 25").select(F.concat_ws(" ", "p_brand", F.split("p_type", " ")[0]).alias("prefix")).distinct().withColumn("level", F.lit("type"))
    rows = part.select("p_partkey", F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string")).alias("k"))
    return E.by_prefix(rows, "k", brands.unionByName(kinds), "prefix").select("p_partkey", "prefix", "level")


@query("""
WITH l AS (SELECT o_custkey AS k, count(*) AS n, min(o_orderstatus) AS s FROM orders WHERE o_orderstatus <> 'P' GROUP BY k), r AS (SELECT o_custkey AS k, count(*) AS n, min(o_orderstatus) AS s FROM orders WHERE o_totalprice > 1000 GROUP BY k)
SELECT coalesce(l.k, r.k) AS k, CASE WHEN l.k IS NULL THEN 'missing_left' WHEN r.k IS NULL THEN 'missing_right' ELSE 'differs' END AS problem FROM l FULL JOIN r USING (k) WHERE l.k IS NULL OR r.k IS NULL OR l.n <> r.n OR l.s <> r.s
""")
def q_differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two derived tables of one key: where they aren't equal."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    made = lambda rows: rows.groupBy("k").agg(F.count("*").alias("n"), F.min("o_orderstatus").alias("s"))
    return E.differing_rows(made(o.where("o_orderstatus <> 'P'")), made(o.where("o_totalprice > 1000")), ["k"], ["n", "s"])


@query("""
WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey + 10 AS k FROM orders)
SELECT k, 'left' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'right' FROM b WHERE k NOT IN (SELECT k FROM a)
""")
def q_keys_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return E.keys_missing(left, table(spark, sf_dir, "orders").select((F.col("o_custkey") + 10).alias("k")), "k")


@query("""
WITH m AS (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN 'user' ELSE 'assistant' END AS role, CASE event_type WHEN 'view' THEN 'call' WHEN 'click' THEN 'result' WHEN 'purchase' THEN 'final' ELSE 'text' END AS kind, day(ts) % 3 AS name FROM events),
b AS (SELECT *, coalesce(max(kind = 'final') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late, role = 'assistant' AND coalesce(lag(role) OVER (PARTITION BY user_id ORDER BY event_id) = 'assistant', false) AS again,
  sum(CASE kind WHEN 'call' THEN 1 WHEN 'result' THEN -1 ELSE 0 END) OVER (PARTITION BY user_id, name ORDER BY event_id) AS bal FROM m),
l AS (SELECT *, least(0, min(bal) OVER (PARTITION BY user_id, name ORDER BY event_id)) AS low FROM b),
z AS (SELECT *, kind = 'result' AND low < coalesce(lag(low) OVER (PARTITION BY user_id, name ORDER BY event_id), 0) AS lost FROM l)
SELECT user_id, count(*) AS turns, count(*) FILTER (WHERE kind = 'call') AS calls, count(*) FILTER (WHERE kind = 'result' AND NOT lost) AS answered, count(*) FILTER (WHERE lost) AS unpaired_results, count(*) FILTER (WHERE late) AS after_final, count(*) FILTER (WHERE again) AS repeated_assistant FROM z GROUP BY user_id
""")
def q_sequence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    kind = F.when(t == "view", "call").when(t == "click", "result").when(t == "purchase", "final").otherwise("text")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(t == "signup", "user").otherwise("assistant").alias("role"), kind.alias("kind"), (F.dayofmonth("ts") % 3).alias("name"))
    return E.sequence_audit(rows, "user_id", "event_id")


@query(r"""
WITH c AS (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n, string_split(coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant'), ''), chr(10)) AS lines FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN n <> 1 THEN 'not_one_assistant_turn' WHEN len(list_filter(lines, lambda x: trim(x) = '')) > 0 THEN 'invalid_subgoal' END AS problem FROM c
""")
def q_plan_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's assistant lines as a plan's objectives."""
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))), lambda x: x["text"]), "\n")
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("n"), said.alias("t"))
    goals = F.transform(F.split("t", "\n"), lambda x, i: F.struct(i.alias("step"), x.alias("objective")))
    content = F.concat(F.lit("<plan>"), F.to_json(F.struct(goals.alias("subgoals"))), F.lit("</plan>"))
    return rows.select("conv_id", E.plan_problem(F.col("n"), content).alias("problem"))


@query(r"""
WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles, arg_max(role, turn) AS last, arg_max(text, turn) AS t, arg_min(text, turn) AS f, count(*) AS n FROM conversations GROUP BY conv_id),
r AS (SELECT conv_id, roles, CASE last WHEN 'assistant' THEN 'tool_call' WHEN 'user' THEN 'final_answer' END AS d, list_filter(string_split(t, ' ')[1:3], lambda w: length(w) > 4) AS calls, CASE WHEN n % 2 = 0 THEN t END AS fin, string_split(f, ' ')[1:3] AS allowed FROM c),
e AS (SELECT conv_id, list_filter(list_sort([CASE WHEN NOT list_contains(roles, 'user') THEN 'prompt_missing_user_turn' END, CASE WHEN d IS NULL THEN 'invalid_decision_type' END, CASE WHEN d = 'tool_call' AND len(calls) = 0 THEN 'missing_target_tool_calls' END,
  CASE WHEN d = 'tool_call' AND len(list_filter(calls, lambda x: NOT list_contains(allowed, x))) > 0 THEN 'unknown_tool' END, CASE WHEN d = 'final_answer' AND fin IS NULL THEN 'missing_target_final_answer' END]), lambda x: x IS NOT NULL) AS w FROM r)
SELECT 'total_rows' AS code, count(*) AS n FROM e UNION ALL SELECT 'invalid_rows', count(*) FILTER (WHERE len(w) > 0) FROM e UNION ALL SELECT code, count(*) FROM (SELECT unnest(w) AS code FROM e) GROUP BY code
""")
def q_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = lambda f, c: f(c, F.col("turn"))
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(roles.alias("roles"), by(F.max_by, "role").alias("last"), by(F.max_by, "text").alias("t"), by(F.min_by, "text").alias("f"), F.count("*").alias("n"))
    decision = F.when(F.col("last") == "assistant", "tool_call").when(F.col("last") == "user", "final_answer")
    calls = F.filter(F.slice(F.split("t", " "), 1, 3), lambda w: F.char_length(w) > 4)
    reasons = E.training_row_reasons(F.col("roles"), decision, calls, F.when(F.col("n") % 2 == 0, F.col("t")), F.slice(F.split("f", " "), 1, 3))
    return E.validated(rows, reasons, "conv_id")[0]


@query(r"""
WITH s AS (SELECT conv_id, turn, string_split(text, chr(10)) AS s FROM conversations), e AS (SELECT conv_id, turn, s, unnest(range(1, len(s) + 1)) AS i FROM s WHERE len(s) > 1)
SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS place, CAST(CASE WHEN i = 1 THEN 0 ELSE length(array_to_string(s[1:i - 1], chr(10))) + 1 END AS BIGINT) AS prefix_chars, CAST(length(s[i]) AS BIGINT) AS target_chars FROM e
""")
def q_segment_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.segment_targets(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.split("text", "\n"))
    return out.select("conv_id", "turn", "place", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("target").cast("long").alias("target_chars"))


@query(r"""
WITH p AS (SELECT conv_id, turn, role, text, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM conversations),
e AS (SELECT conv_id, turn, prev, unnest(string_split(text, chr(10))) AS seg, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM p WHERE role = 'assistant')
SELECT conv_id, turn, CAST(place AS INTEGER) AS place, CAST(length(seg) AS BIGINT) AS chars, CAST(length(prev) AS BIGINT) AS previous_chars FROM e
""")
def q_editable_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    out = E.editable_segments(c, "conv_id", "turn", "text", F.when(F.col("role") == "user", F.col("text")), F.split("text", "\n"))
    return out.select("conv_id", "turn", "place", F.char_length("segment").cast("long").alias("chars"), F.char_length("previous").cast("long").alias("previous_chars"))


@query()
def q_inferred_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views open a span of their day, clicks close one."""
    t = F.col("event_type")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(t == "view", "start").when(t == "click", "end").otherwise("other").alias("kind"), F.dayofmonth("ts").cast("string").alias("span"))
    return E.inferred_parents(rows, "user_id", "event_id").select("user_id", "event_id", "parent")


@query(r"""
WITH s AS (SELECT conv_id, turn AS place, list_distinct(list(role)) AS names, string_agg(text, chr(10) ORDER BY text) AS t FROM conversations GROUP BY ALL),
c AS (SELECT conv_id, turn AS event, greatest(0, turn - 1 - (turn % 3) * (turn % 2)) AS place, role AS name, split_part(text, ' ', 1) AS value FROM conversations),
p AS (SELECT c.conv_id, c.place, event, CASE WHEN NOT coalesce(list_contains(names, name), false) THEN 'ungrounded_tool' WHEN NOT coalesce(contains(t, value), false) THEN 'ungrounded_value' END AS problem FROM c LEFT JOIN s ON c.conv_id = s.conv_id AND c.place = s.place),
o AS (SELECT conv_id, event, min(place) AS lo, max(place) AS hi FROM c GROUP BY ALL), b AS (SELECT *, lag(hi) OVER (PARTITION BY conv_id ORDER BY event) AS before FROM o)
SELECT * FROM p WHERE problem IS NOT NULL UNION ALL SELECT conv_id, lo, event, 'event_order' FROM b WHERE lo < before
""")
def q_ungrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message's speaker and first word as a claim about an earlier message."""
    c, n = table(spark, sf_dir, "conversations"), F.col("turn")
    sources = c.select("conv_id", n.alias("place"), F.col("role").alias("name"), "text")
    place = F.greatest(F.lit(0), n - 1 - (n % 3) * (n % 2))
    claims = c.select("conv_id", n.alias("event"), place.alias("place"), F.col("role").alias("name"), F.split("text", " ")[0].alias("value"))
    return E.ungrounded(claims, sources, "conv_id", "place")


@query(f"""
WITH {DAILY}, u AS (SELECT user_id, list(list_sort(list_distinct(chain)) ORDER BY day) AS d, list_sort(list_distinct(flatten(list(chain)))) AS inputs FROM daily GROUP BY user_id),
v AS (SELECT user_id, inputs, d[1] AS base, d[2:] AS vs FROM u),
s AS (SELECT user_id, inputs, unnest(CASE WHEN len(vs) > 0 THEN list_transform(range(1, len(vs) + 1), lambda i: {{'n': i, 'c': 'variant', 'r': list_sort(list_distinct(list_concat(base, vs[i])))}}) ELSE [{{'n': 1::BIGINT, 'c': 'default', 'r': base}}] END) AS s FROM v)
SELECT user_id, CAST(s.n AS INTEGER) AS set_no, s.c AS condition, array_to_string(s.r, ',') AS required, array_to_string(list_filter(inputs, lambda x: NOT list_contains(s.r, x)), ',') AS optional FROM s
""")
def q_requirement_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's event types as inputs: those of the first day required, later days as variants."""
    days = F.transform(F.array_sort(F.collect_list(F.struct("day", F.array_sort(F.array_distinct("chain")).alias("s")))), lambda x: x["s"])
    rows = daily(spark, sf_dir).groupBy("user_id").agg(days.alias("d"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("chain")))).alias("inputs"))
    tools = rows.select("user_id", "inputs", F.get("d", 0).alias("required"), F.expr("slice(d, 2, size(d))").alias("variants"))
    out = E.requirement_sets(tools, "user_id")
    return out.select("user_id", "set_no", "condition", joined(F.array_sort("required")).alias("required"), joined("optional").alias("optional"))


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN upper(p_type) ELSE p_type END AS p_type, CASE WHEN p_size > 40 AND p_size % 2 = 0 THEN 0 ELSE p_size END AS p_size FROM part")
def q_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    patch = base.where("p_size > 40").select("p_partkey", F.upper("p_type").alias("p_type"), F.when(F.col("p_size") % 2 == 0, F.lit(0)).alias("p_size"))
    return E.annotated(base, patch, ["p_partkey"], ["p_type", "p_size"])


@query("""
WITH l AS (SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id) SELECT user_id, event_id FROM l WHERE event_type IN ('error', 'view')
""")
def q_open_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type").isin("error", "view"), F.col("event_type")).otherwise("ok").alias("status"))
    return E.open_alerts(log, "user_id", "event_id").select("user_id", "event_id")


@query("""
SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P') AS n FROM orders GROUP BY o_custkey
""")
def q_connectable(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.struct(F.col("o_orderkey").alias("name"), F.when(F.col("o_orderpriority") == "1-URGENT", "control").otherwise("data").alias("kind"), F.when(F.col("o_orderstatus") == "P", "no").alias("state"))
    early = F.col("o_orderkey") < 5000
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.when(early, slot)).alias("a"), F.collect_list(F.when(~early, slot)).alias("b"))
    return rows.select("o_custkey", F.size(E.connectable(F.col("a"), F.col("b"))).cast("long").alias("n"))


@query("""
SELECT event_id, CASE WHEN value < 5 THEN event_type WHEN event_type = 'view' THEN 'browse' WHEN event_type = 'click' THEN 'press' ELSE event_type END AS name, value < 5 AS failed,
  CASE WHEN value < 5 THEN 'kept_failed' WHEN event_type IN ('signup', 'press') THEN 'unknown' WHEN event_type IN ('view', 'click') THEN 'renamed' ELSE 'same' END AS status FROM events
""")
def q_adapted_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("name"), (F.col("value") < 5).alias("failed"))
    renames = spark.createDataFrame([("view", "browse"), ("click", "press")], "old string, new string")
    return E.adapted_calls(calls, renames, spark.createDataFrame([(n,) for n in ("browse", "press", "purchase", "error")], "name string"))


ONTOLOGY = [("click", "valid", True), ("click", "weak", True), ("view", "valid", False), ("purchase", "weak", True), ("error", "invalid", False)]


@query("""
WITH o(t, s, n) AS (VALUES ('click', 'valid', true), ('click', 'weak', true), ('view', 'valid', false), ('purchase', 'weak', true), ('error', 'invalid', false)),
r AS (SELECT event_id, event_type AS t, CASE WHEN value > 60 THEN 'valid' WHEN value > 20 THEN 'weak' ELSE 'invalid' END AS st, CASE WHEN value % 2 < 1.5 THEN 'out' END AS slot FROM events)
SELECT event_id, CASE WHEN t NOT IN (SELECT t FROM o) THEN 'unknown_edge_type' WHEN (t, st) NOT IN (SELECT (t, s) FROM o) THEN 'status_not_allowed' ELSE 'missing_slot' END AS problem FROM r
WHERE t NOT IN (SELECT t FROM o) OR (t, st) NOT IN (SELECT (t, s) FROM o) OR (slot IS NULL AND t IN (SELECT t FROM o WHERE n))
""")
def q_edge_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    edge = F.struct(F.col("event_type").alias("type"), F.when(v % 2 < 1.5, "out").alias("source_slot"), F.lit("in").alias("target_slot"))
    rows = table(spark, sf_dir, "events").select("event_id", F.when(v > 60, "valid").when(v > 20, "weak").otherwise("invalid").alias("relation_status"), F.array(edge).alias("edge_types"))
    return E.edge_problems(rows, spark.createDataFrame(ONTOLOGY, "edge_type string, allowed_status string, needs_slots boolean"), "event_id")


@query(f"""
WITH {DAILY} SELECT user_id, array_to_string(list_sort(list_distinct(list_filter(flatten(list(chain)), lambda x: x <> ''))), ',') AS ids FROM daily GROUP BY user_id
""")
def q_edge_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).groupBy("user_id").agg(F.collect_list(F.struct(F.col("chain").alias("evidence_ids"))).alias("e"))
    return rows.select("user_id", joined(E.edge_evidence(F.col("e"))).alias("ids"))


@query(f"""
WITH {DAILY} SELECT user_id, day, CASE WHEN len(chain) > 2 AND chain[1] = 'error' THEN 'edges_differ' WHEN len(chain) % 2 = 0 THEN 'hops_differ' END AS problem FROM daily
""")
def q_chain_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of a day: those that begin with an error lack their first edge, those of even length a hop."""
    n = F.size("chain")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(F.get("chain", i - 1).alias("source"), F.get("chain", i).alias("target")))
    edges = F.when(n == 1, F.slice(pairs, 1, 0)).when((n > 2) & (F.get("chain", 0) == "error"), F.slice(pairs, F.lit(2), F.greatest(n - 2, F.lit(0)))).otherwise(pairs)
    return daily(spark, sf_dir).select("user_id", "day", E.chain_problem(F.col("chain"), edges, n - 1 - (n % 2 == 0).cast("int")).alias("problem"))


@query("""
WITH m AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY k), w AS (SELECT unnest(range(1, 1001)) AS k)
SELECT coalesce(w.k, m.k) AS k, CASE WHEN m.k IS NULL THEN 'missing' WHEN w.k IS NULL THEN 'unexpected' ELSE 'repeated' END AS problem FROM w FULL JOIN m USING (k) WHERE m.k IS NULL OR w.k IS NULL OR n > 1
""")
def q_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.uncovered(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k", 1, 1000)


@query(f"""
WITH {CHAINS}, s AS (SELECT user_id, CASE user_id % 4 WHEN 0 THEN 'vs' WHEN 1 THEN 'ac' WHEN 2 THEN 'pf' ELSE 'kg' END AS task, list_sort(list_distinct(chain)) AS vs, chain[-8:] AS seen FROM chains),
j AS (SELECT user_id, task, '["' || array_to_string(vs, '","') || '"]' AS vs, vs[1] AS first, '[' || array_to_string(list_transform(seen, lambda x: '{{"tool_name":"' || x || '","status":"' || CASE WHEN x = 'error' THEN 'failed' ELSE 'ok' END || '"}}'), ',') || ']' AS ev FROM s)
SELECT user_id, sha256('{{"task_type":"' || task || '",' || CASE task WHEN 'vs' THEN '"ranked_smiles":' || vs || ',"selected_smiles":"' || first || '"' WHEN 'ac' THEN '"answer_smiles":"' || first || '"' WHEN 'pf' THEN '"selected_smiles":' || vs ELSE '"result":"' || first || '"' END || ',"evidence":' || ev || '}}') AS payload FROM j
""")
def q_final_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("user_id") % 4
    task = F.when(k == 0, "vs").when(k == 1, "ac").when(k == 2, "pf").otherwise("kg")
    rows = chains(spark, sf_dir).withColumn("v", F.array_sort(F.array_distinct("chain")))
    seen = F.transform("chain", lambda x: F.struct(x.alias("tool_name"), F.when(x == "error", "failed").otherwise("ok").alias("status")))
    return rows.select("user_id", F.sha2(E.final_payload(task, F.col("v"), F.get("v", 0), seen), 256).alias("payload"))


@query("""
WITH r AS (SELECT user_id, event_id, 'f' || event_id AS artifact, event_type = 'purchase' AS pref FROM events WHERE event_type <> 'error' AND value > 30)
SELECT user_id, coalesce(arg_max(artifact, event_id) FILTER (WHERE pref), arg_max(artifact, event_id)) AS artifact FROM r GROUP BY user_id
""")
def q_last_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    artifact = F.when(F.col("value") > 30, F.concat(F.lit("f"), F.col("event_id").cast("string")))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", artifact.alias("artifact"), (F.col("event_type") == "purchase").alias("preferred"), (F.col("event_type") == "error").alias("is_error"))
    return E.last_artifact(rows, "user_id", "event_id")


@query("""
WITH x AS (SELECT event_id, event_type <> 'error' AS v, event_id % 3 AS m, event_id % 4 AS p, event_id % 3 AS g, value / 100 AS f, least(1, value / 60) AS rq, least(1, value / 75) AS cr, least(1, value / 90) AS cf, value > 95 AS ex FROM events),
s AS (SELECT *, least(1.0, greatest(-0.5, CASE WHEN NOT v THEN -0.5 WHEN m = 0 THEN -0.4 WHEN m <> p OR m <> g THEN 0.35 * f - 0.05 WHEN rq < 1 THEN 0.3 + 0.2 * rq WHEN cr < 1 THEN 0.55 + 0.15 * cr WHEN cf < 1 THEN 0.72 + 0.13 * cf WHEN ex THEN 1.0 ELSE 0.9 END)) AS staged,
  CASE WHEN NOT v THEN 'invalid_react_tool_envelope' WHEN m = 0 THEN 'wrong_tool' WHEN m <> p OR m <> g THEN 'partial_tool_set' WHEN rq < 1 THEN 'missing_required_arguments' WHEN cr < 1 THEN 'critical_argument_mismatch' WHEN cf < 1 THEN 'invalid_configurable_arguments' WHEN ex THEN 'teacher_equivalent' ELSE 'valid_alternative_configuration' END AS gate,
  CASE WHEN p = 0 AND g = 0 THEN 1.0 ELSE least(1, greatest(0, 0.2 * f + 0.35 * rq + 0.2 * cr + 0.25 * cf)) END AS tools,
  0.5 * CASE WHEN v THEN 1 ELSE 0 END + 0.5 * CASE WHEN v AND CASE WHEN ex THEN m = 0 AND p + g = 0 ELSE p > 0 AND g = 0 AND m <> 0 END THEN 1 ELSE 0 END AS rules FROM x)
SELECT event_id, gate, round(staged, 6)::DOUBLE AS staged, round(tools, 6)::DOUBLE AS tools, round(rules, 6)::DOUBLE AS rules, round(CASE WHEN m = 1 AND cf < 0.3 THEN least(0, CASE p WHEN 0 THEN staged WHEN 1 THEN tools WHEN 2 THEN rules END) ELSE CASE p WHEN 0 THEN staged WHEN 1 THEN tools WHEN 2 THEN rules END END, 6)::DOUBLE AS by_mode FROM s
""")
def q_reward_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, v = F.col("event_id"), F.col("value")
    part = lambda d: F.least(F.lit(1.0), v / d)
    valid, exact = F.col("event_type") != "error", v > 95
    staged = E.staged_reward(valid, i % 3, i % 4, i % 3, v / 100, part(60), part(75), part(90), exact)
    rows = table(spark, sf_dir, "events").withColumn("s", staged)
    rows = rows.withColumns({"tools": E.tool_component(i % 4, i % 3, v / 100, part(60), part(75), part(90)), "rules": E.rule_score(valid, F.when(exact, "final_answer").otherwise("tool_call"), i % 3 == 0, i % 4, i % 3)})
    mode = F.when(i % 4 == 0, "staged").when(i % 4 == 1, "tools").when(i % 4 == 2, "rules").otherwise("none")
    by_mode = E.reward_by_mode(mode, {"staged": F.col("s.score"), "tools": F.col("tools"), "rules": F.col("rules")}, (i % 3 == 1) & (part(90) < 0.3))
    return rows.select("event_id", "s.gate", r6(F.col("s.score")).alias("staged"), r6(F.col("tools")).alias("tools"), r6(F.col("rules")).alias("rules"), r6(by_mode).alias("by_mode"))


@query("""
WITH a AS (SELECT conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p, text, role FROM conversations) SELECT conv_id, turn, CASE WHEN role <> 'system' AND coalesce(lower(p) = lower(text), false) THEN 1.0 ELSE -0.5 END::DOUBLE AS score FROM a
""")
def q_final_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message as the answer that the one before it is the target of."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "conversations").withColumn("p", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    answer = lambda c, s: F.create_map(F.lit("summary"), F.lit(s), F.lit("result"), F.lower(c))
    return rows.select("conv_id", "turn", E.final_reward(F.col("role") != "system", answer(F.col("text"), "a"), F.when(F.col("p").isNotNull(), answer(F.col("p"), "b"))).alias("score"))


@query("""
WITH t AS (SELECT user_id, event_id, value / 100 - event_id % 7 / 10.0::DOUBLE AS d, CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END AS m, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
SELECT user_id, round(sum(d * m) / greatest(sum(m), 1), 6) AS kl, count(*) AS n, round(coalesce(sum(CASE WHEN r <= 5 THEN event_id % 7 / 10.0::DOUBLE END), 0), 6) AS tail FROM t GROUP BY user_id
""")
def q_sequence_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("s"))
    old, new = F.transform("s", lambda x: x["value"] / 100), F.transform("s", lambda x: (x["event_id"] % 7) / F.lit(10.0))
    kl = E.sequence_kl(old, new, F.transform("s", lambda x: F.when(x["event_type"] == "error", 0.0).otherwise(1.0)))
    tail = F.aggregate(E.teacher_tail(new, F.lit(5)), F.lit(0.0), lambda a, x: a + x)
    return rows.select("user_id", r6(F.get(kl, 0)).alias("kl"), F.size(kl).cast("long").alias("n"), r6(tail).alias("tail"))


@query("SELECT conv_id, sha256(string_agg(text, chr(10) ORDER BY turn)) AS text FROM conversations WHERE role = 'assistant' AND trim(text) <> '' GROUP BY conv_id")
def q_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.spoken(table(spark, sf_dir, "conversations"), "conv_id", "turn").select("conv_id", F.sha2("text", 256).alias("text"))


@query(f"""
WITH {CHAINS} SELECT user_id, array_to_string(list_filter(chain, lambda x: x NOT IN ('view', 'error')), ',') AS domain, CAST(len(list_filter(chain, lambda x: x IN ('view', 'error'))) AS INTEGER) AS n_local, len(list_filter(chain, lambda x: x = 'view'))::INTEGER AS views FROM chains
""")
def q_tool_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = E.tool_sequence(F.col("chain"), ("view", "error"))
    return chains(spark, sf_dir).select("user_id", joined(s["domain"]).alias("domain"), s["n_local"].alias("n_local"), F.coalesce(F.element_at(s["local"], "view"), F.lit(0)).alias("views"))


@query(f"""
WITH {CHAINS}, n AS (SELECT user_id, chain, list_filter(range(1, len(chain) + 1), lambda i: chain[i] <> 'error') AS t FROM chains),
e AS (SELECT user_id, chain, t, list_filter(range(1, len(chain)), lambda i: chain[i] <> 'error' AND chain[i + 1] <> 'error') AS e FROM n)
SELECT user_id, array_to_string(list_sort(list_distinct(list_transform(t, lambda i: chain[i]))), ',') AS tools, array_to_string(list_transform(e, lambda i: chain[i] || '>' || chain[i + 1] || ':' || CASE WHEN chain[i] = chain[i + 1] THEN 'again' ELSE 'workflow_transition' END), ',') AS edges FROM e
""")
def q_toolchain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as a graph's nodes, errors among them no tools."""
    nodes = F.transform("chain", lambda t, i: F.struct(i.cast("string").alias("id"), F.when(t == "error", "data").otherwise("tool").alias("type"), t.alias("tool")))
    last = F.size("chain") - 1
    pairs = F.when(last < 1, F.expr("slice(array(0), 1, 0)")).otherwise(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))))
    edges = F.transform(pairs, lambda i: F.struct(i.cast("string").alias("source"), (i + 1).cast("string").alias("target"), F.when(F.get("chain", i) == F.get("chain", i + 1), "again").otherwise("").alias("relation")))
    rows = chains(spark, sf_dir).withColumn("g", E.toolchain(nodes, edges))
    shown = F.transform("g.edges", lambda e: F.concat(e["source_tool"], F.lit(">"), e["target_tool"], F.lit(":"), e["edge_type"]))
    return rows.select("user_id", joined("g.tools").alias("tools"), joined(shown).alias("edges"))


@query(r"""
WITH t AS (SELECT conv_id, turn, text, string_split(text, chr(10)) AS l FROM conversations),
c AS (SELECT conv_id, turn, list_concat(CASE WHEN trim(l[1]) <> '' THEN ['first:' || trim(l[1])] ELSE [] END, list_transform(list_filter(list_transform(l, lambda x: trim(x)), lambda x: x <> ''), lambda x: 'line:' || x)) AS c FROM t)
SELECT conv_id, turn, CAST(len(list_distinct(c)) AS BIGINT) AS n, sha256(coalesce(c[1], '')) AS best FROM c
""")
def q_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    rows = table(spark, sf_dir, "conversations").withColumn("c", K.candidates(("first", F.slice(lines, 1, 1)), ("line", lines)))
    best = F.coalesce(F.concat_ws(":", F.get("c", 0)["source"], F.get("c", 0)["text"]), F.lit(""))
    return rows.select("conv_id", "turn", F.size("c").cast("long").alias("n"), F.sha2(best, 256).alias("best"))


@query(r"""
SELECT conv_id, turn, sha256(CASE WHEN role = 'user' AND trim(text) <> '' THEN trim(text) WHEN role = 'system' THEN 'q ' || turn ELSE '{"turn":"' || turn || '"}' END) AS question, CASE WHEN role = 'user' THEN 'outer' ELSE 'inner' END AS label FROM conversations
""")
def q_question_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of users' messages is the question, a system's is a JSON string, others' is the record."""
    turn, role = F.col("turn").cast("string"), F.col("role")
    fields = (
        F.when(role == "user", F.create_map(F.lit("prompt"), F.col("text"), F.lit("turn"), turn, F.lit("Answer "), F.lit("outer")))
        .when(role == "system", F.create_map(F.lit("question"), F.lit(" "), F.lit("raw_question_json"), F.concat(F.lit('"q '), turn, F.lit('"')))).otherwise(F.create_map(F.lit("turn"), turn, F.lit("f1"), F.lit("0.5")))
    )
    labels = K.labels_of(fields, F.create_map(F.lit("Answer "), F.lit("inner")), ("answer",))
    question = K.question_text(fields, denied=("answer", "f1"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(question, 256).alias("question"), F.element_at(labels, "Answer ").alias("label"))
