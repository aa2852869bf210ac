"""Gates, pairings, merges, audits, decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions import names as N
from loomtrace.operators import gates as G
from loomtrace.operators import pairing as J
from loomtrace.operators import upserts as U
from loomtrace.plans.base import joined, r6, table
from loomtrace.plans.registry import query
from loomtrace.sources.writers import progress


@query("""
WITH t AS (SELECT user_id, arg_max((event_id, value), event_id) FILTER (WHERE event_type = 'error') AS t FROM events GROUP BY user_id)
SELECT user_id, concat_ws(',', CASE WHEN t[2] > 50 THEN 'terminal_result_error' END, CASE WHEN t[1] % 3 = 0 THEN 'terminal_api_error:500' END, CASE WHEN t[1] % 2 = 0 THEN 'terminal_subtype:error_limit' END,
  CASE WHEN t[1] % 5 = 0 THEN 'terminal_reason:aborted' END) AS findings FROM t
""")
def q_terminal_status_last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("event_type") == "error", "result").otherwise("assistant").alias("type"), (F.col("value") > 50).alias("is_error"),
        F.when(i % 3 == 0, "500").otherwise("").alias("api_error_status"), F.when(i % 2 == 0, "error_limit").alias("subtype"), F.when(i % 5 == 0, "aborted").otherwise("done").alias("terminal_reason"),
    )
    return G.terminal_findings(e, ["user_id"], "event_id").select("user_id", joined("findings").alias("findings"))


@query("""
WITH g AS (SELECT doc_id, length(text) >= 200 AS a, lang = 'en' AS b, NOT regexp_matches(text, '[#$%&]{3}') AS c FROM documents)
SELECT doc_id, CASE WHEN a AND b AND c THEN 'accepted' ELSE 'rejected' END AS status,
  concat_ws(',', CASE WHEN NOT a THEN 'execution_invalid' END, CASE WHEN NOT b THEN 'task_answer_invalid' END, CASE WHEN NOT c THEN 'training_trace_invalid' END) AS reasons FROM g
""")
def q_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    s = G.final_status(F.char_length("text") >= 200, F.col("lang") == "en", ~F.col("text").rlike("[#$%&]{3}"))
    return d.select("doc_id", s["status"].alias("status"), joined(s["reasons"]).alias("reasons"))


@query("""
WITH r AS (SELECT user_id, bool_or(event_type = 'purchase') AS done, bool_or(event_type = 'click') AS used, count(*) FILTER (WHERE event_type = 'error' AND value > 80) AS failed, count(DISTINCT event_type) / 5 AS coverage FROM events GROUP BY user_id),
f AS (SELECT *, CASE WHEN done AND used AND failed = 0 THEN 'success' WHEN NOT done THEN 'execution_failure' WHEN failed > 0 THEN 'tool_call_failure' WHEN NOT used THEN 'no_tool_use' ELSE 'execution_failure' END AS kind FROM r)
SELECT user_id, kind AS failure_type, CASE WHEN kind = 'success' THEN CASE WHEN coverage < 0.5 THEN 'downweight' ELSE 'keep' END WHEN kind = 'no_tool_use' THEN 'reject' WHEN kind = 'tool_call_failure' THEN 'downweight' ELSE 'needs_manual_review' END AS recommendation FROM f
""")
def q_failure_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    r = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.bool_or(t == "purchase").alias("done"), F.bool_or(t == "click").alias("used"), F.count_if((t == "error") & (F.col("value") > 80)).alias("failed"), (F.count_distinct("event_type") / 5).alias("coverage"),
    )
    f = r.withColumn("failure_type", G.failure_type(F.col("done"), F.col("used"), F.col("failed")))
    return f.select("user_id", "failure_type", G.recommendation(F.col("failure_type"), F.col("coverage")).alias("recommendation"))


@query("""
WITH s AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN ' Failed ' WHEN 1 THEN 'ok' WHEN 2 THEN 'running' END AS o, CASE event_id % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'TIMEOUT' END AS c,
  CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS p, CASE event_id % 4 WHEN 0 THEN false END AS e, CASE WHEN event_type = 'error' THEN 'bad' END AS err FROM events),
l AS (SELECT *, lower(trim(coalesce(o, ''))) AS lo, lower(trim(coalesce(c, ''))) AS lc FROM s),
b AS (SELECT *, lo IN ('failed') OR lc IN ('timeout') OR coalesce(p, false) OR coalesce(e, false) OR err IS NOT NULL AS bad, lo = 'ok' OR lc = 'success' OR coalesce(NOT p, false) OR coalesce(NOT e, false) AS good FROM l)
SELECT event_id, bad AS is_error, CASE WHEN bad THEN 'error' ELSE coalesce(nullif(lc, ''), nullif(lo, ''), 'success') END AS status, bad AND good AS conflict FROM b
""")
def q_observation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    o = F.when(i % 7 == 0, " Failed ").when(i % 7 == 1, "ok").when(i % 7 == 2, "running")
    c = F.when(i % 5 == 0, "success").when(i % 5 == 1, "TIMEOUT")
    s = G.observation_status(o, c, F.when(i % 3 == 0, True).when(i % 3 == 1, False), F.when(i % 4 == 0, False), F.when(F.col("event_type") == "error", "bad"))
    return table(spark, sf_dir, "events").withColumn("s", s).select("event_id", "s.is_error", "s.status", "s.conflict")


@query("""
WITH s AS (SELECT event_id, event_id % 11 <> 0 AS tr, event_id % 7 <> 0 AS sc, CASE event_id % 5 WHEN 0 THEN true END AS er, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'OK' ELSE 'odd' END AS st FROM events),
k AS (SELECT *, CASE WHEN NOT tr THEN 'TransportError' WHEN NOT sc THEN 'ToolValidationError' WHEN coalesce(er, false) THEN 'ToolRuntimeError' WHEN lower(st) = 'failed' THEN 'ToolStatusError' WHEN lower(st) = 'ok' THEN '' ELSE 'ToolSemanticUnknown' END AS kind FROM s)
SELECT event_id, kind IN ('', 'ToolSemanticUnknown') AS execution, kind = '' AS semantic, kind = 'ToolSemanticUnknown' AS unknown, nullif(kind, '') AS error_type FROM k
""")
def q_tool_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "OK").otherwise("odd")
    s = G.tool_success(i % 11 != 0, i % 7 != 0, F.when(i % 5 == 0, True), status)
    return table(spark, sf_dir, "events").withColumn("s", s).select("event_id", "s.*")


@query("""
SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'failure' WHEN bool_or(event_type = 'purchase') THEN 'success' WHEN count(*) FILTER (WHERE event_type IN ('view', 'error', 'purchase')) > 0 THEN 'unknown' ELSE 'missing' END AS outcome
FROM events GROUP BY user_id
""")
def q_observation_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    status = F.when(t == "error", "failed").when(t == "purchase", "completed").when(t == "view", "running")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(G.observation_outcome(F.lit(None).cast("boolean"), status).alias("outcome"))


@query("""
WITH w AS (SELECT *, lag(role) OVER o AS p, lead(role) OVER o AS nx FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, count(*) AS n_messages, concat_ws(',', CASE WHEN bool_or(role = 'assistant' AND p = 'assistant') THEN 'consecutive_assistant_messages' END, CASE WHEN NOT bool_or(nx IS NULL AND role = 'assistant') THEN 'missing_final_answer' END) AS findings FROM w GROUP BY conv_id
""")
def q_sequence_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = G.sequence_findings(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")
    return rows.select("conv_id", "n_messages", joined(F.array_remove("findings", "unsanitized_path")).alias("findings"))


@query("""
SELECT user_id, count(*) FILTER (WHERE n > 0) AS answered, count(*) FILTER (WHERE n = 0) AS orphans FROM
 (SELECT c.user_id, c.event_id, (SELECT count(*) FROM events r WHERE r.event_type = 'purchase' AND r.user_id = c.user_id AND day(r.ts) = day(c.ts)) AS n FROM events c WHERE c.event_type = 'click') GROUP BY user_id
""")
def q_call_result_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    known, orphans = J.answered(e.where("event_type = 'click'"), e.where("event_type = 'purchase'"), ["user_id", "day"])
    both = known.select("user_id", F.lit(1).alias("a")).unionByName(orphans.select("user_id", F.lit(0).alias("a")))
    return both.groupBy("user_id").agg(F.count_if(F.col("a") == 1).alias("answered"), F.count_if(F.col("a") == 0).alias("orphans"))


@query("""
WITH c AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events WHERE event_type = 'view'),
r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events WHERE event_type = 'click')
SELECT c.user_id, c.event_id, r.event_id AS result_event_id FROM c LEFT JOIN r USING (user_id, k)
""")
def q_fifo_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    pick = lambda t: e.where(F.col("event_type") == t).drop("event_type")
    return J.fifo_pairs(pick("view"), pick("click"), ["user_id"], "event_id")


@query("""SELECT user_id, event_id, event_type, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.latest_by_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", r6(F.col("value")).alias("value"))


@query("""
WITH b AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0), u AS (SELECT o_orderkey, 'U' AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 5 = 0)
SELECT * FROM u UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)
""")
def q_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return U.upsert(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("U")), "o_orderkey", ["o_orderkey"])


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def q_unique_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("""
WITH h AS (SELECT DISTINCT sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS k FROM documents WHERE doc_id % 10 = 0),
d AS (SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS k FROM documents WHERE doc_id % 10 <> 0)
SELECT doc_id, k IN (SELECT k FROM h) AS excluded FROM d
""")
def q_decontaminate_prompt_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    kept, out = U.decontaminate(d.where("doc_id % 10 <> 0"), d.where("doc_id % 10 = 0"), lambda t: N.prompt_hash(t["text"]))
    return kept.select("doc_id", F.lit(False).alias("excluded")).unionByName(out.select("doc_id", F.lit(True).alias("excluded")))


@query("""
WITH e AS (SELECT o_orderkey AS k, count(*) AS expected FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1), a AS (SELECT l_orderkey AS k, count(*) AS actual FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
SELECT k, coalesce(expected, 0) AS expected, coalesce(actual, 0) AS actual, CASE WHEN expected IS NULL THEN 'unexpected' WHEN actual IS NULL THEN 'omitted' ELSE 'non_unit' END AS problem
FROM e FULL JOIN a USING (k) WHERE expected IS NULL OR actual IS NULL OR actual <> 1
""")
def q_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("k"))
    return U.audit_counts(o, table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("k")), "k")


@query("""
SELECT l_partkey AS k, 'unknown' AS side FROM (SELECT DISTINCT l_partkey FROM lineitem) WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)
UNION ALL SELECT p_partkey, 'uncovered' FROM part WHERE p_size > 5 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem)
""")
def q_coverage_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"))
    return G.coverage_errors(rows, table(spark, sf_dir, "part").where("p_size > 5").select(F.col("p_partkey").alias("k")), "k")


@query("""SELECT doc_id, concat_ws(',', CASE WHEN lang = 'en' THEN 'lang' END, CASE WHEN n_chars % 2 = 0 THEN 'n_chars' END) AS changed FROM documents""")
def q_changed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    after = d.withColumns({"lang": F.when(F.col("lang") == "en", None).otherwise(F.col("lang")), "n_chars": F.col("n_chars") + (F.col("n_chars") % 2 == 0).cast("int")})
    return U.changed_facts(d, after, "doc_id", ["lang", "source", "n_chars"]).select("doc_id", joined("changed").alias("changed"))


@query("""
WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'delete' WHEN turn % 3 = 1 THEN 'replace' ELSE 'keep' END AS action FROM conversations WHERE conv_id % 2 = 0),
bad AS (SELECT conv_id FROM conversations WHERE conv_id % 10 = 0)
SELECT conv_id, sha256(string_agg(CASE WHEN action = 'replace' THEN 'x' || turn ELSE text END, '' ORDER BY turn)) AS text_sha256 FROM
 (SELECT c.conv_id, c.turn, c.text, CASE WHEN c.conv_id % 10 = 0 THEN NULL ELSE p.action END AS action FROM conversations c LEFT JOIN p ON p.conv_id = c.conv_id AND p.turn = c.turn) WHERE action IS DISTINCT FROM 'delete' GROUP BY conv_id
""")
def q_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations divisible by 10 also get a patch of a turn they lack, which reverts them whole."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    action = F.when(F.col("turn") % 3 == 0, "delete").when(F.col("turn") % 3 == 1, "replace").otherwise("keep")
    p = c.where("conv_id % 2 = 0").select("conv_id", "turn", action.alias("action"), F.concat(F.lit("x"), F.col("turn").cast("string")).alias("new_text"))
    stray = c.where("conv_id % 10 = 0").select("conv_id", F.lit(10_000).cast("long").alias("turn"), F.lit("delete").alias("action"), F.lit("").alias("new_text")).distinct()
    out = U.reassemble(U.patch(c, p.unionByName(stray), ["conv_id", "turn"]), ["conv_id"], "turn")
    return out.select("conv_id", F.sha2("text", 256).alias("text_sha256"))


@query("""
SELECT o_orderstatus AS suite, o_orderpriority AS status, CASE WHEN o_totalprice > 200000 THEN 'limit' ELSE 'final' END AS done_reason, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = 'completed') AS completed
FROM orders GROUP BY GROUPING SETS ((1), (2), (3), ())
""")
def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("suite"), F.col("o_orderpriority").alias("status"), F.when(F.col("o_totalprice") > 200000, "limit").otherwise("final").alias("done_reason"))
    return progress(o).select("suite", "status", "done_reason", "n", "completed")


@query("""
SELECT 'customer' AS kind, c_custkey AS id, c_nationkey AS nation, NULL::DOUBLE AS price FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, NULL FROM supplier UNION ALL SELECT 'part', p_partkey, NULL, round(p_retailprice, 2) FROM part
""")
def q_tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.round("p_retailprice", 2).alias("price"))
    return U.tagged_union({"customer": c, "supplier": s, "part": p})


@query("""
SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(lower(text), '(^|[^a-z0-9])the($|[^a-z0-9])') THEN 'the' END, CASE WHEN regexp_matches(lower(text), '(^|[^a-z0-9])der($|[^a-z0-9])') THEN 'der' END,
  CASE WHEN regexp_matches(lower(text), '(^|[^a-z0-9])license($|[^a-z0-9])') THEN 'License' END) AS leaks, contains(lower(text), 'apache') OR contains(lower(text), 'password') AS holds_phrase FROM documents
""")
def q_tool_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(F.lit("the"), F.lit("der"), F.lit("License"))
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", joined(G.leaks(F.col("text"), names)).alias("leaks"), G.holds_any(F.col("text"), ("Apache", "password")).alias("holds_phrase"))


@query("""
WITH n AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'mcp__tools__' || event_type WHEN 1 THEN event_type WHEN 2 THEN 'mcp__a__b__' || event_type ELSE 'x__' || event_type END AS name FROM events)
SELECT event_id, CASE WHEN starts_with(name, 'mcp__tools__') THEN substr(name, 13) END AS bare, regexp_replace(name, '^mcp__.*__', '') AS without_server, string_split(name, '__')[-1] AS last_segment, regexp_replace(name, '^(?:mcp__[a-z]+__)', '') AS without_prefix,
  'call::' || substr(sha256(name || '::' || event_id), 1, 20) AS key, sha256(json(props)::VARCHAR) AS hashed FROM n JOIN events USING (event_id)
""")
def q_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, t = F.col("event_id"), F.col("event_type")
    name = F.when(i % 4 == 0, F.concat(F.lit("mcp__tools__"), t)).when(i % 4 == 1, t).when(i % 4 == 2, F.concat(F.lit("mcp__a__b__"), t)).otherwise(F.concat(F.lit("x__"), t))
    n = F.col("name")
    return table(spark, sf_dir, "events").withColumn("name", name).select(
        "event_id", N.bare_name(n, "mcp__tools__").alias("bare"), N.without_server(n).alias("without_server"), N.last_segment(n).alias("last_segment"), N.without_prefix(n, "mcp__[a-z]+__").alias("without_prefix"),
        N.surrogate_key("call", n, i.cast("string")).alias("key"), N.content_hash(F.col("props")).alias("hashed"),
    )


@query("""
WITH e AS (SELECT user_id, d AS day FROM (SELECT DISTINCT user_id FROM events), range(1, 31) AS r(d)) SELECT user_id, CAST(day AS BIGINT) AS day FROM e ANTI JOIN (SELECT user_id, day(ts) AS day FROM events) a USING (user_id, day)
""")
def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    expected = e.select("user_id").distinct().withColumn("day", F.explode(F.array(*[F.lit(d).cast("long") for d in range(1, 31)])))
    return expected.join(e.select("user_id", F.dayofmonth("ts").cast("long").alias("day")).distinct(), ["user_id", "day"], "left_anti")


@query("""
WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'view'), b AS (SELECT user_id, event_id AS right_event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'signup')
SELECT user_id, place, event_id, right_event_id FROM a FULL JOIN b USING (user_id, place)
""")
def q_positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    pick = lambda t: e.where(F.col("event_type") == t).drop("event_type")
    out = U.positional_join(pick("view"), pick("signup"), ["user_id"], "event_id")
    return out.withColumn("place", F.col("place").cast("long"))
