"""Tagged messages, graders, reconstruction, compaction and chunking over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions import answers as A
from loomtrace.operators import curation as C
from loomtrace.operators import rewards as W
from loomtrace.plans.base import chains, joined, r6, table
from loomtrace.plans.registry import query
from loomtrace.plans.texts import normal


#: Blocks made of a message's first words, a kind by each word's length; the same in SQL.
BLOCK_SQL = """CASE length(w) % 6 WHEN 0 THEN '<thought>' || w || '</thought>' WHEN 1 THEN '<tool_call>{"tool_name":"' || w || '","arguments":{}}</tool_call>' WHEN 2 THEN '<final_answer>{"a":"' || w || '"}</final_answer>'
  WHEN 3 THEN w WHEN 4 THEN '<tool_call>[1]</tool_call>' ELSE '<observation>{}</observation>' END"""


def _block(w: Column) -> Column:
    n = F.char_length(w) % 6
    call = F.concat(F.lit('<tool_call>{"tool_name":"'), w, F.lit('","arguments":{}}</tool_call>'))
    final = F.concat(F.lit('<final_answer>{"a":"'), w, F.lit('"}</final_answer>'))
    return F.when(n == 0, F.concat(F.lit("<thought>"), w, F.lit("</thought>"))).when(n == 1, call).when(n == 2, final).when(n == 3, w).when(n == 4, "<tool_call>[1]</tool_call>").otherwise("<observation>{}</observation>")


@query(rf"""
WITH t AS (SELECT conv_id, turn, array_to_string(list_transform(string_split(text, ' ')[1:1 + turn % 3], lambda w: {BLOCK_SQL}), chr(10)) AS t FROM conversations),
b AS (SELECT conv_id, turn, t, regexp_extract_all(t, '(?s)<thought>.*?</thought>|<tool_call>.*?</tool_call>|<final_answer>.*?</final_answer>|<observation>.*?</observation>') AS b FROM t),
k AS (SELECT *, list_transform(b, lambda x: regexp_extract(x, '^<([a-z_]+)', 1)) AS kinds, list_transform(b, lambda x: regexp_replace(x, '^<[a-z_]+>|</[a-z_]+>$', '', 'g')) AS bodies, regexp_replace(list_reduce(list_concat([t], b), lambda a, x: replace(a, x, '')), '\s+', '', 'g') AS rest FROM b),
n AS (SELECT *, len(list_filter(kinds, lambda x: x = 'tool_call')) AS calls, len(list_filter(kinds, lambda x: x = 'final_answer')) AS finals, len(list_filter(range(1, len(b) + 1), lambda i: kinds[i] <> 'thought' AND NOT json_valid(bodies[i]))) AS bad,
  len(list_filter(range(1, len(b) + 1), lambda i: kinds[i] = 'tool_call' AND CASE WHEN json_valid(bodies[i]) THEN json_type(bodies[i]) <> 'OBJECT' OR json_type(bodies[i], '$.arguments') <> 'OBJECT' ELSE false END)) AS loose FROM k),
e AS (SELECT *, CASE WHEN len(b) = 0 THEN 'no_block' WHEN rest <> '' THEN 'text_outside_blocks' WHEN list_contains(kinds, 'observation') THEN 'observation_by_assistant' WHEN bad > 0 THEN 'invalid_json' WHEN loose > 0 THEN 'invalid_tool_call'
  WHEN calls > 0 AND finals > 0 THEN 'mixed_decision' WHEN finals > 1 THEN 'several_final_answers' WHEN calls = 0 AND finals = 0 THEN 'no_decision' END AS error FROM n)
SELECT conv_id, turn, CASE WHEN error IS NOT NULL THEN 'invalid' WHEN finals > 0 THEN 'final_answer' ELSE 'tool_call' END AS kind, error, len(b) AS n_blocks FROM e
""")
def q_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.slice(F.split("text", " "), F.lit(1), (F.col("turn") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(F.transform(words, _block), "\n").alias("t"))
    d = C.decision(F.col("t"))
    return rows.select("conv_id", "turn", d["kind"].alias("kind"), d["error"].alias("error"), F.size(C.blocks(F.col("t"))).cast("long").alias("n_blocks"))


#: What opens a response, by the length of the message: the order of its blocks.
ORDERS = ("think,answer", "think,search,information,think,answer", "think,search,information,answer", "answer,answer", "think,search,information,think,search,information,think,answer", "think", "think,answer,think")


@query(rf"""
WITH o AS (SELECT conv_id, turn, string_split(text, ' ') AS w, string_split(CASE length(text) % 7 {" ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(ORDERS))} END, ',') AS o FROM conversations),
t AS (SELECT conv_id, turn, w, CASE WHEN len(w) % 4 = 0 THEN '<answer>' || w[1] || '</answer> ' ELSE '' END || CASE WHEN len(w) % 9 = 0 THEN '' ELSE '<|im_start|>assistant' || chr(10) END || array_to_string(list_transform(range(1, len(o) + 1), lambda i: '<' || o[i] || '>' || coalesce(w[i], '') || '</' || o[i] || '>'), ' ') || CASE WHEN len(w) % 5 = 0 THEN ' tail' ELSE '' END AS t FROM o),
v AS (SELECT conv_id, turn, w, contains(t, '<|im_start|>assistant') AND regexp_full_match(regexp_extract(t, '(?s)<\|im_start\|>assistant\s*(.*)$', 1), '(?s)\s*<think>[^<]*</think>\s*(?:<search>[^<]*</search>\s*<information>[^<]*</information>\s*<think>[^<]*</think>\s*)*<answer>[^<]*</answer>\s*') AS valid,
  regexp_extract_all(t, '(?s)<answer>(.*?)</answer>', 1) AS a, regexp_extract_all(t, '(?s)<information>(.*?)</information>', 1) AS f FROM t),
x AS (SELECT conv_id, turn, valid, CASE WHEN len(a) > 1 THEN trim(a[-1]) END AS answer, {{norm_gold}} AS g, f FROM v),
y AS (SELECT *, len(list_filter(f, lambda i: contains({{norm_i}}, g))) > 0 AS hit, CASE WHEN answer IS NOT NULL THEN {{norm_answer}} = g END AS same FROM x)
SELECT conv_id, turn, valid, answer, round(CASE WHEN same THEN CASE WHEN valid THEN 1.0 ELSE 0.8 END WHEN valid AND hit THEN 0.3 WHEN valid THEN 0.2 WHEN answer IS NOT NULL THEN 0.1 ELSE 0.0 END, 6)::DOUBLE AS score FROM y
""".replace("{norm_gold}", normal("coalesce(w[2], '')")).replace("{norm_i}", normal("i")).replace("{norm_answer}", normal("answer")))
def q_tag_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-style responses of a message's words: the order of tags, the answer, and the ladder of scores."""
    n, w = F.char_length("text") % len(ORDERS), F.col("w")
    orders = F.coalesce(*[F.when(n == i, F.split(F.lit(o), ",")) for i, o in enumerate(ORDERS)])
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ").alias("w"), orders.alias("o"))
    blocks = F.transform("o", lambda o, i: F.concat(F.lit("<"), o, F.lit(">"), F.coalesce(F.get(w, i), F.lit("")), F.lit("</"), o, F.lit(">")))
    early = F.when(F.size(w) % 4 == 0, F.concat(F.lit("<answer>"), F.get(w, 0), F.lit("</answer> "))).otherwise("")
    mark = F.when(F.size(w) % 9 == 0, "").otherwise("<|im_start|>assistant\n")
    rows = rows.withColumn("t", F.concat(early, mark, F.array_join(blocks, " "), F.when(F.size(w) % 5 == 0, " tail").otherwise("")))
    c, golds = F.col("t"), F.array(F.coalesce(F.get(w, 1), F.lit("")))
    rows = rows.withColumns({"valid": A.tag_order_valid(c), "answer": A.last_answer(c), "hit": A.retrieved(c, golds)})
    score = W.em_reward(F.col("valid"), F.col("answer"), golds, F.col("hit"))
    return rows.select("conv_id", "turn", "valid", "answer", r6(score).alias("score"))


@query("""
WITH u AS (SELECT user_id, list(event_type ORDER BY ts, event_id) AS chain FROM events GROUP BY user_id),
n AS (SELECT user_id, list_filter(list_transform(chain, lambda t: CASE WHEN t IN ('view', 'click') THEN 'browse' WHEN t = 'purchase' THEN 'buy' END), lambda x: x IS NOT NULL) AS f FROM u),
r AS (SELECT user_id, list_filter(list_transform(range(1, len(f) + 1), lambda i: CASE WHEN i = 1 OR f[i] <> f[i - 1] THEN f[i] END), lambda x: x IS NOT NULL) AS r FROM n)
SELECT user_id, array_to_string(CASE len(r) WHEN 0 THEN ['analyze', 'synthesize'] WHEN 1 THEN list_append(r, 'synthesize') ELSE r END, ',') AS plan FROM r
""")
def q_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains(spark, sf_dir).select("user_id", joined(C.plan(F.col("chain"), {"^(view|click)$": "browse", "^purchase$": "buy"})).alias("plan"))


@query("SELECT event_id, (event_id + 1) % 10 = 0 OR (event_id + 1) % 33 = 0 OR event_id = 999 AS runs FROM events")
def q_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", C.periodic(F.col("event_id"), 10, 33, 1000).alias("runs"))


@query("""
WITH c AS (SELECT user_id, list(event_type ORDER BY ts, event_id) AS a FROM events GROUP BY user_id),
r AS (SELECT user_id, len(a) AS n, len(list_filter(range(2, len(a) + 1), lambda i: a[i] = a[i - 1])) AS reps, a[-1] AS last FROM c)
SELECT user_id, round(greatest(-0.2, least(0.1, CASE last WHEN 'purchase' THEN 0.1 WHEN 'error' THEN -0.1 ELSE 0 END - least(0.15, greatest(0, n - 25) * 0.01))), 6)::DOUBLE AS efficiency,
  round(greatest(-0.2, least(0.1, 0.05 - least(0.2, reps * 0.05))), 6)::DOUBLE AS progress FROM r
""")
def q_trace_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chains(spark, sf_dir)
    last = F.element_at("chain", -1)
    done = F.when(last == "purchase", "final_answer").when(last == "error", "abort").otherwise("other")
    return rows.select("user_id", r6(W.efficiency(done, F.size("chain"), 50)).alias("efficiency"), r6(W.progress(F.col("chain"), F.col("chain"))).alias("progress"))


@query("""
WITH x AS (SELECT event_id, event_id % 5 > 0 AS valid, event_id % 7 / 7.0::DOUBLE AS f, event_id % 4 AS p, event_id % 3 AS w, event_id % 11 / 11.0::DOUBLE AS pn, event_id % 13 / 13.0::DOUBLE AS pv, event_id % 6 AS m FROM events),
q AS (SELECT *, 0.10 * (CASE WHEN valid THEN 1 ELSE 0 END) + 0.55 * f + 0.10 * (CASE WHEN greatest(p, w) > 0 THEN 1 - abs(p - w) / greatest(p, w) ELSE 1 END) + 0.10 * pn + 0.15 * pv AS q FROM x)
SELECT event_id, round(CASE WHEN NOT valid OR m = 0 THEN -0.5 ELSE least(1, greatest(-0.5, 1.5 * q - 0.5)) END, 6)::DOUBLE AS score FROM q
""")
def q_decision_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    score = W.decision_reward(i % 5 > 0, (i % 7) / F.lit(7.0), i % 4, i % 3, (i % 11) / F.lit(11.0), (i % 13) / F.lit(13.0), i % 6)
    return table(spark, sf_dir, "events").select("event_id", r6(score).alias("score"))


@query()
def q_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions: views are calls, clicks their results in order of the user's day, purchases said."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    kind = F.when(t == "view", "tool_use").when(t == "click", "tool_result").otherwise("text")
    rows = e.select("user_id", "event_id", F.when(t == "signup", "user").otherwise("assistant").alias("role"), kind.alias("kind"), F.dayofmonth("ts").cast("string").alias("call_id"), t.alias("name"), F.col("event_id").cast("string").alias("body"))
    first = rows.where("kind = 'tool_use'").dropDuplicates(["user_id", "call_id"])
    out = C.reconstruct(rows.where("kind <> 'tool_use'").unionByName(first), "user_id", "event_id")
    return out.groupBy("user_id").agg(F.count("*").alias("turns"), F.sum(F.char_length("text")).alias("chars"))


@query()
def q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.chunks(d, "text", 2000, 100).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.max(F.char_length("text")).alias("longest"))


@query()
def q_compact_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.to_json(F.struct("text", "turn")).alias("text"))
    out = C.compact_old_observations(c, "conv_id", "turn", 800, 1)
    return out.select("conv_id", "turn", F.char_length("text").cast("long").alias("chars"))


@query()
def q_near_thoughts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("lines"))
    return d.select("conv_id", "turn", F.size("lines").cast("long").alias("n"), F.size(C.merge_near_thoughts("lines")).cast("long").alias("left"))


@query()
def q_math_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    text = F.when(i % 3 == 0, F.concat(F.lit("so\nAnswer: $\\frac{"), i.cast("string"), F.lit("}{2}$"))).when(i % 3 == 1, F.concat(F.lit("Answer: "), F.format_number(i, 0))).otherwise("none")
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("t"), F.when(i % 3 == 0, (i / 2).cast("string")).otherwise(i.cast("string")).alias("gold"))
    m = A.math_score(F.col("t"), F.col("gold"))
    return rows.select("event_id", m["score"].alias("score"), m["acc"].alias("acc"))
