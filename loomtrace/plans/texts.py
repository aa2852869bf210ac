"""Answers, references, excerpts, rewards and losses, sources, streams, plug-ins."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions import registry as X
from loomtrace.functions.lineage import shared_folder
from loomtrace.functions import sets
from loomtrace.functions import text as C
from loomtrace.operators import gates as G
from loomtrace.operators import graph
from loomtrace.operators import rewards as W
from loomtrace.plans.base import joined, r6, table
from loomtrace.plans.registry import query
from loomtrace.sources import readers
from loomtrace.streaming import groups

PUNCT = "'!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~'"


def normal(x: str) -> str:
    """The SQL of ``text.normal_answer``."""
    return f"array_to_string(list_filter(string_split_regex(translate(lower({x}), {PUNCT}, ''), '\\s+'), lambda w: w NOT IN ('a', 'an', 'the', '')), ' ')"


@query(f"""
WITH a AS (SELECT b.item_id, {normal("b.text")} AS p, {normal("n.text")} AS g FROM benchmark b JOIN benchmark n ON n.item_id = b.item_id + 1),
t AS (SELECT item_id, p, g, list_filter(string_split(p, ' '), lambda w: w <> '') AS x, list_filter(string_split(g, ' '), lambda w: w <> '') AS y FROM a),
c AS (SELECT *, list_sum(list_transform(list_intersect(list_distinct(x), list_distinct(y)), lambda w: least(len(list_filter(x, lambda z: z = w)), len(list_filter(y, lambda z: z = w))))) AS s FROM t)
SELECT item_id, sha256(p) AS normal_sha256, round(coalesce(2 * (s / len(x)) * (s / len(y)) / (s / len(x) + s / len(y)), 0), 6) AS f1, round(coalesce(s / len(x), 0), 6) AS "precision", p = g AS "exact" FROM c
""")
def q_answer_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    head = F.col("next")
    b = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("next")), "item_id")
    f = C.token_f1(F.col("text"), head)
    rows = b.select("item_id", F.sha2(C.normal_answer(F.col("text")), 256).alias("normal_sha256"), f.alias("f"), C.exact_match(F.col("text"), F.array(head)).alias("exact"))
    return rows.select("item_id", "normal_sha256", r6(F.col("f.f1")).alias("f1"), r6(F.col("f.precision")).alias("precision"), "exact")


@query(r"""
WITH w AS (SELECT conv_id, turn, text, string_split(text, ' ') AS w FROM conversations),
t AS (SELECT conv_id, turn, CASE length(text) % 4 WHEN 0 THEN text WHEN 1 THEN text || ' the answer is (' || upper(substr(text, 1, 1)) || ')' WHEN 2 THEN '<answer> ' || w[1] || ' </answer>' || text ELSE '<answer> </answer><Solution>' || coalesce(w[2], '') || chr(10) || '</Solution> \boxed{' || upper(substr(text, 1, 1)) || '}' END AS t FROM w)
SELECT conv_id, turn, coalesce(nullif(trim(regexp_extract(t, '(?is)<answer>(.*?)</answer>', 1)), ''), nullif(trim(regexp_extract(t, '(?is)<solution>(.*?)</solution>', 1)), '')) AS answer,
  upper(coalesce(nullif(regexp_extract(t, '(?i)answer\s*(?:is|:)\s*\(?([A-J])\b', 1), ''), nullif(regexp_extract(t, '\\boxed\{\s*\(?([A-J])\)?\s*\}', 1), ''), list_filter(string_split_regex(t, '[^\pL\pN_]+'), lambda x: regexp_full_match(x, '[A-J]'))[-1])) AS letter FROM t
""")
def q_answer_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as they are, and with an answer phrase, block or box of their words."""
    t, n, w = F.col("text"), F.char_length("text") % 4, F.split("text", " ")
    first = F.upper(F.substring(t, 1, 1))
    text = (
        F.when(n == 0, t).when(n == 1, F.concat(t, F.lit(" the answer is ("), first, F.lit(")"))).when(n == 2, F.concat(F.lit("<answer> "), F.get(w, 0), F.lit(" </answer>"), t))
        .otherwise(F.concat(F.lit("<answer> </answer><Solution>"), F.coalesce(F.get(w, 1), F.lit("")), F.lit("\n</Solution> \\boxed{"), first, F.lit("}")))
    )
    return table(spark, sf_dir, "conversations").withColumn("t", text).select("conv_id", "turn", C.answer_block(F.col("t")).alias("answer"), C.final_letter(F.col("t")).alias("letter"))


@query(r"""
WITH v AS (SELECT conv_id, turn, length(text) % 3 AS k, string_split(text, ' ')[1:4] AS w, text FROM conversations),
i AS (SELECT conv_id, turn, CASE k WHEN 0 THEN w WHEN 1 THEN string_split('- ' || replace(text, chr(10), chr(10) || '2. '), chr(10)) ELSE string_split(text, chr(10)) END AS i FROM v),
c AS (SELECT conv_id, turn, list_filter(list_transform(list_filter(list_transform(i, lambda x: trim(x)), lambda x: x <> ''), lambda x: trim(regexp_replace(x, '^\s*(?:[-*•]|\d+[.)])\s+', ''))), lambda x: x <> '') AS c FROM i)
SELECT conv_id, turn, len(c) AS n, sha256(array_to_string(c, '|')) AS items FROM c
""")
def q_json_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message's first words as a JSON list, its lines with bullets, its lines as they are."""
    t, n = F.col("text"), F.char_length("text") % 3
    value = F.when(n == 0, F.to_json(F.slice(F.split(t, " "), 1, 4))).when(n == 1, F.concat(F.lit("- "), F.replace(t, F.lit("\n"), F.lit("\n2. ")))).otherwise(t)
    items = C.lines_or_json(value)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(items).cast("long").alias("n"), F.sha2(F.array_join(items, "|"), 256).alias("items"))


@query(r"""
WITH w AS (SELECT conv_id, turn, text, string_split(text, ' ') AS w FROM conversations),
t AS (SELECT conv_id, turn, '<artifact:tables/' || coalesce(w[2], '') || '>' AS known, 'see <artifact:files/' || w[1] || '> and <artifact:tables/' || coalesce(w[2], '') || '> and <artifact:files/' || w[1] || '> at /data/' || coalesce(w[3], '') || '/x' || turn || '.csv ' || text AS t FROM w),
r AS (SELECT *, list_filter(range(1, len(m) + 1), lambda i: list_position(m, m[i]) = i) AS firsts FROM (SELECT *, regexp_extract_all(t, '<artifact:[^<>\s]+>') AS m FROM t)),
u AS (SELECT *, list_transform(firsts, lambda i: m[i]) AS refs FROM r)
SELECT conv_id, turn, array_to_string(refs, ',') AS refs, sha256(regexp_replace(t, '(^|[^\w:/<])/(?:[\w.@-]+/)+([\w.@-]+)', '\1<artifact:files/\2>', 'g')) AS clean, sha256(list_reduce(list_concat([t], list_filter(refs, lambda x: x <> known)), lambda a, x: replace(a, x, '[unavailable server path]'))) AS known_only FROM u
""")
def q_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References and paths of a message's words, before its text."""
    w = F.split("text", " ")
    at = lambda i: F.coalesce(F.get(w, i), F.lit(""))
    ref, known = F.concat(F.lit("<artifact:files/"), at(0), F.lit(">")), F.concat(F.lit("<artifact:tables/"), at(1), F.lit(">"))
    text = F.concat(F.lit("see "), ref, F.lit(" and "), known, F.lit(" and "), ref, F.lit(" at /data/"), at(2), F.lit("/x"), F.col("turn").cast("string"), F.lit(".csv "), F.col("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("t"), known.alias("known"))
    return rows.select("conv_id", "turn", joined(C.artifact_tokens(F.col("t"))).alias("refs"), F.sha2(C.sanitised(F.col("t")), 256).alias("clean"), F.sha2(C.without_unknown(F.col("t"), F.array("known")), 256).alias("known_only"))


@query("""
SELECT doc_id, sha256(CASE WHEN length(text) <= 300 THEN text ELSE substr(text, 1, 150) || chr(10) || '[... ' || (length(text) - 300) || ' characters omitted, sha256=' || sha256(text) || ' ...]' || chr(10) || right(text, 150) END) AS excerpt_sha256 FROM documents
""")
def q_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(C.excerpt(F.col("text"), 300), 256).alias("excerpt_sha256"))


@query("""
WITH t AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT a.user_id, a.i, round(sum(b.value * pow(0.9048374180359595, b.i - a.i)), 6) AS g FROM t a JOIN t b ON a.user_id = b.user_id AND b.i >= a.i GROUP BY a.user_id, a.i
""")
def q_discounted_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))), lambda x: x["value"])
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(W.discounted_returns(seq, 0.9048374180359595).alias("g"))
    return rows.select("user_id", F.posexplode("g").alias("p", "v")).select("user_id", (F.col("p") + 1).cast("long").alias("i"), F.round("v", 6).alias("g"))


@query("""
WITH t AS (SELECT user_id, value / 100 AS r, event_id % 7 / 10.0::DOUBLE AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
d AS (SELECT user_id, i, r + 0.99 * coalesce(lead(v) OVER (PARTITION BY user_id ORDER BY i), 0) - v AS d FROM t)
SELECT a.user_id, a.i, round(sum(b.d * pow(0.99 * 0.95, b.i - a.i)), 6) AS advantage FROM d a JOIN d b ON a.user_id = b.user_id AND b.i >= a.i GROUP BY a.user_id, a.i
""")
def q_gae(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value")))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(seq.alias("s"))
    r, v = F.transform("s", lambda x: x["value"] / 100), F.transform("s", lambda x: (x["event_id"] % 7) / F.lit(10.0))
    rows = rows.select("user_id", r.alias("r"), v.alias("v")).select("user_id", W.gae(F.col("r"), F.col("v"), 0.99, 0.95).alias("a"))
    return rows.select("user_id", F.posexplode("a").alias("p", "x")).select("user_id", (F.col("p") + 1).cast("long").alias("i"), F.round("x", 6).alias("advantage"))


@query("""
WITH x AS (SELECT event_id, value / 100 AS a, event_id % 13 / 13.0::DOUBLE AS p, event_id % 11 / 11.0::DOUBLE AS q FROM events), k AS (SELECT *, p - q AS d FROM x),
l AS (SELECT *, greatest(-exp(-d) * a, -least(1.28, greatest(0.8, exp(-d))) * a) AS loss FROM k)
SELECT event_id, round(d, 6) AS k1, round(d * d / 2, 6) AS k2, round(exp(-d) - 1 + d, 6) AS k3, round(CASE WHEN a < 0 THEN least(-3.0 * a, loss) ELSE loss END, 6) + 0::DOUBLE AS loss FROM l
""")
def q_policy_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    p, q, a = (i % 13) / F.lit(13.0), (i % 11) / F.lit(11.0), F.col("value") / 100
    kl = lambda kind: W.approx_kl(p, q, kind)
    return table(spark, sf_dir, "events").select("event_id", r6(kl("k1")).alias("k1"), r6(kl("k2")).alias("k2"), r6(kl("low_var_kl")).alias("k3"), (r6(W.policy_loss(kl("k1"), a, 0.2, 0.28, 3.0)) + 0.0).alias("loss"))


@query("""
WITH t AS (SELECT user_id, event_id % 5 / 10.0::DOUBLE - event_id % 3 / 10.0::DOUBLE AS r, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS m, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
s AS (SELECT *, sum(r * m) OVER (PARTITION BY user_id) / greatest(sum(m) OVER (PARTITION BY user_id), 1) AS g FROM t)
SELECT user_id, round(sum(CASE WHEN m = 1 THEN least(1.2, exp(r)) ELSE 0 END), 6) AS token_sum, round(sum(CASE WHEN m = 1 THEN least(1.2, greatest(0.9, exp(g))) ELSE 0 END), 6) AS geometric_sum FROM s GROUP BY user_id
""")
def q_importance_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.array_sort(F.collect_list(F.struct("event_id", "event_type")))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(e.alias("s"))
    p, q = F.transform("s", lambda x: (x["event_id"] % 5) / F.lit(10.0)), F.transform("s", lambda x: (x["event_id"] % 3) / F.lit(10.0))
    m = F.transform("s", lambda x: F.when(x["event_type"] == "error", 0).otherwise(1))
    total = lambda level, low: r6(F.aggregate(W.importance_weights(p, q, m, level, low, 1.2), F.lit(0.0), lambda a, x: a + x))
    return rows.select("user_id", total("token", None).alias("token_sum"), total("geometric", 0.9).alias("geometric_sum"))


@query("""
SELECT user_id, count(*) FILTER (WHERE event_type IN ('click', 'purchase') AND r <= 3) AS top_3, count(*) FILTER (WHERE event_type IN ('click', 'purchase') AND r <= 10) AS top_10
FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) GROUP BY user_id
""")
def q_hits_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtrace.plans.base import chains

    truth = F.array(F.lit("click"), F.lit("purchase"))
    return chains(spark, sf_dir).select("user_id", *[sets.hits_at(F.col("chain"), truth, k).cast("long").alias(f"top_{k}") for k in (3, 10)])


@query("""
WITH k AS (SELECT user_id, bool_or(value > 99) AS hi, count(*) AS n FROM events GROUP BY user_id) SELECT user_id, n, CASE WHEN NOT hi THEN 'no_high_value' END AS reason FROM k
""")
def q_plugin_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group predicate by registry: kept groups' rows, and the dropped groups with reasons."""
    e = table(spark, sf_dir, "events")
    kept, dropped = X.apply_filter(e, ["user_id"], F.bool_or(F.col("value") > 99), F.first(F.lit("no_high_value")))
    n = e.groupBy("user_id").agg(F.count("*").alias("n"))
    return n.join(kept.select("user_id").distinct().unionByName(dropped.select("user_id")), "user_id").join(dropped, "user_id", "left")


# --- results that SQL does not express; tests hold each against a plain version ---


@query()
def q_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", r6(C.compression_ratio(F.col("text"))).alias("zlib"), r6(C.compression_ratio(F.col("text"), "bz2")).alias("bz2"), C.has_repetition(F.col("text")).alias("repetitive"))


@query()
def q_call_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted calls (a day's first half) against wanted ones (its second half)."""
    call = lambda x: F.struct(x["event_type"].alias("tool_name"), F.struct(x["user_id"].alias("u"), x["value"].alias("v")).alias("arguments"))
    e = table(spark, sf_dir, "events").groupBy("user_id", F.dayofmonth("ts").cast("long").alias("day")).agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "user_id", "value"))).alias("s"))
    half = F.floor(F.size("s") / 2).cast("int")
    side = lambda a: F.to_json(F.transform(a, call))
    rows = e.select("user_id", "day", side(F.slice("s", F.lit(1), F.greatest(half, F.lit(0)))).alias("p"), side(F.slice("s", half + 1, F.size("s"))).alias("g"))
    return rows.withColumn("m", W.call_pairing("p", "g")).select("user_id", "day", F.col("m.pairs").cast("long").alias("pairs"), r6(F.col("m.f1")).alias("f1"), r6(F.col("m.mean_score")).alias("mean_score"))


@query()
def q_schema_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"type": "object", "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 90}}, "required": ["k"]}
    return table(spark, sf_dir, "events").select("event_id", G.schema_valid(F.col("props"), schema).alias("valid"))


@query()
def q_jsonl_divert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as JSON lines, some of them broken."""
    i = F.col("event_id")
    value = F.when(i % 10 == 0, F.concat("props", F.lit("}"))).when(i % 10 == 1, "[1]").when(i % 10 == 2, "").otherwise(F.col("props"))
    lines = table(spark, sf_dir, "events").select(F.lit("events").alias("path"), i.alias("line_no"), value.alias("value"))
    rows, bad = readers.divert_json(lines)
    return rows.select("line_no", F.lit("").alias("reason")).unionByName(bad.select("line_no", "reason")).groupBy("reason").agg(F.count("*").alias("n"), F.sum("line_no").alias("line_sum"))


@query()
def q_schema_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"properties": {"a": {"type": "object", "properties": {"b": {"type": "string"}}, "required": ["b"]}, "c": {"type": "array", "items": {"properties": {"d": {"type": "number"}}}}}, "required": ["a"]}
    tools = table(spark, sf_dir, "events").select(F.col("event_type").alias("tool")).distinct().withColumn("schema", F.lit(json.dumps(schema)))
    return graph.schema_slots(tools, "schema")


@query("""
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS r FROM events), g AS (SELECT user_id, r // 20 AS g, count(*) AS n, stddev_samp(value) AS s FROM r GROUP BY ALL)
SELECT user_id, count(*) AS groups, count(*) FILTER (WHERE s > 1e-6) AS kept FROM g WHERE n = 20 GROUP BY user_id
""")
def q_stream_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream: groups of 20 samples a user, emitted when complete."""
    import uuid

    e = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(e.schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir) if not sf_dir.endswith(".parquet") else None
    out = groups.complete_groups(stream.select("user_id", "event_id", "value"), "user_id", "value", 20, groups.spread, order="event_id")
    run = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    q = out.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    done = spark.read.schema("user_id long, n int, mean_reward double, kept boolean").parquet(f"{run}/out")
    return done.groupBy("user_id").agg(F.count("*").alias("groups"), F.count_if("kept").alias("kept"))
