"""Prompts, schemas, protocol parts, registries, pair rows, cursors and queues over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions.lineage import shared_folder
from loomtrace.operators import releases as L
from loomtrace.plans.base import CHAINS, chains, joined, r6, table
from loomtrace.plans.registry import query


@query(r"""
WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM conversations),
c AS (SELECT conv_id, CASE WHEN starts_with(w, 'Th') AND trim(substr(w, 3)) <> '' THEN trim(substr(w, 3)) END AS d, w, CASE WHEN turn % 2 = 1 THEN 'only_domain_tools' WHEN i % 7 = 0 THEN 'refused' END AS why, w IN ('of', 'and', 'the') AS loc FROM w)
SELECT coalesce(CASE WHEN d IS NOT NULL THEN 'domain' WHEN loc AND why IS NULL THEN 'local' END, CASE WHEN NOT loc THEN 'unsupported_tool' ELSE why END) AS class, count(*) AS n, count(DISTINCT CASE WHEN d IS NOT NULL THEN d WHEN loc AND why IS NULL THEN w END) AS names FROM c GROUP BY ALL
""")
def q_tool_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as tools' names."""
    rows = table(spark, sf_dir, "conversations").select("turn", F.posexplode(F.split("text", " ")).alias("i", "w"))
    c = L.tool_class(F.col("w"), "Th", ("of", "and", "the"), F.col("turn") % 2 == 1, F.when((F.col("i") + 1) % 7 == 0, "refused"))
    rows = rows.select(c.alias("c")).select(F.coalesce("c.kind", "c.reason").alias("class"), F.col("c.name").alias("name"))
    return rows.groupBy("class").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"))


@query(r"SELECT doc_id FROM documents WHERE len(list_filter(string_split_regex(trim(text), '\s+'), lambda w: w <> '')) <= 200")
def q_within_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.within_tokens(table(spark, sf_dir, "documents"), "text", 200).select("doc_id")


@query(r"""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM conversations WHERE role = 'assistant'),
r AS (SELECT conv_id, turn, place, array_to_string(list_filter([CASE WHEN regexp_matches(t, '[0-9]') THEN 'digits' END, CASE WHEN regexp_matches(t, '(?i)\bthe\b') THEN 'article' END], lambda x: x IS NOT NULL), ',') AS reasons FROM l)
SELECT conv_id, turn, CAST(place AS INTEGER) AS place, reasons FROM r WHERE reasons <> ''
""")
def q_prose_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of an assistant as a thought."""
    thoughts = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<thought>"), x, F.lit("</thought>"))), "")
    rows = table(spark, sf_dir, "conversations").withColumn("t", thoughts)
    out = L.prose_findings(rows, "conv_id", "turn", "t", {"digits": "[0-9]", "article": r"(?i)(?<![A-Za-z0-9_])the(?![A-Za-z0-9_])"})
    return out.withColumn("reasons", joined("reasons"))


@query(r"""
WITH c AS (SELECT conv_id, turn, string_split(text, ' ')[1:6] AS w FROM conversations), n AS (SELECT conv_id, turn, w, list_transform(range(1, len(w) + 1), lambda i: CASE WHEN length(w[i]) = 3 THEN 'image' WHEN length(w[i]) = 5 THEN 'video' END) AS k FROM c),
p AS (SELECT conv_id, turn, list_transform(range(1, len(w) + 1), lambda i: CASE WHEN k[i] IS NULL THEN 'text:' || w[i] ELSE k[i] || ':' || coalesce([turn || k[i] || '0', turn || k[i] || '1'][len(list_filter(k[1:i], lambda x: x = k[i]))], '') END) AS p FROM n)
SELECT conv_id, turn, len(list_filter(p, lambda x: NOT starts_with(x, 'text:'))) AS media, array_to_string(list_filter(p, lambda x: NOT starts_with(x, 'text:')), ',') AS placed FROM p
""")
def q_placed_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of three and five letters become placeholders, for two items of each kind."""
    mark = lambda w: F.when(F.char_length(w) == 3, "<image>").when(F.char_length(w) == 5, "<video>").otherwise(w)
    text = F.array_join(F.transform(F.slice(F.split("text", " "), 1, 6), mark), " ")
    items = lambda k: F.array(*[F.concat(F.col("turn").cast("string"), F.lit(f"{k}{i}")) for i in range(2)])
    rows = table(spark, sf_dir, "conversations").withColumn("p", L.placed_media(text, {"image": items("image"), "video": items("video")}))
    media = F.filter("p", lambda x: x["type"] != "text")
    return rows.select("conv_id", "turn", F.size(media).cast("long").alias("media"), F.array_join(F.transform(media, lambda x: F.concat(x["type"], F.lit(":"), F.coalesce(x["value"], F.lit("")))), ",").alias("placed"))


@query(f"""
WITH {CHAINS} SELECT CASE WHEN user_id % 3 > 0 THEN 'u' || user_id ELSE 'alt' || user_id END AS id, CASE WHEN user_id % 4 > 0 THEN 'given' ELSE 'toolchain_derived' END AS task_type, chain[1] AS start_tool, chain[-1] AS end_tool, CAST(len(chain) - 1 AS INTEGER) AS hops, 'run7' AS run_id FROM chains
""")
def q_canonical_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, i = F.col("user_id").cast("string"), F.col("user_id")
    rows = chains(spark, sf_dir).select(F.when(i % 3 > 0, F.concat(F.lit("u"), u)).alias("sample_id"), F.concat(F.lit("alt"), u).alias("id"), F.when(i % 4 > 0, "given").alias("task_type"), F.col("chain").alias("nodes"))
    return L.canonical_task(rows, "run7").drop("nodes")


@query("""
WITH k AS (SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, length(event_type) AS n FROM events)
SELECT event_id, concat_ws('; ', CASE WHEN n % 3 = 0 THEN '$.extra: additional' END, CASE WHEN k > 90 THEN '$.k: maximum' END, CASE WHEN k < 10 THEN '$.k: minimum' END, CASE WHEN n = 4 THEN '$.tags[0]: enum' END, CASE WHEN k % 2 = 1 THEN '$.tags[1]: type' END, CASE WHEN user_id % 5 = 0 THEN '$: required name' END) AS findings FROM k
""")
def q_schema_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' properties in documents that break a schema in several places."""
    k, n = F.get_json_object("props", "$.k").cast("long"), F.char_length("event_type")
    second = F.when(k % 2 == 1, F.lit("7")).otherwise(F.lit('"view"'))
    name = F.when(F.col("user_id") % 5 == 0, "").otherwise(',"name":"x"')
    text = F.concat(F.lit('{"k":'), k.cast("string"), F.lit(',"tags":["'), F.col("event_type"), F.lit('",'), second, F.lit("]"), name, F.when(n % 3 == 0, ',"extra":1').otherwise(""), F.lit("}"))
    tags = {"type": "array", "items": {"type": "string", "enum": ["click", "purchase", "signup", "error"]}}
    schema = {"type": "object", "required": ["k", "name"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 90}, "name": {"type": "string", "minLength": 1}, "tags": tags}}
    found = F.filter(L.schema_findings(text, schema), lambda x: x != "$.tags[1]: enum")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(found, "; ").alias("findings"))


@query(r"""
WITH w AS (SELECT conv_id, turn, role, unnest(string_split(text, ' ')[1:3]) AS w, generate_subscripts(string_split(text, ' ')[1:3], 1) AS i FROM conversations),
k AS (SELECT *, CASE length(w) % 3 WHEN 0 THEN 'tool_call' WHEN 1 THEN 'observation' ELSE 'final_answer' END AS kind, length(w) % 4 <> 0 AS ok FROM w),
o AS (SELECT * FROM k WHERE (role = 'assistant' AND kind <> 'observation') OR (role = 'user' AND kind = 'observation'))
SELECT c.conv_id, count(*) FILTER (WHERE ok AND kind = 'tool_call') AS calls, count(*) FILTER (WHERE ok AND kind = 'observation') AS observations, count(*) FILTER (WHERE ok AND kind = 'final_answer') AS finals,
  coalesce(string_agg('message_' || turn || '_' || kind || '_json_invalid', ',' ORDER BY turn, i) FILTER (WHERE NOT ok), '') AS malformed FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN o USING (conv_id) GROUP BY ALL
""")
def q_protocol_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def block(w):
        kind = F.when(F.char_length(w) % 3 == 0, "tool_call").when(F.char_length(w) % 3 == 1, "observation").otherwise("final_answer")
        body = F.when(F.char_length(w) % 4 != 0, '{"a":1}').otherwise("[1")
        return F.concat(F.lit("<"), kind, F.lit(">"), body, F.lit("</"), kind, F.lit(">"))

    rows = table(spark, sf_dir, "conversations").withColumn("t", F.array_join(F.transform(F.slice(F.split("text", " "), 1, 3), block), " "))
    out = L.protocol_parts(rows, "conv_id", "turn", "t")
    return out.select("conv_id", *[F.size(c).cast("long").alias(c) for c in ("calls", "observations", "finals")], joined("malformed").alias("malformed"))


@query("""
WITH f AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL), i AS (SELECT user_id, event_type, 'artifact_' || row_number() OVER (PARTITION BY user_id ORDER BY first, event_type) AS logical_id FROM f) SELECT event_id, logical_id FROM events JOIN i USING (user_id, event_type)
""")
def q_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.registered(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type").select("event_id", "logical_id")


@query("""
WITH b AS (SELECT user_id, event_type, 0 AS p, event_id FROM events WHERE value > 80 UNION ALL SELECT user_id, event_type, 1, event_id FROM events WHERE value <= 80),
o AS (SELECT user_id, event_type, min(p) AS p, arg_min(event_id, p * 1000000000 + event_id) AS event_id FROM b GROUP BY ALL)
SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY p, event_id, event_type) AS rank FROM o QUALIFY rank <= 3
""")
def q_grounding_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    out = L.grounding_facts(e.where("value > 80").drop("value"), e.where("value <= 80").drop("value"), "user_id", "event_type", "event_id", 3)
    return out.select("user_id", "event_type", "event_id", F.col("rank").cast("long").alias("rank"))


@query("""
WITH t AS (SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN event_type END AS f FROM events ORDER BY event_id LIMIT 400), g AS (SELECT event_id FROM t WHERE f IS NULL ORDER BY event_id LIMIT 100), l AS (SELECT CASE WHEN count(*) >= 100 THEN max(event_id) END AS last FROM g)
SELECT f AS failure, count(*) AS n FROM t, l WHERE f IS NOT NULL AND (last IS NULL OR event_id < last) GROUP BY f UNION ALL SELECT 'none', count(*) FROM g
""")
def q_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    good, bad = L.attempts(table(spark, sf_dir, "events").select("event_id", F.when(t.isin("error", "view"), t).alias("failure")), "event_id", "failure", 100, 400)
    return bad.unionByName(good.agg(F.count("*").alias("n")).select(F.lit("none").alias("failure"), "n"))


@query("""
SELECT event_id, concat_ws(';', CASE WHEN event_type <> 'error' THEN 'input=' || CASE WHEN event_type = 'view' THEN 'new' ELSE event_type END END, CASE WHEN user_id % 2 = 0 THEN 'smiles=["C"]' ELSE 'smiles=["O"]' END) AS arguments FROM events
""")
def q_current_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    both = F.create_map(F.lit("file"), t, F.lit("input"), F.lit("new"), F.lit("legacy"), F.lit("x"), F.lit("smiles"), F.when(F.col("user_id") % 2 == 0, "C").otherwise('["O"]'))
    old, none = F.map_filter(both, lambda k, _: k != "input"), F.map_filter(both, lambda k, _: ~k.isin("input", "file"))
    arguments = F.when(t == "view", both).when(t == "error", none).otherwise(old)
    now = L.current_arguments(arguments, {"file": "input"}, ("smiles",), ("legacy",))
    shown = F.array_sort(F.transform(F.map_entries(now), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(shown, ";").alias("arguments"))


@query(f"""
WITH {CHAINS}, p AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN chain[1:2] WHEN user_id % 3 = 1 THEN [] ELSE chain[-2:] END AS a, chain[1:1] AS b FROM chains),
f AS (SELECT user_id, CASE WHEN len(a) > 0 THEN a ELSE b END AS tools FROM p) SELECT user_id, sha256('{{"schema_version":"v1","user_id":' || user_id || ',"tools":["' || array_to_string(tools, '","') || '"]}}') AS document FROM f
""")
def q_task_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("user_id") % 3, F.col("chain")
    shape = F.when(k == 0, F.slice(c, 1, 2)).when(k == 1, F.slice(c, 1, 0)).otherwise(F.when(F.size(c) < 2, c).otherwise(F.slice(c, -2, 2)))
    rows = chains(spark, sf_dir).select("user_id", L.first_present(shape, F.slice(c, 1, 1)).alias("tools"))
    return rows.select("user_id", F.sha2(L.task_document(["user_id", "tools"], "v1"), 256).alias("document"))


@query("""
WITH t AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), s AS (SELECT conv_id, turn - 1 AS turn, text AS r FROM conversations WHERE role = 'assistant' AND turn % 2 = 1),
j AS (SELECT t.conv_id, t.turn, CASE WHEN trim(t.text) = '' THEN 'blank_teacher' WHEN r IS NULL THEN 'no_response' WHEN r = t.text THEN 'same_response' END AS reason FROM t LEFT JOIN s ON t.conv_id = s.conv_id AND t.turn = s.turn)
SELECT coalesce(reason, 'pair') AS reason, count(*) AS n, CAST(sum(turn) AS BIGINT) AS turns FROM j GROUP BY ALL
""")
def q_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    student = c.where("role = 'assistant' and turn % 2 = 1").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("r"))
    pairs, skipped = L.pair_rows(c.where("role = 'user'").withColumn("p", F.lit("")), ["conv_id", "turn"], "p", "text", student, "r")
    both = skipped.select("turn", "reason").unionByName(pairs.select("turn", F.lit("pair").alias("reason")))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.sum("turn").alias("turns"))


@query("""
WITH n AS (SELECT count(*) AS n FROM lineitem) SELECT 'repeated_key' AS problem, (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) AS n UNION ALL SELECT 'high_tax', count(*) FROM lineitem WHERE NOT l_tax < 0.08 UNION ALL SELECT 'stored_count', abs(n - 1000) FROM n
""")
def q_release_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    stored = spark.range(1).select(F.lit(1000).cast("long").alias("rows"))
    return L.release_problems(rows, "k", {"high_tax": F.col("l_tax") < 0.08, "no_quantity": F.col("l_quantity") > 0}, stored)


@query("""
WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'failed' END AS status, o_totalprice AS score FROM orders WHERE o_totalprice > 100000)
SELECT o_orderpriority AS suite, count(*) AS tasks, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status IS NULL) AS missing, round(sum(CASE WHEN status = 'completed' THEN score ELSE 0 END) / count(*), 4) AS score FROM orders LEFT JOIN r ON k = o_orderkey GROUP BY ALL
""")
def q_saved_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    results = o.where("o_totalprice > 100000").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"), F.col("o_totalprice").alias("score"))
    return L.saved_results(o.select("o_orderkey", F.col("o_orderpriority").alias("suite")), results, "o_orderkey", "suite").withColumn("score", F.round("score", 4))


@query("""
WITH s AS (SELECT user_id, event_id AS a, event_id + CAST(floor(value) AS BIGINT) AS b, event_type FROM events), e AS (SELECT user_id, 'span_start' AS type, a AS ts, NULL AS error FROM s UNION ALL SELECT user_id, 'span_end', b, CASE WHEN event_type = 'error' THEN 'failed' END FROM s),
t AS (SELECT user_id, min(a) AS "begin", max(b) AS "end", count(*) AS spans FROM s GROUP BY GROUPING SETS ((user_id), ())), c AS (SELECT user_id, count(*) AS events, count(error) AS errors, CAST(sum(ts) AS BIGINT) AS ts FROM e GROUP BY GROUPING SETS ((user_id), ()))
SELECT t.*, events, errors, ts FROM t JOIN c ON t.user_id IS NOT DISTINCT FROM c.user_id
""")
def q_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("a"), (F.col("event_id") + F.floor("value").cast("long")).alias("b"), F.when(F.col("event_type") == "error", "failed").alias("error"))
    events = L.span_events(spans, ["user_id"], "a", "b", "error")
    counts = events.groupingSets([[F.col("user_id")], []], F.col("user_id")).agg(F.count("*").alias("events"), F.count("error").alias("errors"), F.sum("ts").alias("ts")).withColumnRenamed("user_id", "u")
    out = L.timelines(spans, "user_id", "a", "b")
    return out.join(counts, F.col("user_id").eqNullSafe(F.col("u"))).drop("u")


@query("""
WITH s AS (SELECT user_id, event_id, value / 100 AS s FROM events WHERE value / 100 BETWEEN 0.2 AND 0.98), r AS (SELECT user_id, list(s ORDER BY s DESC, event_id DESC) AS s, list(event_id ORDER BY s DESC, event_id DESC) AS e FROM s GROUP BY user_id HAVING count(*) > 1)
SELECT user_id, e[1] AS best, round(s[1] - s[2], 6) AS margin, CASE WHEN s[1] - s[2] > 0.2 THEN 'easy' WHEN s[1] - s[2] > 0.08 THEN 'medium' ELSE 'hard' END AS difficulty FROM r WHERE s[1] - s[2] > 0.001
""")
def q_gap_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("value") / 100).alias("s"))
    return L.gap_cases(rows, "user_id", "event_id", "s", gap=0.001).withColumn("margin", r6(F.col("margin")))


@query("SELECT event_id FROM events WHERE value <= 50 AND event_id % 3 > 0 UNION ALL SELECT 70")
def q_queue_and_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that a queue has finished, and the offset that a cursor resumes at."""
    path = f"{shared_folder(spark)}/cursor-{uuid.uuid4().hex}"
    for step in range(1, 8):
        L.save_cursor(spark, path, step * 10, step // 5, step)
    offset, _ = L.load_cursor(spark, path)
    e = table(spark, sf_dir, "events")
    done = L.drained(e, e.where("event_id % 3 = 0"), "event_id", "value", 50)
    return done.select("event_id").unionByName(spark.createDataFrame([(offset,)], "event_id long"))


@query("""
SELECT role, count(*) AS n, count(*) FILTER (WHERE length(text) > 300) AS patched FROM conversations GROUP BY role
""")
def q_patch_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider that shortens long messages, twice for one of them; the others keep their text."""
    c = table(spark, sf_dir, "conversations").withColumn("k", F.concat_ws("-", "conv_id", "turn"))
    patches, rest = L.provided_patches(c, lambda r: r.select("k", F.when(F.char_length("text") > 300, F.left("text", F.lit(300))).alias("text")), "k", ["text"])
    both = patches.join(c.select("k", "role"), "k").select("role", F.lit(1).alias("p")).unionByName(rest.select("role", F.lit(0).alias("p")))
    views = L.serve(spark, {"rows": both}, f"served_{uuid.uuid4().hex}_")
    return spark.sql(f"SELECT role, count(*) AS n, sum(p) AS patched FROM {views[0]} GROUP BY role")


@query()
def q_nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.array(F.from_json("props", "struct<k:int>"), F.struct(F.col("value").alias("k"))).alias("k"))).alias("t"))
    return rows.select("event_id", joined(L.nested_values("k")("t")).alias("found"))
