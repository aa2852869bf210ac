"""Selection, sampling, packing, graphs, retrieval, knowledge base look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtrace.functions import names as N
from loomtrace.operators import decisions as D
from loomtrace.operators import graph as G
from loomtrace.operators import packing as P
from loomtrace.operators import pairing as J
from loomtrace.operators import retrieval as R
from loomtrace.operators import sampling as T
from loomtrace.plans.base import joined, r6, table
from loomtrace.plans.registry import query
from loomtrace.sources import readers


def unit(seed: str, key: str) -> str:
    """The SQL of ``names.jitter``."""
    return f"(('0x' || substr(sha256('{seed}:' || {key}), 1, 13))::BIGINT / 4503599627370496.0)"


@query("SELECT event_type, event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, day(ts) ORDER BY sha256('7:' || event_id), event_id) = 1")
def q_stratum_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    return T.stratum_winners(e, ["event_type", "day"], "event_id", "7").select("event_type", "event_id", "user_id")


@query("SELECT lang, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) <= 5")
def q_limit_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.per_group(table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars"), ["lang"], ["n_chars", "doc_id"], 5)


@query("""
WITH d AS (SELECT doc_id, n_chars FROM documents)
SELECT doc_id, false AS padding FROM d UNION ALL (SELECT doc_id, true FROM (SELECT *, row_number() OVER (ORDER BY n_chars, doc_id) AS r FROM d) WHERE r <= (64 - (SELECT count(*) FROM d) % 64) % 64)
""")
def q_batch_align_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return T.pad_to_multiple(d, ["n_chars", "doc_id"], 64).select("doc_id", "padding")


@query(f"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, {unit("q", "(l_partkey || '-' || l_suppkey || '-' || l_orderkey || '-' || l_linenumber || '-' || l_extendedprice::BIGINT)")} AS j FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice::BIGINT) * FROM lineitem)),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY j) <= 20), c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY j) <= 1)
SELECT l_suppkey, count(*) AS n, round(min(j), 9) AS least FROM c GROUP BY l_suppkey
""")
def q_quota_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", F.rint("l_extendedprice").cast("long")))
    rows = T.quota_choice(li.select("l_suppkey", "l_partkey", "k").distinct(), {"l_suppkey": 20, "l_partkey": 1}, "k", "q")
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.min(N.jitter("q", F.col("k"))), 9).alias("least"))


@query("""
WITH s AS (SELECT l_partkey AS k, min(CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN l_extendedprice END) AS best FROM lineitem GROUP BY 1)
SELECT p_partkey, row_number() OVER (ORDER BY best ASC NULLS LAST, p_partkey) AS new_place, round(best, 2) AS best_score FROM part LEFT JOIN s ON k = p_partkey
""")
def q_rank_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by the least price of their large returned lines; the score of every other line is null."""
    score = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), F.col("l_extendedprice"))
    scores = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), score.alias("l_extendedprice"))
    rows = T.rank_with_unscored(table(spark, sf_dir, "part").select("p_partkey"), scores, "p_partkey", "l_extendedprice", "p_partkey")
    return rows.select("p_partkey", F.col("new_place").cast("long").alias("new_place"), F.round("best_score", 2).alias("best_score"))


@query("""
WITH n AS (SELECT count(*) AS n FROM benchmark), r AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS p FROM benchmark), g AS (SELECT range AS group_index, (range + 33) % (SELECT n FROM n) AS p FROM range(16))
SELECT item_id, CAST(group_index AS BIGINT) AS group_index, CAST(group_index * 3 + c AS BIGINT) AS "index" FROM r JOIN g USING (p), (VALUES (0), (1), (2)) AS v(c)
""")
def q_wrapped_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.wrapped_batch(table(spark, sf_dir, "benchmark").select("item_id"), "item_id", 33, 16, copies=3)


@query("""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, tier FROM r, (VALUES (0.0::DOUBLE), (0.5::DOUBLE), (0.95::DOUBLE), (1.0::DOUBLE)) AS v(tier) WHERE abs(r - CAST(round_even((n - 1) * tier, 0) AS BIGINT)) <= 2
""")
def q_length_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.length_probes(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id", width=2).select("doc_id", "tier")


@query(f"""
WITH a AS (SELECT event_id, user_id, event_type, event_type = 'signup' AS anchor, {unit("v", "event_id")} AS j, 1 / sqrt(count(*) OVER (PARTITION BY event_type)) AS w FROM events),
b AS (SELECT *, row_number() OVER (PARTITION BY event_type, anchor ORDER BY j, event_id) AS r FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY user_id, anchor ORDER BY r > 40, w DESC, j, event_id) AS g FROM b)
SELECT event_id, anchor FROM c WHERE anchor OR (r <= 40 AND g <= 2)
""")
def q_coverage_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return T.coverage_view(e, "event_id", "user_id", "event_type", F.col("event_type") == "signup", 40, 2, "v").select("event_id", "anchor")


@query()
def q_pack_first_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recurrence over all earlier bins: tested against a plain version."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    out = P.pack(d, ["source"], "doc_id", "n_chars", "first_fit", capacity=20_000)
    return out.groupBy("source", "bin").agg(F.count("*").alias("n"), F.sum("n_chars").alias("total"))


@query()
def q_balanced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    out = P.pack(d, ["source"], "doc_id", "n_chars", "differencing", bins=4)
    return out.groupBy("source", "bin").agg(F.count("*").alias("n"), F.sum("n_chars").alias("total"))


@query()
def q_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "conversations").select("conv_id", (F.col("conv_id") * 100 + F.col("turn")).alias("pos"), F.char_length("text").cast("long").alias("n"))
    out = P.schedule(d, "conv_id", "pos", "n", per_step=8, ranks=4, capacity=2000)
    return out.groupBy("step", "rank").agg(F.count("*").alias("samples"), F.sum("n").alias("total"), F.count_distinct("bin").alias("micro_batches"))


@query()
def q_size_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.char_length("text").cast("long").alias("n"))
    return P.size_batches(d, ["conv_id"], "turn", "n", 500).select("conv_id", "turn", F.col("batch").cast("long").alias("batch"), "oversize")


# --- graph ---

STAGES = "st AS (SELECT DISTINCT p_brand || ':' || p_size % 4 AS tool, 's' || p_size % 4 AS stage FROM part), al AS (SELECT * FROM (VALUES ('s0', 's1'), ('s1', 's2'), ('s2', 's3')) AS v(a, b))"


def _stages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stage = (F.col("p_size") % 4).cast("string")
    st = table(spark, sf_dir, "part").select(F.concat("p_brand", F.lit(":"), stage).alias("tool"), F.concat(F.lit("s"), stage).alias("stage")).distinct()
    return st, spark.createDataFrame([("s0", "s1"), ("s1", "s2"), ("s2", "s3")], "source_stage string, target_stage string")


@query(f"""
WITH {STAGES}, c AS (SELECT tool, split_part(tool, ':', 1) AS cluster FROM st)
SELECT x.tool AS source, y.tool AS target, x.stage || '>' || y.stage AS supports, split_part(x.tool, ':', 1) = split_part(y.tool, ':', 1) AS alternative FROM st x JOIN al ON x.stage = a JOIN st y ON y.stage = b WHERE x.tool <> y.tool
""")
def q_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    st, allowed = _stages(spark, sf_dir)
    out = G.candidate_pairs(st, allowed, st.select("tool", F.element_at(F.split("tool", ":"), 1).alias("cluster")))
    return out.select("source", "target", joined("supports").alias("supports"), "alternative")


EDGES = "e AS (SELECT DISTINCT c_nationkey AS source, (c_nationkey * 7 + c_custkey % 3) % 25 AS target FROM customer)"


@query(f"""
WITH {EDGES}, p1 AS (SELECT [source, target] AS p FROM e WHERE source <> target OR source = target), p2 AS (SELECT list_append(p, target) AS p FROM p1 JOIN e ON e.source = p[-1] WHERE NOT list_contains(p, target)),
p3 AS (SELECT list_append(p, target) AS p FROM p2 JOIN e ON e.source = p[-1] WHERE NOT list_contains(p, target)) SELECT array_to_string(p, '>') AS path FROM p3
""")
def q_simple_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    e = c.select(F.col("c_nationkey").cast("long").alias("source"), ((F.col("c_nationkey") * 7 + F.col("c_custkey") % 3) % 25).cast("long").alias("target"))
    return G.simple_paths(e, 3).select(F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))


@query("""
WITH d AS (SELECT p_partkey AS source, p_partkey + p_size AS target, p_size % 3 AS n, p_brand FROM part WHERE p_size % 3 > 0 AND p_retailprice > 950)
SELECT source, target, 'type' || i AS edge_type, source || '::' || target || '::' || lpad(i::VARCHAR, 2, '0') AS edge_id FROM d, (VALUES (1), (2)) AS v(i) WHERE i <= n
""")
def q_edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.transform(F.sequence(F.lit(1), F.greatest(F.col("p_size") % 3, F.lit(1))), lambda i: F.concat(F.lit("type"), i.cast("string")))
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source"), (F.col("p_partkey") + F.col("p_size")).alias("target"), (F.col("p_size") % 3 > 0).alias("valid"), (F.col("p_retailprice") > 950).alias("eligible"), types.alias("edge_types"))
    return G.edge_rows(d).select("source", "target", "edge_type", "edge_id")


@query("""
WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS first FROM events GROUP BY ALL), t AS (SELECT user_id, list(event_type ORDER BY first) AS c FROM f GROUP BY user_id)
SELECT user_id, array_to_string(list_transform(range(1, len(c) + 1), lambda i: printf('tool::%02d::%s', i - 1, c[i])), ',') AS nodes, CAST(greatest(len(c) - 1, 0) AS BIGINT) AS n_edges FROM t
""")
def q_expected_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomtrace.plans.base import chains

    rows = chains(spark, sf_dir).select("user_id", F.array_distinct("chain").alias("chain"))
    return G.expected_trajectory(rows, "chain").select("user_id", joined("nodes").alias("nodes"), F.size("edges").cast("long").alias("n_edges"))


@query("""
WITH RECURSIVE s AS (SELECT user_id, event_id AS span_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) END AS parent_id FROM events),
d AS (SELECT user_id, span_id, 0 AS depth FROM s WHERE parent_id IS NULL UNION ALL SELECT s.user_id, s.span_id, d.depth + 1 FROM s JOIN d ON s.user_id = d.user_id AND s.parent_id = d.span_id WHERE d.depth < 64)
SELECT depth, count(*) AS n FROM d GROUP BY depth
""")
def q_span_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev = F.lag("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))
    s = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("span_id"), F.when(F.col("event_id") % 4 != 0, prev).alias("parent_id"))
    return G.depths(s, "user_id").groupBy("depth").agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT user_id, event_id // 2 AS span_id, epoch(ts) AS ts, event_id % 2 = 0 AS st, event_id % 5 AS par, event_id FROM events),
s AS (SELECT user_id, span_id, min(ts) AS "start", min(par) AS parent_id FROM e WHERE st GROUP BY ALL), f AS (SELECT user_id, span_id, max(ts) AS "end" FROM e WHERE NOT st GROUP BY ALL),
l AS (SELECT user_id, max(ts) AS last FROM e GROUP BY user_id), j AS (SELECT * FROM s FULL JOIN f USING (user_id, span_id) JOIN l USING (user_id)),
n AS (SELECT *, lead("start") OVER (PARTITION BY user_id, parent_id ORDER BY "start" NULLS FIRST, span_id) AS nx FROM j)
SELECT user_id, CAST(span_id AS BIGINT) AS span_id, round(coalesce("end", greatest("start", least(last, coalesce(nx, last)))) - "start", 3) AS duration, CASE WHEN "end" IS NULL THEN CASE WHEN coalesce(nx < last, false) THEN 'sibling' ELSE 'row_end' END END AS clipped_by FROM n
""")
def q_span_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select("user_id", F.floor(i / 2).alias("span_id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), F.when(i % 2 == 0, "start").otherwise("end").alias("kind"), (i % 5).alias("parent_id"))
    return J.spans(e, "user_id").select("user_id", "span_id", F.round(F.col("end") - F.col("start"), 3).alias("duration"), "clipped_by")


@query("""
WITH a AS (SELECT user_id, event_id, epoch(ts) / 3600 AS s, epoch(ts) / 3600 + 2 AS e FROM events WHERE event_type = 'view'), b AS (SELECT user_id, event_id AS other, epoch(ts) / 3600 AS s2, epoch(ts) / 3600 + abs(value) / 50 AS e2 FROM events WHERE event_type = 'click')
SELECT user_id, event_id, other FROM a JOIN b USING (user_id) WHERE s < e2 AND e > s2
""")
def q_interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.unix_micros(F.col("ts").cast("timestamp")) / 3.6e9
    e = table(spark, sf_dir, "events")
    a = e.where("event_type = 'view'").select("user_id", "event_id", h.alias("s"), (h + 2).alias("e"))
    b = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("other"), h.alias("s2"), (h + F.abs("value") / 50).alias("e2"))
    return J.overlaps(a, b, ["user_id"], ("s", "e"), ("s2", "e2"), 4.0).select("user_id", "event_id", "other")


# --- knowledge base and retrieval ---


@query("""
SELECT l_orderkey, l_linenumber, p_name, s_name, round(l_extendedprice, 2) AS price FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 50
""")
def q_kb_star_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    rows = J.star_top(li, [(p, "l_partkey"), (s, "l_suppkey")], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 60)
    return rows.select("l_orderkey", "l_linenumber", "p_name", "s_name", F.round("l_extendedprice", 2).alias("price"))


@query("""
WITH p AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END, o_orderkey) = 1)
SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN p ON o_custkey = c_custkey
""")
def q_preferred_row_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = J.preferred_row(table(spark, sf_dir, "orders"), ["o_custkey"], [F.when(F.col("o_orderstatus") == "F", 0).otherwise(1), F.col("o_orderkey")])
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_orderstatus")


@query("""
SELECT k AS id, CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = k) THEN 'supplier' WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = k) THEN 'customer' WHEN EXISTS (SELECT 1 FROM part WHERE p_partkey = k) THEN 'part' END AS found_in
FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)
""")
def q_first_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    of = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("id"))
    return J.first_hit(ids, "id", {"supplier": of("supplier", "s_suppkey"), "customer": of("customer", "c_custkey"), "part": of("part", "p_partkey")})


@query("SELECT p_partkey, p_name FROM part WHERE (contains(lower(p_name), 'ring') OR contains(lower(p_type), 'small')) AND trim(p_brand) <> '' ORDER BY p_partkey LIMIT 25")
def q_keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    one, two = R.keyword_search(p, ["p_name"], "ring", "p_partkey", 25, ["p_brand"]), R.keyword_search(p, ["p_type"], "Small", "p_partkey", 25, ["p_brand"])
    return one.unionByName(two).distinct().orderBy("p_partkey").limit(25).select("p_partkey", "p_name")


@query("""
WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT query_id, v.vec_id, round(list_inner_product(list_transform(q.e, lambda x: x::DOUBLE), list_transform(v.embedding, lambda x: x::DOUBLE)), 6) AS score FROM q, embeddings v)
SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 5
""")
def q_dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return R.dense_top(e.where("vec_id % 20 = 0"), e, 5, "vec_id", "embedding").withColumn("rank", F.col("rank").cast("long"))


@query("""
WITH q AS (SELECT * FROM (VALUES (1, 'the apache license'), (2, 'heat and the version'), (3, 'password')) AS v(query_id, query)),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM documents), n AS (SELECT count(*) AS n, avg(len(w)) AS a FROM d),
t AS (SELECT DISTINCT query_id, unnest(list_filter(string_split_regex(lower(query), '[^a-z0-9]+'), lambda w: w <> '')) AS term FROM q),
u AS (SELECT doc_id, len(w) AS l, unnest(w) AS term FROM d), f AS (SELECT doc_id, l, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM t) GROUP BY ALL),
g AS (SELECT term, count(*) AS df FROM f GROUP BY term),
s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 0.9 * (1 - 0.4 + 0.4 * l / a))), 6) AS score FROM t JOIN f USING (term) JOIN g USING (term), n GROUP BY ALL)
SELECT CAST(query_id AS INTEGER) AS query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 10
""")
def q_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = spark.createDataFrame([(1, "the apache license"), (2, "heat and the version"), (3, "password")], "query_id int, query string")
    return R.bm25_top(q, table(spark, sf_dir, "documents").select("doc_id", "text"), 10, "doc_id", "text").withColumn("rank", F.col("rank").cast("long"))


@query("""
WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE o_orderkey % 4 WHEN 0 THEN '>' || o_totalprice::BIGINT WHEN 1 THEN 'n/a' WHEN 2 THEN '' END AS ki, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey * 10)::VARCHAR ELSE 'x' END AS ic FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'Ki' WHEN o_orderkey % 3 = 0 THEN 'IC50' END AS activity_type, CASE WHEN o_orderkey % 4 = 0 THEN (o_totalprice::BIGINT)::DOUBLE WHEN o_orderkey % 3 = 0 THEN (o_orderkey * 10)::DOUBLE END AS activity_value,
  'pair::' || substr(sha256(o_orderkey || '::' || o_custkey), 1, 20) AS record_id FROM r WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ORDER BY o_orderkey LIMIT 2000
""")
def q_kb_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ki = F.when(k % 4 == 0, F.concat(F.lit(">"), F.rint("o_totalprice").cast("long").cast("string"))).when(k % 4 == 1, "n/a").when(k % 4 == 2, "")
    ic = F.when(k % 3 == 0, (k * 10).cast("string")).otherwise("x")
    rows = o.withColumns({"ki": ki, "ic": ic}).withColumn("a", readers.first_activity([("Ki", "ki"), ("IC50", "ic")]))
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    rows = readers.import_pairs(rows, c, o.select("o_orderkey"), "o_custkey", "o_orderkey", ["o_orderkey"], 2000)
    return rows.select("o_orderkey", F.col("a.type").alias("activity_type"), F.col("a.value").alias("activity_value"), N.surrogate_key("pair", k.cast("string"), F.col("o_custkey").cast("string")).alias("record_id"))


@query("""
WITH s AS (SELECT o_orderkey, o_totalprice, (SELECT list(l_quantity ORDER BY l_linenumber, l_partkey, l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) AS q FROM orders)
SELECT o_orderkey, CAST(i - 1 AS BIGINT) AS segment_idx, CAST(len(q) AS BIGINT) AS num_segments, round(o_totalprice / len(q), 6) AS reward, q[i] AS segment FROM (SELECT *, unnest(range(1, len(q) + 1)) AS i FROM s)
""")
def q_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")))
    q = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(parts, lambda p: p["l_quantity"]).alias("q"))
    rows = D.fan_out(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("reward")).join(q, "o_orderkey"), "q", "reward")
    return rows.select("o_orderkey", F.col("segment_idx").cast("long"), F.col("num_segments").cast("long"), r6(F.col("reward")).alias("reward"), "segment")
