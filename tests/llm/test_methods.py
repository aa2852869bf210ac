"""What the dealt methods promise: plans, probabilities, ledgers, cutoffs, matches, and the pipeline's
stages against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomtrace.llm import bpe, components, lines, mixing, nearcopies, quality, queries, secrets, simhash, substrings, tokencounts, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


# --- line dedup ---


def test_lines_plan(spark, docs):
    """Keys are dealt by ranges once and streamed there: no exchange deals them by hash of the key."""
    keys = lines._keys(docs, 40).checkpoint()
    plan = lines.stream_occurrences(keys)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_lt_range" in plan and "Window" in plan and plan.count("rangepartitioning(") == 1
    above = plan[: plan.index("rangepartitioning(")]
    assert "hashpartitioning" not in above and "Sort [_lt_range" in above


def test_lines_hot_key(spark):
    """A line that most documents hold is salted, with the same result as any other."""
    rng = random.Random(1)
    hot, rows = "x" * 45, []
    for i in range(3000):
        text = [hot] * rng.randint(0, 2) + [f"{'y' * 40} {rng.randrange(400)}"] + [f"own line number {i} " + "z" * 30]
        rng.shuffle(text)
        rows.append((i, "\n".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    keys = lines._keys(df, 40).checkpoint()
    streamed = lines.stream_occurrences(keys, one_in=2)
    assert streamed.where("_lt_hot").select("_lt_salt").distinct().count() > 1
    out = lines.dedup_lines(df).select("doc_id", "_lt_lines", "_lt_dropped", F.sha2("text", 256))
    assert order(out.collect()) == order(brute.lines(rows))


# --- mixing ---


def test_inclusion_probabilities(spark):
    """Over many seeds a document is drawn about as often as its p says; p differs by size and is 1 for the largest."""
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([3, 5, 8, 13, 40, 90]), "a") for i in range(120)] + [(1000, "w " * 900, "a")] + [(2000 + i, "w " * 50, "b") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    drawn, p, whole = Counter(), {}, {}
    seeds = 3
    for seed in range(seeds):
        for r in mixing.mix_sources(df, weights=(1, 12), seed=seed * 7 + 1).where("source = 'a'").collect():
            base = math.floor(r.target / r.source_size)
            drawn[r.doc_id] += r.copies - base
            p[r.doc_id], whole[r.doc_id] = r.p, base
    assert len({round(x, 6) for x in p.values()}) >= 5 and p[1000] == max(p.values()) == 1.0
    by_p = defaultdict(list)
    for i, x in p.items():
        by_p[round(x, 9)].append(drawn[i] / seeds)
    for x, seen in by_p.items():
        spread = 5 * math.sqrt(max(x * (1 - x), 1e-4) / (seeds * len(seen))) + 0.06
        assert abs(sum(seen) / len(seen) - x) < spread, (x, sum(seen) / len(seen))


def test_inclusion_by_class(spark):
    """The closed form against raising c step by step."""
    sums = [("s", k, w, 900.0) for k, w in ((0, 100), (8, 300), (16, 500), (24, 800), (40, 400))]
    df = spark.createDataFrame(sums, "_lt_s string, _lt_class int, _lt_words long, _lt_open double")
    got = mixing.inclusion(df).first()["_lt_ps"]
    low, high = 0.0, 10.0
    for _ in range(200):
        c = (low + high) / 2
        total = sum(min(1, c * 2 ** (k / 8)) * w for _, k, w, _ in sums)
        low, high = (c, high) if total < 900 else (low, c)
    assert all(abs(got[k] - min(1, low * 2 ** (k / 8))) < 1e-9 for _, k, _, _ in sums)


# --- quality ---


def plain_kept(measured, good, risk=0.02, alpha=0.05):
    """measured: (stratum, base_failed, n_words, chars, symbols, dup, rep); good: labels by place."""
    ratio = {"symbols": lambda m: m[4] / max(m[3], 1), "dup_lines": lambda m: m[5] / max(m[2], 1) * 10, "repeats": lambda m: m[6] / max(m[2], 1), "long_words": lambda m: m[3] / max(m[2], 1)}
    held = [(m, good[i]) for i, m in enumerate(measured) if not m[1] and i in good]
    strata = {m[0] for m, _ in held}
    limit = {}
    for s in strata:
        own = [m for m, g in held if m[0] == s and g]
        for rule, cutoffs in quality.GRID.items():
            for c in sorted(cutoffs, reverse=True):
                r, n = sum(ratio[rule](m) > c for m in own), len(own)
                tail = sum(math.comb(n, k) * risk**k * (1 - risk) ** (n - k) for k in range(r + 1))
                if r >= risk * n or tail > alpha / (len(strata) * len(quality.GRID)):
                    break
                limit[s, rule] = c
    return [not m[1] and not any(ratio[k](m) > limit.get((m[0], k), math.inf) for k in ratio) for m in measured], limit


def test_kept(spark):
    """Verdicts by the exact binomial test in a fixed sequence, strata with enough labels and with too few."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(2600):
        lang = "en" if i < 1500 else "de" if i < 2500 else None
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(5, 40))]
        bad = rng.random() < 0.2
        if bad:
            words = [w + rng.choice(["", "###", "|||||"]) for w in words] + ["spam"] * rng.choice([0, 6])
        rows.append((i, " ".join(words) + ("\nsame\nsame" if rng.random() < 0.1 else ""), lang))
        if rng.random() < 0.8:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    measured = [(rows[i][2] or "", r[6], r[1], r[2], r[3], r[4], r[5]) for i, r in enumerate(brute.quality([x[:2] for x in rows]))]
    want, limit = plain_kept(measured, {i: bool(q) for i, q in labels})
    assert len({s for s, _ in limit}) >= 2 and all(s for s, _ in limit)
    assert [got[i]["_lt_kept"] for i in range(len(rows))] == want
    assert sum(not k and not m[1] for k, m in zip(want, measured, strict=True)) > 50


def test_binomial_tail_large(spark):
    """Against the sum over all terms, and bounded work for a billion labels."""
    cases = [(5000, 70, 0.02), (5000, 0, 0.02), (40000, 700, 0.02), (50, 0, 0.02)]
    for n, r, rate in cases:
        logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate) for k in range(r + 1)]
        top = max(logs)
        want = top + math.log(sum(math.exp(x - top) for x in logs))
        got = spark.range(1).select(quality.log_binomial_tail(F.lit(n).cast("long"), F.lit(r).cast("long"), rate)).first()[0]
        assert abs(got - want) < 1e-6
    big = spark.range(1).select(quality.log_binomial_tail(F.lit(10**9).cast("long"), F.lit(19_990_000).cast("long"), 0.02)).first()[0]
    assert -10 < big < -1


# --- secrets ---


def test_ledger_versions(spark):
    """Spans belong to a rule version: scanning again under another finds each once, and old ones don't count."""
    versions = spark.createDataFrame([("a", "token=abcdef1"), ("b", "x")], "path string, text string")
    spans, pairs = secrets.scan_unseen(versions, rule_version="1")
    findings, ledger = secrets.scan_versions(versions, ledger=pairs, past=spans, rule_version="2")
    assert [len(r.spans) for r in findings.collect()] == [1] and ledger.count() == 4
    again, same = secrets.scan_versions(versions, ledger=ledger, past=spans.unionByName(spans), rule_version="1")
    assert [len(r.spans) for r in again.collect()] == [1] and same.count() == 4
    lost, _ = secrets.scan_versions(versions, ledger=pairs.limit(0), past=spans, rule_version="1")  # spans of pairs that the ledger lacks are found anew
    assert [len(r.spans) for r in lost.collect()] == [1]


def test_commits(spark, rows):
    """A history of commits, blobs repeated across them, gives what one scan of all gives."""
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [df.where("doc_id % 3 = 0"), df.where("doc_id % 3 = 1 or doc_id is null"), df, df.where("doc_id % 3 = 2")]
    findings, ledger = secrets.scan_commits(parts)
    one, _ = secrets.scan_versions(df)
    assert order((r.blob, str(r.spans)) for r in findings.collect()) == order((r.blob, str(r.spans)) for r in one.collect())
    assert ledger.count() == ledger.distinct().count() == df.select(secrets.blobs_of(df)).distinct().count()


def test_added_kinds(spark):
    texts = ["é -----BEGIN RSA PRIVATE KEY----- x -----BEGIN PRIVATE KEY-----", "ghp_" + "a1B2" * 10 + " ghx_" + "a" * 40, "t eyJhbGciOiJ.eyJzdWIiOiI.abcdefgh-_ eyJ.eyJ.x", "none", ""]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "blob string, text string")
    got = {(r.blob, r.kind, r.start, r.end) for r in secrets.scan_blobs(df).where("rank > 2").collect()}
    want = {(str(i), r.kind, m.start(), m.end()) for i, t in enumerate(texts) for r in secrets.RULES[3:] for m in re.finditer(r.pattern, t)}
    assert got == want and len(want) == 4


# --- toxicity ---


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, last[j] + (x != y), last[j + 1] + 1))
    return row[-1]


def plain_match(lexicon, raw):
    """An entry of a word by comparing it with every entry."""
    word = raw.strip(toxicity.EDGE)
    if word in lexicon.words:
        return word, lexicon.words[word]
    for s in sorted(lexicon.stems, key=len):
        if word.startswith(s):
            return s, lexicon.stems[s]
    if re.search(r"(.)\1{2,}", word):
        word = re.sub(r"(.)\1{2,}", r"\1", word)
        if word in lexicon.words:
            return word, lexicon.words[word]
    near = sorted((distance(word, e), e) for e in lexicon.near if word not in lexicon.benign and distance(word, e) <= 1)
    return (near[0][1], 0.7 * lexicon.words[near[0][1]]) if near else None


def test_scores_against_plain(spark):
    """Scores of texts by a plain scorer: entries by comparison with the whole lexicon, windows by slices."""
    rng = random.Random(6)
    words = {w: rng.uniform(0.2, 1) for w in ("idiot", "clown", "scum", "moron", "filthy", "garbage", "loser", "dumb")}
    lexicon = toxicity.Lexicon(words, {"stupi": 0.9}, frozenset({"clowns"}), frozenset(words) - {"dumb"})
    model = toxicity.Model(lexicon, (-3.0, 5.0, 0.7))
    pool = [*words, "idi0t", "cl0wn", "clowns", "scums", "morons", "iidiot", "loooser", "stupidity", "you", "said", '"scum"', "word", "the", "a", "of", "dum", "garbag", "lo", "moon", "crown", "x,", "idiot!!"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(300)] + [None, "", " \n"]

    def plain(text):
        raw = (text or "").lower().split()
        found = {i: m for i, w in enumerate(raw) if (m := plain_match(lexicon, w))}
        total, entries = 0.0, set()
        for i, (entry, weight) in found.items():
            window = {w.strip(toxicity.EDGE) for w in raw[max(0, i - 5) : i + 6]}
            others = sum(0 < abs(j - i) <= 5 for j in found)
            quoted = (raw[i][0] in toxicity.QUOTES and raw[i].rstrip(".,;:!?")[-1] in toxicity.QUOTES) or bool(window & toxicity.REPORTING)
            total += weight * (0.25 if quoted and not others else 1.5 if others or window & toxicity.ADDRESSED else 1)
            entries.add(entry)
        z = -3.0 + 5.0 * math.log1p(total) + 0.7 * math.log1p(len(entries))
        return 1 / (1 + math.exp(-z))

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r["_lt_score"] for r in toxicity.score(df, model).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-9 for i, t in enumerate(texts))


# --- near copies ---


def test_components_in_blocks(spark):
    """Blocks of a few links, contracted and then joined by rounds, give what one block gives."""
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1090)]
    df = spark.createDataFrame(links, "u long, v long")
    one = {r.node: r.root for r in components.components(df).collect()}
    many = {r.node: r.root for r in components.components(df, block=7).collect()}
    assert one == many and one[1090] == 1000
    assert components.components(df.limit(0)).count() == 0


def test_index_stays_off_the_driver(spark, monkeypatch):
    """However small the index seems to Spark, its joins send none of it to the driver."""
    plans, cut = [], simhash.cut
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(simhash, "cut", lambda df: (cut(df), plans.append(plan(df)))[0])
    links = simhash.near_links(spark.range(500).select(F.lit(0).alias("tab"), F.xxhash64(F.col("id").bitwiseAND(-2)).bitwiseXOR(F.col("id") % 2).alias("fp")))
    assert links.count() == len(links.collect()) == 500  # both ways
    plans.append(plan(links))
    assert all("SortMergeJoin" in p and "Broadcast" not in p for p in plans) and len(plans) == 2


def test_candidates_by_fingerprint(spark):
    """Most pairs that share 0.8 of their shingles are connected by word fingerprints alone; all are in the end."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(4000)]
    rows = []
    for _ in range(80):
        base = rng.choices(vocabulary, k=rng.randint(80, 400))
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 50)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = nearcopies.prefixes(docs).checkpoint()
    sets = made.groupBy("sid").agg(F.min(F.struct("_lt_doc", "_lt_key", "n", "fps", "sketch")).alias("s")).select("sid", "s.*").checkpoint()
    sid = {r["_lt_doc"]: r.sid for r in made.select("_lt_doc", "sid").collect()}
    own = [set(nearcopies.shingles(t).tolist()) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a - a % 4, a) if sid[a] != sid[b] and 9 * len(own[a] & own[b]) >= 4 * (len(own[a]) + len(own[b]))]
    found = nearcopies._plausible(nearcopies._by_fingerprint(sets), sets)
    root = {r.node: r.root for r in components.components(found).collect()}
    hit = sum(root.get(sid[a], sid[a]) == root.get(sid[b], sid[b]) for a, b in near)
    assert len(near) > 200 and hit >= 0.9 * len(near), (hit, len(near))
    group = {r["_lt_doc"]: r.root for r in nearcopies.near_copies(docs).select("_lt_doc", "root").collect()}
    assert all(group[a] == group[b] for a, b in near)


def test_sketch_bound():
    """Sketches never differ in more bits than sets do in shingles."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(100):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.int64).astype(np.uint64)
        a, b = (np.unique(pool[rng.random(400) < p]) for p in rng.random(2))
        bits = sum(int(x ^ y).bit_count() for x, y in zip(nearcopies.sketch(a), nearcopies.sketch(b), strict=True))
        assert bits <= len(np.setxor1d(a, b))


# --- all operators: names that clash, long texts ---


CLASHES = ("_lt_doc", "_lt_key", "_lt_text", "_lt_score", "_lt_matches", "_lt_lines", "_lt_dropped", "_lt_s", "_lt_salt", "_lt_own", "_lt_copy", "bits", "spans", "copies", "size", "c0", "c1", "root", "sid", "blob", "ids", "decoded", "n_words")


@pytest.fixture(scope="module")
def clashing(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in CLASHES}).repartition(3).checkpoint()


def test_operators_with_clashing_names(spark, rows, clashing):
    """Operators give the same beside columns of any name."""
    import public_tokenizers

    plain = spark.createDataFrame(rows, SCHEMA).checkpoint()
    ranks, pieces = public_tokenizers.path(queries.BPE_RANKS), public_tokenizers.path(queries.UNIGRAM_PIECES)
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    made = {
        "encode": lambda d: bpe.encode(d, ranks, public_tokenizers.PATTERN), "counts": lambda d: tokencounts.token_counts(d, pieces), "secrets": lambda d: secrets.scan_versions(d)[0].select("blob"),
        "simhash": lambda d: simhash.near_groups(d).select("doc_id", "component_id"), "quality": lambda d: quality.judge(d, labels).select("doc_id", "_lt_kept"), "substrings": lambda d: substrings.dedup_substrings(d),
        "mixing": lambda d: mixing.mix_sources(d).select("doc_id", "copies"), "near": lambda d: nearcopies.near_copies(d).select("_lt_doc", "root"), "decode": lambda d: bpe.decode(bpe.encode(d, ranks, public_tokenizers.PATTERN), ranks).select("doc_id", "decoded"),
    }
    for name, f in made.items():
        assert order(f(clashing).collect()) == order(f(plain).collect()), name
    vectors = spark.createDataFrame([(i, [float(i % 5), 1.0], "x", "y") for i in range(30)], "vec_id long, embedding array<double>, id string, part string")
    q = topk.quantised(vectors)
    assert topk.top_k(q.where("id % 20 = 0"), q).count() == 40


def test_stages_with_clashing_names(spark, folder, clashing):
    """Stages return the columns they got, with their values."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, f"{folder}/full")
        assert out.columns == clashing.columns, name
        assert out.where(" and ".join(f"`{c}` = 'own {c}'" for c in CLASHES)).count() == out.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, clashing, f"{folder}/full").count() == clashing.count()


def test_stages_against_plain(spark, folder, rows):
    """Each stage on its own input: what it keeps and changes, by plain versions."""
    import public_tokenizers

    full = f"{folder}/full"
    docs = spark.read.parquet(f"{full}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    scored = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{full}/labels.parquet").where(~queries.held_out())))
    kept = stages["toxicity"](spark, docs, full)
    assert order(kept.collect()) == order(r[:5] for r in scored.collect() if r["_lt_score"] < 0.5)
    cleaned = stages["line dedup"](spark, docs, full).collect()
    assert order((r.doc_id, brute.sha(r.text)) for r in cleaned) == order((r[0], r[3]) for r in brute.lines([x[:2] for x in rows]))
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in cleaned)
    mixed = Counter(tuple(r) for r in stages["mixing"](spark, docs, full).collect())
    taken = Counter()
    for r in mixing.mix_sources(docs).collect():
        taken[r.doc_id, r.source] += r.copies
    got = Counter()
    for r, n in mixed.items():
        got[r[0], r[3]] += n
    assert got == +taken and set(mixed) <= {tuple(r) for r in rows}
    encoding = bpe._encoder(bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS)), public_tokenizers.PATTERN)
    out = stages["byte-level BPE"](spark, docs, full).collect()
    assert order((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == order(brute.bpe([x[:2] for x in rows], encoding))
    assert all(len(r.ids) == r.n_tokens for r in out)


def test_very_long_text(spark):
    """One text of millions of characters among short ones."""
    import public_tokenizers

    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    long = " ".join(rng.choices(vocabulary, k=400_000))
    rows = [(1, long[:60_000]), (2, long), (3, "short"), (4, long[100_000:160_000])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in substrings.dedup_substrings(df).select("doc_id", "n_words", "n_removed").collect()}
    assert out[2].n_words == 400_000 and out[1].n_removed == 0 and out[4].n_removed >= out[4].n_words - 2
    encoding = bpe._encoder(bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS)), public_tokenizers.PATTERN)
    ids = {r.doc_id: r.ids for r in bpe.encode(df, public_tokenizers.path(queries.BPE_RANKS), public_tokenizers.PATTERN).collect()}
    assert all(ids[i] == encoding.encode_ordinary(t) for i, t in rows)
    lined = spark.createDataFrame([(i, long.replace(" ", "\n", 100_000)) for i in range(2)] + [(9, "x")], "doc_id long, text string")
    assert sorted(r["_lt_lines"] for r in lines.dedup_lines(lined).collect()) == [1, 100_001, 100_001]


def test_block_memory(monkeypatch):
    """A block's positions are worked on in parts: joining the answers takes less than 30 bytes a position (44 before)."""
    import tracemalloc

    import pyarrow as pa

    from loomtrace.llm import wordshuffle as w

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(w, "TaskContext", Task)
    n = 3 << 20
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3], pa.int64()), pa.array(["a b c " * (n // 3), "", "c d"])], names=["i", "t"])
    tracemalloc.start()
    out = pa.Table.from_batches(list(w._blocks(lambda t: t.split(), 1, 1 << 30)([batch])))
    out = w._answers(lambda words: [list(x) * 2 for x in words])(out)
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    got = w._lists(out)
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    ids = got.column("ids").combine_chunks()
    assert got.column("n_words").to_pylist() == [n, 0, 2] and [len(x) for x in ids] == [2 * n, 0, 4]
    assert ids[2].as_py() == [99, 99, 100, 100] and ids[0].values[:6].to_pylist() == [97, 97, 98, 98, 99, 99] and ids[0].values[-2:].to_pylist() == [99, 99]
    assert most < 30 * n, most / n
