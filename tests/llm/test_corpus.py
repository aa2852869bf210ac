"""The corpus operators against plain versions, over awkward rows and over real ones."""

import math
from collections import Counter

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomtrace.llm import bpe, components, lines, mixing, packed, quality, queries, secrets, simhash, substrings, tokencounts, topk, toxicity, wordshuffle


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def two(rows):
    return [r[:2] for r in rows]


def run(spark, folder, name, which="full"):
    return queries.QUERIES[name](spark, f"{folder}/{which}").collect()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, folder, name):
    assert run(spark, folder, name, "empty") == []


def test_lines(spark, folder, rows):
    assert order(run(spark, folder, "op4_line_dedup")) == order(brute.lines(two(rows)))


def test_secrets(spark, folder, rows):
    got = run(spark, folder, "op5_secret_scan")
    assert order(r[:5] for r in got) == order(brute.secrets(two(rows)))
    assert "assign:" in "".join(r.spans for r in got)


def test_secret_ledger(spark):
    versions = spark.createDataFrame([("a", "token=abcdef1"), ("b", "token=abcdef1"), ("c", "nothing"), ("d", "-----BEGIN RSA PRIVATE KEY-----")], "path string, text string")
    findings, ledger = secrets.scan_versions(versions)
    assert ledger.count() == 3 and findings.count() == 2
    more = versions.unionByName(spark.createDataFrame([("e", "secret: zzzzzz")], "path string, text string"))
    again, ledger2 = secrets.scan_versions(more, ledger=ledger)
    assert [len(r.spans) for r in again.collect()] == [1]  # only the blob not seen before
    assert ledger2.count() == 4
    assert secrets.scan_versions(more, ledger=ledger2, rule_version="2")[0].count() == 3


def test_quality(spark, folder, rows):
    got = run(spark, folder, "op7_quality_rules")
    assert order(r[:7] for r in got) == order(brute.quality(two(rows)))
    assert not any(r.kept and r.base_failed for r in got)


def test_binomial_tail(spark):
    n, r, rate = 200, 3, 0.05
    want = math.log(sum(math.comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(r + 1)))
    got = spark.range(1).select(quality.log_binomial_tail(F.lit(n).cast("long"), F.lit(r).cast("long"), rate)).first()[0]
    assert abs(got - want) < 1e-9


def test_safe_cutoffs(spark):
    """2000 good rows of which none has more than 0.2: every cutoff from there is safe, those below are not."""
    scored = spark.range(2000).select(F.lit("x").alias("s"), F.lit(True).alias("good"), (F.col("id") % 3 / 10).alias("m"))
    out = quality.safe_cutoffs(scored, "s", "good", risk=0.02, grid={"m": (0.05, 0.15, 0.2, 0.3)}).collect()
    assert [(r.rule, r.cutoff) for r in out] == [("m", 0.2)]
    few = quality.safe_cutoffs(scored.limit(20), "s", "good", risk=0.02, grid={"m": (0.2,)})
    assert few.count() == 0


def test_bpe(spark, folder, rows):
    encoding = bpe._encoder(bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS)), public_tokenizers.PATTERN)
    assert order(run(spark, folder, "op3_byte_bpe")) == order(brute.bpe(two(rows), encoding))


def test_token_counts(spark, folder, rows):
    pieces = tokencounts.read_pieces(public_tokenizers.path(queries.UNIGRAM_PIECES))
    assert order(run(spark, folder, "op10_token_counts")) == order(brute.unigram(two(rows), pieces))


def test_many_blocks(spark, rows):
    """Blocks of a few words and few buckets give what one block gives."""
    df = spark.createDataFrame(rows, "doc_id long, text string, a string, b string, c long")
    split, work = (lambda t: t.encode().split()), (lambda ws: [[len(w), i] for i, w in enumerate(ws)])
    one = wordshuffle.apply_to_words(df, split, lambda ws: [[len(w), w[0]] for w in ws])
    small = wordshuffle.apply_to_words(df.repartition(5), split, lambda ws: [[len(w), w[0]] for w in ws], block_chars=200)
    assert order((r.doc_id, r.n_words, tuple(r.ids)) for r in one.collect()) == order((r.doc_id, r.n_words, tuple(r.ids)) for r in small.collect())
    assert work([b"a"]) == [[1, 0]]


def test_substrings(spark, folder, rows):
    want = order(brute.substrings(two(rows)))
    assert order(run(spark, folder, "op8_substring_dedup")) == want
    df = spark.createDataFrame(rows, "doc_id long, text string, a string, b string, c long").repartition(4)
    small = substrings.dedup_substrings(df, block_chars=500, buckets=64).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert order(small.collect()) == want


def test_simhash(spark, folder, rows):
    assert order(run(spark, folder, "op6_simhash")) == order(brute.simhash(two(rows)))


def test_simhash_crowded(spark):
    """Keys over the pair limit go through shared neighbours and connect the same fingerprints."""
    base = 0x0123456789ABCDEF
    fps = [base] + [base ^ (1 << k) for k in range(40)] + [base ^ (7 << 20), 5, 4, 1 << 50]
    df = spark.createDataFrame([(0, x) for x in fps], "tab int, fp long")
    roots = []
    for most_pairs in (10**9, 1):
        links = simhash.near_links(df, 2, most_pairs).select("u", "v")
        roots.append({(r.node, r.root) for r in components.components(links).collect()})
    assert roots[0] == roots[1]
    near = {frozenset((a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    assert {frozenset((r.u, r.v)) for r in simhash.near_links(df, 2, 10**9).collect()} == near


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_near_copies(spark, docs, rows):
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert max(ids.values()) == 1  # equal rows, and rows of equal id that are near, leave one
    assert not {104 + k for k in range(6)} & set(ids)  # copies of 4
    assert {i for i in range(40) if i not in (3, 4)} - set(ids) == set()
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0


def test_topk(spark, folder):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/full/embeddings.parquet").collect()]
    want = order(brute.topk(vectors))
    assert order(run(spark, folder, "op2_exact_topk")) == want
    q = topk.quantised(spark.read.parquet(f"{folder}/full/embeddings.parquet"))
    assert order(topk.top_k(q.where("id % 20 = 0"), q, shard=3, block=2).collect()) == want


def test_mixing(spark, folder, rows):
    got = run(spark, folder, "op9_mix_sources")
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(brute.words(t))
    targets = brute.targets(sizes)
    out = mixing.mix_sources(spark.read.parquet(f"{folder}/full/documents.parquet")).collect()
    taken = Counter()
    for r in out:
        assert abs(r.target - targets[r.source]) < 1e-6 and r.source_size == sizes[r.source] and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    biggest = Counter()
    for _, t, _, s, _ in rows:
        biggest[s] = max(biggest[s], len(brute.words(t)))
    assert all(abs(taken[s] - targets[s]) <= biggest[s] for s in sizes)
    assert order(got) == order(run(spark, folder, "op9_mix_sources"))  # reruns agree


def test_mixed_rows(spark, docs):
    copies = mixing.mix_sources(docs).groupBy().sum("copies").first()[0]
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == copies


def test_source_targets(spark):
    for sizes in ({"a": 5, "b": 1, "c": 1, None: 100}, {"a": 0, "b": 0}, {"a": 10}, {str(k): k * k for k in range(30)}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = brute.targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_levenshtein_automaton():
    words = ["idiot", "clown", "scum", "moron"]
    trie = toxicity.trie_of(words)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(row[j] + 1, last[j] + (x != y), last[j + 1] + 1))
        return row[-1]

    for w in ("idiot", "idi0t", "idiots", "idot", "dioit", "cum", "scam", "clwn", "oron", "maroon", ""):
        near = sorted((plain(w, x), x) for x in words)
        got = toxicity.intersect(trie, toxicity.LevenshteinAutomaton(w, 1))
        assert got == (near[0] if near[0][0] <= 1 else None)


def test_context():
    model = toxicity.Model(toxicity.Lexicon({"idiot": 1.0, "scum": 1.0}, near=frozenset({"idiot", "scum"})), (-3.0, 6.0, 0.0))
    score = lambda t: model.score(model.matches(t))
    assert score("you idiot") > 0.5 and score("such an idi0t and scvm") > 0.5 and score("what an idioooot") > 0.5
    assert score('the word "idiot" appears') < 0.5 < score("the idiot scum appears")
    assert score("a clean text") < 0.1 and score("") < 0.1


def test_toxicity_held_out(spark, sf_dir):
    """Accuracy on rows whose labels were not learned from."""
    folder = sf_dir.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op1_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    hit = Counter((labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels)
    assert hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.85
    assert hit[0, 0] / (hit[0, 0] + hit[0, 1]) > 0.98


def test_toxicity_rows(spark, folder, rows):
    got = run(spark, folder, "op1_toxicity")
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_lines_keep_columns(docs):
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_lt_lines", "_lt_dropped"] and out.count() == docs.count()


def test_packed():
    import numpy as np

    arrays = [np.array([], np.int64), np.array([1, -5, 2**60], np.int64), np.array([3, 70000], np.uint32)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, packed.unpack(packed.pack(*arrays)), strict=True))
    for words in ([], [b""], [b"a", b"", "é".encode()]):
        assert packed.unpack_strings(packed.pack_strings(words)) == words


def test_pipeline(spark, folder, rows):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{folder}/full/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{folder}/full")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.checkpoint()
        sizes.append(docs.count())
    assert sizes[1] == sizes[2] > sizes[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, f"{folder}/full")
    assert out.count() == sizes[-1] and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0
