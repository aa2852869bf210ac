"""The pipeline's near dedup against all pairs of documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomtrace.llm import nearcopies


def sets(text):
    w = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def groups(rows):
    """Places of ``rows`` by component of similarity 0.8 over five-word shingles."""
    own = [sets(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if own[a] == own[b] or 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b]):
                root[find(a)] = find(b)
    out = {}
    for a in range(len(rows)):
        out.setdefault(find(a), set()).add(a)
    return list(out.values())


def kept(rows, groups):
    """The ids kept, a row a group."""
    least = lambda i: -(2**63) if i is None else i
    return sorted(min(least(rows[k][0]) for k in g) for g in groups)


def ids(df):
    return sorted(r[0] for r in df.select(F.coalesce("doc_id", F.lit(-(2**63)))).collect())


def near_rows():
    """Copies of some texts with words changed, swapped, repeated and cut, about the limit on either side."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(25):
        w = rng.choices(vocabulary, k=rng.choice([3, 7, 12, 40, 90, 200]))
        rows.append((len(rows), " ".join(w)))
        for _ in range(rng.randint(0, 12)):
            v = list(w)
            for _ in range(rng.randint(0, 1 + len(w) // 25)):
                v[rng.randrange(len(v))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(v[: len(v) - rng.choice([0, 0, 1, len(w) // 6])]).upper() if rng.random() < 0.3 else " ".join(v)))
    # the same words in another order have no shingle in common
    rows += [(len(rows), " ".join(vocabulary[:100])), (len(rows) + 1, " ".join(vocabulary[99::-1]))]
    return rows


@pytest.mark.parametrize("most_pairs", [1, 20, 4096])
def test_groups(spark, most_pairs):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {}
    for r in nearcopies.near_copies(docs, most_pairs=most_pairs).collect():
        found.setdefault(r.root, set()).add(r._lt_doc)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups(rows)))


def test_stage_links(spark):
    """Texts of the same words that share no shingle both stay; copies do not."""
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ids(corpus_pipeline.drop_copies(spark, docs, "")) == kept(rows, groups(rows))


def test_stage_ids(spark):
    """Unrelated texts of one id, or of none, all stay; a copy of one of them does not."""
    say = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(None, say(0)), (None, say(1)), (None, say(2)), (7, say(1)), (5, say(3)), (5, say(4)), (8, say(3)), (9, say(4)), (5, say(4)), (1, ""), (2, None), (3, " \t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = -(2**63)
    assert kept(rows, groups(rows)) == [none, none, none, 1, 5, 5]
    out = corpus_pipeline.drop_copies(spark, docs, "")
    assert ids(out) == [none, none, none, 1, 5, 5]
    assert {r.text for r in out.collect()} == {say(k) for k in range(5)} | {""}


def test_shared_places(spark):
    """What two prefixes have in common is found without a row a shingle: sorted parts move packed."""
    rows = near_rows()
    made = nearcopies.prefixes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("n > 0").checkpoint()
    sets = {(r.sid, r.n, tuple(r.prefix)) for r in made.collect()}
    where = {}
    for sid, n, prefix in sets:
        for i, h in enumerate(prefix):
            where.setdefault(h & (1 << 64) - 1, set()).add((sid, n, i))
    want = {(h >> 16, *x) for h, found in where.items() if len(found) > 1 for x in found}
    alone = {(h >> 16, *x) for h, found in where.items() if len(found) == 1 for x in found}
    for block in (50, 1 << 20):
        out = nearcopies._shared(made, block=block, bucket=100)
        got = {(r.h, r.sid, r.n, r.i) for r in out.collect()}
        # copies of one set count as several rows here, and as one set later
        assert want <= got <= want | alone
    assert "explode" not in out._jdf.queryExecution().toString()
