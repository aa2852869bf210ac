"""Plain Python restatements of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WHITE = " \t\n\x0b\x0c\r"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda s: hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def words(text):
    return SPLIT.findall(text or "")


def lines(docs):
    """docs: list of (doc_id, text)."""
    holders = defaultdict(set)
    key = lambda x: x.strip(WHITE).translate(LOW)
    order = lambda i: -(2**63) if i is None else i
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(order(i))
    out = []
    for i, t in docs:
        all_, kept = (t or "").split("\n"), []
        for x in all_:
            h = holders.get(key(x), ())
            if len(h) < 5 or max(h) == order(i):
                kept.append(x)
        out.append((i, len(all_), len(all_) - len(kept), sha("\n".join(kept))))
    return out


ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(docs):
    out = []
    for i, t in docs:
        t = t or ""
        found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        n = [sum(f[1] == k for f in found) for k in range(3)]
        out.append((i, *n, sha(",".join(f"{f[2]}:{f[0]}:{f[3]}" for f in sorted(found)))))
    return out


def quality(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = words(t)
        at = defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        rep = {k + d for v in at.values() if len(v) > 1 for k in v for d in range(5)}
        real = [x for x in t.split("\n") if SPLIT.search(x)]
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(real) - len(set(real)), len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w)))
    return out


def targets(sizes):
    """sizes: {source or None: words}; shared by rounds, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def bpe(docs, encoding):
    out = []
    for i, t in docs:
        ids = encoding.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha((t or "").encode())))
    return out


def unigram(docs, pieces):
    """Tokens of the best segmentation of each word, without any sharing."""
    import functools

    score = dict(pieces)
    longest, byte = max(map(len, score)), 10 + max(-s for s in score.values())

    @functools.lru_cache(None)
    def count(word):
        best = [(0.0, 0)]
        for e in range(1, len(word) + 1):
            choices = [(best[b][0] + score[word[b:e]], best[b][1] - 1) for b in range(max(0, e - longest), e) if word[b:e] in score]
            if word[e - 1] not in score:
                n = len(word[e - 1].encode())
                choices.append((best[e - 1][0] - byte * n, best[e - 1][1] - n))
            best.append(max(choices))
        return -best[-1][1]

    return [(i, len(words(t)), sum(count("▁" + w) for w in words(t))) for i, t in docs]


def substrings(docs, window=13):
    least = {}
    order = lambda i: -(2**63) if i is None else i
    cut = [(i, words(t)) for i, t in docs]
    for i, w in cut:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, 2**63), order(i))
    out = []
    for i, w in cut:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < order(i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def simhash(docs, shingle=3, most=2):
    import xxhash

    fps = []
    for _, t in docs:
        w = [x.translate(LOW) for x in words(t)]
        s = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
        h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    order = lambda i: -(2**63) if docs[i][0] is None else docs[i][0]
    for a in range(len(docs)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)), key=order)
                root[y] = x
    least = {}
    for a in range(len(docs)):
        r = find(a)
        least[r] = min(least.get(r, 2**63), order(a))
    return [(docs[a][0], f"{fps[a]:016x}", None if least[find(a)] == -(2**63) else least[find(a)]) for a in range(len(docs))]


def topk(vectors, k=20):
    import math

    rows = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in rows if i % 20 == 0}):
        q = min(q for j, q in rows if j == i)
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out
