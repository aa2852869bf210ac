"""Toxicity by a lexicon trie, Levenshtein automata and context windows.

A lexicon is learned from labelled rows: whole words, and stems (prefixes with several
continuations), that occur in toxic rows in varied contexts and hardly ever in clean ones.
Counting distinct neighbours rather than rows keeps a copied toxic document from turning its
every word into an entry. A word of a text matches an entry exactly, by its stem, or within
one edit: the word's Levenshtein automaton is intersected with the trie of whole words.
Words near an entry that clean rows use are benign. Each match is weighed by its window:
quotation marks or reporting words make it a quotation, an addressed reader or further
matches make it abuse. A logistic model over the summed weights gives the score.

Learning uses a bounded sample of labelled rows (``most_rows`` of either label); all rows are
scored, whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.common import cut, lean, numbered, small_batches, text_of

# Characters stripped from a word's ends, and the words and marks that context windows look for.
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’‚…–—¡¿"
QUOTES = "\"'«»“”„‘’‚"
REPORTING = frozenset("said says say quote quoted quotes quoting wrote called calls word words term terms phrase slur insult".split())
ADDRESSED = frozenset("you your you're youre u ur yourself du dich dein tu ton te vous usted".split())
PREFIXES = (4, 5, 6, 7)
WINDOW = 5
LONG_RUN = re.compile(r"(.)\1{2,}")
REMEMBERED = 300_000  # words classified before a task forgets them; only speed depends on it


class LevenshteinAutomaton:
    """States are rows of the edit distance table to ``word``; entries above ``most`` are capped."""

    def __init__(self, word: str, most: int) -> None:
        self.word, self.most = word, most

    def start(self) -> tuple[int, ...]:
        return tuple(min(i, self.most + 1) for i in range(len(self.word) + 1))

    def step(self, state: tuple[int, ...], char: str) -> tuple[int, ...]:
        row = [min(state[0] + 1, self.most + 1)]
        for i, c in enumerate(self.word):
            row.append(min(row[i] + 1, state[i] + (c != char), state[i + 1] + 1, self.most + 1))
        return tuple(row)

    def alive(self, state: tuple[int, ...]) -> bool:
        return min(state) <= self.most

    def distance(self, state: tuple[int, ...]) -> int:
        return state[-1]


def trie_of(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def intersect(trie: dict, automaton: LevenshteinAutomaton) -> tuple[int, str] | None:
    """The nearest (distance, entry) that both accept, ties to the smaller entry."""
    best, stack = None, [(trie, automaton.start())]
    while stack:
        node, state = stack.pop()
        for char, child in node.items():
            if char == "":
                if automaton.distance(state) <= automaton.most and (best is None or (automaton.distance(state), child) < best):
                    best = automaton.distance(state), child
            elif automaton.alive(after := automaton.step(state, char)):
                stack.append((child, after))
    return best


def without_one(word: str) -> list[str]:
    """The word with each of its characters left out."""
    return [word[:i] + word[i + 1 :] for i in range(len(word))]


@dataclass
class Lexicon:
    """Entries with their weights (0 to 1). Only entries of ``near`` match within one edit."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    benign: frozenset[str] = frozenset()
    near: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self.trie = trie_of(sorted(self.near))
        # two words within one edit agree once a character of one, the other, or each is left out: few other words get to the trie
        self.shorter = {x for w in self.near for x in (w, *without_one(w))}
        self.lengths = (min(map(len, self.near), default=1) - 1, max(map(len, self.near), default=0) + 1)
        self.stem_lengths = sorted({len(s) for s in self.stems})

    def match(self, raw: str) -> tuple[str, float] | None:
        """(entry, weight) of a lower-cased word: exactly, by its stem, or at 0.7 of the weight within one edit."""
        word = raw.strip(EDGE)
        if word in self.words:
            return word, self.words[word]
        for n in self.stem_lengths:
            if word[:n] in self.stems:
                return word[:n], self.stems[word[:n]]
        if LONG_RUN.search(word):
            word = LONG_RUN.sub(r"\1", word)
            if word in self.words:
                return word, self.words[word]
        if not self.lengths[0] <= len(word) <= self.lengths[1] or word in self.benign:
            return None
        if word in self.shorter or not self.shorter.isdisjoint(without_one(word)):
            found = intersect(self.trie, LevenshteinAutomaton(word, 1))
            return (found[1], 0.7 * self.words[found[1]]) if found else None
        return None


@dataclass
class Model:
    lexicon: Lexicon
    weights: tuple[float, float, float] = (-6.0, 8.0, 0.0)
    known: dict = field(default_factory=dict)
    seen: set = field(default_factory=set)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "seen": set()}

    def matches(self, text: str) -> list[tuple[int, str, str, float, bool]]:
        """(position, word, entry, weight, quoted) of every match, weights set by context."""
        raw = text.lower().split()
        new = set(raw) - self.seen
        for w in new:
            found = self.lexicon.match(w)
            if found:
                self.known[w] = found
        self.seen |= new
        hits = [] if self.known.keys().isdisjoint(raw) else [i for i, w in enumerate(raw) if w in self.known]
        out = []
        for at, i in enumerate(hits):
            entry, weight = self.known[raw[i]]
            window = [w.strip(EDGE) for w in raw[max(0, i - WINDOW) : i + WINDOW + 1]]
            marks = raw[i][0] in QUOTES and raw[i].rstrip(".,;:!?")[-1] in QUOTES
            quoted = marks or not REPORTING.isdisjoint(window)
            others = sum(abs(j - i) <= WINDOW for j in hits[max(0, at - WINDOW) : at + WINDOW + 1]) - 1
            if quoted and not others:
                weight *= 0.25
            elif others or not ADDRESSED.isdisjoint(window):
                weight *= 1.5
            out.append((i, raw[i], entry, weight, quoted))
        if len(self.seen) > REMEMBERED:
            self.seen, self.known = set(), {}
        return out

    def features(self, found: list[tuple]) -> tuple[float, float]:
        return math.log1p(sum(m[3] for m in found)), math.log1p(len({m[2] for m in found}))

    def score(self, found: list[tuple]) -> float:
        a, b = self.features(found)
        z = self.weights[0] + self.weights[1] * a + self.weights[2] * b
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def labelled(docs: DataFrame, labels: DataFrame, most_rows: int, seed: int = 1) -> DataFrame:
    """(_lt_text, _lt_toxic) of at most ``most_rows`` rows of either label, by hash of the id."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("_lt_toxic"))
    pick = lambda label: known.where(F.col("_lt_toxic") == label).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most_rows)
    ids = pick(1).unionByName(pick(0)).withColumnRenamed("doc_id", "_lt_id")
    rows = docs.select(docs["doc_id"].alias("_lt_doc"), text_of(docs).alias("_lt_text"))
    # at most 2 * most_rows ids: a size fixed by the parameter
    return rows.join(F.broadcast(ids), F.col("_lt_doc") == F.col("_lt_id")).select("_lt_text", "_lt_toxic")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) >> 1


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("term", pa.string()), ("word", pa.string()), ("row", pa.int64()), ("near", pa.int64())])
    for batch in batches:
        for text in batch.column(0).to_pylist():
            words = [w.strip(EDGE) for w in text.lower().split()]
            row, rows = _hash(text), set()
            for before, w, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                near = _hash(f"{before} {after}")
                if w:
                    rows.add((w + "\0", w, row, near))
                    rows.update((w[:n], w, row, near) for n in PREFIXES if len(w) >= n)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _uses(terms: set[str], lexicon: Lexicon | None = None):
    """Per text: which terms it uses; with a lexicon, which words near an entry instead."""
    schema = pa.schema([("term", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str] = []
            for text in batch.column(0).to_pylist():
                words = {w.strip(EDGE) for w in text.lower().split()}
                if lexicon is None:
                    found += {t for w in words for t in (w + "\0", *(w[:n] for n in PREFIXES if len(w) >= n))} & terms
                else:
                    found += [w + "\0" + m[0] for w in words if (m := lexicon.match(w)) and w != m[0] and m[0] not in lexicon.stems]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], schema=schema)

    return run


def learn_lexicon(sample: DataFrame, least_rows: int = 3, least_contexts: int = 5, least_lift: float = 15.0) -> Lexicon:
    """From (_lt_text, _lt_toxic). A term's lift is its rate in toxic rows over that in clean ones;
    of stems that are each other's prefixes the one that tells most is kept. What reaches the
    driver are terms and words of the sample, whose rows are bounded: terms that ``least_rows``
    toxic rows use in ``least_contexts`` contexts, and words near an entry."""
    toxic, clean = sample.where("_lt_toxic = 1").select("_lt_text"), sample.where("_lt_toxic = 0").select("_lt_text")
    sizes = {r["_lt_toxic"]: r["count"] for r in sample.groupBy("_lt_toxic").count().collect()}
    terms = toxic.mapInArrow(lean(_terms), "term string, word string, row long, near long")
    terms = terms.groupBy("term").agg(F.count_distinct("row").alias("rows"), F.count_distinct("near").alias("contexts"), F.count_distinct("word").alias("words"))
    # without any clean row that uses it a term's lift is at most this; others can't reach the least one
    reach = (F.col("rows") + 0.5) / (sizes.get(1, 0) + 1) * (sizes.get(0, 0) + 1) / 0.5
    terms = terms.where((F.col("rows") >= least_rows) & (F.col("contexts") >= least_contexts) & (reach >= least_lift))
    found = {r["term"]: r for r in terms.collect()}
    used = clean.mapInArrow(_uses(set(found)), "term string").groupBy("term").count()
    uses = {r["term"]: r["count"] for r in used.collect()}
    lift = {t: (r["rows"] + 0.5) / (sizes[1] + 1) * (sizes.get(0, 0) + 1) / (uses.get(t, 0) + 0.5) for t, r in found.items()}
    weight = {t: min(1.0, max(0.2, (math.log(x) - 2) / 2)) for t, x in lift.items() if x >= least_lift}
    tells = lambda t: (-found[t]["rows"] * math.log(lift[t]), t)
    stems: dict[str, float] = {}
    for t in sorted((t for t in weight if t[-1] != "\0" and found[t]["words"] >= 4), key=tells):
        if not any(t.startswith(k) or k.startswith(t) for k in stems):
            stems[t] = weight[t]
    words = {t[:-1]: weight[t] for t in weight if t[-1] == "\0" and len(t) > 3 and not any(t.startswith(k) for k in stems)}
    # an entry among whose neighbours clean rows have many words says nothing about a misspelling
    trial = Lexicon(words, stems, near=frozenset(w for w in words if len(w) >= 4))
    near = clean.mapInArrow(_uses(set(), trial), "term string").distinct()
    pairs = [r["term"].split("\0") for r in near.collect()]
    crowded = Counter(entry for _, entry in pairs)
    return Lexicon(words, stems, frozenset(w for w, _ in pairs), frozenset(w for w in trial.near if crowded[w] <= 2))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights (intercept first) by Newton's method with a ridge penalty."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 4000, **options) -> Model:
    """A model from the labelled rows of ``docs``; ``labels`` has doc_id and toxic (0 or 1; other
    values are no labels; of an id labelled twice the larger counts). Without a toxic and a
    clean row the lexicon is empty and every text scores low."""
    small_batches(docs.sparkSession)
    sample = cut(labelled(docs, labels, most_rows))
    model = Model(learn_lexicon(sample, **options))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(model.matches(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()), batch.column(1).cast(pa.int32())], names=["a", "b", "y"])

    rows = np.array(sample.mapInArrow(features, "a double, b double, y int").collect(), float).reshape(-1, 3)
    rows = rows[np.lexsort(rows.T)]
    if len(set(rows[:, 2])) == 2:
        w = logistic(rows[:, :2], rows[:, 2])
        if w[1] > 0 and w[1] + w[2] > 0:  # else the features tell nothing, and the default says so
            model.weights = tuple(float(v) for v in w)
    return model


MATCH = pa.struct([("position", pa.int32()), ("word", pa.string()), ("entry", pa.string()), ("weight", pa.float64()), ("quoted", pa.bool_())])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows and columns of ``docs``, whatever their names, and last ``_lt_score`` (0 to 1) and
    ``_lt_matches``, an array of (position, word, entry, weight, quoted). Null and empty texts have
    no match and score low; equal rows score alike; a text is held in memory whole."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    docs, _, back = numbered(docs)
    names = [*docs.columns, "_lt_score", "_lt_matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.matches(t or "") for t in batch.column(at).to_pylist()]
            fields = [[dict(zip(("position", "word", "entry", "weight", "quoted"), m, strict=True)) for m in f] for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([own.score(f) for f in found], pa.float64()), pa.array(fields, pa.list_(MATCH))], names=names)

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    out = docs.mapInArrow(lean(run), f"{fields}, _lt_score double, _lt_matches array<struct<position:int,word:string,entry:string,weight:double,quoted:boolean>>")
    return out.select(*back, "_lt_score", "_lt_matches")
