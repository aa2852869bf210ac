"""SimHash near-dedup by deletion-variant signatures.

A fingerprint of 64 bits is cut into segments, fewer than the differing bits allowed plus
one, so that of two near fingerprints some segment differs by one bit at most: two segments
for two or three bits. Each segment is indexed as it is and with each of its set bits cleared
(a wildcard there: of two segments that differ at one bit only, the one with 1 clears to the
other). Equal keys are joined and every candidate pair is verified on all bits.

A key shared by so many fingerprints that its pairs would exceed ``most_pairs`` is not paired
up. Its fingerprints go an exact, linear way instead: two fingerprints differ in at most two
bits if and only if some value is within one bit of both, and at most 65 fingerprints are
within one bit of any value; so each fingerprint is dealt to its 65 such values, and those
that meet are linked. (For more than two bits the values within half of them are used.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.common import NO_ID, cut, id_of, shown_id, small_batches, text_of
from loomtrace.llm.components import components

BITS = 64
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
STEP = 1 << 16  # shingles counted at a time, so that a very long text needs no more memory


def fingerprint(text: str, shingle: int) -> int:
    """A bit is 1 if set in over half the XXH64 hashes (seed 42) of the text's shingles, repeats
    included; A-Z are lower-cased, and a text of fewer words is one shingle. No words: zero."""
    words = text.encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, ends = np.concatenate([[0], ends[:-1]]), ends - 1
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), STEP):
        pairs = zip(starts[at : at + STEP], ends[at : at + STEP], strict=True)
        hashes = np.array([digest(flat[a:b], 42) for a, b in pairs], dtype=np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


class _Stripped(dict):
    """Words and the hashes of what is left of them without what is neither letter nor digit at
    their ends, 0 if nothing is; as far as remembered, on which only speed depends."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 15:
            self.clear()
        own = word if word.isalnum() else EDGES.sub("", word)
        self[word] = found = xxhash.xxh64_intdigest(own.encode(), 42) if own else 0
        return found


STRIPPED = _Stripped()


def word_fingerprints(text: str, tables: int) -> list[int]:
    """Independent fingerprints over a text's distinct words, lower-cased and without what is
    neither letter nor digit at their ends. No words: zeros."""
    words = set(text.lower().split())
    base = np.unique(np.fromiter(map(STRIPPED.__getitem__, words), np.uint64, len(words)))
    base = base[base != 0]
    if not len(base):
        return [0] * tables
    out = []
    for t in range(tables):
        h = base + np.uint64((t + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        counts = np.zeros(BITS, np.int64)
        for at in range(0, len(h), STEP):
            counts += np.unpackbits(h[at : at + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits((2 * counts > len(h)).astype(np.uint8), bitorder="little").view(np.uint64)[0]))
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, tables: int = 1, text: str = "text") -> DataFrame:
    """(_lt_doc, _lt_key, fps) a row of ``docs``: id, text hash and fingerprints as longs of the
    same 64 bits: one over shingles, or of ``tables`` over 1 that many over distinct words."""
    small_batches(docs.sparkSession)
    rows = docs.select(id_of(docs).alias("_lt_doc"), F.xxhash64(text_of(docs, text)).alias("_lt_key"), text_of(docs, text).alias("_lt_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            fps = [word_fingerprints(t, tables) if tables > 1 else [fingerprint(t, shingle)] for t in texts]
            flat = np.array(fps, np.uint64).reshape(-1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, tables), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["_lt_doc", "_lt_key", "fps"])

    return rows.mapInArrow(run, "_lt_doc long, _lt_key long, fps array<long>")


def _segments(most: int) -> list[tuple[int, int]]:
    """(shift, width): most differing bits < 2 * segments."""
    n = most // 2 + 1
    edges = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def segment_index(fps: DataFrame, most: int, of: str = "fp") -> DataFrame:
    """(tab, seg, val, own, ``of``) from (tab, fp, ``of``): a row a segment as it is (own), and
    one a set bit with it cleared."""
    rows = []
    for s, (shift, width) in enumerate(_segments(most)):
        mask = F.lit((1 << width) - 1).cast("long")
        rows.append(F.struct(F.lit(s).alias("seg"), F.shiftrightunsigned("fp", shift).bitwiseAND(mask).alias("val")))
    segments = fps.select("tab", of, F.explode(F.array(*rows)).alias("s")).select("tab", of, "s.seg", "s.val")
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.getbit("val", b) == 1)
    cleared = F.transform(set_bits, lambda b: F.struct((F.col("val") - F.call_function("shiftleft", F.lit(1).cast("long"), b)).alias("val"), F.lit(False).alias("own")))
    variants = F.concat(F.array(F.struct(F.col("val").alias("val"), F.lit(True).alias("own"))), cleared)
    return segments.select("tab", of, "seg", F.explode(variants).alias("v")).select("tab", "seg", "v.val", "v.own", of)


def dealt(fps: DataFrame, most_rows: int = 1 << 18) -> DataFrame:
    """``fps`` over so many tasks that each makes at most about ``most_rows`` rows of the index:
    a fingerprint makes some 2 + BITS / 2, so few rows in are many out."""
    return fps.repartition(max(1, -(-fps.count() * (2 + BITS // 2) // most_rows)), "fp")


def near_links(fps: DataFrame, most: int = 2, most_pairs: int = 4096) -> DataFrame:
    """(tab, u, v) of distinct (tab, fp): every pair of a table that differs in at most ``most``
    bits is joined or, where it shares only crowded keys, connected through links of this table.

    Spark's estimates of size don't count the rows that an explode makes, so that an index of 34 times
    the size of what it comes from may seem small enough to broadcast; the joins of the index are told
    to sort and merge, and nothing of it comes to the driver."""
    key = ["tab", "seg", "val"]
    index = segment_index(dealt(fps), most)
    # an own segment meets own ones and cleared ones; cleared ones need not meet each other
    counts = index.groupBy(*key).agg(F.count_if("own").alias("a"), F.count("*").alias("b")).where("a >= 1 and b >= 2")
    shared = cut(index.hint("merge").join(counts, key))
    few, many = shared.where(F.col("a") * F.col("b") <= most_pairs), shared.where(F.col("a") * F.col("b") > most_pairs)
    pairs = few.where("own").select(*key, F.col("fp").alias("u")).hint("merge").join(few.select(*key, F.col("fp").alias("v")), key)
    pairs = pairs.where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= most)).select("tab", "u", "v")
    flips = [0] + [sum(1 << b for b in c) for n in range(1, most // 2 + 1) for c in combinations(range(BITS), n)]
    flips = F.array(*[F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("long") for x in flips])
    around = many.select("tab", "fp").distinct().select("tab", "fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("at"))
    met = around.groupBy("tab", "at").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = met.select("tab", F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u <> v")
    return pairs.unionByName(stars).distinct()


def near_groups(docs: DataFrame, shingle: int = 3, most: int = 2, tables: int = 1, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, _lt_key (the text's hash), fps, component_id.

    Rows are linked whose fingerprints of some table differ in at most ``most`` bits, an even
    number; component_id is the smallest doc_id reachable over links, the row's own included.
    Null and empty texts have fingerprint zero and are linked like any other. Null ids count as
    one document smaller than any other, and are null as a component_id. Equal rows are linked.
    An empty table gives none.
    """
    if most % 2:
        raise ValueError("most must be even")
    rows = cut(fingerprints(docs, shingle, tables, text))
    node = F.xxhash64("tab", "fp") if tables > 1 else F.col("fp")
    distinct = cut(rows.groupBy("fps").agg(F.min("_lt_doc").alias("least")))
    each = distinct.select("fps", F.posexplode("fps").alias("tab", "fp"))
    links = near_links(each.select("tab", "fp").distinct(), most)
    links = links.select("u", "v") if tables == 1 else links.select(F.xxhash64("tab", "u").alias("u"), F.xxhash64("tab", "v").alias("v"))
    first = F.xxhash64(F.lit(0), F.element_at("fps", 1)) if tables > 1 else F.element_at("fps", 1)
    if tables > 1:
        # a document's fingerprints are joined through its first one; those that are neither linked nor another
        # document's too lead nowhere and stay out of the rounds
        links = cut(links)
        own = cut(each.select(first.alias("u"), node.alias("v")))
        shared = own.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v")
        linked = links.select("v").unionByName(links.select(F.col("u").alias("v"))).unionByName(shared).distinct()
        links = links.unionByName(own.join(linked, "v", "left_semi").select("u", "v"))
    roots = components(links)
    mine = distinct.withColumn("node", first).join(roots, "node", "left").select("fps", "least", F.coalesce("root", "node").alias("root"))
    mine = cut(mine)
    # one row a component, dealt anew for the join, so that a component of very many fingerprints can be split
    least = cut(mine.groupBy("root").agg(F.min("least").alias("component")))
    named = mine.select("root", "fps").join(least, "root").select("fps", "component")
    out = rows.join(named, "fps")
    return out.select(shown_id("_lt_doc").alias("doc_id"), "_lt_key", "fps", shown_id("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, most: int = 2, tables: int = 8, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each group of near copies, all columns kept: a row of the
    group's smallest id, of several such one whose text's hash is smallest.

    Groups are those of ``near_groups`` over several word fingerprints: copies that share 0.8 of
    their five-word shingles differ in two words of a hundred, which moves few bits of a
    fingerprint over distinct words, while one over shingles differs in ten bits of 64, beyond
    the reach of any selective segment. With eight tables one of them is near with high
    probability; unrelated texts differ in over ten bits.
    """
    groups = near_groups(docs, most=most, tables=tables, text=text)
    own = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = own.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("_lt_doc")).agg(F.min("_lt_key").alias("_lt_key"))
    keyed = docs.withColumns({"_lt_doc": id_of(docs), "_lt_key": F.xxhash64(text_of(docs, text))}).join(stay, ["_lt_doc", "_lt_key"])
    place = F.row_number().over(Window.partitionBy("_lt_doc", "_lt_key").orderBy(F.lit(1)))  # dealt and sorted by the join
    return keyed.withColumn("_lt_place", place).where("_lt_place = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
