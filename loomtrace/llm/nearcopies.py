"""SimHash near-dedup verified on shingles: rows are linked if and only if they share 0.8 of their
five-word shingles.

1. Candidates by deletion-variant signatures, as in ``simhash``: a row has a few independent
   fingerprints over its distinct words, each cut into two segments; rows that agree in a segment
   but for one bit meet, and every row that meets others is compared with the smallest of them.
2. What fingerprints miss is found by prefixes of the sets of shingles: of two sets of which the
   shared part is 0.8 of the union, the first n - ceil(0.8 n) + 1 shingles of either, in any one
   order of all shingles, meet. The order puts shingles that a sample of documents repeats last,
   by how often, and the others by hash, so that few texts meet that are not near; the sample
   decides how many candidates there are, and not which links are found.

Every candidate is verified on the whole sets. A shingle in the prefixes of so many sets that its
pairs would exceed ``most_pairs`` is not paired up at once: its sets are first compared with one of
them only, and then those pairs that are not connected yet, unless their sizes, their places in the
prefixes or their sketches tell that they can't be near. A sketch has the parities of the numbers
of a set's shingles in 1024 classes: two sets differ in at least as many shingles as sketches in bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.common import cut, freed, id_of, lean, numbered, small_batches, text_of
from loomtrace.llm.components import components
from loomtrace.llm.keyfilter import key_filter, passes
from loomtrace.llm.packed import pack, unpack
from loomtrace.llm.simhash import dealt, segment_index, word_fingerprints
from loomtrace.llm.substrings import window_hashes

#: Similarity: near sets share NEAR of OF parts of their union.
NEAR, OF = 4, 5
#: Words of 64 bits in a sketch.
SKETCH = 16


class _Hashes(dict):
    """Words and their hashes, as far as remembered; only speed depends on it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 15:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 42)
        return found


HASHES = _Hashes()


def shingles(text: str, words: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, sorted; A-Z are lower-cased, a text of
    fewer words is one shingle, and one of no words has none."""
    split = text.encode().lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(HASHES.__getitem__, split), np.uint64, len(split))
    return np.unique(window_hashes(own, min(words, len(split))))


def _longs(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate([np.zeros(0, np.uint64), *lists]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _known(texts: DataFrame, words: int, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of (_lt_key, _lt_text) repeats, sorted, and their counts."""
    share = max(1, -(-texts.count() // sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *(shingles(t, words) for t in batch.column(0).to_pylist())]).view(np.int64))], names=["h"])

    found = texts.where(F.pmod(F.xxhash64(F.lit(7), "_lt_key"), F.lit(share)) == 0).select("_lt_text").mapInArrow(lean(run), "h long")
    # an order only, so those that are left out cost candidates and lose none
    rows = found.groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(1 << 18).toArrow()
    known, counts = rows["h"].to_numpy().astype(np.int64).view(np.uint64), rows["count"].to_numpy().astype(np.int64)
    place = np.argsort(known)
    return known[place], counts[place]


def sketch(own: np.ndarray) -> np.ndarray:
    counts = np.bincount((own >> np.uint64(8)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def prefixes(docs: DataFrame, words: int = 5, text: str = "text", sample_rows: int = 10_000, tables: int = 2) -> DataFrame:
    """(_lt_doc, _lt_key, sid, n, fps, sketch, prefix) a row of ``docs``: id, text hash, hash and size
    of the set of shingles, fingerprints, sketch, and the shingles that meet those of every near set."""
    small_batches(docs.sparkSession)
    rows = docs.select(id_of(docs).alias("_lt_doc"), F.xxhash64(text_of(docs, text)).alias("_lt_key"), text_of(docs, text).alias("_lt_text"))
    shared = docs.sparkSession.sparkContext.broadcast(_known(rows, words, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            sids, sizes, firsts, fps, sketches = [], [], [], [], []
            for t in batch.column(2).to_pylist():
                own = shingles(t, words)
                sids.append(xxhash.xxh64_intdigest(own.tobytes(), 42))
                sizes.append(len(own))
                fps.append(np.array(word_fingerprints(t, tables), np.uint64))
                sketches.append(sketch(own))
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    own = own[np.lexsort((own, np.where(known[at] == own, counts[at], 0)))]
                firsts.append(own[: len(own) - -(-len(own) * NEAR // OF) + 1])
            columns = [pa.array(np.array(sids, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), _longs(fps), _longs(sketches), _longs(firsts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["_lt_doc", "_lt_key", "sid", "n", "fps", "sketch", "prefix"])

    return rows.mapInArrow(lean(run), "_lt_doc long, _lt_key long, sid long, n int, fps array<long>, sketch array<long>, prefix array<long>")


def _shared(rows: DataFrame, block: int = 1 << 20, bucket: int = 1 << 19) -> DataFrame:
    """(h, sid, n, i) of sets and the places of their prefixes whose shingle the prefix of another row
    has too; h is the shingle's upper 48 bits, so that a few more may meet.

    Most shingles are in one prefix only. They move packed, the sorted ones of a block of rows
    to each bucket, in some six bytes; what is shared becomes rows. ``rows`` must be kept ones."""
    sizes = F.sum(F.size("prefix").cast("long"))
    buckets = max(64, 1 << (max(1, (rows.agg(sizes).first()[0] or 0) // bucket)).bit_length())
    low = np.uint64(16 + buckets.bit_length() - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            h, row, place = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            home = (h >> np.uint64(16)) & np.uint64(buckets - 1)
            by = np.lexsort((h, home))
            h, row, place, home = h[by] >> low, row[by], place[by], home[by]
            edges = np.flatnonzero(np.diff(home, prepend=np.uint64(buckets)))
            out = []
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(h)], strict=True):
                first = int(row[a:b].min())
                out.append((int(home[a]), pack(np.diff(h[a:b], prepend=np.uint64(0)), np.array([first], np.int64), (row[a:b] - first).astype(np.uint32), place[a:b])))
            homes, payloads = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(homes, pa.int32()), pa.array(payloads, pa.binary())], names=["bucket", "payload"])

        held = 0
        for batch in batches:
            lists = batch.column(1)
            lens = np.diff(lists.offsets.to_numpy())
            if not lens.sum():
                continue
            places = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            waiting.append((lists.flatten().to_numpy().view(np.uint64), np.repeat(batch.column(0).to_numpy(), lens), places.astype(np.uint32)))
            held += int(lens.sum())
            if held >= block:
                yield packed()
                held = 0
        if waiting:
            yield packed()

    def meet(table: pa.Table) -> pa.Table:
        parts = []
        for p in table.column("payload"):
            steps, first, row, place = unpack(p.as_py())
            parts.append((np.cumsum(steps, dtype=np.uint64), first[0] + row.astype(np.int64), place))
        h, row, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.argsort(h, kind="stable")
        h, row, place = h[by], row[by], place[by]
        same = h[1:] == h[:-1]
        met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        whole = (h[met] << np.uint64(low - 16)) | np.uint64(table.column("bucket")[0].as_py())
        return pa.table({"h": pa.array(whole.astype(np.int64)), "row": pa.array(row[met]), "i": pa.array(place[met].astype(np.int32))})

    placed = rows.withColumn("row", F.monotonically_increasing_id())
    found = placed.select("row", "prefix").mapInArrow(lean(send), "bucket int, payload binary").groupBy("bucket").applyInArrow(meet, "h long, row long, i int")
    return found.join(placed.select("row", "sid", "n"), "row").select("h", "sid", "n", "i").distinct()


def _may_be_near(u: str, v: str) -> Column:
    """Whether two sets that meet at the places i of their prefixes are of sizes, and have enough left after them, to be near."""
    n, m, i, j = (F.col(f"{s}.{c}") for c in "ni" for s in (u, v))
    most = F.least(i, j) + F.least(n - i, m - j)
    return (F.least(n, m) * OF >= F.greatest(n, m) * NEAR) & (most * (OF + NEAR) >= (n + m) * NEAR)


def _differ(u: str, v: str) -> Column:
    """In how many bits two sketches differ: no more than their sets differ in shingles."""
    word = lambda s, k: F.get(F.col(f"{s}.sketch"), k)
    return sum((F.bit_count(word(u, k).bitwiseXOR(word(v, k))) for k in range(1, SKETCH)), F.bit_count(word(u, 0).bitwiseXOR(word(v, 0))))


def _of_candidates(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose _lt_key is in ``keys`` and few others, without a shuffle, texts compressed."""
    shared = texts.sparkSession.sparkContext.broadcast(key_filter(keys, "_lt_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            some = batch.filter(pa.array(passes(shared.value, batch.column(1).to_numpy())))
            packed = pa.array([pack(t.encode()) for t in some.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), packed], names=["_lt_doc", "_lt_key", "z"])

    return texts.mapInArrow(lean(run), "_lt_doc long, _lt_key long, z binary")


def _verified(pairs: DataFrame, one: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Those of the distinct, kept (u, v) that are near. ``one`` has the row (sid, _lt_doc, _lt_key) of a set, ``texts`` all rows.
    Compressed texts move, a third of the bytes of their sets; two meet in a task at a time."""
    ids = pairs.select(F.col("u").alias("sid")).unionByName(pairs.select(F.col("v").alias("sid"))).distinct()
    wanted = cut(one.select("sid", "_lt_doc", "_lt_key").join(ids, "sid", "left_semi"))
    own = cut(_of_candidates(texts, wanted).join(wanted, ["_lt_doc", "_lt_key"]).groupBy("_lt_doc", "_lt_key").agg(F.min("sid").alias("sid"), F.min("z").alias("z")).select("sid", "z"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=64)
        def of(z: bytes) -> np.ndarray:
            return shingles(zstandard.ZstdDecompressor().decompress(z).decode(), words)

        for batch in batches:
            sets = [(of(x), of(y)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            near = [len(np.intersect1d(a, b, assume_unique=True)) * (OF + NEAR) >= (len(a) + len(b)) * NEAR for a, b in sets]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(own.toDF("u", "x"), "u").join(own.toDF("v", "y"), "v").select("u", "v", "x", "y")
    return both.mapInArrow(lean(run), "u long, v long")


def _by_fingerprint(sets: DataFrame) -> DataFrame:
    """(u, v) of sets that agree in a segment of a fingerprint but for one bit: each with the smallest that it meets."""
    fps = sets.select("sid", F.posexplode("fps").alias("tab", "fp"))
    index = segment_index(dealt(fps), 2, "sid")
    key = ["tab", "seg", "val"]
    hubs = index.groupBy(*key).agg(F.min(F.when(F.col("own"), F.col("sid"))).alias("hub"), F.count("*").alias("c")).where("c > 1 and hub is not null")
    met = index.join(hubs.select(*key, "hub"), key).where("sid <> hub")
    return met.select(F.least("sid", "hub").alias("u"), F.greatest("sid", "hub").alias("v")).distinct()


def links(rows: DataFrame, texts: DataFrame, words: int = 5, most_pairs: int = 4096) -> DataFrame:
    """(u, v) of sets, all near and so that every near pair of the ``rows`` of ``prefixes`` is
    connected. ``texts`` has (_lt_doc, _lt_key, _lt_text)."""
    index = cut(_shared(rows))
    met = cut(index.join(index.groupBy("h").agg(F.count("*").alias("c")).where("c > 1"), "h"))
    del index
    sets = cut(rows.groupBy("sid").agg(F.min(F.struct("_lt_doc", "_lt_key", "n", "fps", "sketch")).alias("s")).select("sid", "s.*"))
    del rows
    freed()
    few, many = (met.where(x).select("h", "sid", "n", "i") for x in (F.col("c") * F.col("c") <= most_pairs, F.col("c") * F.col("c") > most_pairs))
    pairs = few.alias("u").join(few.alias("v"), (F.col("u.h") == F.col("v.h")) & (F.col("u.sid") < F.col("v.sid")) & _may_be_near("u", "v"))
    pairs = pairs.select(F.col("u.sid").alias("u"), F.col("v.sid").alias("v"))
    hubs = many.groupBy("h").agg(F.min(F.struct("sid", "n", "i")).alias("hub"))
    stars = many.join(hubs, "h").select("hub", F.struct("sid", "n", "i").alias("v")).where((F.col("hub.sid") < F.col("v.sid")) & _may_be_near("hub", "v")).select(F.col("hub.sid").alias("u"), F.col("v.sid").alias("v"))
    tried = cut(_plausible(_by_fingerprint(sets).unionByName(pairs).unionByName(stars).distinct(), sets))
    del few, pairs, hubs, stars
    found = cut(_verified(tried, sets, texts, words))
    del tried
    if many.isEmpty():
        return found
    roots = components(found).toDF("sid", "root")
    parted = many.join(roots, "sid", "left").join(sets.select("sid", "sketch"), "sid")
    parted = cut(parted.withColumn("root", F.coalesce("root", "sid")))
    split = parted.groupBy("h").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("h")
    apart = parted.join(split, "h", "left_semi")
    near = _may_be_near("u", "v") & (_differ("u", "v") * (OF + NEAR) <= (F.col("u.n") + F.col("v.n")) * (OF - NEAR))
    apart = apart.alias("u").join(apart.alias("v"), (F.col("u.h") == F.col("v.h")) & (F.col("u.sid") < F.col("v.sid")) & (F.col("u.root") != F.col("v.root")) & near)
    apart = cut(apart.select(F.col("u.sid").alias("u"), F.col("v.sid").alias("v")).distinct())
    del parted, split
    return cut(found.unionByName(_verified(apart, sets, texts, words)))


def _plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that sizes and sketches allow to be near."""
    told = sets.select("sid", F.struct("n", "sketch").alias("s"))
    both = pairs.join(told.toDF("u", "x"), "u").join(told.toDF("v", "y"), "v")
    n, m = F.col("x.n"), F.col("y.n")
    return both.where((F.least(n, m) * OF >= F.greatest(n, m) * NEAR) & (_differ("x", "y") * (OF + NEAR) <= (n + m) * (OF - NEAR))).select("u", "v")


def near_copies(docs: DataFrame, words: int = 5, text: str = "text", most_pairs: int = 4096) -> DataFrame:
    """One row per row of ``docs``: _lt_doc (NO_ID for null), _lt_key (the text's hash), sid, and
    root, which is the same for the rows of one group of near copies and no others.

    Rows are linked whose sets of five-word shingles share 0.8 of their union; groups are all that
    is reachable over links. Texts without words are copies of each other."""
    rows = cut(prefixes(docs, words, text))
    members = cut(rows.select("_lt_doc", "_lt_key", "sid"))
    texts = docs.select(id_of(docs).alias("_lt_doc"), F.xxhash64(text_of(docs, text)).alias("_lt_key"), text_of(docs, text).alias("_lt_text"))
    waiting = [rows.where("n > 0")]
    del rows  # by far the largest: it goes as soon as links() is done with it
    roots = components(links(waiting.pop(), texts, words, most_pairs)).toDF("sid", "root")
    return members.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def drop_shingle_copies(docs: DataFrame, words: int = 5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each group of ``near_copies``, all columns kept: a row of the
    group's smallest id, of several such one whose text's hash is smallest, of rows equal in both the one whose other
    columns' hash is. A null id is the smallest. Columns may have any names. An empty table gives none."""
    groups = near_copies(docs, words, text)
    stay = groups.groupBy("root").agg(F.min(F.struct("_lt_doc", "_lt_key")).alias("s")).select("s.*")
    rows, of, back = numbered(docs)
    keyed = rows.withColumns({"_lt_doc": id_of(rows, of["doc_id"]), "_lt_key": F.xxhash64(text_of(rows, of[text]))}).join(stay, ["_lt_doc", "_lt_key"])
    whole = F.xxhash64(*[F.col(f"c{i}") for i in range(len(back))])
    place = F.row_number().over(Window.partitionBy("_lt_doc", "_lt_key").orderBy(whole))  # dealt by the join
    return keyed.withColumn("_lt_place", place).where("_lt_place = 1").select(*back)
