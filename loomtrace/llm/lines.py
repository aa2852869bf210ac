"""Line dedup: lines that many documents hold stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.common import WHITE, cut, hashed, id_of, numbered, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS = 60


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_lt_doc, _lt_text, bits): the lines that a document loses, as a sparse bitmap.

    ``bits`` maps a line's position div 60 to a word with the bit position mod 60 set;
    words and documents that lose nothing are absent, so it is a compressed keep
    bitmap with ones left out. A row is known by its id and its text's hash.

    Keys are 128 bits of hash. Their lines are partitioned by ranges of the hash and sorted by
    key, document (largest first) and position, and each partition is streamed once: a line
    of another document than the line before it is that document's first occurrence, and
    those are counted per key. Only lines that go leave their partition.

    A key that would hold much of a partition is found in a sample of the documents (there are
    at most ``2 * spark.sql.shuffle.partitions`` such keys) and its lines are salted by document,
    so that they are streamed in several partitions; the counts of its salts are then summed.
    The sample decides how lines are dealt and no result.
    """
    keys = cut(_keys(docs, min_chars))  # a few dozen bytes a line; else sampling, counting and streaming each split all texts again
    streamed = stream_occurrences(keys).where(F.col("_lt_hot") | ((F.col("_lt_docs") >= min_docs) & (F.col("_lt_doc") < F.col("_lt_last"))))
    streamed = cut(streamed.select("_lt_a", "_lt_b", "_lt_hot", "_lt_new", "_lt_doc", "_lt_text", "_lt_pos"))
    totals = streamed.where("_lt_hot and _lt_new").groupBy("_lt_a", "_lt_b").agg(F.count("*").alias("_lt_docs"), F.max("_lt_doc").alias("_lt_last"))
    hot = streamed.where("_lt_hot").join(F.broadcast(totals), ["_lt_a", "_lt_b"]).where((F.col("_lt_docs") >= min_docs) & (F.col("_lt_doc") < F.col("_lt_last")))
    own = ["_lt_doc", "_lt_text", "_lt_pos"]
    lost = streamed.where("not _lt_hot").select(*own).unionByName(hot.select(*own))
    word = F.floor(F.col("_lt_pos") / BITS).cast("int")
    words = lost.groupBy("_lt_doc", "_lt_text", word.alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, _lt_pos % {BITS})")).alias("b"))
    return words.groupBy("_lt_doc", "_lt_text").agg(F.map_from_entries(F.collect_set(F.struct("w", "b"))).alias("bits"))


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(_lt_a, _lt_b, _lt_doc, _lt_text, _lt_pos): key, document and position of lines that are long enough."""
    source = docs.select(id_of(docs).alias("_lt_doc"), text_of(docs).alias("_lt_t"))
    lines = source.select("_lt_doc", F.xxhash64("_lt_t").alias("_lt_text"), F.posexplode(F.split("_lt_t", "\n")).alias("_lt_pos", "_lt_line"))
    lines = lines.where(F.char_length(F.btrim("_lt_line", F.lit(WHITE))) >= min_chars).withColumn("_lt_k", line_key(F.col("_lt_line")))
    return lines.select(hashed(F.col("_lt_k"), seed=1).alias("_lt_a"), hashed(F.col("_lt_k"), seed=2).alias("_lt_b"), "_lt_doc", "_lt_text", "_lt_pos")


def stream_occurrences(keys: DataFrame, one_in: int = 16) -> DataFrame:
    """The rows of ``_keys`` with _lt_new (a document's first line of the key), _lt_docs (documents
    of the key) and _lt_last (the largest of them); of salted keys (_lt_hot) by salt."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = keys.where(F.pmod(F.xxhash64(F.lit(3), "_lt_doc"), F.lit(one_in)) == 0)
    crowded = max(64, sample.count() // (2 * parts))
    hot = sample.groupBy("_lt_a", "_lt_b").agg(F.count("*").alias("n")).where(F.col("n") >= crowded).select("_lt_a", "_lt_b", F.lit(True).alias("_lt_hot"))
    rows = keys.join(F.broadcast(hot), ["_lt_a", "_lt_b"], "left").withColumn("_lt_hot", F.coalesce("_lt_hot", F.lit(False)))
    salt = F.when(F.col("_lt_hot"), F.pmod(F.xxhash64("_lt_doc"), F.lit(parts))).otherwise(F.lit(0))
    rows = rows.withColumns({"_lt_range": F.shiftright("_lt_a", 44), "_lt_salt": salt}).repartitionByRange("_lt_range", "_lt_salt")
    key = Window.partitionBy("_lt_range", "_lt_salt", "_lt_a", "_lt_b")  # the partitioning by range has its rows together
    before = F.lag("_lt_doc").over(key.orderBy(F.desc("_lt_doc"), "_lt_pos"))
    rows = rows.withColumn("_lt_new", F.coalesce(before != F.col("_lt_doc"), F.lit(True)))
    return rows.withColumns({"_lt_docs": F.count_if("_lt_new").over(key), "_lt_last": F.max("_lt_doc").over(key)})


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per row of ``docs``: all its columns with ``text`` cleaned, and
    ``_lt_lines``, ``_lt_dropped``: lines before, and lines dropped (the last two columns,
    whatever others are called).

    A line's key is the line without white space at both ends and with A-Z lower-cased.
    A key of ``min_chars`` code points or more in ``min_docs`` distinct doc_ids or more
    keeps its lines only in the largest of them (all of them there). Null and empty
    texts are one empty line and become empty texts. Null doc_ids count as one document
    smaller than any other. Repeated rows are judged alike. An empty table gives none.
    """
    bitmaps = drop_bitmaps(docs, min_chars, min_docs)
    rows, of, back = numbered(docs)
    text = text_of(rows, of["text"])
    rows = rows.withColumns({"_lt_doc": id_of(rows, of["doc_id"]), "_lt_text": F.xxhash64(text)}).join(bitmaps, ["_lt_doc", "_lt_text"], "left")
    bit = lambda i: F.coalesce(F.element_at("bits", F.floor(i / BITS).cast("int")), F.lit(0).cast("long"))
    kept = F.filter(F.split(text, "\n"), lambda _, i: F.getbit(bit(i), (i % BITS).cast("int")) == 0)
    clean = F.when(F.col("bits").isNull(), text).otherwise(F.array_join(kept, "\n"))
    dropped = F.aggregate(F.coalesce(F.map_values("bits"), F.array().cast("array<bigint>")), F.lit(0), lambda n, b: n + F.bit_count(b))
    breaks = F.regexp_count(text, F.lit("\n"))
    own = [clean.alias("text") if c == of["text"] else x for c, x in zip((f"c{i}" for i in range(len(back))), back, strict=True)]
    return rows.select(*own, (breaks + 1).cast("long").alias("_lt_lines"), dropped.cast("long").alias("_lt_dropped"))
