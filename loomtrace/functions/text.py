"""Text answers, JSON in text, artifact references, excerpts and compression."""

from __future__ import annotations

import bz2
import gzip
import json
import lzma
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ARTIFACT = r"<artifact:[^<>\s]+>"


def normal_answer(text: Column) -> Column:
    """Lower case, without punctuation and the articles a, an, the, white space collapsed."""
    bare = F.translate(F.lower(text), PUNCTUATION, "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?U)\b(a|an|the)\b", " "), r"\s+", " "))


def token_f1(prediction: Column, truth: Column) -> Column:
    """struct(f1, precision, recall) of normalised tokens as bags; yes, no and noanswer must match whole."""
    p, t = normal_answer(prediction), normal_answer(truth)
    words = lambda x: F.filter(F.split(x, " "), lambda w: w != "")
    a, b = words(p), words(t)
    count = lambda items, x: F.size(F.filter(items, lambda y: y == x))
    shared = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    closed = (p != t) & (p.isin("yes", "no", "noanswer") | t.isin("yes", "no", "noanswer"))
    zero = closed | (shared == 0)
    precision, recall = shared / F.greatest(F.size(a), F.lit(1)), shared / F.greatest(F.size(b), F.lit(1))
    return F.struct(
        F.when(zero, 0.0).otherwise(2 * precision * recall / (precision + recall)).alias("f1"),
        F.when(zero, 0.0).otherwise(precision).alias("precision"), F.when(zero, 0.0).otherwise(recall).alias("recall"),
    )


def exact_match(prediction: Column, golds: Column) -> Column:
    return F.exists(golds, lambda g: normal_answer(g) == normal_answer(prediction))


def answer_block(text: Column) -> Column:
    """The content of the first answer block, else of the first solution block, trimmed."""
    inner = lambda tag: F.nullif(F.trim(F.regexp_extract(text, rf"(?is)<{tag}>(.*?)</{tag}>", 1)), F.lit(""))
    return F.coalesce(inner("answer"), inner("solution"))


def json_blocks(text: Column) -> Column:
    """Fenced JSON blocks, else inline objects and arrays, that parse."""
    fenced = F.regexp_extract_all(text, F.lit(r"(?s)```(?:json)?\s*(.*?)```"), F.lit(1))
    inline = F.regexp_extract_all(text, F.lit(r"(\{[^{}]*\}|\[[^\[\]]*\])"), F.lit(1))
    fine = lambda xs: F.filter(F.transform(xs, F.trim), lambda x: F.try_parse_json(x).isNotNull() & (x != ""))
    return F.when(F.size(fine(fenced)) > 0, fine(fenced)).otherwise(fine(inline))


def string_list(value: Column) -> Column:
    """A JSON list of strings, else the lines; trimmed, blanks dropped."""
    items = F.coalesce(F.from_json(value, "array<string>"), F.split(value, "\n"))
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def lines_or_json(value: Column) -> Column:
    """As string_list, with bullets and numbers cut off the lines."""
    return F.filter(F.transform(string_list(value), lambda x: F.trim(F.regexp_replace(x, r"^\s*(?:[-*•]|\d+[.)])\s+", ""))), lambda x: x != "")


def answer_array(value: Column) -> Column:
    """A JSON array, else one within the text's outermost brackets; null if neither parses."""
    inside = F.regexp_extract(value, r"(?s)(\[.*\])", 1)
    return F.coalesce(F.from_json(value, "array<string>"), F.when(inside != "", F.from_json(inside, "array<string>")))


def final_letter(text: Column) -> Column:
    """The answer letter A to J of a response: by phrase, boxed, then the last alone standing one."""
    found = [
        F.regexp_extract(text, r"(?i)answer\s*(?:is|:)\s*\(?([A-J])\b", 1),
        F.regexp_extract(text, r"\\boxed\{\s*\(?([A-J])\)?\s*\}", 1),
        F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(r"\b([A-J])\b"), F.lit(1))), -1),
    ]
    return F.coalesce(*[F.upper(F.nullif(f, F.lit(""))) for f in found])


def artifact_tokens(text: Column) -> Column:
    """Distinct artifact references in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({ARTIFACT})"), F.lit(1)))


def artifact_reference(path: Column) -> Column:
    """A path as a reference by namespace: from the path's words, else from its extension."""
    low, base = F.lower(path), F.element_at(F.split(path, r"[/\\]"), -1)
    space = (
        F.when(low.contains("dock"), "docking").when(low.contains("pocket"), "pockets")
        .when(low.rlike(r"\.(pdb|pdbqt|cif)$"), "structures").when(low.rlike(r"\.(sdf|mol2?|smi)$"), "ligands")
        .when(low.rlike(r"\.(csv|tsv|json|jsonl|parquet)$"), "tables").otherwise("files")
    )
    return F.concat(F.lit("<artifact:"), space, F.lit("/"), base, F.lit(">"))


def sanitised(text: Column) -> Column:
    """Absolute file paths replaced by references to their base names, existing references kept."""
    return F.regexp_replace(text, r"(?<![\w:/<])/(?:[\w.@-]+/)+([\w.@-]+)", "<artifact:files/$1>")


def without_unknown(text: Column, known: Column, placeholder: str = "[unavailable server path]") -> Column:
    """References that are not known become a placeholder."""
    unknown = F.array_except(artifact_tokens(text), known)
    return F.aggregate(unknown, text, lambda t, u: F.replace(t, u, F.lit(placeholder)))


def excerpt(text: Column, most: int) -> Column:
    """A long text's head and tail around a note of what is left out and the whole text's hash."""
    half = most // 2
    note = F.concat(F.lit("\n[... "), (F.char_length(text) - 2 * half).cast("string"), F.lit(" characters omitted, sha256="), F.sha2(text, 256), F.lit(" ...]\n"))
    return F.when(F.char_length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, half), note, F.right(text, F.lit(half))))


def role_runs(text: Column) -> Column:
    return F.size(F.split(text, r"\n\s*\n"))


def _ratio(algorithm: str):
    pack = {"zlib": lambda b: zlib.compress(b, 9), "gzip": lambda b: gzip.compress(b, 9, mtime=0), "bz2": lambda b: bz2.compress(b, 9), "lzma": lambda b: lzma.compress(b, preset=6)}[algorithm]

    @F.pandas_udf(T.DoubleType())
    def ratio(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> float | None:
            if t is None:
                return None
            raw = t.encode()
            return len(raw) / len(pack(raw)) if raw else float("inf")

        return texts.map(one)

    return ratio


def compression_ratio(text: Column, algorithm: str = "zlib") -> Column:
    """Bytes over compressed bytes; infinite for an empty text."""
    return _ratio(algorithm)(text)


def has_repetition(text: Column) -> Column:
    """Texts over 10,000 characters whose last 10,000 compress over tenfold."""
    tail = F.when(F.char_length(text) > 10_000, F.right(text, F.lit(10_000)))
    return F.coalesce(compression_ratio(tail) > 10, F.lit(False))


@F.pandas_udf(T.StringType())
def boxed_answer(texts: pd.Series) -> pd.Series:
    """The content of the last balanced ``\\boxed{}``."""

    def one(t: str | None) -> str | None:
        at = (t or "").rfind("\\boxed{")
        if at < 0:
            return None
        depth, start = 1, at + len("\\boxed{")
        for i in range(start, len(t)):
            depth += (t[i] == "{") - (t[i] == "}")
            if depth == 0:
                return t[start:i].strip()
        return None

    return texts.map(one)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def nested_numbers(values: pd.Series) -> pd.Series:
    """All numbers of a JSON text, depth first, booleans left out."""

    def walk(v):
        if isinstance(v, dict):
            for x in v.values():
                yield from walk(x)
        elif isinstance(v, list):
            for x in v:
                yield from walk(x)
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            yield float(v)

    def one(t: str | None) -> list[float]:
        try:
            return list(walk(json.loads(t or "null")))
        except ValueError:
            return []

    return values.map(one)


def public_part(value: Column, denied: tuple[str, ...]) -> Column:
    """A flat map of strings without the denied keys, compared trimmed and in lower case."""
    return F.map_filter(value, lambda k, _: ~F.lower(F.trim(k)).isin(*denied))
