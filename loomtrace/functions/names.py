"""Names, ids and stable hashes. The three tool-name normalisers differ on purpose: they
disagree on names that hold ``__`` themselves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare_name(name: Column, prefix: str) -> Column:
    """The name without a provider's prefix; null where it hasn't it or nothing is left."""
    rest = F.trim(F.substring(name, len(prefix) + 1, 1 << 30))
    return F.when(F.startswith(name, F.lit(prefix)) & (rest != ""), rest)


def without_server(name: Column) -> Column:
    """The name without any ``mcp__server__`` prefix; a blank name is an error."""
    out = F.regexp_replace(F.trim(name), r"^mcp__.*__", "")
    return F.when(F.assert_true(F.coalesce(out, F.lit("")) != "", F.lit("blank tool name")).isNull(), out)


def last_segment(name: Column) -> Column:
    """What follows the last ``__``."""
    return F.element_at(F.split(name, "__"), -1)


def without_prefix(name: Column, pattern: str) -> Column:
    """The name without a prefix pattern; null becomes empty."""
    return F.coalesce(F.regexp_replace(name, f"^(?:{pattern})", ""), F.lit(""))


def surrogate_key(prefix: str, *parts: Column) -> Column:
    """``prefix::`` and 20 hex digits of the parts' SHA-256."""
    return F.concat(F.lit(f"{prefix}::"), F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, 20))


def content_hash(value: Column) -> Column:
    """SHA-256 of JSON text with keys sorted and numbers normalised: equal objects, equal hash."""
    return F.sha2(F.to_json(F.parse_json(value)), 256)


def prompt_hash(text: Column) -> Column:
    """SHA-256 of the text with white space runs collapsed and ends trimmed."""
    return F.sha2(F.trim(F.regexp_replace(text, r"\s+", " ")), 256)


def jitter(seed: str, key: Column) -> Column:
    """A uniform number in [0, 1) from the first 52 bits of SHA-256(seed:key)."""
    digest = F.substring(F.sha2(F.concat_ws(":", F.lit(seed), key), 256), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / float(1 << 52)


def retry_delay(attempt: Column) -> Column:
    """Seconds: 30 doubled an attempt, at most 300."""
    return F.least(F.lit(300), 30 * F.pow(F.lit(2), F.least(attempt - 1, F.lit(4)))).cast("long")
