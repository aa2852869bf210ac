"""Secret scans over content-addressed blobs, with a ledger of what was scanned.

Every version of every path is addressed by the SHA-256 of its content. Only blobs
that the ledger does not hold under the current rule version are scanned, each once
however many paths and versions hold it; findings are then joined back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtrace.llm.common import cut, text_of

# The patterns of the base kinds, and of public token formats.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
GITHUB = r"gh[pousr]_[A-Za-z0-9]{36,}"
JWT = r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` code points."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


RULES = (Rule("assign", ASSIGN, 2, 6), Rule("access", ACCESS, 0, 20), Rule("hex", HEX, 0, 24), Rule("pem", PEM, base=False), Rule("github", GITHUB, base=False), Rule("jwt", JWT, base=False))
RULE_VERSION = "1"


def blobs_of(versions: DataFrame, text: str = "text") -> Column:
    return F.sha2(text_of(versions, text), 256)


def _with_length(rule: Rule) -> str:
    """For a pattern that ends in a class repeated without end, demanding the length
    in the pattern finds the same runs and skips the short ones early."""
    return {"AKIA[A-Z0-9]+": r"AKIA[A-Z0-9]{16,}", "[0-9a-f]+": r"[0-9a-f]{24,}"}.get(rule.pattern, rule.pattern)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """From (blob, text): a row per span, (blob, kind, rank, start, end), in code points, end exclusive.

    Matches and the gaps between them come from the same expression, so a match's place
    is a running sum of lengths over the matches of one blob and kind.
    """
    # texts without matches end here; the gaps are only cut where there are matches
    def matches(k: int, rule: Rule) -> Column:
        found = F.regexp_extract_all("text", F.lit(_with_length(rule)), F.lit(0))
        return F.transform(found, lambda m, i: F.struct(F.lit(k).alias("rank"), i.alias("i"), F.char_length(m).alias("n")))

    found = F.concat(*[matches(k, r) for k, r in enumerate(rules)])
    hits = blobs.withColumn("_lt_found", found).where(F.size("_lt_found") > 0)
    per_rule = [
        F.struct(
            F.lit(k).alias("rank"),
            F.transform(F.split("text", _with_length(r), -1), F.char_length).alias("gaps"),
            F.transform(F.regexp_extract_all("text", F.lit(_with_length(r)), F.lit(r.group)), F.char_length).alias("sizes"),
        )
        for k, r in enumerate(rules)
    ]
    lists = hits.select("blob", "_lt_found", F.explode(F.array(*per_rule)).alias("r")).where(F.size("r.sizes") > 0)
    own = F.filter("_lt_found", lambda m: m["rank"] == F.col("r.rank"))
    rows = lists.select("blob", F.col("r.rank").alias("rank"), F.explode(F.arrays_zip(own.alias("m"), F.expr("slice(r.gaps, 1, size(r.sizes))").alias("gap"), F.col("r.sizes").alias("size"))).alias("z"))
    rows = rows.select("blob", "rank", F.col("z.m.i").alias("i"), F.col("z.m.n").alias("n"), F.col("z.gap").alias("gap"), F.col("z.size").alias("size"))
    so_far = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far)).withColumn("start", F.col("end") - F.col("n"))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    least = F.array(*[F.lit(r.least) for r in rules])
    at = F.col("rank") + 1
    return rows.where(F.col("size") >= F.element_at(least, at)).select("blob", F.element_at(kinds, at).alias("kind"), "rank", "start", "end")


SPANS = ["blob", "rule_version", "kind", "rank", "start", "end"]


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """(spans, pairs): the spans (columns SPANS) of the blobs that ``ledger`` doesn't hold under
    ``rule_version``, and the (blob, rule_version) pairs scanned, also those without a span."""
    blobs = versions.select(blobs_of(versions, text).alias("blob"), text_of(versions, text).alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))  # equal addresses hold equal texts; merged on the map side
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    spans = scan_blobs(blobs, rules).withColumn("rule_version", F.lit(rule_version)).select(*SPANS)
    return spans, blobs.select("blob", F.lit(rule_version).alias("rule_version"))


def findings_of(spans: DataFrame, rule_version: str = RULE_VERSION) -> DataFrame:
    """(blob, spans): all spans of a blob under ``rule_version`` as an array of (start, rank, kind, end)."""
    own = spans.where(F.col("rule_version") == rule_version)
    return own.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, past: DataFrame | None = None, text: str = "text",
                  rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger) for a table of paths and versions.

    ``ledger`` holds (blob, rule_version) pairs scanned before and ``past`` the spans found for
    them (columns SPANS); both may be absent. Findings are those of ``findings_of`` under
    ``rule_version``, of blobs scanned now and, from ``past``, of pairs that the ledger holds;
    spans under other versions don't count. The ledger returned also holds the pairs scanned now.
    Join findings to paths by ``blobs_of``. Null texts are empty; empty texts have no finding;
    repeated rows are one blob; other columns of ``versions``, whatever their names, are not used.
    """
    spans, scanned = scan_unseen(versions, ledger, text, rules, rule_version)
    if past is not None and ledger is not None:
        pairs = ledger.select("blob", "rule_version").distinct()
        spans = spans.unionByName(past.select(*SPANS).distinct().join(pairs, ["blob", "rule_version"], "left_semi").select(*SPANS))
    findings = cut(findings_of(spans, rule_version))  # few; dealt anew when joined to paths, so that a blob of very many paths can be split over tasks
    return findings, scanned if ledger is None else ledger.select("blob", "rule_version").unionByName(scanned)


def scan_commits(commits: list[DataFrame], text: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger) after a history of commits, each a table of versions: the ledger and the
    spans are written after each, and the next scans only what they don't hold."""
    ledger = spans = None
    for versions in commits:
        found, scanned = scan_unseen(versions, ledger, text, rules, rule_version)
        found, scanned = cut(found), cut(scanned)
        ledger = scanned if ledger is None else ledger.unionByName(scanned)
        spans = found if spans is None else spans.unionByName(found)
    return cut(findings_of(spans, rule_version)), ledger
