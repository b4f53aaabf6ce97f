"""Secret scans with an incremental ledger of blobs, with DataFrame functions alone.

Every version of every file is known by the hash of its text. The ledger has one row for each blob: the rule versions it
was scanned with, and the spans they found. A scan reads only blobs that a current rule version hasn't seen, with just
those rules, and returns the grown ledger; findings are then joined back to all rows that hold the blob.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import named, whole_row
from millrace.llm.tables import written


class Rule(NamedTuple):
    """A kind of secret. Matches of ``pattern`` are leftmost and don't overlap; those whose ``group`` has fewer than
    ``least`` characters are dropped afterwards. Texts without a match of ``hint`` are passed over: it has to match every
    text that has a match to keep."""

    kind: str
    version: int
    pattern: str
    hint: str
    group: int = 0
    least: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns. Quantified minimums stand where they can't change which matches are found.
_ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]"
BASE = (
    Rule("assign", 1, _ASSIGN + "+)", _ASSIGN + "{8,})", group=2, least=8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}", "AKIA[A-Z0-9]{12}"),
    Rule("hex", 1, "[0-9a-f]{32,}", "[0-9a-f]{32}"),
)
RULES = (
    *BASE,
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN "),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_"),
)

SPAN = "struct<start: int, rank: int, rule: string, end: int>"
LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"
RAW = "array<struct<rank: int, i: int, gap: int, size: int, part: int>>"


def blob_of(text: Column) -> Column:
    """The address of a text: the hash of its bytes. Null is the empty text."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _raw(text: Column, todo: Column, rank: int, rule: Rule) -> Column:
    """Lengths of the gap before each match, the match and its group."""
    lengths = F.zip_with(
        F.zip_with(F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
                   lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"))),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)),
        lambda both, group: F.struct(both["gap"].alias("gap"), both["size"].alias("size"), F.length(group).alias("part")),
    )
    found = F.transform(lengths, lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), x["part"].alias("part")
    ))
    return F.when(F.array_contains(todo, rule.id) & text.rlike(rule.hint), found).otherwise(F.array().cast(RAW))


def _scanned(unseen: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, found): spans of the rules in ``todo`` in each text."""
    raw = F.flatten(F.array(*[_raw(F.col("text"), F.col("todo"), r, rule) for r, rule in enumerate(rules)]))
    # A match starts after all gaps up to it and all matches before it.
    matches = unseen.select("blob", F.explode(raw).alias("x")).select("blob", "x.*")
    upto = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(upto).cast("int")
    spans = matches.withColumn("end", end).filter("size IS NOT NULL")
    least = F.get(F.array(*[F.lit(r.least) for r in rules]), F.col("rank"))
    rule = F.get(F.array(*[F.lit(r.id) for r in rules]), F.col("rank"))
    spans = spans.filter(F.col("part") >= least).select(
        "blob", F.struct((F.col("end") - F.col("size")).alias("start"), "rank", rule.alias("rule"), "end").alias("span")
    )
    return spans.groupBy("blob").agg(F.collect_list("span").alias("found"))


def grow_ledger(versions: DataFrame, ledger: DataFrame | None = None, *, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger after all blobs of ``versions`` are scanned with all rules. Blobs of the old ledger stay in it.

    Only pairs of blob and rule version that ``ledger`` doesn't have are scanned; equal texts are scanned once. Null and
    empty texts are the empty blob, which has no spans. An empty table leaves the ledger as it is.
    """
    ids = F.array(*[F.lit(r.id) for r in rules])
    blobs = versions.select(blob_of(named(text)).alias("blob"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        unseen = blobs.withColumn("todo", ids)
        before = None
    else:
        before = ledger.select("blob", F.col("rules").alias("old_rules"), F.col("spans").alias("old_spans"))
        unseen = blobs.join(before.select("blob", "old_rules"), "blob", "left")
        unseen = unseen.withColumn("todo", F.array_except(ids, F.coalesce("old_rules", F.array().cast("array<string>"))))
        unseen = unseen.filter(F.size("todo") > 0).select("blob", "text", "todo")
    found = _scanned(unseen, rules)
    new = unseen.select("blob", "todo").join(found, "blob", "left")
    new = new.withColumn("found", F.coalesce("found", F.array().cast(f"array<{SPAN}>")))
    if before is None:
        return new.select("blob", F.col("todo").alias("rules"), F.col("found").alias("spans"))
    none = F.array()
    both = before.join(new, "blob", "full")
    return both.select(
        "blob",
        F.concat(F.coalesce("old_rules", none.cast("array<string>")), F.coalesce("todo", none.cast("array<string>"))).alias("rules"),
        F.concat(F.coalesce("old_spans", none.cast(f"array<{SPAN}>")), F.coalesce("found", none.cast(f"array<{SPAN}>"))).alias("spans"),
    )


def findings(versions: DataFrame, ledger: DataFrame, *, text: str = "text", rules: Sequence[Rule] = RULES, keep=None) -> DataFrame:
    """``row`` (a struct of the kept columns of versions, default all), ``blob`` and ``spans`` of the current rules.

    Spans are (start, end, kind), in code points with the end exclusive, by start and then by the order of the rules.
    Every row that holds a blob gets its spans, repeated rows too; other columns pass through.
    """
    current = F.array(*[F.lit(r.id) for r in rules])
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.id, r.kind)])
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.id, i)])
    mine = F.filter("spans", lambda s: F.array_contains(current, s["rule"]))
    ordered = F.array_sort(F.transform(mine, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(ranks, s["rule"]).alias("rank"), s["end"].alias("end"), s["rule"].alias("rule")
    )))
    spans = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(kinds, s["rule"]).alias("kind")))
    hits = ledger.filter(F.size("spans") > 0).select("blob", spans.alias("spans"))
    rows = versions.select(whole_row(versions, keep).alias("row"), blob_of(named(text)).alias("blob"))
    joined = rows.join(hits, "blob", "left")
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start: int, end: int, kind: string>>")))


def scan(versions: DataFrame, ledger: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Findings of all versions, and the grown ledger, written below the shared folder."""
    keep = options.pop("keep", None)
    grown = written(grow_ledger(versions, ledger, **options), "ledger")
    return findings(versions, grown, keep=keep, **options), grown
