"""Mixing to target weights by iterative proportional fitting.

Token counts are summed by cell (one value of each dimension: source, language, topic). Rounds of raking scale the cell
weights to each dimension's target shares in turn, until all marginals hold together. A document's rate is its cell's
weight over its cell's share of tokens; documents are drawn with a probability in proportion to it, by a hash of their
ids, and carry the weight that makes up for rates above one, or the number of copies to write instead.

Documents are read twice (sums, draw); all rounds work on the table of cells.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import named, whole_row
from millrace.llm.tables import written

#: Rounds of raking at least; each one goes through all dimensions. More follow until TOLERANCE holds.
ROUNDS = 8
#: Largest gap between a raked share and its target, relative to the target, at which raking ends.
TOLERANCE = 1e-3
#: Raking ends with a warning where so many rounds in turn don't bring the largest gap down by a hundredth.
STALLED_ROUNDS = 5
#: Share of tokens to draw, were no rate above one.
BUDGET = 0.7
#: Target shares are shares of tokens to this power, where none are given: below 1 lifts small values.
TEMPERATURE = 0.7


def topic_of(text: Column, n_tokens: Column) -> Column:
    """A coarse topic by what a text holds: table, legal, contact, note or prose."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.lower(text)
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(low, F.lit("license")) | F.contains(low, F.lit("copyright")), "legal")
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("://")), "contact")
        .when(n_tokens < 100, "note")
        .otherwise("prose")
    )


def spaced_words(text: Column) -> Column:
    """One more than the number of spaces; 0 for null and empty texts."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def uniform(doc_id: Column, seed: str = "") -> Column:
    """A number in [0, 1) by a hash of the id; null ids read as empty text."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join where null equals null; the right side's keys go."""
    other = right.select(*[named(k).alias(f"_{k}") for k in keys], *[named(c) for c in right.columns if c not in keys])
    same = [named(k).eqNullSafe(named(f"_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return left.join(other, on, how).drop(*[f"_{k}" for k in keys])


def _raised(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    sums = cells.groupBy(named(dimension)).agg(F.sum("mass").alias("mass_"))
    return sums.select(named(dimension), F.pow("mass_", F.lit(power)).alias("share"))


def tempered(cells: DataFrame, dimension: str, power: float = TEMPERATURE) -> DataFrame:
    """Target shares (value of the dimension, share): token shares to a power, made to sum to one."""
    raised = _raised(cells, dimension, power)
    total = raised.agg(F.sum("share")).head()[0] or 1.0
    return raised.withColumn("share", F.col("share") / F.lit(total))


def largest_gap(cells: DataFrame, dims: Sequence[str]) -> tuple[float, str]:
    """The largest gap of summed weights to target shares above 0, relative to the target, and its dimension.

    ``cells`` has ``share_0``, ``share_1``, ... beside the dimensions; all of these are summed in one aggregate.
    """
    marks = [F.struct(F.lit(d).alias("name"), named(d).cast("string").alias("value"), F.col(f"share_{i}").alias("share")) for i, d in enumerate(dims)]
    sums = cells.select("weight", F.explode(F.array(*marks)).alias("m")).filter("m.share > 0")
    gaps = sums.groupBy("m.name", "m.value").agg((F.abs(F.sum("weight") / F.max("m.share") - 1)).alias("gap"))
    row = gaps.agg(F.max("gap").alias("gap"), F.max_by("name", "gap").alias("name")).head()
    return (row["gap"], row["name"]) if row["name"] is not None else (0.0, "")


def _with_shares(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """The cells with their share of all mass as ``weight``, and the target share of each dimension's value.

    Shares of values that no cell with mass has are left out; the rest sum to one.
    """
    out = cells
    for i, (name, target) in enumerate(targets.items()):
        out = _joined(out, target.select(named(name), F.col("share").alias(f"share_{i}")), [name], "left")
    out = written(out, "cells")
    # Each value's share once, whatever the number of its cells.
    there = out.filter("mass > 0")
    sums = []
    for i, name in enumerate(targets):
        shares = there.select(named(name).alias("v"), F.col(f"share_{i}").alias("s")).groupBy("v").agg(F.max("s").alias("s"))
        sums.append(shares.agg(F.sum("s").alias("total")).select(F.lit(i).alias("i"), "total"))
    totals = {}
    if sums:
        all_ = sums[0]
        for one in sums[1:]:
            all_ = all_.union(one)
        totals = {r["i"]: r["total"] or 1.0 for r in all_.collect()}
    mass = cells.agg(F.sum("mass")).head()[0] or 0.0
    shares = {f"share_{i}": F.coalesce(F.col(f"share_{i}") / F.lit(totals[i]), F.lit(0.0)) for i in range(len(targets))}
    return out.withColumns({**shares, "weight": F.col("mass") / F.lit(float(mass) or 1.0)})


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The cells with ``weight``, whose sums by each dimension are the target shares within ``tolerance``.

    At least ``rounds`` rounds are made, and more until the largest relative gap to any target is within ``tolerance``.
    Targets that no weights meet together are reported by a warning with the gap that stays; the last dimension's hold.

    ``cells`` has a column for each dimension and ``mass``; a target has the dimension's value and ``share``. Values
    without a target, and cells without mass, get weight 0. Targets for values that no cell has are left out, and the
    rest made to sum to one. A round is one plan, in which each dimension scales the weights by their sums over its
    values; the table of cells is written after it, so that plans stay short.
    """
    dims = list(targets)
    now = _with_shares(cells, targets)
    made, stalled, least = 0, 0, float("inf")
    while dims:
        if made >= rounds:
            gap, where = largest_gap(now, dims)
            if gap <= tolerance:
                break
            least, stalled = (gap, 0) if gap < 0.99 * least else (least, stalled + 1)
            if stalled >= STALLED_ROUNDS:
                warnings.warn(f"targets can't be met together: {where} is off by {gap:.2%} of a target after {made} rounds", stacklevel=2)
                break
        made += 1
        for i, name in enumerate(dims):
            have = F.sum("weight").over(Window.partitionBy(named(name)))
            now = now.withColumn("have", have).withColumn("weight", F.when(F.col("have") > 0, F.col("weight") * (F.col(f"share_{i}") / F.col("have"))).otherwise(0.0)).drop("have")
        now = written(now, "cells")
    return now.drop(*[f"share_{i}" for i in range(len(dims))])


def mix(docs: DataFrame, dimensions: Mapping[str, Column], n_tokens: Column, *, doc_id: str = "doc_id",
        targets: Mapping[str, DataFrame] | None = None, temperature: float = TEMPERATURE, budget: float = BUDGET,
        rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: str = "", keep=None) -> DataFrame:
    """Every row with its draw: ``row`` (kept columns of docs, default all), the dimensions, ``n_tokens``,
    ``probability``, ``sampled``, ``weight`` and ``copies``.

    ``probability`` is ``budget`` times the cell's raked share over its token share, 1 at most; ``weight`` is the rate
    over the probability, 1 but for rates above 1, so that weighted draws meet the targets on average. ``copies`` is for
    output without weights: the whole part of the rate, and one more by the hash for the rest, so it is at least 1 for
    sampled rows and 0 for others. A dimension without a target in ``targets`` gets tempered shares.

    Null is a value of a dimension like any other. Rows without tokens add nothing to a cell; in a cell without any
    tokens the probability is 0. Repeated rows are drawn together. Extra columns pass through.
    """
    dims = list(dimensions)
    rows = docs.select(
        whole_row(docs, keep).alias("row"), uniform(named(doc_id), seed).alias("u"),
        *[c.cast("string").alias(d) for d, c in dimensions.items()], n_tokens.cast("long").alias("n_tokens"),
    )
    cells = written(rows.groupBy(*dims).agg(F.sum("n_tokens").cast("double").alias("mass")), "cells")
    targets = {d: (targets or {}).get(d) for d in dims}
    targets = {d: _raised(cells, d, temperature) if t is None else t for d, t in targets.items()}  # raking makes them sum to one
    raked = rake(cells, targets, rounds, tolerance)
    mass = cells.agg(F.sum("mass")).head()[0] or 0.0
    rate = F.when(F.col("mass") > 0, F.lit(budget) * F.col("weight") / (F.col("mass") / F.lit(mass or 1.0))).otherwise(0.0)
    rates = raked.select(*dims, rate.alias("rate"))
    drawn = _joined(rows, rates, dims).withColumn("probability", F.least(F.lit(1.0), "rate"))
    weight = F.when(F.col("rate") > 1, F.col("rate")).otherwise(1.0)
    copies = F.floor("rate") + (F.col("u") < F.col("rate") - F.floor("rate")).cast("long")
    return drawn.select(
        "row", *dims, "n_tokens", "probability", (F.col("u") < F.col("probability")).alias("sampled"), weight.alias("weight"),
        copies.alias("copies"),
    )


def document_mix(docs: DataFrame, *, text: str = "text", source: str = "source", lang: str = "lang", **options) -> DataFrame:
    """``mix`` of documents by source, language and topic."""
    n = spaced_words(named(text))
    return mix(docs, {"source": named(source), "lang": named(lang), "topic": topic_of(named(text), n)}, n, **options)
