"""Winnowing fingerprints with DataFrame functions alone.

A text's words are hashed, k-gram hashes are built from them by joining runs of one, two, four ... words, and of every
``window`` neighbouring k-gram hashes the smallest one is chosen, the rightmost of equal ones. Each choice is kept once,
with its place. So any passage of ``window + k - 1`` words that two texts share is met by a choice that they share.

A hash and its place are one number (hash above, place complemented below), so that the smallest number is the
smallest hash at the rightmost place. Minima over two, four, eight neighbours follow from each other by halves.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import named, whole_row

#: Words in a gram, and neighbouring grams of which one is kept. Both are sums of powers of two.
K, WINDOW = 5, 8
PLACE_BITS = 32
PLACES = (1 << PLACE_BITS) - 1
HASHES = (1 << 31) - 1
#: Bytes of text in a range of keys, and ranges that one sketch cuts.
RANGE_BYTES = 64 << 20
COARSE_RANGES = 512


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _after(values: Column, n: int) -> Column:
    """The values without the first n."""
    return F.slice(values, n + 1, F.greatest(F.size(values) - n, F.lit(0)))


def _paired(one: Column, two: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Values joined by place, as many as ``two`` has (``one`` has no fewer)."""
    return F.zip_with(F.slice(one, 1, F.size(two)), two, join)


def _runs(values: Column, n: int, join: Callable[[Column, Column], Column]) -> Column:
    """For each run of n neighbours, one value built by ``join`` from the left to the right."""
    if n == 1:
        return values
    half = n // 2
    if n % 2:  # the run without its last value, and that value
        return let(values, lambda v: _paired(_runs(v, n - 1, join), _after(v, n - 1), join))
    return let(_runs(values, half, join), lambda h: _paired(h, _after(h, half), join))


def chosen(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The choices of a text as one array of numbers, in order of their places.

    Texts with fewer than k words have one gram of all their words, texts with fewer than ``window`` grams one window of
    all their grams. Null, empty and blank texts have none.
    """
    trimmed = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"^\s+|\s+$", "")
    words = let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"\s+")))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    several = lambda h: _runs(h, k, lambda a, b: F.xxhash64(a, b))
    few = lambda h: F.when(F.size(h) == 0, h).otherwise(F.array(F.xxhash64(h)))
    grams = let(hashes, lambda h: F.when(F.size(h) >= k, several(h)).otherwise(few(h)))
    numbers = F.transform(
        grams, lambda g, i: F.shiftleft(g.bitwiseAND(F.lit(HASHES)), PLACE_BITS).bitwiseOR(F.lit(PLACES) - i.cast("long"))
    )
    least = lambda n: F.when(F.size(n) == 0, n).otherwise(F.array(F.array_min(n)))
    minima = lambda n: F.when(F.size(n) >= window, _runs(n, window, lambda a, b: F.least(a, b))).otherwise(least(n))
    return F.array_distinct(let(numbers, minima))


def hashes_of(choices: Column) -> Column:
    """The distinct hashes of a text's choices."""
    return F.array_distinct(F.transform(choices, lambda n: F.shiftright(n, PLACE_BITS).cast("int")))


def places_of(choices: Column) -> Column:
    """(place, hash) of each choice: the gram's first word, counted from 0."""
    return F.transform(
        choices,
        lambda n: F.struct((F.lit(PLACES) - n.bitwiseAND(F.lit(PLACES))).alias("place"), F.shiftright(n, PLACE_BITS).alias("hash")),
    )


def as_text(choices: Column) -> Column:
    """``hash:place`` of each choice, joined by commas."""
    return F.array_join(
        F.transform(choices, lambda n: F.concat(
            F.shiftright(n, PLACE_BITS).cast("string"), F.lit(":"), (F.lit(PLACES) - n.bitwiseAND(F.lit(PLACES))).cast("string")
        )), ","
    )


def likeness(one: Column, two: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; 1 for two empty ones."""
    common = F.size(F.array_intersect(one, two))
    either = F.size(one) + F.size(two) - common
    return F.when(either == 0, 1.0).otherwise(common / F.greatest(either, F.lit(1)))


def fingerprints(docs: DataFrame, *, text: str = "text", k: int = K, window: int = WINDOW, keep=None) -> DataFrame:
    """``row`` (a struct of the kept columns of docs, default all) and ``choices`` (place, hash) of every whole text.

    Words are runs of characters other than white space, as they are. Null and empty texts have no choices; equal texts
    have equal ones. Repeated rows are each returned; extra columns pass through.
    """
    return docs.select(whole_row(docs, keep).alias("row"), places_of(chosen(named(text), k, window)).alias("choices"))


def _cuts(rows: DataFrame, key: str, parts: int) -> list[list[int]]:
    """Cut points of the keys into about ``parts`` ranges of like many rows: a list of cuts for each coarse range.

    Coarse ranges are few enough for one sketch; each is cut further by a sketch of its own, where there are more ranges.
    The first cut of a coarse range but the first one is where it begins.
    """
    keys = rows.select(F.col(key).cast("bigint").alias("k")).filter("k IS NOT NULL")
    coarse = min(parts, COARSE_RANGES)
    if coarse < 2:
        return [[]]
    starts = sorted({int(c) for c in keys.approxQuantile("k", [i / coarse for i in range(1, coarse)], 1 / (4 * coarse))})
    fine = -(-parts // coarse)
    if fine < 2:
        return [[], *[[c] for c in starts]]
    shares = F.array(*[F.lit(i / fine) for i in range(1, fine)])
    within = keys.groupBy(_place(F.array(*[F.lit(c) for c in starts]), "k").alias("at")).agg(F.percentile_approx("k", shares, F.lit(4 * fine)).alias("cuts"))
    found = {r["at"]: r["cuts"] for r in within.collect()}
    return [sorted({*([starts[i - 1]] if i else []), *[c for c in found.get(i, []) if not i or c > starts[i - 1]]}) for i in range(len(starts) + 1)]


def _place(cuts: Column, key: str) -> Column:
    """How many of the cuts are not above the key; null keys lie below all cuts."""
    return F.when(F.col(key).isNull(), 0).otherwise(F.size(F.filter(cuts, lambda c: c <= F.col(key))))


def _constant(values: list, kind: str) -> Column:
    """A list as one literal, however long."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def ranges_for(rows: DataFrame, text: str, at_least: int = 1) -> int:
    """Ranges of about ``RANGE_BYTES`` of text, and no fewer than ``at_least``: more text makes more ranges, not larger ones."""
    size = rows.agg(F.sum(F.octet_length(named(text)))).head()[0] or 0
    return max(at_least, 1, -(-size // RANGE_BYTES))


def with_next(rows: DataFrame, key: str, parts: int, add: Callable[[DataFrame], DataFrame], carry: list[str]) -> DataFrame:
    """Rows with ``next_<c>`` of the row that follows by (key, c...) for each carried column; the first follows the last.

    Keys are cut into about ``parts`` ranges, each of which is one task's. The first row of each range also goes to the
    range before, so that a window inside each range sees its follower, and the rows are shuffled once. ``add`` adds
    columns after the shuffle, before the followers are looked up. Null keys come first. Rows of one key are in one range.
    The driver holds two numbers for each range, as it does for each task.
    """
    cuts = _cuts(rows, key, parts)
    flat = [c[0] for c in cuts[1:]]
    coarse = _place(_constant(flat, "array<bigint>"), key)
    fine = _place(F.get(_constant(cuts, "array<array<bigint>>"), coarse), key)
    before = [0]  # ranges that begin below the coarse range
    for i, c in enumerate(cuts):
        before.append(before[-1] + len(c) + (1 if i == 0 else 0))
    # In all but the first coarse range the first cut is the start, so ``fine`` counts from 1 there.
    number = F.get(_constant([b - (1 if i else 0) for i, b in enumerate(before[:-1])], "array<int>"), coarse) + fine
    ranged = rows.withColumn("_range", number)
    # The first key of every range: as many as there are ranges.
    firsts = ranged.groupBy("_range").agg(F.min(F.struct(F.col(key).isNotNull().alias("there"), F.col(key).alias("key"))).alias("f")).collect()
    keys = {r["_range"]: r["f"]["key"] for r in firsts}
    used = sorted(keys)
    previous = {r: used[i - 1] for i, r in enumerate(used)}  # of the first range: the last one
    n = before[-1]
    first_key = F.get(_constant([keys.get(r) for r in range(n)], "array<bigint>"), F.col("_range"))
    behind = F.get(_constant([previous.get(r) for r in range(n)], "array<int>"), F.col("_range"))
    own = F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest"))
    guest = F.struct(behind.alias("at"), F.lit(1).alias("guest"))
    dealt = ranged.withColumn("_to", F.explode(F.when(F.col(key).eqNullSafe(first_key), F.array(own, guest)).otherwise(F.array(own))))
    dealt = dealt.withColumn("_at", F.col("_to.at")).repartitionById(n, F.col("_at"))
    order = Window.partitionBy("_at").orderBy(F.col("_to.guest"), F.col(key).asc_nulls_first(), *carry[:1])
    out = add(dealt)
    out = out.withColumns({f"next_{c}": F.lead(c).over(order) for c in carry})
    return out.filter("_to.guest = 0").drop("_range", "_to", "_at")
