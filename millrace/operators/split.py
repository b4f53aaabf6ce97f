"""Reproducible splits, samples and folds.

The exact splits order rows by a seeded md5 of their key. Only the hashes at the cuts are searched for
(``rank.find_cuts``: three scans for any number of cuts); the split itself is then a projection, with no shuffle of the
table. Helper columns get names that the table doesn't have.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import row_hash
from millrace.functions.columns import fresh_name, quoted, value_text
from millrace.operators.rank import Cut, find_cuts, stored, with_small

#: Copies of one row that one task writes out.
COPIES_PER_TASK = 1_000_000
#: Rows of a class that one task deals out to folds, about; copies of one row are dealt out in chunks of as many.
ROWS_PER_BUCKET = 1 << 16
#: Partitions for chunks of copies at most; beyond it a task deals out several chunks, one after another.
MOST_PARTITIONS = 10_000

Sizes = Sequence[tuple[str, int | None]]


def _key(df: DataFrame, key: str | Sequence[str] | None) -> list[str]:
    if key is None:
        return df.columns
    return [key] if isinstance(key, str) else list(key)


def _segments(df: DataFrame, key: list[str], seed: int, sizes: Sizes | Callable[[int], Sizes], column: str) -> DataFrame:
    """Name consecutive stretches of the hash order; a size of None takes the rest.

    ``sizes`` may be a function of the number of rows. Rows past the last stretch are left out.
    """
    digest = row_hash(key, seed)
    columns = [quoted(c) for c in df.columns if c != column]

    def ends(n: int) -> list[int]:
        """The first rank after each stretch that has a size."""
        out, end = [], 0
        for _, size in sizes(n) if callable(sizes) else sizes:
            if size is not None:
                end += size
                out.append(end)
        return out

    n, found = find_cuts(df, digest, ends)
    sizes = sizes(n) if callable(sizes) else list(sizes)
    found = iter(found)
    cuts: list[Cut | None] = [None if size is None else next(found) for _, size in sizes]

    def by_rank(rank: Column) -> Column:
        label, start = F.lit(None).cast("string"), 0
        for name, size in sizes:
            inside = rank >= F.lit(start)
            if size is not None:
                start += size
                inside = inside & (rank < F.lit(start))
            label = F.when(inside, F.lit(name)).otherwise(label)
        return label

    label = F.lit(None).cast("string")
    for (name, size), cut in reversed(list(zip(sizes, cuts))):
        if size == 0:
            continue
        everything = F.lit(True) if cut is None else digest < F.lit(cut.hash)
        label = F.when(everything, F.lit(name)).otherwise(label)
    shared = {c.hash: c for c in cuts if c is not None and c.start < c.rank}
    plain = df.filter(~digest.isin(list(shared))) if shared else df
    out = plain.select(*columns, label.alias(column)).filter(quoted(column).isNotNull())
    if not shared:
        return out
    if set(key) != set(df.columns):
        # Different rows with one key lie across a cut: they are split in turn by all their columns.
        for cut in shared.values():
            inner, at = [], 0
            for name, size in sizes:
                begin, at = at, at + (size or 0)
                inner.append((name, None if size is None else max(0, at - max(begin, cut.start))))
            tied = df.filter(digest == F.lit(cut.hash))
            out = out.unionByName(_segments(tied, df.columns, seed, inner, column))
        return out
    # Copies of one row lie across a cut. They are counted, not collected, and written out again
    # in chunks with their ranks.
    h, many, chunk, copy = (fresh_name(df.columns, c) for c in ("hash", "many", "chunk", "copy"))
    starts = F.create_map(*[F.lit(x) for c in shared.values() for x in (c.hash, c.start)])
    copies = df.filter(digest.isin(list(shared))).groupBy(digest.alias(h), *[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(many))
    chunks = copies.withColumn(
        chunk, F.explode(F.sequence(F.lit(0), F.floor((F.col(many) - 1) / COPIES_PER_TASK)))
    ).repartition(F.col(h), F.col(chunk))
    first = F.col(chunk) * COPIES_PER_TASK
    last = F.least(first + COPIES_PER_TASK, F.col(many)) - 1
    ranked = chunks.withColumn(copy, F.explode(F.sequence(first, last)))
    tied = ranked.select(*columns, by_rank(starts[F.col(h)] + F.col(copy)).alias(column)).filter(quoted(column).isNotNull())
    return out.unionByName(tied)


def split_exact(
    df: DataFrame,
    key: str | Sequence[str] | None = None,
    train: float | None = None,
    test: float | None = None,
    seed: int = 0,
    column: str = "split",
) -> DataFrame:
    """Random split into ``train`` and ``test`` with exact sizes.

    ``train=f`` gives floor(f*n) rows to train; ``test=f`` gives ceil(f*n) rows to test. ``key``
    names columns that identify a row (all columns when omitted). A column of the name ``column`` is replaced.
    """
    if (train is None) == (test is None):
        raise ValueError("give either train or test")

    def sizes(n: int) -> Sizes:
        return [("train", math.floor(train * n) if train is not None else n - math.ceil(test * n)), ("test", None)]

    return _segments(df, _key(df, key), seed, sizes, column)


def split_counts(
    df: DataFrame,
    key: str | Sequence[str] | None,
    n_train: int,
    n_validation: int,
    seed: int = 0,
    column: str = "split",
) -> DataFrame:
    """Shuffled split by absolute sizes; the remaining rows are left out, as asked for."""
    sizes = [("train", n_train), ("validation", n_validation)]
    return _segments(df, _key(df, key), seed, sizes, column)


def sample_n(df: DataFrame, key: str | Sequence[str] | None, n: int, seed: int = 0) -> DataFrame:
    """Shuffle and keep ``n`` rows."""
    label = fresh_name(df.columns, "sample")
    return _segments(df, _key(df, key), seed, [("sample", n)], label).drop(label)


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Independent seeded draws per row; sizes vary, and so does the result with the partitioning."""
    return df.randomSplit(list(weights), seed)


def split_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    return df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("n"))


# ---- folds -------------------------------------------------------------------------------------------


def _prefix_digits(n: int, rows: int) -> int:
    """Digits of a uniform hash whose prefixes cut ``n`` rows into buckets of about ``rows``."""
    digits = 1
    while n > rows * 16**digits and digits < 16:
        digits += 1
    return digits


def assign_folds(
    df: DataFrame,
    key: str | Sequence[str] | None = None,
    k: int = 5,
    seed: int = 0,
    stratify: str | None = None,
    column: str = "fold",
) -> DataFrame:
    """Add a fold number from 0 to k-1; a column of the name ``column`` is replaced.

    Without ``stratify`` each row draws its fold from its hash: a projection, sizes nearly equal.
    With ``stratify`` rows are dealt out in turn along (class, hash), so each class differs by at
    most one row between folds. That needs one shuffle, by (class, hash prefix), with prefixes long
    enough that even a class of all rows is cut into buckets of ROWS_PER_BUCKET. Rows of one key that
    fill more than a bucket come last in theirs, and are dealt out along the hashes of all their columns;
    copies of one row that do so are counted and written out again in chunks.
    """
    columns = [c for c in df.columns if c != column]
    digest = row_hash(_key(df, key), seed)
    if stratify is None:
        number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
        return df.select(*[quoted(c) for c in columns], F.pmod(number, F.lit(k)).cast("int").alias(column))

    # The class as text, so that NULL is a class too and joins are plain equalities. The row stays in a struct, where its
    # columns can't clash with the helpers.
    row = F.struct(*[quoted(c) for c in df.columns])
    rows = df.select(row.alias("row"), value_text(quoted(stratify)).alias("c"), digest.alias("h"))
    sizes = df.groupBy(quoted(stratify).alias("value"), value_text(quoted(stratify)).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    along = Window.orderBy("value", "c").rowsBetween(Window.unboundedPreceding, -1)  # one row per class
    starts = stored(sizes.select("c", "n", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start")), "classes")
    of_row = F.md5(F.concat_ws("|", F.lit(str(seed)), *[value_text(F.col("row").getField(c)) for c in df.columns]))
    again = of_row if set(_key(df, key)) != set(df.columns) else None
    total = starts.agg(F.sum("n")).first()[0] or 0
    dealt = _dealt(rows, starts.select("c", "start"), total, again, k)
    return dealt.select(*[F.col("row").getField(c).alias(c) for c in columns], F.col("fold").alias(column))


def _dealt(rows: DataFrame, starts: DataFrame, n: int, again: Column | None, k: int) -> DataFrame:
    """(row, fold): rows (row, c, h) dealt out along h inside each class c, from the class's first rank ``start`` on.

    ``again`` is a hash of the whole row, for rows that share h but may differ; None where rows of one h are copies.
    """
    bucket = F.substring("h", 1, _prefix_digits(n, ROWS_PER_BUCKET))
    rows = rows.withColumn("b", bucket)
    sizes = stored(rows.groupBy("c", "b").agg(F.count(F.lit(1)).alias("rows")), "buckets")
    along = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("rows").over(along), F.lit(0))).join(starts, "c")
    sizes = sizes.select("c", "b", "rows", (F.col("start") + F.col("before")).alias("start"))
    full = sizes.filter(F.col("rows") > 2 * ROWS_PER_BUCKET).select("c", "b")
    n_full = full.count()
    hot, n_hot = None, 0
    if n_full:
        inside = with_small(rows.select("c", "b", "h"), full, ["c", "b"], n_full).groupBy("c", "b", "h").agg(F.count(F.lit(1)).alias("copies"))
        hot = stored(inside.filter(F.col("copies") > ROWS_PER_BUCKET), "hot")
        n_hot = hot.count()

    plain = rows
    if n_hot:
        keys = hot.select("c", "h")
        plain = rows.join(F.broadcast(keys) if n_hot <= ROWS_PER_BUCKET else keys.hint("merge"), ["c", "h"], "left_anti")
    inside = Window.partitionBy("c", "b").orderBy("h")
    out = plain.join(sizes.select("c", "b", "start"), ["c", "b"]).select(
        "row", ((F.col("start") + F.row_number().over(inside) - 1) % k).cast("int").alias("fold")
    )
    if not n_hot:
        return out

    # Keys of many rows come behind the others of their buckets.
    along = Window.partitionBy("c", "b").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    taken = hot.groupBy("c", "b").agg(F.sum("copies").alias("taken"))
    placed = hot.withColumn("before", F.coalesce(F.sum("copies").over(along), F.lit(0))).join(taken, ["c", "b"]).join(sizes, ["c", "b"])
    start = F.col("start") + F.col("rows") - F.col("taken") + F.col("before")
    placed = stored(placed.select("c", "h", start.alias("start"), "copies"), "placed")
    mine = with_small(rows.select("row", "c", "h"), placed.select("c", "h", "start"), ["c", "h"], n_hot)
    if again is not None:
        name = F.concat_ws("|", "c", "h").alias("c")
        n = placed.agg(F.sum("copies")).first()[0]
        return out.unionByName(_dealt(mine.select("row", name, again.alias("h")), placed.select(name, "start"), n, None, k))
    copies = mine.groupBy("c", "h", "row", "start").agg(F.count(F.lit(1)).alias("copies"))
    chunks = copies.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / ROWS_PER_BUCKET))))
    first = F.col("chunk") * ROWS_PER_BUCKET
    last = F.least(first + ROWS_PER_BUCKET, F.col("copies")) - 1
    parts = placed.agg(F.sum(F.ceil(F.col("copies") / ROWS_PER_BUCKET))).first()[0]
    each = chunks.repartitionByRange(min(parts, MOST_PARTITIONS), "c", "h", "chunk").withColumn("copy", F.explode(F.sequence(first, last)))
    return out.unionByName(each.select("row", ((F.col("start") + F.col("copy")) % k).cast("int").alias("fold")))
