"""Ranks, running totals and exact quantiles without sorting a table in one task.

* Numbers are ordered by a 64-bit integer with the order of the doubles (``with_order_key``), read in digits of 16 bits from the
  highest on. A histogram of digits combines before it is shuffled, and has at most 65,536 cells for each digit above.
* Quantiles are found by radix selection: of each round only the cells that hold a wanted rank are kept, and the next
  round counts the next digit of the rows in these. Four digits are a whole key; a cell of one value needs no more.
* Running totals add up the totals of the cells before, digit by digit, as many digits as bring a cell down to one task's
  share of rows.
* Text hashes are uniform, so their digits are read in the same way (``find_cuts``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import fresh_name, quoted
from millrace.session import scratch_path

#: Bits below the digits that are read so far, round by round.
BELOW = (48, 32, 16, 0)
#: Rows of a small table that are sent to all executors; a larger one is joined by a shuffle, whose skew AQE splits.
BROADCAST_ROWS = 100_000
#: Rows that one task puts in order.
ROWS_PER_TASK = 1_000_000

# The layout of a double.
FRACTION = 1 << 52
BIAS = 1023
SPECIAL = 2047 * FRACTION


def with_order_key(df: DataFrame, number: str, name: str = "key", descending: bool = False) -> DataFrame:
    """The table with a 64-bit integer that orders as a column of doubles does, found by exact arithmetic, step by step.

    Equal numbers have equal keys, so -0.0 and 0.0 do; infinities come first and last, and NaN after them. The key of a
    missing number is 0.
    """
    value = quoted(number)
    size, guess, scaled = (fresh_name([*df.columns, name], n) for n in ("size", "guess", "scaled"))
    out = df.withColumn(size, F.abs(value))
    out = out.withColumn(guess, F.floor(F.log2(size)))
    out = out.withColumn(scaled, F.col(size) * F.pow(F.lit(2.0), -F.col(guess)))  # near 1 to 2; the logarithm is rounded
    # One step of the exponent up or down, where the rounding asks for it, is a factor of two.
    off = F.when(F.col(scaled) >= 2, 1).when(F.col(scaled) < 1, -1).otherwise(0)
    fraction = F.when(F.col(scaled) >= 2, F.col(scaled) / 2).when(F.col(scaled) < 1, F.col(scaled) * 2).otherwise(F.col(scaled)) - 1
    bits = (
        F.when(F.isnan(value), F.lit(SPECIAL + 1))
        .when(F.col(size) == 0, F.lit(0).cast("long"))
        .when(F.col(size) == math.inf, F.lit(SPECIAL))
        .when(F.col(size) < F.lit(2.0**-1022), (F.col(size) * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .otherwise((F.col(guess) + off + BIAS) * F.lit(FRACTION) + (fraction * F.lit(float(FRACTION))).cast("long"))
    )
    sign = F.when((value < 0) != F.lit(descending), F.lit(-1)).otherwise(F.lit(1))
    return out.withColumn(name, F.coalesce(bits * sign, F.lit(0).cast("long"))).drop(size, guess, scaled)


def key_value(key: Column) -> Column:
    """The double of an ascending order key."""
    bits = F.abs(key)
    exponent = F.shiftright(bits, 52)
    fraction = bits.bitwiseAND(F.lit(FRACTION - 1)).cast("double")
    size = (
        F.when(bits > SPECIAL, F.lit(math.nan))
        .when(bits == SPECIAL, F.lit(math.inf))
        .when(exponent == 0, fraction * F.lit(2.0**-537) * F.lit(2.0**-537))
        .otherwise((1 + fraction / F.lit(float(FRACTION))) * F.pow(F.lit(2.0), exponent - BIAS))
    )
    return F.when(key < 0, -size).otherwise(size)


def _digits(key: Column, below: int) -> Column:
    """The digits of a key above the given number of bits, as one integer of the same order."""
    return F.shiftright(key, below) if below else key


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared folder and read again: the plan behind them runs once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_small(rows: DataFrame, small: DataFrame, on: Sequence[str], n_small: int) -> DataFrame:
    """Rows joined with a table of ``n_small`` rows: sent to all executors up to BROADCAST_ROWS, shuffled beyond."""
    return rows.join(F.broadcast(small) if n_small <= BROADCAST_ROWS else small.hint("merge"), list(on))


# ---- quantiles ---------------------------------------------------------------------------------------


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles: ``*by, n, quantiles array<double>``.

    Spark's own ``percentile`` keeps every distinct value of a group in one buffer. Here each round scans the column once
    and counts the next digit in the cells that hold a wanted rank; rows are never shuffled while the cells are few enough
    to be sent to them (BROADCAST_ROWS). NULL and NaN values and NULL groups are left out. The rounds run when this is
    called; the result is a small table.
    """
    spark, group = df.sparkSession, [f"g{i}" for i in range(len(by))]
    value = quoted(column).cast("double")
    values = df.filter(value.isNotNull() & ~F.isnan(value)).select(*[quoted(b).alias(g) for b, g in zip(by, group)], value.alias("v"))
    values = with_order_key(values.na.drop("any", subset=group) if by else values, "v").drop("v")

    def ranks_of(n: Column) -> list[tuple[Column, Column]]:
        return [(F.floor(F.lit(float(p)) * (n - 1)), F.ceil(F.lit(float(p)) * (n - 1))) for p in probabilities]

    def counted(rows: DataFrame, cell: list[str], below: int) -> DataFrame:
        """Rows, least and greatest key of each next digit, and the rows before it inside the cell above."""
        cells = rows.groupBy(*cell, _digits(F.col("key"), below).alias("at")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        inside = Window.partitionBy(*cell)
        before = F.sum("rows").over(inside.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
        return cells.withColumns({"inside": F.coalesce(before, F.lit(0)), "all": F.sum("rows").over(inside)})

    def held(cells: DataFrame) -> DataFrame:
        """The cells that hold a wanted rank, with the ranks that they hold."""
        mine = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("rows")))
        found = cells.withColumn("ranks", mine).filter(F.size("ranks") > 0).select(*group, "n", "at", "start", "low", "high", "ranks")
        if by:
            return stored(found, "ranks")
        return spark.createDataFrame(found.collect(), found.schema)  # two cells a probability at most

    wanted = F.array_distinct(F.array(*[r.cast("long") for pair in ranks_of(F.col("n")) for r in pair]))
    first = counted(values, group, BELOW[0]).withColumnRenamed("all", "n").withColumn("start", F.col("inside"))
    cells = held(first.withColumn("ranks", wanted))
    done = None
    for above, below in zip(BELOW, BELOW[1:]):
        settled = cells.filter("low = high")
        done = settled if done is None else done.union(settled)
        open_ = cells.filter("low < high")
        n_open = open_.count()
        cells = None
        if not n_open:
            break
        parents = open_.select(*group, F.col("at").alias("parent"))
        inside = with_small(values.withColumn("parent", _digits(F.col("key"), above)), parents, [*group, "parent"], n_open)
        parents = open_.select(*group, F.col("at").alias("parent"), "n", F.col("start").alias("begin"), "ranks")
        next_ = counted(inside, [*group, "parent"], below).join(parents, [*group, "parent"])
        cells = held(next_.withColumn("start", F.col("begin") + F.col("inside")))
    done = done if cells is None else done.union(cells)

    each = done.select(*group, "n", F.explode("ranks").alias("rank"), key_value(F.col("low")).alias("v"))
    picked = each.groupBy(*group, "n").agg(F.map_from_entries(F.collect_set(F.struct("rank", "v"))).alias("found"))

    def between(lower: Column, upper: Column, p: float) -> Column:
        low, high = (F.element_at("found", r.cast("long")) for r in (lower, upper))
        part = F.lit(float(p)) * (F.col("n") - 1) - lower
        # Equal neighbours stay as they are: the difference of two infinities is no number.
        return F.when(low == high, low).otherwise(low + (high - low) * part)

    quantiles = [between(*pair, p) for pair, p in zip(ranks_of(F.col("n")), probabilities)]
    return picked.select(*[F.col(g).alias(b) for g, b in zip(group, by)], "n", F.array(*quantiles).alias("quantiles"))


# ---- running totals ----------------------------------------------------------------------------------


def _depth(keys: DataFrame, group: list[str], rows_per_task: int) -> int:
    """How many digits bring every cell down to one task's share of rows."""
    n = keys.count()
    for depth, below in enumerate(BELOW, start=1):
        if n <= rows_per_task or not below:
            return depth
        n = keys.groupBy(*group, _digits(F.col("key"), below)).count().agg(F.max("count")).first()[0]
        if n <= rows_per_task:
            return depth
    return len(BELOW)


def running_totals(
    counts: DataFrame,
    order_col: str,
    sums: Sequence[str],
    descending: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
    by: Sequence[str] = (),
) -> DataFrame:
    """Running totals along ``order_col`` (a double) over a table with one row per value, or per value of each group.

    Returns ``by``, ``order_col``, the summed columns, and for each of these ``s``: ``cum_s`` (up to and including the row),
    ``total_s`` and ``next_s`` (the value of the following row, NULL on the last one). The given plan runs once, when this
    is called; the totals are read from what it wrote. No ordered window holds more than ``rows_per_task`` rows or the
    65,536 cells of a digit. Groups of a NULL are left out.
    """
    names, group = [f"s{i}" for i in range(len(sums))], [f"g{i}" for i in range(len(by))]
    rows = counts.select(
        *[quoted(b).alias(g) for b, g in zip(by, group)], quoted(order_col).alias("v"), *[quoted(s).alias(n) for s, n in zip(sums, names)]
    )
    rows = stored(with_order_key(rows, "v", descending=descending), "totals")
    depth = _depth(rows, group, rows_per_task)

    # Cells of the lowest digit first: their sums, and the values of their first rows.
    cell = _digits(F.col("key"), BELOW[depth - 1])
    added = [F.sum(n).alias(n) for n in names]
    cells = [rows.groupBy(*group, cell.alias("at")).agg(*added, *[F.min_by(n, "key").alias(f"first_{n}") for n in names])]
    for _ in range(depth - 1):
        up = cells[-1].groupBy(*group, F.shiftright("at", 16).alias("up"))
        cells.append(up.agg(*added, *[F.min_by(f"first_{n}", "at").alias(f"first_{n}") for n in names]).withColumnRenamed("up", "at"))

    placed = None
    for level in reversed(cells):
        inner = [*group, "parent"]
        level = level.withColumn("parent", F.shiftright("at", 16) if placed is not None else F.lit(0).cast("long"))
        siblings = Window.partitionBy(*inner) if placed is not None else Window.partitionBy(*group)
        along = siblings.orderBy("at")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(
            *inner, "at",
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"before_{n}") for n in names],
            *[F.lead(f"first_{n}").over(along).alias(f"after_{n}") for n in names],
            *([F.sum(n).over(siblings).alias(f"total_{n}") for n in names] if placed is None else []),
        )
        if placed is not None:
            above = placed.select(
                *group, F.col("at").alias("parent"), *[F.col(f"before_{n}").alias(f"begin_{n}") for n in names],
                *[F.col(f"after_{n}").alias(f"end_{n}") for n in names], *[f"total_{n}" for n in names],
            )
            level = level.join(above, inner).select(
                *group, "at", *[(F.col(f"begin_{n}") + F.col(f"before_{n}")).alias(f"before_{n}") for n in names],
                *[F.coalesce(f"after_{n}", f"end_{n}").alias(f"after_{n}") for n in names], *[f"total_{n}" for n in names],
            )
        placed = level

    inside = Window.partitionBy(*group, "at").orderBy("key")
    up_to_row = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.withColumn("at", cell).join(placed.drop("parent"), [*group, "at"])
    return both.select(
        *[F.col(g).alias(b) for g, b in zip(group, by)],
        F.col("v").alias(order_col),
        *[F.col(n).alias(s) for n, s in zip(names, sums)],
        *[(F.col(f"before_{n}") + F.sum(n).over(up_to_row)).alias(f"cum_{s}") for n, s in zip(names, sums)],
        *[F.col(f"total_{n}").alias(f"total_{s}") for n, s in zip(names, sums)],
        *[F.coalesce(F.lead(n).over(inside), F.col(f"after_{n}")).alias(f"next_{s}") for n, s in zip(names, sums)],
    )


# ---- cuts of a hash order ----------------------------------------------------------------------------

#: Hexadecimal digits of a hash that are counted in one scan.
HASH_DIGITS = 4


@dataclass(frozen=True)
class Cut:
    """The hash found at a rank, and the ranks ``[start, start + rows)`` that share it."""

    rank: int
    hash: str
    start: int
    rows: int


def find_cuts(df: DataFrame, digest: Column, ranks) -> tuple[int, list[Cut | None]]:
    """The number of rows, and the hashes at 0-based ranks of the ascending hash order; None beyond the last row.

    ``digest`` is a uniform text hash of a row; ``ranks`` a list, or a function of the number of rows that gives one. Three
    scans find any number of cuts: the first counts rows by the first four digits, which gives the number of rows too, the
    second by the next four of the rows with a wanted prefix, and the third counts the whole hashes that begin with the
    eight digits found: one in four billion of all for each cut, and copies of a row as one. The driver holds 65,536 counts
    of the first scan, and of the others those with a wanted prefix.
    """
    hashes = df.select(digest.alias("h"))
    cells = _cells(hashes, HASH_DIGITS)
    n = sum(rows for _, rows in cells)
    ranks = ranks(n) if callable(ranks) else list(ranks)
    held = {r: found for r in set(ranks) if (found := _holding(cells, r, 0))}
    for digits in (2 * HASH_DIGITS, None):
        prefixes = sorted({p for p, _ in held.values()})
        if not prefixes:
            break
        long = len(prefixes[0])
        inside = hashes.filter(F.substring("h", 1, long).isin(prefixes))
        cells = _cells(inside, digits)
        within = {p: [c for c in cells if c[0].startswith(p)] for p in prefixes}
        held = {r: _holding(within[p], r, start) for r, (p, start) in held.items()}
    counts = dict(cells) if held else {}
    return n, [Cut(r, held[r][0], held[r][1], counts[held[r][0]]) if r in held else None for r in ranks]


def _cells(hashes: DataFrame, digits: int | None) -> list[tuple[str, int]]:
    """Rows per prefix (or per whole hash), in order."""
    prefix = F.substring("h", 1, digits) if digits else F.col("h")
    return sorted((r["p"], r["count"]) for r in hashes.groupBy(prefix.alias("p")).count().collect())


def _holding(cells: list[tuple[str, int]], rank: int, start: int) -> tuple[str, int] | None:
    """The cell that holds a rank, and the rows before it."""
    for prefix, rows in cells:
        if rank < start + rows:
            return prefix, start
        start += rows
    return None
