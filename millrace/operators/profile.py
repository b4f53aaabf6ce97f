"""Profiles: missing values, counts, quartile fences, group statistics, box- and pair-plot data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import is_missing
from millrace.functions.columns import quoted
from millrace.operators.rank import exact_quantiles, stored, with_small

APPROX_ACCURACY = 100_000
#: Cells that a task holds counts of at a time, about.
CELLS_HELD = 1 << 22
CELL = T.StructType([T.StructField(n, T.IntegerType()) for n in ("i", "j", "x_bin", "y_bin")] + [T.StructField("n", T.LongType())])

_q = quoted


def _per_column(df: DataFrame, hit, name: str) -> DataFrame:
    """One count per column from a single aggregate, turned into rows."""
    counted = df.agg(*[F.count_if(hit(c)).alias(c) for c in df.columns])
    return counted.unpivot([], [_q(c) for c in df.columns], "column_name", name)


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, lambda c: is_missing(df, c), "nulls")


def value_counts_equal(df: DataFrame, sentinel: str = "?") -> DataFrame:
    """How often each column equals a sentinel text; 0 for columns that are not text."""

    def hit(c: str) -> Column:
        if isinstance(df.schema[c].dataType, T.StringType):
            return _q(c) == F.lit(sentinel)
        return F.lit(False)

    return _per_column(df, hit, "hits")


def incomplete_fraction(df: DataFrame) -> DataFrame:
    """Share of the rows that have at least one missing value."""
    any_missing = F.lit(False)
    for c in df.columns:
        any_missing = any_missing | is_missing(df, c)
    return df.agg(F.avg(any_missing.cast("int")).alias("incomplete_fraction"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(_q(column)).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    known = df.filter(_q(column).isNotNull())
    counted = known.groupBy(_q(column)).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), _q(column))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination, ordered by the keys."""
    names = [_q(k) for k in keys]
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names)


def group_stats(df: DataFrame, key: str, column: str, approx: bool = False) -> DataFrame:
    """Mean, median, max and min per group (exact median unless ``approx``)."""
    known = df.filter(_q(key).isNotNull() & ~is_missing(df, column)).select(_q(key).alias("_key"), _q(column).alias("_v"))
    stats = [F.avg("_v").alias("mean"), F.max("_v").alias("max"), F.min("_v").alias("min")]
    if approx:
        median = F.percentile_approx(F.col("_v").cast("double"), 0.5, APPROX_ACCURACY).alias("median")
        found = known.groupBy("_key").agg(*stats, median)
    else:
        medians = exact_quantiles(known, "_v", [0.5], by=["_key"])
        medians = medians.select("_key", F.col("quantiles")[0].alias("median"))
        found = known.groupBy("_key").agg(*stats).join(medians, "_key")
    return found.select(F.col("_key").alias(key), "mean", "median", "max", "min")


def quartiles(df: DataFrame, column: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """``*by, q1, median, q3``"""
    if approx:
        known = df.filter(~is_missing(df, column)).na.drop("any", subset=list(by) or None)
        at = F.percentile_approx(_q(column).cast("double"), [0.25, 0.5, 0.75], APPROX_ACCURACY)
        q = known.groupBy(*by).agg(at.alias("quantiles"))
    else:
        q = exact_quantiles(df, column, [0.25, 0.5, 0.75], by=by)
    names = ("q1", "median", "q3")
    return q.select(*by, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])


def _fences(q: DataFrame, k: float) -> DataFrame:
    iqr = F.when(F.col("q3") == F.col("q1"), 0.0).otherwise(F.col("q3") - F.col("q1"))
    return q.withColumns({"iqr": iqr, "lower": F.col("q1") - k * iqr, "upper": F.col("q3") + k * iqr})


def iqr_fences(df: DataFrame, column: str, k: float = 1.5, approx: bool = False) -> DataFrame:
    """One row: ``q1, q3, iqr, lower, upper``."""
    return _fences(quartiles(df, column, approx=approx), k).drop("median")


@dataclass(frozen=True)
class Fences:
    """Quartile fences of one column: five numbers, found once and then used as literals."""

    q1: float | None
    q3: float | None
    iqr: float | None
    lower: float | None
    upper: float | None

    def inside(self, c: Column) -> Column:
        return c.between(F.lit(self.lower), F.lit(self.upper))


def find_fences(df: DataFrame, column: str, k: float = 1.5, approx: bool = False) -> Fences:
    """Run the quartile query; its single row comes to the driver, so later scans can push it down."""
    row = iqr_fences(df, column, k, approx).first()
    return Fences(**row.asDict()) if row else Fences(None, None, None, None, None)


def iqr_report(df: DataFrame, column: str, k: float = 1.5, approx: bool = False) -> DataFrame:
    """The fences with the share of all rows strictly outside them."""
    fences = find_fences(df, column, k, approx)
    outside = ~fences.inside(_q(column)) & ~is_missing(df, column)
    share = (F.count_if(outside) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("outlier_fraction")
    numbers = [F.lit(v).cast("double").alias(n) for n, v in asdict(fences).items()]
    return df.agg(share).select(*numbers, "outlier_fraction")


def box_stats(
    df: DataFrame, column: str, by: str | None = None, k: float = 1.5, approx: bool = False
) -> DataFrame:
    """Box-plot data: quartiles, whiskers (furthest values inside the fences), outlier count.

    The fences are found first, one row per group; the rows then meet them without a shuffle, and what they give is
    combined before it is shuffled (above ``rank.BROADCAST_ROWS`` groups the rows are shuffled to their fences).
    """
    keys = ["_by"] if by else []
    group = [_q(by).alias("_by")] if by else []
    known = df.filter(~is_missing(df, column)).select(*group, _q(column).cast("double").alias("_v"))
    fences = _fences(quartiles(known, "_v", keys, approx), k)
    if by:
        fences = stored(fences, "fences")
        both = with_small(known, fences, keys, fences.count())
    else:
        # One row, found first, then repeated as literals.
        found = fences.first()
        numbers = found.asDict() if found else dict.fromkeys(fences.columns)
        both = known.select("_v", *[F.lit(v).cast("double").alias(n) for n, v in numbers.items()])
    inside = F.col("_v").between(F.col("lower"), F.col("upper"))
    found = both.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return found.withColumnRenamed("_by", by) if by else found


def pair_bins(df: DataFrame, columns: Sequence[str], hue: str, bins: int = 10) -> DataFrame:
    """Counts per hue on a grid of bins, for each pair of columns: ``x_col, y_col, x_bin, y_bin, n``.

    A column paired with itself gives its histogram. Bins have equal width between the smallest and
    the largest value. Each task counts its rows into dense blocks of ``bins`` by ``bins`` cells, one for each hue and
    pair; only cells that aren't empty leave it, so what is shuffled doesn't follow the rows.
    """
    columns = list(columns)
    complete = df.filter(~_any_missing(df, columns))
    numbers = [_q(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    row = complete.agg(*[f(n).alias(f"{f.__name__}{i}") for i, n in enumerate(numbers) for f in (F.min, F.max)]).first()
    low = [row[f"min{i}"] for i in range(len(columns))]
    high = [row[f"max{i}"] for i in range(len(columns))]

    def bin_of(i: int) -> Column:
        if low[i] is None or low[i] == high[i]:
            return F.lit(0)
        at = F.floor((_q(columns[i]).cast("double") - F.lit(low[i])) / F.lit((high[i] - low[i]) / bins))
        return F.least(at, F.lit(bins - 1)).cast("int")

    binned = complete.select(_q(hue).alias("hue"), *[bin_of(i).cast("int").alias(f"b{i}") for i in range(len(columns))])
    places = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    cells = binned.mapInArrow(_cell_counts(places, bins), T.StructType([binned.schema["hue"], *CELL.fields]))
    names = F.array(*[F.lit(c) for c in columns])
    counted = cells.groupBy("hue", "i", "j", "x_bin", "y_bin").agg(F.sum("n").alias("n"))
    return counted.select(
        F.col("hue").alias(hue), F.get(names, F.col("i")).alias("x_col"), F.get(names, F.col("j")).alias("y_col"), "x_bin", "y_bin", "n"
    )


def _cell_counts(places: Sequence[tuple[int, int]], bins: int):
    """Counts of a task's rows per hue, pair of columns and cell, given out when CELLS_HELD cells are at hand."""
    most = max(1, CELLS_HELD // (len(places) * bins * bins))  # hues

    def told(hues: list, blocks: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        counts = np.stack(blocks)  # hue, pair, x, y
        at = np.nonzero(counts)
        i, j = np.array(places, np.int32)[at[1]].T
        cells = [pa.array(x.astype(np.int32)) for x in (i, j, at[2], at[3])]
        return pa.RecordBatch.from_arrays([pa.array(hues, kind).take(pa.array(at[0])), *cells, pa.array(counts[at])], names=["hue", *CELL.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = {}, None
        for batch in batches:
            coded = batch.column("hue").dictionary_encode(null_encoding="encode")
            kind = coded.dictionary.type
            code = coded.indices.to_numpy(zero_copy_only=False)
            at = [batch.column(k + 1).to_numpy(zero_copy_only=False) for k in range(batch.num_columns - 1)]
            values = coded.dictionary.to_pylist()
            for low in range(0, len(values), most):
                mine = slice(None) if len(values) <= most else (code >= low) & (code < low + most)
                some = values[low : low + most]
                shape = (len(some), bins, bins)
                block = np.stack([np.bincount(
                    np.ravel_multi_index((code[mine] - low, at[i][mine], at[j][mine]), shape), minlength=len(some) * bins * bins
                ).reshape(shape) for i, j in places], axis=1)
                for h, counts in zip(some, block):
                    if h in held:
                        held[h] += counts
                    else:
                        held[h] = counts
                if len(held) >= most:
                    yield told(list(held), list(held.values()), kind)
                    held = {}
        if held:
            yield told(list(held), list(held.values()), kind)

    return run


def _any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | is_missing(df, c)
    return out
