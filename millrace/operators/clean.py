"""Renames, sentinels, casts, row filters and appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import is_missing, map_value, null_if, threshold_label, to_type
from millrace.operators.profile import find_fences


def _q(name: str):
    return F.col(f"`{name}`")


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``"string"`` or ``"numeric"`` columns."""
    types = {"string": T.StringType, "numeric": T.NumericType}
    if kind not in types:
        raise ValueError(f"kind must be one of {sorted(types)}")
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types[kind])]


def select_types(df: DataFrame, kind: str) -> DataFrame:
    return df.select([_q(c) for c in columns_of(df, kind)])


def null_sentinels(df: DataFrame, sentinel: str = "?", columns: Sequence[str] | None = None) -> DataFrame:
    """Turn a sentinel text into NULL, in all text columns or in the given ones."""
    columns = columns_of(df, "string") if columns is None else columns
    return df.withColumns({c: null_if(_q(c), sentinel) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    return df.withColumns({c: to_type(_q(c), t, strict) for c, t in types.items()})


def map_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(column, map_value(_q(column), mapping))


def with_literal(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def with_threshold_label(df: DataFrame, column: str, at_least: float, label: str = "label") -> DataFrame:
    """Replace a score column by a boolean label (the score must not stay a feature)."""
    return df.withColumn(label, threshold_label(_q(column), at_least)).drop(column)


def features_and_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The table without the label column, and the label column alone."""
    return df.drop(label), df.select(_q(label))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep the rows without any NULL (or NaN)."""
    return df.na.drop("any")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(df, column))


def null_rows_all(df: DataFrame) -> DataFrame:
    """``(column_name, row)`` for every missing value, from one scan instead of one per column."""
    hits = [F.when(is_missing(df, c), F.lit(c)) for c in df.columns]
    row = F.struct(*[_q(c) for c in df.columns]).alias("row")
    return df.select(F.explode(F.array_compact(F.array(*hits))).alias("column_name"), row)


def drop_outliers(
    df: DataFrame, column: str, k: float = 1.5, keep_null: bool = True, approx: bool = False
) -> DataFrame:
    """Drop the rows outside the quartile fences (values on a fence stay).

    The fences are found first, then the filter is a plain comparison that reaches the scan.
    """
    fences = find_fences(df, column, k, approx)
    if fences.lower is None:
        return df if keep_null else df.filter(~is_missing(df, column))
    inside = fences.inside(_q(column))
    if keep_null:
        return df.filter(is_missing(df, column) | inside)
    return df.filter(inside)


def union_all(*frames: DataFrame) -> DataFrame:
    """Append tables, columns matched by name; a missing column becomes NULL; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame(rows, "position int, column_name string, type string, nullable boolean")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
