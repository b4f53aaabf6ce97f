"""CSV files, file listings and first lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    header: bool = False,
    sep: str = ",",
    infer: bool = False,
    null_value: str | None = None,
    trim: bool = False,
    cast_to: str | Mapping[str, str] | None = None,
) -> DataFrame:
    """Read CSV with a declared schema, with inference, or as text.

    A declared schema saves the extra pass over the files that inference costs. ``null_value``
    turns a sentinel into NULL while reading, so that inference then sees the column's own type.
    ``cast_to`` turns the text columns into one type, or into a type per column; text that does not
    fit becomes NULL. Blanks around values are kept unless ``trim``.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    df = reader.csv(path)
    if cast_to is None:
        return df
    if isinstance(cast_to, str):
        cast_to = {f.name: cast_to for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in cast_to.items()})


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files below a folder: ``path, length, modification_time``. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", "length", F.col("modificationTime").alias("modification_time")
    )


def preview_lines(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """The first lines of a text file."""
    return spark.read.text(path).limit(n)
