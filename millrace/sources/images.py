"""Folders with one sub-folder per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CLASSES = 100_000


def _parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def _files(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def class_names(
    spark: SparkSession, path: str, pattern: str | None = None, max_classes: int = MAX_CLASSES
) -> list[str]:
    """Sorted sub-folder names; the position of a name is its class id. More than ``max_classes`` are an error."""
    names = _files(spark, path, pattern).select(_parent_folder(F.col("path")).alias("c")).distinct()
    rows = names.limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} class folders below {path}")
    return sorted(r["c"] for r in rows)


def read_image_folder(
    spark: SparkSession,
    path: str,
    decode: bool = True,
    pattern: str | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """One row per file: ``path, class_name, label, image``.

    ``image`` is Spark's decoded image struct (channels in blue-green-red order), or the file's
    bytes with ``decode=False``. Both are read only when a later step uses the column. Undecodable
    files keep their row with ``nChannels = -1``. The class list is a small driver-side list; pass
    ``names`` to fix it, for instance when a test folder lacks a class.
    """
    names = class_names(spark, path, pattern) if names is None else names
    if decode:
        reader = spark.read.format("image").option("recursiveFileLookup", True)
        if pattern is not None:
            reader = reader.option("pathGlobFilter", pattern)
        rows = reader.load(path).select(F.col("image.origin").alias("path"), "image")
    else:
        rows = _files(spark, path, pattern).select("path", F.col("content").alias("image"))
    folder = _parent_folder(F.col("path"))
    at = F.array_position(F.array(*[F.lit(n) for n in names]), folder)
    label = F.when(at > 0, (at - 1).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("folder is not a class: "), folder))
    )
    return rows.select("path", folder.alias("class_name"), label.alias("label"), "image")
