"""Run a numpy function over a text column, beside columns that pass through untouched."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The given columns (default: all) as one struct, so that added columns can't clash with them."""
    return F.struct(*[named(c) for c in (docs.columns if columns is None else columns)])


def map_text(
    docs: DataFrame,
    text: Column,
    fields: T.StructType,
    fn: Callable[[pa.Array], list[pa.Array]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns ``row`` (the kept columns of docs, default all) and ``found`` (what ``fn`` returns).

    ``fn`` gets the texts of an Arrow batch and returns one array of the same length for each field.
    """
    packed = docs.select(whole_row(docs, keep).alias("row"), text.cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("found", fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.StructArray.from_arrays(fn(batch.column("text")), names=fields.names)
                yield pa.RecordBatch.from_arrays([batch.column("row"), found], names=["row", "found"])

    return packed.mapInArrow(run, schema)


def lists(values: pa.Array, counts) -> pa.Array:
    """A list column from the values of all rows and the number of values of each row."""
    import numpy as np

    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)
