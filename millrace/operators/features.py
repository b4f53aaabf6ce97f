"""Categorical encoding and feature pipelines."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import fresh_name, quoted
from millrace.operators.clean import columns_of
from millrace.operators.rank import BROADCAST_ROWS, ROWS_PER_TASK, stored

MAX_DUMMY_COLUMNS = 10_000


def category_levels(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_DUMMY_COLUMNS) -> dict[str, list]:
    """Sorted distinct values per column, from one scan. They become column names, so the driver
    holds them; more than ``max_levels`` in total is an error, never a cut."""
    pairs = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    if not pairs:
        return {}
    distinct = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.name", "p.value")
    rows = distinct.filter("value is not null").distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} category values; use feature_pipeline instead")
    levels: dict[str, list] = {c: [] for c in columns}
    for row in rows:
        levels[row["name"]].append(row["value"])
    return {c: sorted(values) for c, values in levels.items()}


def dummies(df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = MAX_DUMMY_COLUMNS) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per level of each text column; NULL gives all zeros.

    The other columns come first and stay as they are. No pivot, no shuffle of the table. More than
    ``max_levels`` levels in all are an error.
    """
    columns = columns_of(df, "string") if columns is None else list(columns)
    levels = category_levels(df, columns, max_levels)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    flags = [
        F.coalesce((F.col(f"`{c}`") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in columns
        for v in levels[c]
    ]
    return df.select(*kept, *flags)


def index_categories(
    columns: Sequence[str], order: str = "frequencyDesc", handle_invalid: str = "error", suffix: str = "Index"
) -> StringIndexer:
    """Category to index, by default the most frequent first and ties by name. All columns are
    counted in one job."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        stringOrderType=order,
        handleInvalid=handle_invalid,
    )


def index_table(df: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``value, n, index``: the categories of a column as a table, most frequent first and ties by name.

    For columns of any number of levels: levels are counted, dealt out in ranges of their order and numbered range by
    range, so no list of them comes to the driver. NULL is no level.
    """
    value = quoted(column).cast("string")
    counts = df.filter(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "levels")
    parts = max(1, -(-counts.count() // rows_per_task))
    order = [F.desc("n"), F.asc("value")]
    dealt = counts.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "dealt_levels")  # written, as another run of the range shuffle might deal otherwise
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select("part", F.coalesce(F.sum("size").over(along), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    return dealt.join(before, "part").select("value", "n", number.cast("double").alias("index"))


def with_index(df: DataFrame, column: str, levels: DataFrame, output: str | None = None, handle_invalid: str = "error") -> DataFrame:
    """The table with the index of each row's category from an ``index_table``, as the fitted indexer would give it.

    Categories that the table doesn't have, and NULL, fail the query (``error``), go (``skip``), or get the number of
    levels (``keep``). Up to ``rank.BROADCAST_ROWS`` levels are sent to the rows, more are joined by a shuffle.
    """
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError("handle_invalid must be error, skip or keep")
    output = f"{column}Index" if output is None else output
    n = levels.count()
    value, index = (fresh_name([*df.columns, output], c) for c in ("value", "index"))
    small = levels.select(F.col("value").alias(value), F.col("index").alias(index))
    keyed = df.withColumn(output, quoted(column).cast("string"))
    on = keyed[f"`{output}`"] == small[value]
    found = keyed.join(F.broadcast(small) if n <= BROADCAST_ROWS else small.hint("merge"), on, "left")
    known = F.col(index)
    if handle_invalid == "skip":
        found = found.filter(known.isNotNull())
    elif handle_invalid == "keep":
        known = F.coalesce(known, F.lit(float(n)))
    else:
        known = F.when(known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(quoted(output), F.lit("NULL")))))
    return found.select(*[quoted(c) for c in df.columns if c != output], known.alias(output))


def index_label(column: str, output: str = "label", order: str = "frequencyDesc") -> StringIndexer:
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType=order)


def one_hot(columns: Sequence[str], drop_last: bool = True, handle_invalid: str = "error") -> OneHotEncoder:
    """Index columns ``<c>Index`` to 0/1 vectors ``<c>classVec``."""
    return OneHotEncoder(
        inputCols=[c + "Index" for c in columns],
        outputCols=[c + "classVec" for c in columns],
        dropLast=drop_last,
        handleInvalid=handle_invalid,
    )


def assemble(columns: Sequence[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def feature_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str | None = None,
    handle_invalid: str = "error",
    drop_last: bool = True,
) -> Pipeline:
    """Index, one-hot, label index and assembly as one pipeline.

    ``features`` holds the one-hot vectors in the given order, then the numbers. ``label`` is the
    text column to index into ``label``; leave it out when the table already has one.
    """
    stages = []
    if categorical:
        stages += [
            index_categories(categorical, handle_invalid=handle_invalid),
            one_hot(categorical, drop_last, "keep" if handle_invalid == "keep" else "error"),
        ]
    if label is not None:
        stages.append(index_label(label))
    stages.append(assemble([c + "classVec" for c in categorical] + list(numeric)))
    return Pipeline(stages=stages)


def prepare(df: DataFrame, pipeline: Pipeline, keep: Sequence[str] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on the whole table, transform it, and keep ``label, features`` and the source columns.

    ``fit_on`` holds the same rows in a plan that is cheaper to read, where ``df`` shuffles them into an order: categories
    are counted, in any order.
    """
    keep = df.columns if keep is None else list(keep)
    out = pipeline.fit(df if fit_on is None else fit_on).transform(df)
    return out.select("label", "features", *[F.col(f"`{c}`") for c in keep if c != "label"])


def signature(inputs: DataFrame, outputs: DataFrame) -> str:
    """Input and output columns of a model as JSON, for a run record."""
    return json.dumps({"inputs": json.loads(inputs.schema.json()), "outputs": json.loads(outputs.schema.json())})


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the vector slots, from the column's metadata."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [a for group in attrs.values() for a in group]
    return [a.get("name", str(a["idx"])) for a in sorted(slots, key=lambda a: a["idx"])]
