"""Batch inference with a caller-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_infer(
    df: DataFrame,
    inputs: Sequence[str],
    make_predict_fn: Callable[[], Callable],
    return_type: T.DataType | None = None,
    batch_size: int = 64,
    input_shapes: Sequence[Sequence[int] | None] | None = None,
    output: str = "prediction",
) -> DataFrame:
    """Add the model's answer for each row, computed in batches inside the tasks.

    ``make_predict_fn`` loads the model once per Python worker and returns a function from NumPy
    batches to a NumPy array with one answer per row. ``input_shapes`` gives the tensor shape of array columns.
    """
    predict = predict_batch_udf(
        make_predict_fn,
        return_type=return_type or T.IntegerType(),
        batch_size=batch_size,
        input_tensor_shapes=[list(s) if s is not None else None for s in input_shapes] if input_shapes else None,
    )
    return df.withColumn(output, predict(*[F.col(c) for c in inputs]))
