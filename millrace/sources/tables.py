"""Parquet tables, SQL views and model files."""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader, MLReadable
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the table visible to SQL under a name."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL; keyword tables are bound to ``{name}`` in the text without registering views."""
    return spark.sql(text, **tables)


def save_model(model, path: str, overwrite: bool = False) -> str:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(path: str, model_class: type[MLReadable] | None = None):
    """Load a fitted model. The class is read from the files when it is not given."""
    if model_class is not None:
        return model_class.load(path)
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())
