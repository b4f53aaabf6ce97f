"""Session defaults for local work, the shared folder for written tables, and kept tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Rows of a partition of a table that is dealt out, about; smaller tables have FEWEST_PARTITIONS.
ROWS_PER_PARTITION = 200_000
FEWEST_PARTITIONS = 8


def local_session(cores: int | str = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Where ``spark.checkpoint.dir`` is unset it is a folder in the warehouse, which all executors share too.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/millrace-scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/millrace-{uuid.uuid4().hex[:12]}/{name}"


def partitions_for(df: DataFrame, rows: int = ROWS_PER_PARTITION, fewest: int = FEWEST_PARTITIONS) -> int:
    """How many partitions of about ``rows`` rows a table fills, from its row count."""
    return max(fewest, -(-df.count() // rows))


def dealt(df: DataFrame, key: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Deal rows out by a hash of their key, in the order of the key inside a partition.

    Fits read rows in this order, so that their results don't follow the number of cores. Partitions grow with the row
    count, which is taken here unless ``partitions`` is given.
    """
    partitions = partitions_for(df) if partitions is None else partitions
    return df.repartition(partitions, *key).sortWithinPartitions(*key)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table for the steps inside the block, on disk where memory is short."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
