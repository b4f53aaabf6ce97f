"""Work of one task: partitions follow the row count, and input rows stay as they were on small tables."""

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.plans import data, files, modeling
from millrace.session import dealt, partitions_for


@pytest.fixture(scope="module")
def grown(spark, sf, tmp_path_factory):
    """2,000 copies of the orders with shifted keys."""
    folder = str(tmp_path_factory.mktemp("grown"))
    orders = spark.read.parquet(f"{sf}/orders.parquet").limit(1500)
    many = spark.range(2000).select(F.col("id").alias("copy"))
    orders.crossJoin(many).withColumn("o_orderkey", F.col("copy") * 10_000_000 + F.col("o_orderkey")).drop("copy").write.parquet(f"{folder}/orders.parquet")
    spark.read.parquet(f"{sf}/customer.parquet").write.parquet(f"{folder}/customer.parquet")
    return folder


def sizes(df):
    return [n for (n,) in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_partitions_follow_rows(spark):
    assert partitions_for(spark.range(0)) == partitions_for(spark.range(1000)) == session.FEWEST_PARTITIONS
    assert partitions_for(spark.range(1000), rows=30) == 34
    assert partitions_for(spark.range(1000), fewest=1) == 1
    rows = spark.range(20 * session.ROWS_PER_PARTITION)
    assert dealt(rows, ["id"]).rdd.getNumPartitions() == 20
    assert dealt(rows.limit(5), ["id"]).rdd.getNumPartitions() == session.FEWEST_PARTITIONS


def test_training_rows_of_a_task(spark, grown):
    """No task's share of the rows that a fit reads grows with the table."""
    n = spark.read.parquet(f"{grown}/orders.parquet").count()
    assert n > session.FEWEST_PARTITIONS * session.ROWS_PER_PARTITION
    for rows in (data.order_rows(spark, grown), data.grouped_orders(spark, grown)):
        held = sizes(rows)
        assert sum(held) == n and max(held) < 1.1 * session.ROWS_PER_PARTITION
        one = rows.filter(F.spark_partition_id() == 3).select("o_orderkey").limit(1000).collect()
        assert one == sorted(one)


def test_small_tables_are_dealt_as_before(spark, sf):
    for rows in (data.order_rows(spark, sf), data.grouped_orders(spark, sf), modeling.prepared_orders(spark, sf)):
        assert rows.rdd.getNumPartitions() == session.FEWEST_PARTITIONS


def test_class_files_of_a_task(spark, tmp_path):
    """Small files are spread over tasks; one of each vector."""
    spark.range(6000).select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("label")).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = files._dealt_vectors(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 12 and max(sizes(rows)) < 2 * files.FILES_PER_TASK
    found = {r["folder"]: (r["n_files"], r["bytes"]) for r in files.list_files_query(spark, str(tmp_path)).collect()}
    assert found == {f"class={k}": (2000, sum(len(str(i)) + 1 for i in range(k, 6000, 3))) for k in range(3)}


def test_staged_trees_use_more_tasks(spark, grown, monkeypatch):
    """The longest ensemble is fitted on a table of many partitions where there are many rows."""
    seen = {}

    def fit(rows, **_):
        seen["partitions"] = rows.rdd.getNumPartitions()
        raise InterruptedError

    monkeypatch.setattr(modeling.models, "fit_gbt", fit)
    with pytest.raises(InterruptedError):
        modeling.gbt_staged(spark, grown)
    assert seen["partitions"] == 15
