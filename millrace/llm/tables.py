"""Written tables between steps, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written below the shared folder and read again: lineage ends here."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """The smallest node that each node of undirected links (a, b) can reach, as (node, component).

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one,
    then every node links its smaller neighbours and itself to its smallest one. Each step is a grouped
    minimum (combined before the shuffle) and a join. Paths get shorter by a constant factor each round.
    Nodes without links are not returned.
    """
    edges = written(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("a", "b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = written(small.union(low.select("a", F.col("m"))).filter("a <> b").distinct(), "links")
        total = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        if edges.agg(*total).head() == after.agg(*total).head():
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                after.select("b", "b").distinct()
            )
        edges = after
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
