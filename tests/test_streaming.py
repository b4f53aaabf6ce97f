"""Row-wise operators work on a stream as they are."""

from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.operators import chat, clean, features, models
from millrace.plans.data import SENTINEL
from millrace.session import scratch_path
from millrace.sources import table


def test_row_wise_operators_on_a_stream(spark, sf):
    rows = table(spark, sf, "orders").drop("o_orderdate").withColumn("label", (F.col("o_totalprice") > 250000).cast("double"))
    path = scratch_path(spark, "stream")
    rows.repartition(3).write.parquet(path)
    pipeline = features.feature_pipeline(["o_orderstatus"], ["o_totalprice"]).fit(rows)
    model = models.fit_logistic(pipeline.transform(rows), maxIter=5)

    def work(df):
        scored = models.predict(model, pipeline.transform(clean.null_sentinels(df, SENTINEL, ["o_orderpriority"])))
        named = scored.withColumn("klass", fn.id_to_name(F.col("label").cast("int"), ["low", "high"]))
        asked = chat.chat_messages(named, "Q?", ["low", "high"], label="label")
        text = chat.render_chat("messages").alias("text")
        return asked.select("o_orderkey", "o_orderpriority", "prediction", "klass", text)

    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = work(stream).writeStream.format("memory").queryName("streamed").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    found, wanted = spark.table("streamed"), work(rows)
    assert found.count() == wanted.count() == 1500
    assert found.exceptAll(wanted).count() == 0
