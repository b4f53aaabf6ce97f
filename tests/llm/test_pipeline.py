"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline

from millrace.llm import mixing
from millrace.llm.tables import written


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, sf), name)
        assert after.columns == columns
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == sizes[-1]
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]


def test_drawn_shares_meet_targets(spark):
    rows = [(i, " ".join(["word"] * 50), "en", "rare" if i % 50 == 0 else "usual") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    drawn = [r.source for r in corpus_pipeline.mixing_stage(spark, docs, "").collect()]
    raised = {"rare": 0.02 ** mixing.TEMPERATURE, "usual": 0.98 ** mixing.TEMPERATURE}
    for source, r in raised.items():  # all texts have one length, and the other dimensions one value
        share = r / sum(raised.values())
        assert abs(drawn.count(source) / len(drawn) - share) < 0.05 * share
    assert abs(len(drawn) / 4000 - mixing.BUDGET) < 0.02


def test_stages_use_small_batches(spark, sf):
    """Arrow batches of a stage's tasks, which executors hold in several copies, have 1000 rows at most."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "'some words of text' AS text", "'en' AS lang", "'a' AS source")
    names, seen = list(corpus_pipeline.BATCHES), {}
    for name, stage in corpus_pipeline.STAGES:
        if name == "near_dedup":  # dozens of jobs, which test_stages runs
            continue
        for key in names:
            spark.conf.unset(key)
        stage(spark, docs, sf)
        rows = spark.range(0, 5000, 1, 1).mapInArrow(lambda batches: (b.slice(0, 0).from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
        seen[name] = max(r.n for r in rows.collect())
    assert set(seen.values()) == {1000}
