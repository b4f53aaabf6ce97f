"""Registered queries of the training-data operators, with the digests their contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, langid, linerules, lines, minhash, mixing, prefixtrie, quality, secrets, substrings, tokens, whitening, winnow
from millrace.llm.mixing_sql import mixing_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside verbatim passages of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.array_sort(F.array_distinct(F.col("found.matches.item_id")))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        F.col("found.n_hit").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


@query("op7_minhash")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of three-word shingles at a similarity of 0.85."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, shingle=3, threshold=0.85)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores learnt from pairs of labelled documents outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, keep=["doc_id"]).select(
        "row.doc_id",
        quality.held_out(F.col("row.doc_id")).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= quality.CUT).cast("int").alias("predicted"),
    )


@query("op9_substrings")
def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay when passages of 35 words that come up twice are removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, keep=["doc_id"]).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def tokenizer_path() -> str:
    """The public tokenizer that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_tokens")
def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return tokens.token_output(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawing probabilities of all documents, raked to tempered shares of source, language and topic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.document_mix(docs, keep=["doc_id"]).select(
        "row.doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"),
        "sampled", F.round("weight", 6).alias("weight"),
    )


ORACLES["op10_mixing"] = mixing_sql()


@query("op2_winnow")
def op2_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = winnow.ranges_for(docs, "text", 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = lambda df: df.withColumn("choices", winnow.chosen(F.col("text")))
    rows = winnow.with_next(docs, "doc_id", parts, made, ["text", "choices"])
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - floor(length(text) / 4))"), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "choices", "next_choices")
    after = winnow.let(winnow.chosen(F.col("edited")), lambda e: F.struct(
        F.sha2("edited", 256).alias("edited_sha256"),
        winnow.as_text(F.col("choices")).alias("fingerprint"),
        winnow.as_text(e).alias("edited_fingerprint"),
        winnow.let(winnow.hashes_of(F.col("choices")), lambda mine: F.struct(
            winnow.likeness(mine, winnow.hashes_of(e)).alias("near_edited"),
            winnow.likeness(mine, winnow.hashes_of(F.col("next_choices"))).alias("near_next"),
        )).alias("near"),
    ))
    rows = rows.select("doc_id", "n_chars", after.alias("x"))
    return rows.select("doc_id", "n_chars", "x.edited_sha256", "x.fingerprint", "x.edited_fingerprint", "x.near.near_edited", "x.near.near_next")


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, each text scanned once."""
    found, _ = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = [r.kind for r in secrets.BASE]
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of = lambda spans: F.array_join(F.transform(spans, told), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "row.doc_id", *[count(k) for k in base],
        F.sha2(of(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        of(F.col("spans")).alias("spans"),
    )


@query("op5_langid")
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit_languages(docs)
    return langid.predict_languages(docs, model, keep=["doc_id"]).select(
        "row.doc_id", quality.held_out(F.col("row.doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
    )


@query("op1_lines")
def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that an earlier line resembles, and what is left of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, keep=["doc_id"]).select(
        "row.doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op13_rules")
def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of all documents, and which of them stay when failing lines are taken out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed", "lost_chars")
    return linerules.clean_lines(docs, with_text=False, keep=["doc_id"]).select(
        "row.doc_id", *[f"found.{c}" for c in counts], linerules.base_failed().alias("base_failed"), linerules.is_kept().alias("kept")
    )


@query("op12_trie")
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with shared first turns."""
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(table(spark, sf_dir, "conversations")))


@query("op11_whiten")
def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along their principal components, one row for each of up to 16 components."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit_whitening(rows)
    out = whitening.whiten(rows, model, keep=["vec_id"])
    n, total, error = (model.n, model.total, model.identity_error) if model else (0, 0.0, 0.0)
    shares = [float(e / total) for e in model.variances] if model else []
    out = out.select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.get(F.array(*[F.lit(x) for x in shares]).cast("array<double>"), F.col("at"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )
