"""MinHash near-duplicates by tensored banding.

Two small collections of ``m`` half keys (each ``rows`` minhashes) are computed for each document. The keys of the
``m * m`` tables are all pairs of a half key of the first and one of the second collection, so ``2 * m * rows``
minhashes serve ``m * m`` tables of ``2 * rows`` minhashes. Half keys that no other document has are dropped before
pairs are formed (their tables can't hold two documents), so most documents enter no table.

Candidates are verified on the full shingle sets. In each table documents are first compared with the one that shares
most tables with others, as an original does with its copies; then only documents that still lie in different components
are compared with each other. So a table of copies yields as many pairs as documents, and no link between different
groups is passed over. Pairs that can't reach the similarity are left out inside the join, by their set sizes and by bitmaps of the sets: each shingle flips one bit,
so the bits in which two bitmaps differ are a lower bound of the shingles that only one of the sets has.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as W
from millrace.llm.arrow import lists, map_text, named, whole_row
from millrace.llm.tables import connected_components, written

#: Consecutive words in a shingle, and least Jaccard similarity of linked documents.
SHINGLE, THRESHOLD = 5, 0.8
#: Minhashes in a half key, and the greatest chance to miss a pair at the threshold.
ROWS, MISS = 3, 1e-4
#: 64-bit words in the bitmap of a set.
BITMAP = 8
#: Two hashes of a whole set: equal sets are one class.
CONTENT = ["content", "content2"]

SEEDS = (W.U64(0), W.U64(0x94D049BB133111EB))

SIGNATURE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("content", T.LongType()),
        T.StructField("content2", T.LongType()),
        T.StructField("left", T.ArrayType(T.LongType())),
        T.StructField("right", T.ArrayType(T.LongType())),
        T.StructField("bits", T.ArrayType(T.LongType())),
    ]
)


def half_keys(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Half keys in a collection, so that a pair at the threshold shares one in both but for ``miss``."""
    if threshold >= 1:
        return 1
    return max(1, math.ceil(math.log(1 - math.sqrt(1 - miss)) / math.log(1 - threshold**rows)))


def shingles(texts: pa.Array, k: int):
    """For each group of documents: first row, last row, hashes of its shingles, shingles of each document.

    Shingles are k consecutive words; fewer words are one shingle; no words give none. Repeats are kept.
    """
    data, offsets = W.text_buffers(texts)
    for low, high in W.groups(offsets):
        parts = W.split_words(data, offsets[low : high + 1], W.NOT_SPACE, lower=True)
        places, counts = W.gram_places(parts.first, k)
        values, sizes = W.gram_hashes(parts.hashes, k)[places], np.diff(parts.first)
        short = np.flatnonzero((sizes > 0) & (sizes < k))
        if len(short):
            whole = [W.gram_hashes(parts.hashes[parts.first[d] : parts.first[d + 1]], int(sizes[d])) for d in short]
            values = np.insert(values, (np.cumsum(counts) - counts)[short], np.concatenate(whole))
            counts[short] = 1
        yield low, high, values, counts


def distinct_shingles(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document, and how many there are."""
    end = np.cumsum(counts)
    sets = [np.unique(values[e - c : e]) for c, e in zip(counts, end)]
    return (np.concatenate(sets) if sets else values), np.array([len(s) for s in sets], np.int64)


def _signatures(k: int, m: int, rows: int, seed: int):
    rng = np.random.default_rng(seed)
    multiply = rng.integers(0, 1 << 63, 2 * m * rows, dtype=np.uint64) * W.U64(2) + W.U64(1)
    shift = rng.integers(0, 1 << 63, 2 * m * rows, dtype=np.uint64)

    def run(texts: pa.Array) -> list[pa.Array]:
        n, content, keys = [np.empty(0, np.int64)], [np.empty((0, 2), W.U64)], [np.empty((0, 2 * m), W.U64)]
        bits = [np.empty((0, BITMAP), W.U64)]
        for _, _, values, counts in shingles(texts, k):
            values, counts = distinct_shingles(values, counts)
            full = np.flatnonzero(counts)
            begin = (np.cumsum(counts) - counts)[full]
            own, mixed = np.zeros((len(counts), 2), W.U64), np.zeros((len(counts), 2 * m), W.U64)
            flips = np.zeros((len(counts), BITMAP), W.U64)
            if len(full):
                for i, seed in enumerate(SEEDS):
                    own[full, i] = W.mix(np.add.reduceat(W.mix(values ^ seed), begin) + counts[full].astype(W.U64))
                for h in range(2 * m * rows):
                    least = np.minimum.reduceat((values ^ shift[h]) * multiply[h], begin)
                    mixed[full, h // rows] = W.mix(mixed[full, h // rows] + least)
                bit, word = W.U64(1) << (values & W.U64(63)), (values >> W.U64(6)) % W.U64(BITMAP)
                for i in range(BITMAP):
                    flips[full, i] = np.bitwise_xor.reduceat(np.where(word == W.U64(i), bit, W.U64(0)), begin)
            n.append(counts)
            content.append(own)
            keys.append(mixed)
            bits.append(flips)
        counts, both = np.concatenate(n), np.concatenate(keys).view(np.int64)
        each = np.where(counts > 0, m, 0)
        left, right = both[counts > 0, :m].ravel(), both[counts > 0, m:].ravel()
        bitmaps = lists(pa.array(np.concatenate(bits).view(np.int64).ravel()), np.full(len(counts), BITMAP))
        own = np.concatenate(content).view(np.int64)
        return [pa.array(counts), pa.array(own[:, 0]), pa.array(own[:, 1]),
                lists(pa.array(left), each), lists(pa.array(right), each), bitmaps]

    return run


def _sets(k: int):
    def run(texts: pa.Array) -> list[pa.Array]:
        found, sizes = [np.empty(0, W.U64)], [np.empty(0, np.int64)]
        for _, _, values, counts in shingles(texts, k):
            values, counts = distinct_shingles(values, counts)
            found.append(values)
            sizes.append(counts)
        return [lists(pa.array(np.concatenate(found).view(np.int64)), np.concatenate(sizes))]

    return run


def _tables(classes: DataFrame) -> DataFrame:
    """(key, node, n, keys): the tables that a node shares with others by both of its half keys, and how many."""
    halves = classes.select(
        "node", "n",
        F.posexplode(F.concat("left", "right")).alias("i", "value"), F.size("left").alias("m"),
    ).select("node", "n", F.xxhash64("i", "value").alias("half"), (F.col("i") < F.col("m")).alias("is_left"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    pick = lambda side: F.collect_list(F.when(F.col("is_left") == side, F.col("half")))
    both = halves.join(shared, "half", "left_semi").groupBy("node", "n").agg(pick(True).alias("l"), pick(False).alias("r"))
    keys = (F.size("l") * F.size("r")).alias("keys")
    return both.select("node", "n", "r", keys, F.explode("l").alias("one")).select(
        "node", "n", "keys", F.explode(F.transform("r", lambda x: F.xxhash64(F.col("one"), x))).alias("key")
    )


def _could_link(n1: str, n2: str, percent: int) -> Column:
    """Set sizes that allow the similarity."""
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def _near_enough(n1: str, bits1: str, n2: str, bits2: str, percent: int) -> Column:
    """Set sizes and bitmaps that allow the similarity: true for every pair that reaches it."""
    differ = sum((F.bit_count(F.get(bits1, F.lit(i)).bitwiseXOR(F.get(bits2, F.lit(i)))) for i in range(BITMAP)), F.lit(0))
    return _could_link(n1, n2, percent) & (differ * (100 + percent) <= (F.col(n1) + F.col(n2)) * (100 - percent))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    one, two = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - F.col("common")
    return both.withColumn("common", common).filter(F.col("common") * 100 >= either * percent).select("a", "b").distinct()


def _node_sets(docs, nodes, node, text, shingle) -> DataFrame:
    """Shingle sets of the nodes' documents. The join is a merge join at every size: node ids grow with the corpus."""
    mine = docs.select(named(node).alias("node"), named(text).alias("text")).join(nodes.hint("merge"), "node", "left_semi")
    return map_text(mine, F.col("text"), T.StructType([T.StructField("set", T.ArrayType(T.LongType()))]), _sets(shingle), ["node"]).select(
        "row.node", "found.set"
    )


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, rows: int = ROWS, miss: float = MISS, seed: int = 1) -> DataFrame:
    """Near-duplicate components: (doc_id, n_shingles, component_id, n_links).

    Words are runs of characters that are not ASCII white space, A-Z in lower case. A document's set holds its
    distinct shingles of ``shingle`` words, or all its words as one shingle if there are fewer. Documents are
    linked where the Jaccard similarity of their sets is at least ``threshold`` (in whole hundredths), judged on
    the full sets. ``component_id`` is the smallest doc_id that a document can reach; ``n_links`` counts the
    verified links of its set with different sets.

    Null and empty texts and texts without words have no shingles and are linked with nothing. Repeated rows
    share a component. Rows of one doc_id count as one document as soon as any of them is linked. A null doc_id
    is never linked by similarity; its component is the smallest doc_id with an equal set, or null. Other
    columns are not read. A pair at the threshold is missed with a chance of at most ``miss``, a more similar
    one with less.
    """
    percent = round(threshold * 100)
    m = half_keys(threshold, rows, miss)
    made = map_text(docs.select(named(doc_id).alias("node"), named(text).alias("text")), F.col("text"), SIGNATURE,
                    _signatures(shingle, m, rows, seed), ["node"])
    signed = written(made.select(F.col("row.node").alias("id"), "found.*"), "signatures")
    # Equal sets are one class, known by its smallest id.
    classes = signed.filter("n > 0").groupBy(*CONTENT).agg(
        F.min("id").alias("node"), *(F.first(c).alias(c) for c in ("n", "left", "right", "bits"))
    ).filter("node IS NOT NULL")
    tables = written(_tables(classes), "tables")
    bitmaps = classes.join(tables.select("node").distinct(), "node", "left_semi").select("node", "n", "bits")
    bitmaps = written(bitmaps, "bitmaps")

    # The document that most tables know is the likeliest to be what the others are copies of.
    centre = tables.groupBy("key").agg(F.min(F.struct((-F.col("keys")).alias("known"), "node", "n")).alias("c"), F.count("*").alias("size"))
    stars = (
        tables.join(centre.filter("size > 1"), "key").filter((F.col("node") != F.col("c.node")) & _could_link("n", "c.n", percent))
        .select(F.least("c.node", "node").alias("a"), F.greatest("c.node", "node").alias("b")).distinct()
    )
    one, two = bitmaps.toDF("a", "na", "bits_a"), bitmaps.toDF("b", "nb", "bits_b")
    stars = stars.join(one, "a").join(two, "b").filter(_near_enough("na", "bits_a", "nb", "bits_b", percent))
    stars = written(stars.select("a", "b").distinct(), "stars")
    sets = written(_node_sets(docs, bitmaps.select("node").distinct(), doc_id, text, shingle), "sets")
    links = written(_verified(stars, sets, percent), "star_links")
    component = written(connected_components(links), "components")

    # What is left: pairs of one table that lie in different components and weren't compared yet.
    placed = written(
        tables.select("key", "node").join(component, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")), "placed"
    )
    sized = placed.groupBy("key", "comp").agg(F.count("*").alias("size"))
    mixed = sized.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("hub"), F.count("*").alias("comps")).filter("comps > 1")
    open_ = placed.join(mixed.select("key", F.col("hub.comp").alias("hub")), "key").join(bitmaps, "node")
    outside = open_.filter("comp <> hub").select(
        "key", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("bits").alias("bits_x"), F.col("comp").alias("cx")
    )
    rest = (
        outside.join(open_.select("key", "node", "n", "bits", "comp"), "key")
        .filter((F.col("cx") != F.col("comp")) & _near_enough("nx", "bits_x", "n", "bits", percent))
        .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    more = written(_verified(written(rest, "rest"), sets, percent), "rest_links")
    links = links.union(more)
    component = written(connected_components(links), "components")

    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    of_class = (
        classes.select(*CONTENT, "node").join(component, "node", "left").join(ends, "node", "left")
        .select(*CONTENT, F.coalesce("component", "node").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return (
        signed.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), *[F.when(F.col("n") > 0, F.col(c)).alias(c) for c in CONTENT])
        .join(of_class, CONTENT, "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    )


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs with one row of each near-duplicate group: the smallest doc_id, null last.

    Groups are judged by row, so rows that share an id or have none are compared by their texts like any others; of
    several with the smallest id any one stays. Rows without words are in no group and stay. Columns are those of docs.
    """
    rows = written(docs.select(whole_row(docs).alias("row"), F.monotonically_increasing_id().alias("key")), "rows")
    id_ = F.col("row").getField(doc_id)
    texts = rows.select("key", F.col("row").getField(text).alias("text"))
    grouped = near_duplicates(texts, doc_id="key", text="text", **options).select(F.col("doc_id").alias("key"), "component_id")
    # Groups meet only in a minimum that is combined before the shuffle; rows are told by their own keys.
    grouped = grouped.join(rows.select("key", id_.alias("id")), "key")
    first = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first"))
    stay = rows.join(first.select("first.key"), "key", "left_semi")
    return stay.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
