"""Benchmark decontamination: test suffixes searched in suffix arrays of the training shards.

A shard is the group of documents that a task has in hand. Its suffix array holds the places where a test
suffix can start at all (their first words occur together in the test set), sorted by their next words.
Every test suffix is binary-searched in every shard; the range found gives all verbatim occurrences with
their places, and runs of occurrences on one diagonal give the longest matches.

No shuffle: documents stay where they are, and the test set is sent out in blocks of a bounded size.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as W
from millrace.llm.arrow import lists, named

#: Consecutive words that count as a verbatim match; shorter test items match as a whole.
WINDOW = 13
#: Most bytes of test texts that are sent to the executors at a time.
BLOCK_BYTES = 16 << 20
#: Words that a suffix must share with some test suffix to enter a suffix array.
SEED_WORDS = 4

MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
        T.StructField("doc_start", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
)


class TestSet(NamedTuple):
    """Suffixes of a block of test items that start a window: their next words, item and place."""

    items: np.ndarray
    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    keys: np.ndarray
    seed: int
    seeds: np.ndarray


def test_set(ids: list, texts: pa.Array, window: int) -> TestSet:
    data, offsets = W.text_buffers(texts)
    parts = W.split_words(data, offsets, W.ALNUM, lower=True)
    sizes = np.diff(parts.first)
    n_windows = np.where(sizes > 0, np.maximum(sizes - window, 0) + 1, 0)
    at = W.ranges(parts.first[:-1], n_windows)
    item = np.repeat(np.arange(len(sizes)), n_windows)
    length = np.minimum(sizes, window)[item]
    seed = int(min(SEED_WORDS, length.min())) if len(length) else SEED_WORDS
    keys = _next_words(parts.hashes, at, at + length, window)
    items = np.array(["" if i is None else str(i) for i in ids], dtype=object)
    return TestSet(items, item, at - parts.first[item], length, keys, seed, np.unique(W.gram_hashes(parts.hashes, seed)))


def _next_words(hashes: np.ndarray, at: np.ndarray, end: np.ndarray, window: int) -> np.ndarray:
    """The next ``window`` words from each place on, 0 from ``end`` on."""
    out = np.zeros((window, len(at)), dtype=W.U64)
    for j in range(window):
        there = at + j < end
        out[j, there] = hashes[at[there] + j]
    return out


def _bound(keys: np.ndarray, wanted: np.ndarray, length: np.ndarray, after: bool) -> np.ndarray:
    """For each wanted suffix (a column), the first sorted suffix that isn't below it (``after``: that is
    above it), by its first ``length`` words."""
    low, high = np.zeros(wanted.shape[1], np.int64), np.full(wanted.shape[1], keys.shape[1], np.int64)
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high) // 2, 0)
        below, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for j in range(len(keys)):
            counted = same & (j < length)
            here = keys[j, mid]
            below |= counted & (here < wanted[j])
            same &= ~(counted & (here != wanted[j]))
        up = open_ & (below | (same if after else False))
        low, high = np.where(up, mid + 1, low), np.where(open_ & ~up, mid, high)
    return low


def occurrences(test: TestSet, parts: W.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in the shard, window of the test set) that agree word by word."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(test.seeds) or len(parts.hashes) < test.seed:
        return none
    grams = W.gram_hashes(parts.hashes, test.seed)
    near = np.minimum(np.searchsorted(test.seeds, grams), len(test.seeds) - 1)
    suffixes = np.flatnonzero(test.seeds[near] == grams)
    if not len(suffixes):
        return none
    ends = parts.first[np.searchsorted(parts.first, suffixes, side="right")]
    keys = _next_words(parts.hashes, suffixes, ends, window)
    order = np.lexsort(keys[::-1])
    suffixes, keys = suffixes[order], keys[:, order]
    low = _bound(keys, test.keys, test.length, after=False)
    counts = _bound(keys, test.keys, test.length, after=True) - low
    return suffixes[W.ranges(low, counts)], np.repeat(np.arange(len(low)), counts)


def _longest(test: TestSet, places: np.ndarray, found: np.ndarray, first: np.ndarray):
    """Runs of neighbouring occurrences of one item: (document, item, item place, document place, words)."""
    doc = np.searchsorted(first, places, side="right") - 1
    item, shift = test.item[found], places - test.place[found]
    order = np.lexsort((places, shift, item, doc))
    doc, item, shift, places, found = (x[order] for x in (doc, item, shift, places, found))
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(shift) != 0) | (np.diff(places) != 1)
    begin = np.flatnonzero(new)
    runs = np.diff(np.append(begin, len(places)))
    length = test.length[found[begin]] + runs - 1
    return doc[begin], item[begin], test.place[found[begin]], places[begin] - first[doc[begin]], length


def _covered(first: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Words of each document that lie in any of the spans."""
    steps = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(steps, first[doc] + start, 1)
    np.add.at(steps, first[doc] + start + length, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(steps[:-1]) > 0)))
    return inside[first[1:]] - inside[first[:-1]]


def find_matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep=None) -> DataFrame:
    """Verbatim matches of test items in every whole document.

    Returns ``row`` (a struct of the kept columns of docs, default all) and ``found``: ``n_words``,
    ``n_hit`` (words inside any match) and ``matches`` (item_id as text, word places in item and document,
    number of words; the longest ones, each at least ``window`` words or a whole shorter item).

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower case. Null and
    empty texts have no words; items without words match nothing; items of one id are one item in the
    digest, and a null id reads as empty text. Repeated rows are each judged; extra columns pass through.
    An empty test set leaves every document unhit.

    Test sets above ``block_bytes`` are searched block by block, each block a pass over the documents in
    the same job; each block is sent to the executors, the whole set never is.
    """
    if window < 1:
        raise ValueError("window must be positive")
    items = benchmark.select(named(item_id).cast("string").alias("id"), named(item_text).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    out = None
    for b in range(n_blocks):
        rows = items.filter(block == b).toArrow().combine_chunks()
        test = docs.sparkSession.sparkContext.broadcast(
            tuple(test_set(rows["id"].to_pylist(), pa.array(rows["text"].to_pylist(), pa.string()), window))
        )
        if out is None:
            frame = docs.select(F.struct(*[named(c) for c in (docs.columns if keep is None else keep)]).alias("row"),
                                named(text).cast("string").alias("text"),
                                F.array().cast(T.ArrayType(MATCH)).alias("before"))
        else:
            frame = out.select("row", "text", F.col("found.matches").alias("before"))
        out = _search(frame, test, window, last=b == n_blocks - 1)
    return out


def _search(frame: DataFrame, test, window: int, last: bool) -> DataFrame:
    """One pass over the documents with one block of the test set; earlier matches are kept."""
    kept = ["row"] if last else ["row", "text"]
    schema = T.StructType([frame.schema[c] for c in kept] + [T.StructField("found", FIELDS)])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = search_batch(TestSet(*test.value), batch.column("text"), batch.column("before"), window)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], names=[*kept, "found"])

    return frame.mapInArrow(run, schema)


def search_batch(test: TestSet, texts: pa.Array, before: pa.Array, window: int) -> pa.StructArray:
    """``found`` for an Arrow batch of documents."""
    data, offsets = W.text_buffers(texts)
    old_rows = np.repeat(np.arange(len(texts)), before.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    old = before.flatten()
    n_words, n_hit, cols = [], [], [(old_rows, *(old.field(i).to_numpy(zero_copy_only=False) for i in range(4)))]
    for low, high in W.groups(offsets):
        parts = W.split_words(data, offsets[low : high + 1], W.ALNUM, lower=True)
        doc, item, item_start, doc_start, length = _longest(test, *occurrences(test, parts, window), parts.first)
        mine = (old_rows >= low) & (old_rows < high)
        n_words.append(np.diff(parts.first))
        n_hit.append(_covered(parts.first, np.concatenate((cols[0][0][mine] - low, doc)),
                              np.concatenate((cols[0][3][mine], doc_start)).astype(np.int64),
                              np.concatenate((cols[0][4][mine], length)).astype(np.int64)))
        cols.append((doc + low, test.items[item] if len(item) else np.empty(0, object), item_start, doc_start, length))
    rows, ids, item_start, doc_start, length = (np.concatenate(x) for x in zip(*cols))
    order = np.argsort(rows, kind="stable")
    values = pa.StructArray.from_arrays(
        [pa.array(ids[order], pa.string()), *(pa.array(x[order].astype(np.int64)) for x in (item_start, doc_start, length))],
        names=MATCH.names,
    )
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_hit)),
         lists(values, np.bincount(rows, minlength=len(texts)))],
        names=FIELDS.names,
    )


def is_contaminated(found: str = "found", share: int = 20) -> Column:
    """True where at least one word in ``share`` lies inside a match (and any word does)."""
    hit, n = F.col(f"{found}.n_hit"), F.col(f"{found}.n_words")
    return (hit > 0) & (hit * share >= n)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that are not contaminated, with their columns as they were."""
    kept = find_matches(docs, benchmark, **options).filter(~is_contaminated())
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
