"""Substring dedup on difference-cover anchors.

A difference cover of period v is a set of places modulo v such that, for any two places p and q, some shift below v
takes both into the set. So two equal runs of ``window`` words share an aligned anchor: a run of ``window - v + 1``
words at a cover place of either document. Only anchors are hashed and grouped; where an anchor comes up twice, it is
extended to the windows around it, and those are grouped by a 128-bit hash of all their words.

Equal texts are one text in both steps, known by a 128-bit hash (``c``, ``d``). Anchors and windows that repeat within a task's batch are known there, so
that a batch sends one row for each of them however often it has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as W
from millrace.llm.arrow import lists, named, whole_row

#: Consecutive words that count as a repeated passage.
WINDOW = 35
#: The hashes of a whole text.
KEY = ["c", "d"]

# Perfect difference sets, by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("kept", T.StringType()),
    ]
)


def cover(window: int) -> tuple[int, np.ndarray]:
    """The largest period up to two thirds of the window, and its places."""
    period = max(v for v in COVERS if v == 1 or 3 * v <= 2 * window)
    there = np.zeros(period, bool)
    there[list(COVERS[period])] = True
    return period, there


def _second(hashes: np.ndarray) -> np.ndarray:
    return W.mix(hashes ^ W.U64(0x94D049BB133111EB))


def _known(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose keys occur more than once here, and all of them but one for each key."""
    order = np.lexsort(keys)
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    known, spare = np.zeros(len(order), bool), np.zeros(len(order), bool)
    known[order[1:]] = same
    known[order[:-1]] |= same
    spare[order[1:]] = same
    return known, spare


def _rows(keys: list[np.ndarray], c: np.ndarray, d: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Rows to be grouped by their keys. Spare known rows get a key of their own: they spread over all tasks.

    ``at`` is twice the place in the text, and one more where the key is known to repeat.
    """
    known, spare = _known(*keys)
    own = W.mix(c.view(W.U64) + W.mix(pos.astype(W.U64)))
    keys = [np.where(spare, own ^ W.U64(i), k).view(np.int64) for i, k in enumerate(keys)]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, keys), pa.array(c), pa.array(d), pa.array(2 * pos + known)],
        names=[*(f"h{i}" for i in range(len(keys))), "c", "d", "at"],
    )


def _anchors(window: int):
    period, there = cover(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("text"))
            c, d, got = batch.column("c").to_numpy(), batch.column("d").to_numpy(), []
            for low, high in W.groups(offsets):
                parts = W.split_words(data, offsets[low : high + 1], W.NOT_SPACE, lower=False)
                places, counts = W.gram_places(parts.first, window - period + 1)
                pos = places - np.repeat(parts.first[:-1], counts)
                pick = there[pos % period]
                # A document shorter than the window has no window to share.
                pick &= np.repeat(np.diff(parts.first) >= window, counts)
                hashes = W.gram_hashes(parts.hashes, window - period + 1)[places[pick]]
                text = np.repeat(np.arange(low, high), counts)[pick]
                got.append((hashes, c[text], d[text], pos[pick]))
            if got:
                hashes, *places = (np.concatenate(x) for x in zip(*got))
                yield _rows([hashes], *places)

    return run


def _windows(window: int):
    period, _ = cover(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("text"))
            c, d, got = batch.column("c").to_numpy(), batch.column("d").to_numpy(), []
            hits = batch.column("hits")
            n_hits, hits = hits.value_lengths().to_numpy(), hits.flatten().to_numpy().astype(np.int64)
            begin = np.cumsum(n_hits) - n_hits
            for low, high in W.groups(offsets):
                parts = W.split_words(data, offsets[low : high + 1], W.NOT_SPACE, lower=False)
                mine = hits[begin[low] : begin[high - 1] + n_hits[high - 1]]
                doc = np.repeat(np.arange(high - low), n_hits[low:high])
                # A window that holds an anchor starts up to period - 1 words before it.
                marks = np.zeros(len(parts.hashes) + 1, np.int64)
                np.add.at(marks, parts.first[doc] + np.maximum(mine - period + 1, 0), 1)
                np.add.at(marks, parts.first[doc] + mine + 1, -1)
                places, counts = W.gram_places(parts.first, window)
                pick = np.cumsum(marks)[places] > 0
                at, text = places[pick], np.repeat(np.arange(low, high), counts)[pick]
                got.append((
                    W.gram_hashes(parts.hashes, window)[at], W.gram_hashes(_second(parts.hashes), window)[at],
                    c[text], d[text], at - parts.first[text - low],
                ))
            if got:
                one, two, *places = (np.concatenate(x) for x in zip(*got))
                yield _rows([one, two], *places)

    return run


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Places whose keys come up more than once, as a list for each text."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return rows.withColumn("n", n).filter("at & 1 = 1 OR n > 1").groupBy(*KEY).agg(F.collect_list(F.expr("int(at >> 1)")).alias("hits"))


def _removal(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, n_spans, edges, kept = [], [], [], [np.empty((0, 2), np.int64)], []
            for text, copies, hits in zip(batch.column("text"), batch.column("copies").to_pylist(), batch.column("hits")):
                words = (text.as_py() or "").encode().split()
                steps = np.zeros(len(words) + 1, np.int64)
                if copies > 1 and len(words) >= window:
                    steps[0] = 1
                elif hits.is_valid:
                    starts = hits.values.to_numpy()
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, starts + window, -1)
                gone = np.cumsum(steps)[:-1] > 0
                turns = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                n_spans.append(len(turns))
                edges.append(turns)
                kept.append(b" ".join(compress(words, ~gone) if len(turns) else words).decode())
            start, end = np.concatenate(edges).astype(np.int64).T
            spans = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=SPAN.names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(batch.column(k) for k in KEY), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 lists(spans, n_spans), pa.array(kept, pa.string())],
                names=["row", *KEY, *RESULT.names],
            )

    return run


def content_keys(text: Column) -> list[Column]:
    """Equal texts have equal keys, two hashes of different seeds; null is the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text).alias(KEY[0]), F.xxhash64(F.lit(KEY[1]), text).alias(KEY[1])]


def remove_repeats(docs: DataFrame, *, text: str = "text", window: int = WINDOW, keep=None) -> DataFrame:
    """Words outside of repeated passages, for every whole text.

    Returns ``row`` (a struct of the kept columns of docs, default all) and ``n_words``, ``n_removed``, ``spans``
    (word ranges that go, end exclusive, as large as possible) and ``kept`` (the words that stay, joined by one
    space). A word goes if it lies in a run of ``window`` words that also starts at another place of any document,
    the same one included; all runs are judged on the input.

    Words are runs of characters that are not ASCII white space, unchanged. Null and empty texts have no words;
    texts shorter than the window lose nothing. Repeated rows and equal texts repeat each other. Other columns
    pass through.
    """
    if window < 1:
        raise ValueError("window must be positive")
    # All readers take the same columns, so that one shuffle of the texts serves them.
    rows = docs.select(
        whole_row(docs, keep).alias("row"), *content_keys(named(text)), F.coalesce(named(text).cast("string"), F.lit("")).alias("text")
    )
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"), F.first("row").alias("row"), F.count("*").alias("copies"))
    anchors = texts.mapInArrow(_anchors(window), "h0 long, c long, d long, at long")
    hits = _repeated(anchors, ["h0"])
    windows = texts.join(hits, KEY).mapInArrow(_windows(window), "h0 long, h1 long, c long, d long, at long")
    repeated = _repeated(windows, ["h0", "h1"])
    schema = T.StructType([rows.schema["row"], *[T.StructField(k, T.LongType()) for k in KEY], *RESULT])
    single = texts.filter("copies = 1").join(repeated, KEY, "left").mapInArrow(_removal(window), schema)
    # A text with copies loses all its windows; what is left of it goes to each of its rows.
    several = texts.filter("copies > 1").withColumn("hits", F.lit(None).cast("array<int>")).mapInArrow(_removal(window), schema)
    several = rows.select("row", *KEY).join(several.drop("row"), KEY)
    return single.unionByName(several).drop(*KEY)
