"""Conversation prefix trie: every distinct sequence of first turns, with what its subtree holds.

A conversation is a row of turn ids (128-bit hashes of role and text, as two integers). The rows are dealt out in ranges of
their order, so a shard holds whole stretches of the trie. In a shard, rows are sorted by ``numpy.lexsort`` over padded
matrices of turn ids, BLOCK turns at a time; the change masks of the columns, OR-accumulated from the first turn on, mark
where nodes start, and ``reduceat`` over these marks sums up every depth.

Only nodes on the path of a shard's first or last row can go on in another shard. Such edge nodes are named by a hash of
their turns and added up over shards. What this counts twice follows from the turns that the last row of a shard has in
common with the first row of the next one, and is taken off (or added) along that path. All other nodes are whole.

Texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm import words as W
from millrace.llm.arrow import named
from millrace.llm.tables import written

#: Conversations and turns in a shard, together, about.
SHARD_ROWS = 1 << 16
#: Turns in a padded matrix.
BLOCK = 16
#: Conversations in a group that shares the head of its first one, and turns that may be shared, plus one.
GROUP, HEADS = 100, 6

PAD = np.iinfo(np.int64).min

PARTS = T.StructType([
    T.StructField("shard", T.LongType()),
    T.StructField("edge", T.IntegerType()),  # INNER node; FIRST, LAST: on the path of the first, last row; PATH_*: that row's turns
    T.StructField("depth", T.LongType()),
    T.StructField("k1", T.LongType()),
    T.StructField("k2", T.LongType()),
    T.StructField("conv_id", T.LongType()),
    T.StructField("parent_conv_id", T.LongType()),
    T.StructField("parent_edge", T.IntegerType()),
    T.StructField("n_convs", T.LongType()),
    T.StructField("n_children", T.LongType()),
    T.StructField("n_leaves", T.LongType()),
    T.StructField("saved_tokens", T.LongType()),
    T.StructField("ends", T.StringType()),  # SHA-256 for inner nodes, the ids themselves for edge nodes
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("sizes", T.ArrayType(T.LongType())),
])
INNER, FIRST, LAST, PATH_FIRST, PATH_LAST = range(5)
NO_ENDS = hashlib.sha256(b"").hexdigest()

MERGED = T.StructType([T.StructField("depth", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())] + [
    PARTS[n] for n in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
])
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
RESULT = T.StructType([PARTS[n] for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [
    T.StructField("ends_sha256", T.StringType())
])


# ---- conversations as rows of turn ids -------------------------------------------------------------


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order (null turns first, like turns by their hashes), as
    (turn, id1, id2, size). Null roles and texts are empty; rows without a conv_id are of no conversation and left out;
    repeated rows are turns of their own; other columns are not read."""
    said = [F.coalesce(named(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.select(
        named(conv_id).cast("long").alias("conv_id"),
        F.struct(
            named(turn).alias("turn"), F.xxhash64(*said).alias("id1"), F.xxhash64(F.lit("turn"), *said).alias("id2"),
            F.length(said[1]).cast("long").alias("size"),
        ).alias("t"),
    )
    return rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def heads(conv_id: Column) -> Column:
    """How many first turns a conversation takes over from the first one of its group: a hash of its id."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation with its first turns taken from the first one of its group of GROUP ids."""
    own = written(_turns(conversations, conv_id, turn, role, text), "conversations")
    first = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    mine = own.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), heads(F.col("conv_id")).alias("h"))
    both = mine.join(first, "base", "left")
    none = F.array().cast(own.schema["turns"].dataType)
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


def as_rows(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation as it is."""
    return _turns(conversations, conv_id, turn, role, text)


# ---- one shard ---------------------------------------------------------------------------------------


class Shard(NamedTuple):
    """Conversations in order. Row i has the turns ``first[i]`` to ``first[i + 1]`` of ``ids`` (two numbers a turn) and ``sizes``."""

    conv: np.ndarray
    first: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray


def _block(shard: Shard, rows: np.ndarray, start: int, width: int) -> np.ndarray:
    """Turn ids ``start`` to ``start + width`` of some rows, padded: a row of ``2 * width`` numbers for each."""
    out = np.full((len(rows), width, 2), PAD)
    left = np.minimum(np.diff(shard.first)[rows] - start, width)
    row = np.repeat(np.arange(len(rows)), left)
    column = W.ranges(np.zeros(len(rows), np.int64), left)
    out[row, column] = shard.ids[W.ranges(shard.first[rows] + start, left)]
    return out.reshape(len(rows), 2 * width)


def in_order(shard: Shard, block: int = BLOCK) -> Shard:
    """The rows sorted by their turn ids, shorter rows before those that go on, and by conversation id.

    Works from the last block of turns to the first: the rows that reach a block are ranked by it and by their rank in
    the blocks behind it; rows that end before have rank 0.
    """
    n, lengths = len(shard.conv), np.diff(shard.first)
    rank = np.zeros(n, np.int64)
    for start in range((int(lengths.max(initial=0)) - 1) // block * block, -1, -block):
        rows = np.flatnonzero(lengths > start)
        matrix = _block(shard, rows, start, block)
        order = np.lexsort((rank[rows], *matrix.T[::-1]))
        changed = (matrix[order][1:] != matrix[order][:-1]).any(axis=1) | (rank[rows][order][1:] != rank[rows][order][:-1])
        rank[rows[order]] = np.concatenate(([1], np.cumsum(changed) + 1)) if len(rows) else 0
    order = np.lexsort((shard.conv, rank))
    at = W.ranges(shard.first[order], lengths[order])
    return Shard(shard.conv[order], np.concatenate(([0], np.cumsum(lengths[order]))), shard.ids[at], shard.sizes[at])


def node_starts(shard: Shard, block: int = BLOCK) -> tuple[list[np.ndarray], np.ndarray]:
    """For each depth from 1 on, the rows that start a node; and how many first turns each row shares with the one before."""
    n, lengths = len(shard.conv), np.diff(shard.first)
    shared = np.zeros(n, np.int64)
    new = np.zeros(n, dtype=bool)  # differs from the row before in some turn so far
    new[:1] = True
    starts = []
    for start in range(0, int(lengths.max(initial=0)), block):
        rows = np.flatnonzero(lengths > start)
        matrix = _block(shard, rows, start, block)
        ids = matrix.reshape(len(rows), block, 2)
        change = np.ones((len(rows), block), dtype=bool)
        if len(rows) > 1:
            change[1:] = (ids[1:] != ids[:-1]).any(axis=2)
            change[1:][np.diff(rows) > 1] = True  # a row between them ends before this block
        change[:, 0] |= new[rows]
        change = np.logical_or.accumulate(change, axis=1)
        reach = lengths[rows][:, None] > start + np.arange(block)
        shared[rows] += (~change & reach).sum(axis=1)
        starts += [rows[change[:, i] & reach[:, i]] for i in range(block) if reach[:, i].any()]
        new[:] = True
        new[rows] = change[:, -1]
    return starts, shared


def path_keys(ids: np.ndarray) -> np.ndarray:
    """Names of the prefixes of 0, 1, 2, ... turns of one row: two 64-bit hashes each."""
    out = np.zeros((len(ids) + 1, 2), np.uint64)
    if len(ids):
        place = W.mix(np.arange(1, len(ids) + 1, dtype=np.uint64))
        pair = ids.view(np.uint64)
        for lane in (0, 1):
            turn = W.mix(W.mix(pair[:, lane] + place) ^ pair[:, 1 - lane])
            out[1:, lane] = np.bitwise_xor.accumulate(turn)
    return out.view(np.int64)


def shard_nodes(shard: Shard, number: int, block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard as rows of PARTS, deepest first, and the turns of its first and last row."""
    shard = in_order(shard, block)
    n, lengths = len(shard.conv), np.diff(shard.first)
    starts, shared = node_starts(shard, block)
    starts = [np.zeros(1, np.int64), *starts]  # the root
    paths = {FIRST: path_keys(shard.ids[: shard.first[1]]), LAST: path_keys(shard.ids[shard.first[n - 1] :])}
    # A row is the last one of a leaf unless the next row goes on from it, or is equal to it.
    leaf = np.ones(n, np.int64)
    leaf[:-1] = shared[1:] < lengths[:-1]
    saved, begins = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of deeper nodes, at the rows where these start
    by_length = np.argsort(lengths, kind="stable")
    begin_of = np.searchsorted(lengths[by_length], np.arange(len(starts) + 1))
    alive, below, held, rows_held = np.empty(0, np.int64), None, [], 0  # below: nodes that wait for their parents' ids

    for depth in range(len(starts) - 1, -1, -1):
        ended = by_length[begin_of[depth] : begin_of[depth + 1]]
        alive = np.sort(np.concatenate((alive, ended))) if len(ended) else alive
        at = np.searchsorted(alive, starts[depth])
        count = np.diff(np.concatenate((at, [len(alive)])))
        if depth:
            saved[starts[depth]] += (count - 1) * shard.sizes[shard.first[starts[depth]] + depth - 1]
        edge = np.full(len(at), INNER, np.int32)
        edge[-1] = LAST if lengths[-1] >= depth else INNER
        edge[0] = FIRST if lengths[0] >= depth else edge[0]  # also where the only node is on both paths
        key = np.zeros((len(at), 2), np.int64)
        for path in (FIRST, LAST):
            if (edge == path).any():
                key[edge == path] = paths[path][depth]
        conv = np.minimum.reduceat(shard.conv[alive], at)
        if below is not None:
            own = np.searchsorted(starts[depth], starts[depth + 1], side="right") - 1
            held.append(below | {"parent_conv_id": conv[own], "parent_edge": edge[own]})
            rows_held += len(own)
            if rows_held >= 1 << 15:
                yield _batch(held)
                held, rows_held = [], 0
        below = {
            "shard": np.full(len(at), number), "edge": edge, "depth": np.full(len(at), depth), "k1": key[:, 0], "k2": key[:, 1],
            "conv_id": conv, "n_convs": count, "n_children": np.add.reduceat(begins[alive], at),
            "n_leaves": np.add.reduceat(leaf[alive], at), "saved_tokens": np.add.reduceat(saved[alive], at),
            "ends": _ends(shard.conv, alive[at], np.add.reduceat((lengths[alive] == depth).astype(np.int64), at), edge),
        }
        if depth + 1 < len(starts):
            begins[starts[depth + 1]] = 0
        begins[starts[depth]] = 1
    yield _batch([*held, below])
    for row, kind in ((0, PATH_FIRST), (n - 1, PATH_LAST)):
        own = slice(shard.first[row], shard.first[row + 1])
        yield _batch([{"shard": [number], "edge": [kind], "ids": [shard.ids[own].ravel()], "sizes": [shard.sizes[own]]}])


def _ends(conv: np.ndarray, low: np.ndarray, many: np.ndarray, edge: np.ndarray) -> list[str]:
    """Ids of the rows that end at each node, joined: hashed for inner nodes."""
    out = [NO_ENDS if kind == INNER else "" for kind in edge.tolist()]
    for i in np.flatnonzero(many).tolist():
        text = ",".join(map(str, conv[low[i] : low[i] + many[i]].tolist()))
        out[i] = hashlib.sha256(text.encode()).hexdigest() if edge[i] == INNER else text
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    """Rows of PARTS from groups of columns; what a group doesn't have is null."""
    kinds = to_arrow_schema(PARTS)
    columns = []
    for field in kinds:
        made = [pa.array(r[field.name], field.type) if field.name in r else pa.nulls(len(r["shard"]), field.type) for r in rows]
        columns.append(pa.concat_arrays(made))
    return pa.RecordBatch.from_arrays(columns, schema=kinds)


def _shards(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, ids, sizes, lengths = [], [], [], []
        for batch in batches:
            if batch.num_rows:
                conv.append(batch.column("conv_id").to_numpy(zero_copy_only=False))
                ids.append(batch.column("ids").flatten().to_numpy(zero_copy_only=False))
                sizes.append(batch.column("sizes").flatten().to_numpy(zero_copy_only=False))
                lengths.append(batch.column("sizes").value_lengths().to_numpy(zero_copy_only=False))
        if conv:
            first = np.concatenate(([0], np.cumsum(np.concatenate(lengths), dtype=np.int64)))
            shard = Shard(np.concatenate(conv), first, np.concatenate(ids).reshape(-1, 2), np.concatenate(sizes))
            yield from shard_nodes(shard, TaskContext.get().partitionId(), block)

    return run


# ---- edges of shards ---------------------------------------------------------------------------------


def _overlaps(paths: DataFrame) -> DataFrame:
    """What adding up edge nodes counts wrong, as rows of MERGED: for every two neighbouring shards, along the turns that
    the last row of the one shares with the first row of the other."""
    after = Window.orderBy("shard", "edge")  # two rows a shard
    pairs = paths.select(
        "edge", F.col("ids").alias("a"), "sizes", F.lead("ids").over(after).alias("b")
    ).filter((F.col("edge") == PATH_LAST) & F.col("b").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sizes in zip(*(batch.column(c) for c in ("a", "b", "sizes"))):
                a, b = (np.array(x.values, np.int64).reshape(-1, 2) for x in (a, b))
                n = min(len(a), len(b))
                same = int(np.logical_and.accumulate((a[:n] == b[:n]).all(axis=1)).sum())
                own = np.array(sizes.values, np.int64)[:same]
                keys = path_keys(a[:same])
                saved = np.concatenate((own, [0]))[::-1].cumsum()[::-1]  # from each depth on down
                saved = np.concatenate((saved[:1], saved[:-1]))  # the root has no text of its own
                zero = np.zeros(same + 1, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(same + 1)), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.nulls(same + 1, pa.int64()),
                    pa.array(zero), pa.array(-(np.arange(same + 1) < same).astype(np.int64)), pa.array(zero - (same == len(a))),
                    pa.array(saved), pa.nulls(same + 1, pa.string()),
                ], names=MERGED.names)

    return pairs.mapInArrow(run, MERGED)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edge nodes from their parts, which come one after another, in the order of shards: sums, the smallest id, and the
    hash of all ids, which are never held together."""

    def done(key, state):
        conv, sums, digest, _ = state
        return (*key, conv, *sums, digest.hexdigest())

    key, state, out = None, None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in MERGED.names]
        for depth, k1, k2, conv, *sums, ends in zip(*columns):
            if (depth, k1, k2) != key:
                if key is not None:
                    out.append(done(key, state))
                key, state = (depth, k1, k2), [None, [0] * len(SUMS), hashlib.sha256(), False]
            if conv is not None:
                state[0] = conv if state[0] is None else min(state[0], conv)
            state[1] = [a + b for a, b in zip(state[1], sums)]
            if ends:
                state[2].update((("," if state[3] else "") + ends).encode())
                state[3] = True
        if len(out) >= 10_000:
            yield _merged(out)
            out = []
    if key is not None:
        yield _merged([*out, done(key, state)])


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * (len(MERGED) - 1) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=MERGED.names)


def prefix_trie(rows: DataFrame, *, shard_rows: int = SHARD_ROWS, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, turns), as ``rebuilt`` or ``as_rows`` give them.

    Returns, for every distinct sequence of first turns (role and text), the empty one included: ``conv_id`` (the smallest
    conversation that starts with it), ``depth``, ``parent_conv_id`` (that of the node one turn above; null for the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree, itself included), ``saved_tokens`` (summed
    over the subtree, each node's conversations but one times the code points of its last text) and ``ends_sha256`` (of
    the ascending ids of the conversations that end here, joined by commas).

    Conversations without turns end at the root. Each conversation id has one row here; a table without any has no node.
    A conversation's ids (20 bytes a turn) are one value of one row; a shard holds about ``shard_rows`` rows and turns, or
    one longer conversation.
    """
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], RESULT)
    flat = F.flatten(F.transform("turns", lambda t: F.array(F.greatest(t["id1"], F.lit(int(PAD) + 1)), t["id2"])))
    packed = written(rows.select("conv_id", flat.alias("ids"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "rows")
    total = packed.agg(F.count("*") + F.coalesce(F.sum(F.size("sizes")), F.lit(0))).head()[0]
    shards = max(1, -(-total // shard_rows))
    parts = packed.repartitionByRange(shards, "ids", "conv_id").mapInArrow(_shards(block), PARTS)
    parts = written(parts, "parts")

    edges = parts.filter(F.col("edge").isin(FIRST, LAST))
    overlaps = _overlaps(parts.filter(F.col("edge").isin(PATH_FIRST, PATH_LAST)))
    both = edges.select("shard", *MERGED.names).unionByName(overlaps.withColumn("shard", F.lit(-1).cast("long")))
    merged = both.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "shard")
    merged = written(merged.select(*MERGED.names).mapInArrow(_merge, MERGED), "merged")

    # The ids of parents that are edge nodes, looked up by shard, path and depth: no more rows a key than a shard has.
    known = edges.select("shard", "edge", "depth", "k1", "k2").join(merged.select("depth", "k1", "k2", F.col("conv_id").alias("whole")), ["depth", "k1", "k2"])
    known = known.select("shard", F.col("edge").alias("parent_edge"), (F.col("depth") + 1).alias("depth"), "whole")
    nodes = parts.filter(F.col("edge") == INNER).withColumnRenamed("ends", "ends_sha256")
    names = [f.name for f in RESULT]
    inside = nodes.filter(F.col("parent_edge") == INNER).select(*names)
    under = nodes.filter(F.col("parent_edge") != INNER).join(known, ["shard", "parent_edge", "depth"])
    under = under.withColumn("parent_conv_id", F.col("whole")).select(*names)
    above = edges.select("shard", "parent_edge", "depth", "k1", "k2").join(known, ["shard", "parent_edge", "depth"])
    above = above.groupBy("depth", "k1", "k2").agg(F.min("whole").alias("parent_conv_id"))
    outer = merged.join(above, ["depth", "k1", "k2"], "left").withColumnRenamed("ends", "ends_sha256").select(*names)
    return inside.union(under).union(outer)
