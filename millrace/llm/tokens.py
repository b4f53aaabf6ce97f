"""Token ids of a corpus as directly addressable files, in ascending document order.

Documents are dealt out by ranges of their ids, sorted, encoded and written shard by shard: one shuffle of the texts, and
no task holds more than a shard of tokens. Each file is one binary value of a table that Spark writes, so files go to the
session's file system, and a task that runs twice or is lost leaves no half of one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import named
from millrace.llm.dac import TokenFile, to_bytes
from millrace.session import scratch_path

#: Token that ends a document.
END_ID = 2
#: Tokens in a file, about; a longer document makes a longer file.
SHARD_TOKENS = 1 << 21
#: Words whose ids a Python worker keeps, about; beyond it the less used ones are forgotten.
KEPT_WORDS = 600_000

# The steps before the model of a tokenizer that lower-cases and splits letters, digits and the rest.
LOWER_WORDS = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
]
#: A word that is its pieces: printable ASCII without apostrophes (contractions) and without "<|" (special tokens).
PLAIN = re.compile(rb"(?!.*<\|)[!-&(-~]+")
#: Pieces of plain words in lower case, with a line end behind each word.
PIECE = re.compile(r"[a-z]+|[0-9]|\n|[^a-z0-9\n]+")

#: Characters of a text that ranges of documents are cut by where ids are alike.
KEY_CHARS = 64

#: A token file, beside the task that wrote it, its number there, and what it holds.
FILES = "part int, number int, n_docs long, n_tokens long, file binary"


def _packed(ids: Iterable[int]) -> bytes:
    """Ids as 32-bit integers, in the machine's order."""
    return array("I", ids).tobytes()


class _Slots(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Lists:
    """Lists of ids, by number; the first ``empty`` ones have none."""

    def __init__(self, empty: int):
        self._ids, self._begin, self._count = np.empty(0, np.uint32), np.zeros(empty, np.int64), np.zeros(empty, np.int64)

    def add(self, ids: np.ndarray, count: np.ndarray, begin: np.ndarray | None = None) -> None:
        """More lists: all their ids, the number of each, and where each begins (one after another unless given)."""
        begin = np.cumsum(count) - count if begin is None else begin
        self._begin, self._count = np.concatenate([self._begin, len(self._ids) + begin]), np.concatenate([self._count, count])
        self._ids = np.concatenate([self._ids, ids])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some lists one after another, and the number of ids of each."""
        count = self._count[numbers]
        n = int(count.sum())
        small = np.int32 if max(n, len(self._ids)) < 1 << 31 else np.int64  # places, one for each id
        place = np.repeat((self._begin[numbers] - np.cumsum(count) + count).astype(small), count)
        place += np.arange(n, dtype=small)
        return self._ids[place], count


class Encoder:
    """Token ids of whole texts.

    A tokenizer whose steps are known to drop white space and never to join tokens across it (LOWER_WORDS) encodes every
    word between ASCII white space once, as its ids are the same in any text. Any other encodes whole texts.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        from tokenizers import Tokenizer

        self._tokenizer, self._kept = Tokenizer.from_file(path), kept_words
        self._model = self._tokenizer.model
        steps = json.loads(self._tokenizer.to_str())
        self._by_word = [steps["normalizer"], steps["pre_tokenizer"]] == LOWER_WORDS
        # Known words lie in one Arrow column, some 10 bytes each; a dictionary of them would take some 100.
        self._known, self._ids, self._used = pa.array([""], pa.string()), _Lists(1), np.ones(1, np.int32)

    def _forget(self) -> None:
        """Keep the words that came up in several batches, at most half of KEPT_WORDS, and count again from there."""
        used, most = self._used[1:], self._kept // 2
        least = max(2, np.partition(used, -most)[-most] + 1) if len(used) > most else 2
        stay = np.concatenate(([0], 1 + np.flatnonzero(used >= least)))
        ids, count = self._ids.of(stay)
        self._known, self._ids = self._known.take(pa.array(stay)), _Lists(0)
        self._ids.add(ids, count)
        self._used = self._used[stay] // 2 + 1

    def _plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of printable ASCII without apostrophes, and the number of ids of each: each run of letters,
        digit and run of other characters is a piece of its own, whose bytes the model reads as they are, in lower case. Pieces are not kept."""
        slots, parts = _Slots({"\n": 0}), _Lists(1)
        pieces = PIECE.findall((b"\n".join(words) + b"\n").decode("ascii").lower())
        slot = np.fromiter(map(slots.__getitem__, pieces), np.int64, len(pieces))
        each = [[t.id for t in self._model.tokenize(p)] for p in islice(slots, 1, None)]
        count = np.fromiter(map(len, each), np.int64, len(each))
        parts.add(np.fromiter(chain.from_iterable(each), np.uint32, count.sum()), count)
        ids, counts = parts.of(slot)
        return ids, np.diff(np.cumsum(counts)[slot == 0], prepend=0)

    def _learn(self, new: pa.Array) -> None:
        """Encode the words that came new, plain ones by their pieces, the others by the whole tokenizer."""
        if not len(new):
            return
        words = new.cast(pa.binary()).to_pylist()
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        ids, count = np.empty(0, np.uint32), np.empty(len(words), np.int64)
        if plain.any():
            ids, count[plain] = self._plain([w for w, p in zip(words, plain) if p])
        other = list(self._whole([w.decode() for w, p in zip(words, plain) if not p]))
        count[~plain] = [len(c) // 4 for c in other]
        # Ids of the plain words come first, then those of the others.
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        begin = np.empty(len(words), np.int64)
        begin[order] = np.cumsum(count[order]) - count[order]
        self._ids.add(np.concatenate([ids, np.frombuffer(b"".join(other), np.uint32)]), count, begin)
        self._known = pa.concat_arrays([self._known, new])
        self._used = np.append(self._used, np.zeros(len(new), np.int32))

    def _whole(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), 1000):
            for coded in self._tokenizer.encode_batch_fast(texts[i : i + 1000], add_special_tokens=False):
                yield _packed(coded.ids)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id behind it, and the number of ids of each."""
        if not self._by_word:
            coded = [ids + _packed([end_id]) for ids in self._whole(texts.to_pylist())]
            return np.frombuffer(b"".join(coded), np.uint32), np.array([len(c) // 4 for c in coded], np.int64)
        if len(self._known) > self._kept:
            self._forget()
        words = pc.ascii_split_whitespace(texts)  # blanks at the ends give empty words, which have no ids
        coded = words.flatten().dictionary_encode()
        once, first = coded.dictionary.cast(pa.string()), len(self._known)
        slot = pc.index_in(once, value_set=self._known)
        new = slot.is_null()
        self._learn(once.filter(new))
        slot, new = slot.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), new.to_numpy(zero_copy_only=False)
        slot[new] = np.arange(first, len(self._known))
        self._used[slot] += 1
        ids, counts = self._ids.of(slot[coded.indices.to_numpy()])
        ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum(words.value_lengths().to_numpy())]
        return np.insert(ids, ends, end_id), np.diff(np.concatenate(([0], ends))) + 1


def _encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    holder = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    if path not in vars(holder):
        vars(holder)[path] = Encoder(path)
    return vars(holder)[path]


def _writer(tokenizer: str, end_id: int, shard_tokens: int):
    """A task's documents as token files: rows of FILES, each as large as a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        doc_ids, lengths, tokens, held, number = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            n = np.concatenate(lengths)
            made = to_bytes(doc_ids, n, np.concatenate(tokens))
            columns = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                       pa.array([int(n.sum())], pa.int64()), pa.array([made], pa.binary())]
            doc_ids.clear(), lengths.clear(), tokens.clear()
            return pa.RecordBatch.from_arrays(columns, names=["part", "number", "n_docs", "n_tokens", "file"])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes, first = pc.binary_length(texts).to_numpy(), 0
            while first < len(ids):  # at most a few MB of text at a time
                last, size = first, 0
                while last < min(len(ids), first + 1000) and (last == first or size + sizes[last] <= 4 << 20):
                    size, last = size + sizes[last], last + 1
                got, n = encoder.encode(texts[first:last], end_id)
                doc_ids += ids[first:last]
                tokens.append(got)
                lengths.append(n)
                held, first = held + len(got), last
                if held >= shard_tokens:
                    yield shard()
                    held, number = 0, number + 1
        if doc_ids:
            yield shard()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the token files of whole texts: a table of FILES in ``folder``, in any file system that Spark writes to.

    ``tokenizer`` is the path of a tokenizers file that every executor can read. Documents come in ascending id order
    (null ids first, like ids by their text); null texts are empty, and every document ends with ``end_id``. Repeated
    rows are written each. Other columns are not read. An empty table has no files.
    """
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    # Ranges are cut by ids, and within an id by the beginning of the text: short keys, in the order of the rows.
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, KEY_CHARS)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writer(tokenizer, end_id, shard_tokens), FILES).write.option("compression", "uncompressed").parquet(folder)


def file_starts(files: DataFrame) -> DataFrame:
    """(part, number, before): the tokens before each file. Parts are added up first, then the files of each part."""
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that wrote
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("all")).select("part", F.coalesce(F.sum("all").over(along), F.lit(0)).alias("begin"))
    own = files.select("part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    return own.join(parts, "part").select("part", "number", (F.col("begin") + F.col("inside")).alias("before"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the tokens of all documents before; ``ids_crc32`` is the checksum of a document's ids as
    little-endian unsigned 32-bit integers.
    """
    files = spark.read.schema(FILES).parquet(folder)
    schema = "part int, number int, doc_id long, at long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, file in zip(batch.column("part").to_pylist(), batch.column("number").to_pylist(), batch.column("file")):
                shard = TokenFile(file.as_buffer())
                tokens, at = shard.tokens().astype("<u4"), shard.starts
                crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(crc), pa.int32()), pa.array([number] * len(crc), pa.int32()), pa.array(shard.doc_ids, pa.int64()),
                     pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    read = files.select("part", "number", "file").mapInArrow(run, schema)
    starts = file_starts(files.select("part", "number", "n_tokens"))
    return read.join(starts, ["part", "number"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the token files below the shared folder and report on every document from them."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, folder, tokenizer, **options)
    return read_tokens(spark, folder)
