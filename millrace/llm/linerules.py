"""Quality rules, line first: lines that fail a rule go, then documents that lose too much of their text.

Lines end at line feeds. Each line is judged by itself: how it ends and how marks are spread over its words
(punctuation), whether it is a row of links or cells (navigation), and whether it holds a phrase of page furniture or a
licence (boilerplate). A document is rejected where the lines that go hold more than a share of its word characters,
or where it has too few words or too many repeated ones.

Texts are read as bytes, many documents at a time; nothing is shuffled.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as W
from millrace.llm.arrow import map_text, named

#: Fewest words of a document, and the greatest share of words in repeated windows, in hundredths.
LEAST_WORDS, REPEATED_PERCENT = 10, 20
#: Words in a window that may be repeated.
WINDOW = 5
#: Greatest share of a document's word characters that removed lines may hold, in hundredths.
LOST_PERCENT = 50
#: Greatest share of a line's words that may carry a symbol or a run of marks, in hundredths.
MARKED_PERCENT = 20
#: Least share of a line's words that are separators in a row of links or cells, in hundredths.
SEPARATOR_PERCENT = 20

# Symbols that are counted; how a sentence may end, in ASCII and beyond; marks that shout when they come
# twice; separators of links and cells; phrases of page furniture and licences, in lower case.
SYMBOLS = "#*$%&|<>"
ENDINGS = ".!?:;\"')]"
LONG_ENDINGS = ("…", "”", "’", "»", "。", "！", "？", "」")
SHOUTS = "!?"
SEPARATORS = "|<>"
PHRASES = (
    "all rights reserved", "back to top", "click here", "cookie policy", "copyright ©", "enable javascript", "licensed under",
    "log in to", "lorem ipsum", "privacy policy", "read more", "share on", "sign up for", "skip to content",
    "subscribe to", "terms of service", "terms of use",
)

FIELDS = T.StructType(
    [T.StructField(n, T.LongType()) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unpunctuated", "n_navigation",
        "n_boilerplate", "n_removed", "lost_chars",
    )]
)
TEXT = T.StructField("cleaned", T.StringType())


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode())] = True
    return out


SYMBOL, ENDING, SHOUT, SEPARATOR = _table(SYMBOLS), _table(ENDINGS), _table(SHOUTS), _table(SEPARATORS)
LEAD = np.ones(256, dtype=bool)  # bytes that begin a code point
LEAD[0x80:0xC0] = False
NOT_FEED = np.ones(256, dtype=bool)
NOT_FEED[0x0A] = False
PHRASE = re.compile(b"|".join(re.escape(p.encode()) for p in PHRASES))


class Lines(NamedTuple):
    """Lines of a group of documents. Line i is ``data[starts[i]:ends[i]]``; document d has the lines ``first[d]`` to
    ``first[d + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def split_lines(data: np.ndarray, edges: np.ndarray) -> Lines:
    """Lines of consecutive documents; an empty text has one empty line."""
    feeds = np.flatnonzero(data == 0x0A)
    own = np.searchsorted(feeds, edges)
    first = own + np.arange(len(edges))
    starts = np.empty(first[-1], np.int64)
    later = np.ones(len(starts), dtype=bool)
    later[first[:-1]] = False
    starts[first[:-1]] = edges[:-1]
    starts[later] = feeds + 1
    ends = np.concatenate((starts[1:] - 1, edges[-1:]))[: len(starts)]
    ends[first[1:] - 1] = edges[1:]
    return Lines(starts, ends, first)


def _totals(flags: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))


def _between(totals: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return totals[ends] - totals[starts]


def _of_each(owner: np.ndarray, n: int, flags: np.ndarray | None = None) -> np.ndarray:
    """How many (flagged) things each owner has."""
    return np.bincount(owner if flags is None else owner[flags], minlength=n).astype(np.int64)


def _seen_before(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each thing of a document: whether an earlier one has its hash, and whether any other one has."""
    order = np.lexsort((hashes, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    before, any_ = np.zeros(len(doc), dtype=bool), np.zeros(len(doc), dtype=bool)
    before[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return before, any_


def _ends_a_sentence(data: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether words end with a mark that may end a sentence."""
    out = ENDING[data[ends - 1]]
    for mark in LONG_ENDINGS:
        code = mark.encode()
        hit = lengths >= len(code)
        for i, byte in enumerate(reversed(code)):
            hit = hit & (data[np.maximum(ends - 1 - i, 0)] == byte)
        out = out | hit
    return out


def judge(data: np.ndarray, edges: np.ndarray) -> tuple[dict[str, np.ndarray], Lines, np.ndarray]:
    """FIELDS of each document, its lines, and which of them go."""
    n_docs = len(edges) - 1
    lines = split_lines(data, edges)
    parts = W.split_words(data, edges, W.NOT_SPACE, lower=False)
    starts, ends = parts.starts, parts.ends
    n_lines, n_words = len(lines.starts), np.diff(parts.first)
    line_doc = np.repeat(np.arange(n_docs), np.diff(lines.first))
    word_doc = np.repeat(np.arange(n_docs), n_words)
    line = np.searchsorted(lines.starts, starts, side="right") - 1 if len(starts) else np.empty(0, np.int64)

    symbols = _totals(SYMBOL[data])
    chars = _between(_totals(LEAD[data]), starts, ends)
    of_line = _of_each(line, n_lines)
    has_word = of_line > 0
    last = np.cumsum(of_line)[has_word] - 1  # last word of each line that has one
    lengths = ends - starts

    # Punctuation: the line ends as a sentence does, and few words carry symbols or shout.
    ended = np.ones(n_lines, dtype=bool)
    ended[has_word] = _ends_a_sentence(data, ends[last], lengths[last])
    twice = (lengths > 1) & SHOUT[data[ends - 1]] & (data[np.maximum(ends - 2, 0)] == data[ends - 1]) if len(ends) else np.empty(0, bool)
    marked = _of_each(line, n_lines, (_between(symbols, starts, ends) > 0) | twice)
    unpunctuated = has_word & (~ended | (100 * marked > MARKED_PERCENT * of_line))
    # Navigation: separators between links or cells.
    parted = _of_each(line, n_lines, _between(_totals(SEPARATOR[data]), starts, ends) == lengths)
    navigation = has_word & (100 * parted >= SEPARATOR_PERCENT * of_line) & (parted > 0)
    # Boilerplate: a phrase inside the line.
    low = W.LOWER[data].tobytes()
    hits = np.array([m.start() for m in PHRASE.finditer(low)], np.int64)
    boilerplate = np.zeros(n_lines, dtype=bool)
    if len(hits):
        at = np.searchsorted(lines.starts, hits, side="right") - 1
        whole = np.array([m.end() for m in PHRASE.finditer(low)], np.int64) <= lines.ends[at]
        boilerplate[at[whole]] = True
    gone = unpunctuated | navigation | boilerplate

    texts = W.split_words(data, edges, NOT_FEED, lower=False)  # lines that aren't empty, and their hashes
    at = np.searchsorted(lines.starts, texts.starts, side="right") - 1
    filled = has_word[at]
    repeated, _ = _seen_before(line_doc[at[filled]], texts.hashes[filled])
    places, counts = W.gram_places(parts.first, WINDOW)
    _, again = _seen_before(np.repeat(np.arange(n_docs), counts), W.gram_hashes(parts.hashes, WINDOW)[places])
    steps = np.zeros(len(starts) + 1, np.int64)
    np.add.at(steps, places[again], 1)
    np.add.at(steps, places[again] + WINDOW, -1)

    sums = lambda flags: _of_each(line_doc, n_docs, flags)
    word_chars = _totals(chars)
    found = {
        "n_words": n_words,
        "word_chars": _between(word_chars, parts.first[:-1], parts.first[1:]),
        "n_symbols": _between(symbols, edges[:-1], edges[1:]),
        "n_dup_lines": _of_each(line_doc[at[filled]], n_docs, repeated),
        "n_repeat_words": _of_each(word_doc, n_docs, np.cumsum(steps[:-1]) > 0),
        "n_lines": np.diff(lines.first),
        "n_unpunctuated": sums(unpunctuated),
        "n_navigation": sums(navigation),
        "n_boilerplate": sums(boilerplate),
        "n_removed": sums(gone),
        "lost_chars": np.bincount(word_doc, weights=chars * gone[line], minlength=n_docs).astype(np.int64),
    }
    return found, lines, gone


def _cleaned(data: np.ndarray, edges: np.ndarray, lines: Lines, gone: np.ndarray) -> pa.Array:
    """Each text without the lines that go; the line feed behind such a line goes too, or the one before a last line."""
    feed = np.ones(len(gone), np.int64)
    feed[lines.first[1:] - 1] = 0
    steps = np.zeros(len(data) + 1, np.int64)
    np.add.at(steps, lines.starts[gone], 1)
    np.add.at(steps, (lines.ends + feed)[gone], -1)
    keep = np.cumsum(steps[:-1]) == 0
    # A text whose last line goes ends with its last kept line, without the line feed behind that.
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(lines.first))
    last_kept = np.full(len(edges) - 1, -1, np.int64)
    np.maximum.at(last_kept, doc[~gone], np.flatnonzero(~gone))
    cut = last_kept[(last_kept >= 0) & (last_kept < lines.first[1:] - 1)]
    keep[lines.ends[cut]] = False
    offsets = _totals(keep)[edges]
    return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[keep].tobytes())]).cast(pa.string())


def _judged(with_text: bool):
    def run(texts: pa.Array) -> list[pa.Array]:
        data, offsets = W.text_buffers(texts)
        columns, cleaned = {n: [np.empty(0, np.int64)] for n in FIELDS.names}, [pa.array([], pa.string())]
        for low, high in W.groups(offsets):
            own, edges = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            found, lines, gone = judge(own, edges)
            for n in columns:
                columns[n].append(found[n])
            if with_text:
                cleaned.append(_cleaned(own, edges, lines, gone))
        out = [pa.array(np.concatenate(columns[n])) for n in FIELDS.names]
        return out + [pa.concat_arrays(cleaned)] if with_text else out

    return run


def clean_lines(docs: DataFrame, *, text: str = "text", with_text: bool = True, keep=None) -> DataFrame:
    """Every row with what line-first cleaning makes of it: ``row`` (kept columns of docs, default all) and ``found``.

    ``found`` holds ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word
    that equal an earlier line), ``n_repeat_words`` (words in windows of WINDOW words that come up twice or more in the
    text), ``n_lines``, the lines that fail each rule (``n_unpunctuated``, ``n_navigation``, ``n_boilerplate``; a line may
    fail several), ``n_removed`` lines, ``lost_chars`` (code points in their words) and ``cleaned``, the lines that stay.

    Words are runs of characters that are not ASCII white space. Lines without words stay. Null and empty texts have no
    words, one line, and an empty ``cleaned``. Repeated rows are each judged; ties don't arise; extra columns pass through.
    Equal lines and windows of one text are found by 64-bit hashes.
    """
    fields = T.StructType([*FIELDS.fields, TEXT]) if with_text else FIELDS
    return map_text(docs, named(text), fields, _judged(with_text), keep)


def base_failed(found: str = "found") -> Column:
    """True for documents of too few words, or with too many of them in repeated windows."""
    n, repeated = F.col(f"{found}.n_words"), F.col(f"{found}.n_repeat_words")
    return (n < LEAST_WORDS) | (repeated * 100 > n * REPEATED_PERCENT)


def is_kept(found: str = "found") -> Column:
    """True for documents that pass the base rules and lose no more than LOST_PERCENT of their word characters."""
    lost, chars = F.col(f"{found}.lost_chars"), F.col(f"{found}.word_chars")
    return ~base_failed(found) & (lost * 100 <= chars * LOST_PERCENT)


def keep_clean(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Documents that pass, with their columns as they were but for the text, which has lost the failing lines."""
    found = clean_lines(docs, text=text).filter(is_kept())
    return found.select(*[(F.col("found.cleaned") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
