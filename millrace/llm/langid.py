"""Language identification by a linear-chain conditional random field.

Every word of a text is labelled with a language. A word's own evidence is the sum of learnt weights of its features:
first and last one, two and three bytes (affixes), all byte pairs and triples with the word end (n-grams), and the word
itself (lexicon). Learnt transitions tie neighbouring words, so switches cost. Forward-backward gives each word's
posterior; a text's language has the largest sum over its words.

Training texts have one language each; the model learns from chains in which short stretches of several languages take
turns, so that it meets switches.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as W
from millrace.llm.arrow import lists, map_text, named
from millrace.llm.quality import held_out, threshold

#: Bytes of training text of each language, about, at most, in pieces of so many characters; a hash of the id and the
#: piece's number chooses them.
SAMPLE_BYTES, PIECE = 240_000, 2_000
#: Languages that a fit learns at most; more are an error.
MOST_LANGS = 500
#: Words of a stretch in a training chain.
STRETCH = 25
#: Steps of the fit, its rate, and the pull of weights to 0.
STEPS, RATE, PENALTY = 25, 0.3, 1e-5
#: Rows of the weight table that features are hashed to.
TABLE = 1 << 16
UNKNOWN = "und"

# Bytes of words. Non-ASCII characters count as letters.
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # TABLE x languages
    transitions: np.ndarray  # log weights, from x to
    start: np.ndarray  # log weights


def _row(kind: int, *values: np.ndarray) -> np.ndarray:
    x = W.U64(kind)
    for v in values:
        x = x * W.U64(0x100000001B3) + v
    return (W.mix(x) & W.U64(TABLE - 1)).astype(np.int64)


def word_features(parts: W.Words) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Table rows by word (affixes, lexicon) and by byte (n-grams); first byte and length of each word."""
    lengths = parts.ends - parts.starts
    begin = np.cumsum(lengths) - lengths
    flat = np.append(parts.data[W.ranges(parts.starts, lengths)].astype(W.U64) + W.U64(1), [W.U64(0)] * 2)
    n = int(lengths.sum())
    left = np.repeat(begin + lengths, lengths) - np.arange(n)  # bytes up to the word's end
    one, two, three = flat[:n], np.where(left > 1, flat[1 : n + 1], 0), np.where(left > 2, flat[2 : n + 2], 0)
    end = begin + lengths
    back = [np.where(lengths >= k, flat[np.maximum(end - k, 0)], 0) for k in (1, 2, 3)]
    front = [x[begin] for x in (one, two, three)]
    by_word = [_row(i, *front[:i]) for i in (1, 2, 3)] + [_row(i + 3, *back[:i]) for i in (1, 2, 3)] + [_row(7, parts.hashes)]
    return by_word, [_row(8, one, two), _row(9, one, two, three)], begin, lengths


def emissions(weights: np.ndarray, features) -> np.ndarray:
    """The own evidence of each word, by language."""
    by_word, by_byte, begin, _ = features
    out = np.zeros((len(begin), weights.shape[1]), np.float32)
    for rows in by_word:
        out += weights[rows]
    for rows in by_byte if len(begin) else ():
        out += np.add.reduceat(weights[rows], begin, axis=0)
    return out


def posteriors(model: Model, emission: np.ndarray, starts: np.ndarray):
    """Posterior of each word, and of each pair of labels summed over all neighbours in a chain.

    ``starts`` marks the first words of chains. All chains are one long one with resets, cut into blocks of equal length:
    forward and backward runs step through all blocks at once, first for every label that a block may begin or end with,
    then, once the blocks are tied together, for the right one.
    """
    n, k = emission.shape
    steps = max(1, int(np.sqrt(n)))
    blocks = -(-n // steps)
    pad = blocks * steps - n
    e = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float64)
    e = np.concatenate([e, np.ones((pad, k))]).reshape(blocks, steps, k)
    first = np.concatenate([starts, np.ones(pad, bool)]).reshape(blocks, steps)
    move, begin = np.exp(model.transitions), np.exp(model.start - model.start.max())
    reset = np.broadcast_to(begin, (k, k))
    # One step: from the labels before to the labels here. A chain's first word forgets what was before.
    both = np.stack([move, reset])

    def forward(state):  # state: blocks x rows x labels
        for t in range(steps):
            state = (state @ both[first[:, t].astype(np.int8)]) * e[:, t, None, :]
            state /= state.max(axis=(1, 2), keepdims=True)
            yield t, state

    def backward(state):  # state: blocks x labels x columns, behind the word at t
        for t in range(steps - 1, -1, -1):
            yield t, state
            state = both[first[:, t].astype(np.int8)] @ (e[:, t, :, None] * state)
            state /= state.max(axis=(1, 2), keepdims=True)
        yield -1, state

    eye = np.broadcast_to(np.eye(k), (blocks, k, k))
    for _, through in forward(eye):
        pass
    before = np.empty((blocks, k))
    now = np.ones(k)
    for b in range(blocks):
        before[b] = now
        now = now @ through[b]
        now = now / now.max()
    alpha = np.empty((blocks, steps, k))
    for t, state in forward(before[:, None, :]):
        alpha[:, t] = state[:, 0]
    for _, through in backward(eye):
        pass
    behind = np.empty((blocks, k))
    now = np.ones(k)
    for b in range(blocks - 1, -1, -1):
        behind[b] = now
        now = through[b] @ now
        now = now / now.max()
    beta = np.empty((blocks, steps, k))
    for t, state in backward(behind[:, :, None]):
        if t >= 0:
            beta[:, t] = state[:, :, 0]
    alpha, beta, e = (x.reshape(-1, k)[:n] for x in (alpha, beta, e))
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)

    def pairs() -> np.ndarray:
        inner = np.flatnonzero(~starts)
        joint = alpha[inner - 1][:, :, None] * move * (e[inner] * beta[inner])[:, None, :]
        return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)

    return gamma, pairs


def fit_chain(texts: list[str], labels: list[str], *, stretch: int = STRETCH, steps: int = STEPS, rate: float = RATE,
              penalty: float = PENALTY, seed: int = 1) -> Model:
    """Fit the model by gradient steps on the likelihood of the labels of all words of all texts."""
    langs = sorted(set(labels))
    k = len(langs)
    data, offsets = W.text_buffers(pa.array(texts, pa.string()))
    parts = W.split_words(data, offsets, LETTER, lower=True)
    label = np.repeat(np.searchsorted(langs, labels) if k else np.empty(0, int), np.diff(parts.first))
    model = Model(langs, np.zeros((TABLE, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2 or not len(label):
        return model
    # Chains: stretches of all texts in a random order, in chains of eight.
    piece = np.arange(len(label)) // stretch + np.cumsum(np.isin(np.arange(len(label)), parts.first)) * (len(label) + 1)
    cuts = np.flatnonzero(np.diff(piece, prepend=-1))
    rng = np.random.default_rng(seed)
    turn = rng.permutation(len(cuts))
    size = np.diff(np.append(cuts, len(label)))[turn]
    order = W.ranges(cuts[turn], size)
    starts = np.zeros(len(label), bool)
    starts[(np.cumsum(size) - size)[::8]] = True
    features = word_features(parts)
    by_word, by_byte, _, lengths = features
    truth = np.zeros((len(label), k))
    truth[np.arange(len(label)), label] = 1
    seen = label[order]
    inner = np.flatnonzero(~starts)
    pair_truth = np.zeros((k, k))
    np.add.at(pair_truth, (seen[inner - 1], seen[inner]), 1)
    total = [np.full((TABLE, k), 1e-8), np.full((k, k), 1e-8), np.full(k, 1e-8)]
    for _ in range(steps):
        gamma, pairs = posteriors(model, emissions(model.weights, features)[order], starts)
        miss = np.empty_like(gamma)
        miss[order] = truth[order] - gamma
        slope = np.zeros((TABLE, k))
        for c in range(k):
            for rows in by_word:
                slope[:, c] += np.bincount(rows, miss[:, c], TABLE)
            spread = np.repeat(miss[:, c], lengths)
            for rows in by_byte:
                slope[:, c] += np.bincount(rows, spread, TABLE)
        slopes = [slope - penalty * len(label) * model.weights, pair_truth - pairs(), (truth[order] - gamma)[starts].sum(axis=0)]
        values = []
        for i, value in enumerate((model.weights, model.transitions, model.start)):
            total[i] += slopes[i] ** 2  # every weight has a rate of its own
            values.append(value + rate * slopes[i] / np.sqrt(total[i]))
        model = Model(langs, values[0].astype(np.float32), values[1], values[2])
    return model


def label_words(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the word posteriors of each text, by language, and its number of words."""
    data, offsets = W.text_buffers(texts)
    k = len(model.langs)
    sums, counts = [np.empty((0, k))], [np.empty(0, np.int64)]
    for low, high in W.groups(offsets):
        parts = W.split_words(data, offsets[low : high + 1], LETTER, lower=True)
        n = np.diff(parts.first)
        total = np.zeros((high - low, k))
        if len(parts.starts) and k:
            starts = np.zeros(len(parts.starts), bool)
            starts[parts.first[:-1][n > 0]] = True
            gamma, _ = posteriors(model, emissions(model.weights, word_features(parts)), starts)
            total[n > 0] = np.add.reduceat(gamma, parts.first[:-1][n > 0], axis=0)
        sums.append(total)
        counts.append(n)
    return np.concatenate(sums), np.concatenate(counts)


def _predict(model, texts: pa.Array) -> list[pa.Array]:
    model = Model(*model.value)
    sums, counts = label_words(model, texts)
    # A text without ASCII letters may have words of other signs alone.
    letters = counts > 0
    for i in np.flatnonzero(letters):
        letters[i] = any(map(str.isalpha, texts[int(i)].as_py()))  # ends at the first letter
    if not model.langs:
        return [pa.array([UNKNOWN] * len(counts)), pa.array(np.zeros(len(counts)))]
    best = sums.argmax(axis=1)
    score = np.where(letters, sums[np.arange(len(best)), best] / np.maximum(counts, 1), 0.0)
    return [pa.array(np.where(letters, np.array(model.langs, dtype=object)[best], UNKNOWN), pa.string()), pa.array(np.clip(score, 0, 1))]


def fit_languages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                  sample_bytes: int = SAMPLE_BYTES, seed: int = 1, **options) -> Model:
    """Learn from a sample of texts with a language, outside the held-out rows (see ``quality.held_out``).

    About ``sample_bytes`` of each language are collected, in pieces of PIECE characters without the words cut at their
    ends (all, if there are fewer). A language with text of which no piece is drawn is an error, as more than MOST_LANGS
    languages are.
    """
    mine = docs.select(named(doc_id).alias("id"), named(text).cast("string").alias("text"), named(lang).cast("string").alias("lang"))
    mine = mine.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    sizes = mine.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).limit(MOST_LANGS + 1).collect()
    sizes = {r["lang"]: r["bytes"] for r in sizes}
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not sizes:
        return fit_chain([], [], seed=seed, **options)
    limits = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, threshold(min(1.0, sample_bytes / max(1, n))))])
    last = F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / PIECE).cast("int")
    pieces = mine.select("id", "lang", "text", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.filter(F.xxhash64("id", "piece", F.lit(seed)) <= F.element_at(limits, F.col("lang")))
    part = F.substring("text", F.col("piece") * PIECE + 1, F.lit(PIECE))
    part = F.when(F.col("piece") > 0, F.regexp_replace(part, r"^\S+", "")).otherwise(part)
    part = F.when(F.col("piece") < F.col("last"), F.regexp_replace(part, r"\S+$", "")).otherwise(part)
    rows = pieces.select("id", "lang", "piece", part.alias("text")).toArrow().to_pandas().sort_values(["id", "lang", "piece", "text"])
    missing = {name for name, n in sizes.items() if n} - set(rows["lang"])
    if missing:
        raise RuntimeError(f"no piece of {sorted(missing)} was drawn; take another seed or more bytes")
    return fit_chain(rows["text"].tolist(), rows["lang"].tolist(), seed=seed, **options)


def predict_languages(docs: DataFrame, model: Model, *, text: str = "text", keep=None) -> DataFrame:
    """``row`` (a struct of the kept columns of docs, default all), ``found.lang`` and ``found.score`` of every whole text.

    The score is the mean posterior of the language over the words. Null texts and texts without a letter are ``und``
    with score 0, and so is everything if the model knows no language. Ties go to the first language by name. Repeated
    rows get equal results; only the text is read, other columns pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # the weight table has a fixed size
    return map_text(docs, named(text), RESULT, lambda texts: _predict(sent, texts), keep)



SPANS = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("words", T.LongType()), T.StructField("lang", T.StringType())
])))])


def _spans(model, texts: pa.Array) -> list[pa.Array]:
    """Runs of words with one language, text by text."""
    model = Model(*model.value)
    data, offsets = W.text_buffers(texts)
    starts, ends, words, langs, counts = [], [], [], [], []
    for low, high in W.groups(offsets):
        edges = offsets[low : high + 1] - offsets[low]
        parts = W.split_words(data, offsets[low : high + 1], LETTER, lower=True)
        n = np.diff(parts.first)
        if not len(parts.starts) or not model.langs:
            counts.append(np.zeros(high - low, np.int64))
            continue
        doc = np.repeat(np.arange(high - low), n)
        gamma, _ = posteriors(model, emissions(model.weights, word_features(parts)), np.diff(doc, prepend=-1) > 0)
        best = gamma.argmax(axis=1)
        new = np.ones(len(best), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (best[1:] != best[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(best)) - 1
        points = np.concatenate(([0], np.cumsum((parts.data < 0x80) | (parts.data >= 0xC0))))  # code points up to each byte
        base = points[edges[:-1]][doc[first]]
        starts.append(points[parts.starts[first]] - base)
        ends.append(points[parts.ends[last]] - base)
        words.append(last - first + 1)
        langs.append(np.array(model.langs, dtype=object)[best[first]])
        counts.append(np.bincount(doc[first], minlength=high - low))
    whole = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
    values = pa.StructArray.from_arrays(
        [whole(starts, pa.int64()), whole(ends, pa.int64()), whole(words, pa.int64()), whole(langs, pa.string())], names=["start", "end", "words", "lang"]
    )
    return [lists(values, np.concatenate(counts))]


def language_spans(docs: DataFrame, model: Model, *, text: str = "text", keep=None) -> DataFrame:
    """``row`` (a struct of the kept columns of docs, default all) and ``found.spans``: where the languages of a text lie.

    Every word gets the language of its largest posterior, the first by name in a tie; a span (start, end, words, lang) is a
    run of words of one language, in code points, from the start of its first to the end of its last word. Words are runs
    of letters; texts without any, and null texts, have no spans, and so has everything if the model knows no language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    return map_text(docs, named(text), SPANS, lambda texts: _spans(sent, texts), keep)
