"""Bradley-Terry quality scores: learnt from preference pairs, cut at a score quantile.

Every pair sets a document of label 1 against one of label 0. The model says that document i is preferred to j
with probability ``sigmoid(w . (x_i - x_j))``; ``w`` is fitted by logistic loss on feature differences (no
intercept, as it cancels out). A document's strength is ``w . x``, which needs no pair. The cut is the quantile of
the strengths at the share of label 0, over all labelled rows outside the held-out ones, also where the fit takes a
sample of them; scores are strengths mapped to 0..1 with the cut at ``CUT``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as W
from millrace.llm.arrow import map_text, named
from millrace.llm.tables import written
from millrace.operators.rank import exact_quantiles

#: Labelled rows that a fit uses, about, at most; a hash of the id chooses them.
SAMPLE = 20_000
#: Preference pairs for each row of a fit, about: a fit's pairs grow with its rows, which SAMPLE bounds.
PAIRS_PER_ROW = 5
#: Score at the learnt cut: documents from here on are predicted to be of label 1.
CUT = 0.7
#: Bytes of text whose features are taken at a time: working arrays are some 50 times as large.
FEATURE_BYTES = 512 << 10
#: Weight of the squared weights in the loss, per pair.
PENALTY = 1e-4


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=np.int8)
    out[list(chars.encode())] = 1
    return out


# The characters that are counted. Bytes of non-ASCII characters count as letters.
UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER + _bytes("abcdefghijklmnopqrstuvwxyz")
LETTER[0x80:] = 1
MARK = _bytes("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
CLASSES = {"upper": UPPER, "letter": LETTER, "mark": MARK, "digit": _bytes("0123456789"), "stop": _bytes(".!?"), "line": _bytes("\n")}

FEATURES = (
    *(f"{name}_share" for name in CLASSES),
    "log_words", "word_bytes", "distinct_words", "distinct_triples", "bare_marks", "marked_words", "shouted_words",
    "capital_words", "joined_lines",
)
VECTOR = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])
SCORE = T.StructType([T.StructField("score", T.DoubleType())])
STRENGTH = T.StructType([T.StructField("strength", T.DoubleType())])


class QualityModel(NamedTuple):
    """Weights of the standardized features, and the strength at the cut."""

    weights: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    cut: float


def _totals(flags: np.ndarray) -> np.ndarray:
    """Running totals, from 0 on."""
    out = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _distinct(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    end = np.cumsum(counts)
    return np.array([len(np.unique(values[e - c : e])) for c, e in zip(counts, end)], np.int64)


def text_features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; all 0 for null and empty texts."""
    data, offsets = W.text_buffers(texts)
    out = [np.empty((0, len(FEATURES)))]
    for low, high in W.groups(offsets, FEATURE_BYTES):
        edges = offsets[low : high + 1]
        parts = W.split_words(data, edges, W.NOT_SPACE, lower=False)
        edges, n_words = edges - edges[0], np.diff(parts.first)
        sums = {k: _totals(v[parts.data]) for k, v in CLASSES.items()}
        n_bytes, words = np.maximum(np.diff(edges), 1), np.maximum(n_words, 1)
        of = {k: s[parts.ends] - s[parts.starts] for k, s in sums.items()}  # in each word
        first_upper = UPPER[parts.data[parts.starts]] if len(parts.starts) else np.empty(0, np.int8)

        def share(flags: np.ndarray) -> np.ndarray:
            total = _totals(flags)
            return (total[parts.first[1:]] - total[parts.first[:-1]]) / words

        places, triples = W.gram_places(parts.first, 3)
        line = sums["line"][edges[1:]] - sums["line"][edges[:-1]]
        rows = [(s[edges[1:]] - s[edges[:-1]]) / n_bytes for s in sums.values()]
        rows += [
            np.log1p(n_words), share(parts.ends - parts.starts),
            _distinct(parts.hashes, n_words) / words,
            _distinct(W.gram_hashes(parts.hashes, 3)[places], triples) / np.maximum(triples, 1),
            share((of["letter"] == 0) & (of["digit"] == 0)), share((of["mark"] >= 2) & (of["letter"] > 0)),
            share((of["upper"] >= 2) & (of["upper"] == of["letter"])), share((first_upper == 1) & (of["upper"] < of["letter"])),
            np.log1p(n_words / (line + 1)),
        ]
        out.append(np.stack(rows, axis=1))
    return np.concatenate(out)


def fit_pairs(x: np.ndarray, label: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, seed: int = 1) -> QualityModel:
    """Weights from pairs of a row of label 1 and a row of label 0, each side drawn in turn from a shuffled list.

    Without rows of label 0 every document is predicted 1, without rows of label 1 none is.
    """
    ones, zeros = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(ones) or not len(zeros):
        nothing = np.zeros(len(FEATURES))
        return QualityModel(nothing, nothing, nothing + 1, 1.0 if len(zeros) else 0.0)
    means, scales = x.mean(axis=0), x.std(axis=0)
    scales = np.where(scales > 1e-9, scales, 1.0)
    z = (x - means) / scales
    rng = np.random.default_rng(seed)
    n = min(pairs_per_row * len(label), len(ones) * len(zeros))
    diff = z[np.resize(rng.permutation(ones), n)] - z[rng.choice(zeros, n)]
    w = np.zeros(z.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        slope = diff.T @ (p - 1) / n + PENALTY * w
        bend = (diff * (p * (1 - p))[:, None]).T @ diff / n + PENALTY * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    strength = np.sort(z @ w)
    k = len(zeros)  # the quantile at the share of label 0
    return QualityModel(w, means, scales, float((strength[k - 1] + strength[k]) / 2))


def strengths(model: QualityModel, x: np.ndarray) -> np.ndarray:
    return ((x - model.means) / model.scales) @ model.weights


def scores(model: QualityModel, x: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1; CUT at the model's cut."""
    strength = strengths(model, x) - model.cut
    return 1 / (1 + np.exp(-np.clip(strength + np.log(CUT / (1 - CUT)), -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may read labels of: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def threshold(share: float) -> int:
    """The 64-bit integer up to which this share of all 64-bit integers lies."""
    return min((1 << 63) - 1, round(share * (1 << 64)) - (1 << 63))


def drawn(share: float, doc_id: Column, seed: int) -> Column:
    """Whether the hash of an id lies in the first ``share`` of all hashes; all ids do if it is one or more."""
    return F.lit(True) if share >= 1 else F.xxhash64(doc_id, F.lit(seed)) <= F.lit(threshold(share))


def fit_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                sample: int = SAMPLE, pairs_per_row: int = PAIRS_PER_ROW, seed: int = 1) -> QualityModel:
    """Learn from labelled documents outside the held-out rows.

    About ``sample`` labelled rows are used for the weights, chosen by a hash of their ids (all, if there are fewer); the
    cut comes from all of them. Labels other than 0 and 1 are ignored. A repeated id counts as often as it is there.
    """
    every = labels.select(named(doc_id).alias("id"), named(label).cast("int").alias("label"))
    every = every.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    share = min(1.0, sample / max(1, every.count()))
    marked = every.filter(drawn(share, F.col("id"), seed))
    mine = docs.select(named(doc_id).alias("id"), named(text).alias("text"))
    # At most about `sample` small rows are broadcast and collected.
    used = mine.join(F.broadcast(marked), "id").select("id", "label", "text")
    rows = map_text(used, F.col("text"), VECTOR, _vectors, ["id", "label"])
    got = rows.select("row.id", "row.label", F.col("found.x").alias("x")).toArrow().to_pandas()
    got = got.assign(key=[tuple(v) for v in got["x"]]).sort_values(["id", "label", "key"])  # one order for any partitioning
    x = np.array(got["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    model = fit_pairs(x, got["label"].to_numpy(), pairs_per_row, seed)
    return model._replace(cut=_whole_cut(mine, every, model)) if share < 1 and model.weights.any() else model


def _whole_cut(docs: DataFrame, marked: DataFrame, model: QualityModel) -> float:
    """The strength halfway between the ranks at the number of rows of label 0, over all labelled documents.

    Documents are scored before the join, so that ids and strengths are shuffled at most, no texts.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(strengths(model, text_features(texts)))]

    scored = map_text(docs, F.col("text"), STRENGTH, run, ["id"]).select("row.id", "found.strength")
    rows = written(scored.join(marked, "id").select("label", "strength"), "strengths")
    n, zeros = rows.agg(F.count("*"), F.count(F.when(F.col("label") == 0, 1))).head()
    return exact_quantiles(rows, "strength", [(zeros - 0.5) / (n - 1)]).head()["quantiles"][0]


def _vectors(texts: pa.Array) -> list[pa.Array]:
    x = text_features(texts)
    return [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))]


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", keep=None) -> DataFrame:
    """``row`` (a struct of the kept columns of docs, default all) and ``found.score`` of every whole text.

    Null and empty texts are scored like any other, with all features 0. Repeated rows get equal scores. Only the
    text is read for a score; other columns pass through.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(scores(model, text_features(texts)))]

    return map_text(docs, named(text), SCORE, run, keep)


def keep_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Documents that the classifier learnt from ``labels`` predicts to be of label 1, with their columns."""
    kept = score_quality(docs, fit_quality(docs, labels, **options), text=options.get("text", "text"))
    return kept.filter(F.col("found.score") >= CUT).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
