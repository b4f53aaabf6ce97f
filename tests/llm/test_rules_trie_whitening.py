"""Quality rules, prefix trie and whitening against brute force, on odd rows and on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import linerules, prefixtrie, queries, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Quality rules


def base_counts(text):
    text = text or ""
    words, seen, repeated = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def failing(line):
    """The rules that a line fails, one by one."""
    words = WORD.findall(line)
    if not words:
        return set()
    marked = sum(bool(re.search(r"[#*$%&|<>]", w)) or w.endswith(("!!", "??")) for w in words)
    parted = sum(set(w) <= set("|<>") for w in words)
    out = set()
    if not words[-1].endswith((*linerules.ENDINGS, *linerules.LONG_ENDINGS)) or 5 * marked > len(words):
        out.add("unpunctuated")
    if parted and 5 * parted >= len(words):
        out.add("navigation")
    if any(p in line.translate({c: c + 32 for c in range(65, 91)}) for p in linerules.PHRASES):
        out.add("boilerplate")
    return out


LINES = [
    "A plain line that ends well.", "No end", "Home | About us | Contact.", "Read More about it here.", "", " \t ", "Wörter “so.”", "等等。",
    "What?? Now!! Yes.", "one##", "| | |", "»", "skip to", "content that goes on.", "All rights reserved. Not a phrase.", "ends with …", "x\r.",
]


def test_line_rules(spark, small, odd_rows):
    texts = ["\n".join(LINES), "\n".join(reversed(LINES)), "\n", "No end\nNo end", "x", LINES[0] + "\nNo end", "No end\n" + LINES[0]]
    texts += LINES + [a + "\n" + b for a in LINES for b in LINES[::3]]
    rows = [(i, t, "en", None) for i, t in enumerate(texts)] + [(1000 + (r[0] or 0), *r[1:]) for r in odd_rows] + [(None, None, None, None)]
    found = linerules.clean_lines(small(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        text, f = r["row"]["text"] or "", r.found
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == base_counts(text)
        lines = text.split("\n")
        fails = [failing(x) for x in lines]
        for rule in ("unpunctuated", "navigation", "boilerplate"):
            assert f[f"n_{rule}"] == sum(rule in x for x in fails), (rule, text[:200])
        assert f.n_lines == len(lines) and f.n_removed == sum(map(bool, fails))
        assert f.lost_chars == sum(len("".join(WORD.findall(x))) for x, bad in zip(lines, fails) if bad)
        assert f.cleaned == "\n".join(x for x, bad in zip(lines, fails) if not bad)
        assert r["row"]["a.b"] == 1 and r["row"]["row"] == "y"
    assert linerules.clean_lines(small([])).count() == 0


def test_line_rules_in_groups(monkeypatch):
    """Texts that lie in different groups of a batch."""
    import pyarrow as pa

    monkeypatch.setattr(linerules.W, "GROUP_BYTES", 20)
    monkeypatch.setattr(linerules.W.groups, "__defaults__", (20,))
    texts = ["a b.\nNo end", None, "", "one | two | three.\nGood line.", "x y z.\nx y z.", "\n\n"]
    out = linerules._judged(True)(pa.array(texts))
    assert out[0].to_pylist() == [4, 0, 0, 7, 6, 0]
    assert out[-1].to_pylist() == ["a b.", "", "", "Good line.", "x y z.\nx y z.", "\n\n"]


def test_keep_clean(spark, small):
    good = " ".join(f"word{i}" for i in range(20)) + "."
    docs = small([(1, good + "\nHome | Next", "en", "a"), (2, "Few words.", "en", "a"), (3, good.replace(" ", "## "), "en", "a"), (4, None, None, None)])
    kept = linerules.keep_clean(docs).collect()
    assert [(r.doc_id, r.text, r["a.b"], r.found) for r in kept] == [(1, good, 1, "x")]
    assert linerules.keep_clean(docs).columns == docs.columns


def test_rules_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op13_rules"](spark, sf).collect()}
    assert set(found) == {d.doc_id for d in docs}
    for d in docs:
        r, base = found[d.doc_id], base_counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        lost = sum(len("".join(WORD.findall(x))) for x in (d.text or "").split("\n") if failing(x))
        assert r.lost_chars == lost and r.kept == (not r.base_failed and 2 * lost <= base[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    passed = [r for r in found.values() if not r.base_failed and r.doc_id in labels]
    assert sum(r.kept == (labels[r.doc_id] == 1) for r in passed) >= 0.98 * len(passed)


# Prefix trie


def told(rows):
    """(conv_id, turns) by plain sorting; ties of a turn don't occur here."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(own[c])] for c in own}


def shared_heads(own):
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def trie(built):
    nodes, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0) + sum(saved[x] for x in children[k])
    ends = {k: ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))) for k, m in nodes.items()}
    return sorted((
        min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()
    ) for k, m in nodes.items())


def nodes_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[:2])


TURNS = "conv_id long, turn long, role string, text string, depth string, `n.convs` int"


def made_up(seed):
    """Conversations over few texts, so that prefixes are shared at every depth; some long, some equal, some without heads."""
    rng, rows = np.random.default_rng(seed), []
    for conv in [*range(0, 330, 3), 700, 755, 1234, 1_000_007]:
        n = int(rng.choice([1, 2, 3, 5, 9, 40]))
        turns = rng.permutation(n) - 1
        for t in turns:
            said = None if rng.random() < 0.1 else "é😀" * int(rng.integers(0, 2)) + "ab"[int(rng.integers(0, 2))]
            rows.append((conv, None if t < 0 else int(t), "user" if t % 2 else None, said, "x", 1))
    rows += [(c, t, "user", "same text", "x", 1) for c in range(2001, 2099) for t in range(20)]  # heads are absent
    return rows + [(None, 1, "user", "no id", "x", 1)]


@pytest.mark.parametrize("shard_rows, block", [(1 << 16, 16), (40, 4), (7, 1), (300, 3)])
def test_trie(spark, shard_rows, block):
    rows = made_up(shard_rows)
    df = spark.createDataFrame(rows, TURNS)
    own = told(r[:4] for r in rows)
    plain = prefixtrie.prefix_trie(prefixtrie.as_rows(df), shard_rows=shard_rows, block=block)
    assert nodes_of(plain) == trie(own)
    assert nodes_of(prefixtrie.prefix_trie(prefixtrie.rebuilt(df), shard_rows=shard_rows, block=block)) == trie(shared_heads(own))


def test_trie_of_odd_rows(spark):
    df = spark.createDataFrame([(5, 1, "a", "b", "", 1)] * 3 + [(5, None, None, None, "", 1), (7, 0, "a", "b", "", 1), (7, 0, "a", "b", "", 1)], TURNS)
    own = {5: [("", "")] + [("a", "b")] * 3, 7: [("a", "b")] * 2}
    assert nodes_of(prefixtrie.prefix_trie(prefixtrie.as_rows(df))) == trie(own)
    assert prefixtrie.prefix_trie(prefixtrie.rebuilt(df.filter("false"))).count() == 0
    assert prefixtrie.prefix_trie(prefixtrie.as_rows(df.withColumn("conv_id", F.lit(None).cast("long")))).count() == 0
    turnless = prefixtrie.as_rows(df).withColumn("turns", F.slice("turns", 1, 0))  # all end at the root
    assert nodes_of(prefixtrie.prefix_trie(turnless, shard_rows=1)) == trie({5: [], 7: []})


def test_trie_keeps_few_edges(spark):
    """A hot conversation in many shards: edge nodes are a path for each shard, not all nodes."""
    df = spark.createDataFrame([(c, t, "user", f"turn {t}", "", 1) for c in range(1000) for t in range(4)], TURNS)
    made = nodes_of(prefixtrie.prefix_trie(prefixtrie.as_rows(df), shard_rows=100))
    assert made == trie(told((c, t, "user", f"turn {t}") for c in range(1000) for t in range(4)))


def test_trie_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    df = queries.QUERIES["op12_trie"](spark, sf)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert nodes_of(df) == trie(shared_heads(told(rows)))


# Whitening


def counted(vectors, dimension):
    """Kept rows and their entries in whole steps, one by one."""
    out = []
    for i, e in vectors:
        if e is not None and len(e) == dimension and all(x is not None and np.isfinite(x) for x in e):
            out.append((i, [int(np.floor(64 * float(x))) + 1_000_000 for x in e]))
    return out


def check_whitening(df, vectors, dimension, keep, tolerance=1e-9):
    model = whitening.fit_whitening(df)
    found = whitening.whiten(df, model).collect()
    kept = counted(vectors, dimension)
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    assert (model.n, list(model.sums)) == (n, list(s))
    a = (fit * n - s).astype(float) / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1]
    assert len(model.variances) == keep
    assert np.allclose(model.variances, e[:keep], rtol=1e-9) and np.isclose(model.total, e.sum())
    assert model.identity_error < 1e-9
    assert sorted(r["row"]["vec_id"] for r in found) == sorted(i for i, _ in kept)
    by_id = dict(kept)
    for r in found:
        x = by_id[r["row"]["vec_id"]]
        exact = sum((n * c - t) ** 2 for c, t in zip(x, s))
        assert r.deviation == (exact if exact < 1 << 63 else None)
        y = np.array([n * c - t for c, t in zip(x, s)], float) / n
        mine = np.array(r.whitened)
        assert np.allclose(mine, y @ (model.components / np.sqrt(model.variances)), atol=1e-9)
    gaps = np.abs(np.diff(e[: keep + 1])).min() / e[0] if keep else 0
    if gaps > 1e-6:  # single eigenvectors are settled
        assert np.allclose(np.abs((model.components * q[:, :keep]).sum(axis=0)), 1, atol=tolerance)
    return model


VECTORS = "vec_id long, embedding array<double>, whitened string, `a.b` int"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.standard_normal(5) * [9, 4, 2, 1, 0.5]).tolist()) for i in range(60)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1.0] * 4), (106, [1e300] * 5)]
    rows = [(*r, "x", 1) for r in good + good[:20] + odd]
    df = spark.createDataFrame(rows, VECTORS)
    check_whitening(df.dropDuplicates(["vec_id"]), good, 5, 5)
    out = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    assert len(out) == 80 and out[0]["row"]["a.b"] == 1  # repeated rows come out each


def test_whitening_without_spread(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25], "", 1), (2, [0.5, 0.25], "", 1)], VECTORS)
    model = whitening.fit_whitening(df)
    assert (model.n, model.variances.size, model.total) == (1, 0, 0.0)
    assert [(r.deviation, r.whitened) for r in whitening.whiten(df, model).collect()] == [(0, [])] * 2
    for none in (df.filter("false"), df.withColumn("embedding", F.lit(None).cast("array<double>"))):
        assert whitening.fit_whitening(none) is None
        assert whitening.whiten(none, None).count() == 0


def test_whitening_of_few_directions(spark):
    """Vectors on a plane in six dimensions, and equal variances: as many components as directions."""
    rng = np.random.default_rng(5)
    plane = np.array([[1, 0, 0, 1, 0, 0], [0, 2, 0, 0, 0, -2]])
    vectors = [(i, (rng.integers(-50, 50, 2) @ plane / 64.0).tolist()) for i in range(200)]
    check_whitening(spark.createDataFrame([(*v, "", 1) for v in vectors], VECTORS), vectors, 6, 2)
    cube = [(i, [(1.0 if i >> b & 1 else -1.0) for b in range(4)]) for i in range(16)]
    check_whitening(spark.createDataFrame([(*v, "", 1) for v in cube], VECTORS), cube, 4, 4)


def test_exact_deviations_beyond_64_bits(spark):
    vectors = [(i, [2.0**42 * i, float(i % 3)]) for i in range(8)]
    check_whitening(spark.createDataFrame([(*v, "", 1) for v in vectors], VECTORS), vectors, 2, 1)


def test_bidiagonalisation_settles_early():
    """Many dimensions, a falling spectrum: fewer steps than dimensions, components to double precision."""
    rng = np.random.default_rng(7)
    a = rng.standard_normal((400, 120)) * 0.8 ** np.arange(120) @ np.linalg.qr(rng.standard_normal((120, 120)))[0]

    def step(v, b, vector, before):
        left = whitening._left_vectors(a, v, b)
        u = a @ vector - left @ before
        return left.T @ u, a.T @ u, u @ u, np.vdot(a, a)

    found, deviations, total, steps = whitening.bidiagonalise(step, 120, 16)
    s, q = np.linalg.svd(a)[1:]
    assert steps < 80 and np.allclose(deviations, s[:16], rtol=1e-12) and np.isclose(total, (s**2).sum())
    assert np.allclose(np.abs((found * q[:16].T).sum(axis=0)), 1, atol=1e-12)


def test_whitening_query(spark, sf):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    kept = counted(vectors, 64)
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, s = len(fit), fit.sum(axis=0)
    a = (n * fit - s) / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1][:, :16]
    df = queries.QUERIES["op11_whiten"](spark, sf).toPandas().sort_values(["vec_id", "component"])
    assert len(df) == 16 * len(kept) and list(df.component[:16]) == list(range(1, 17))
    x = np.array([v for _, v in sorted(kept)])
    y = (n * x - s) / n @ q / np.sqrt(e[:16])
    mine = df.whitened.to_numpy().reshape(-1, 16)
    assert np.allclose(mine * np.sign((mine * y).sum(axis=0)), y, atol=1e-8)
    assert (df.deviation.to_numpy().reshape(-1, 16) == ((n * x - s) ** 2).sum(axis=1)[:, None]).all()
    assert set(df.n) == {n} and np.allclose(df.explained[:16], e[:16] / e.sum(), rtol=1e-9)
    assert df.identity_error.nunique() == 1 and 0 <= df.identity_error.iloc[0] < 1e-9
