"""Quantiles, running totals, cuts, splits and folds against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import rank, split


def frame(spark, values, column="x"):
    return spark.createDataFrame([(v,) for v in values], f"{column} double")


def quantiles(df, probabilities, **options):
    row = rank.exact_quantiles(df, "x", probabilities, **options).first()
    return row["n"], list(row["quantiles"])


CASES = {
    "one value": [3.0],
    "two values": [1.0, 4.0],
    "all equal": [2.5] * 50,
    "hot value": [1.0] * 700 + [float(i) for i in range(300)],
    "negative": [-float(i * i) for i in range(101)],
    "spread": [math.sin(i) * 10**(i % 7) for i in range(997)],
}


NUMBERS = [0.0, -0.0, 1.0, -1.0, 0.1, 1 / 3, 1e300, -1e300, 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 1.7976931348623157e308, math.inf, -math.inf, 1e-310]


def test_order_key(spark):
    """Keys order as the numbers do, are those of the bits, and give the numbers back."""
    rng = np.random.default_rng(1)
    values = NUMBERS + rng.integers(-(2**63), 2**63, 3000).view(np.float64).tolist() + [2.0**i for i in range(-1074, 1024, 7)]
    values += [np.nextafter(2.0**i, 0) for i in range(-1021, 1024, 5)] + [np.nextafter(2.0**i, math.inf) for i in range(-1021, 1023, 5)]
    values = [float(v) for v in values if not math.isnan(v)]
    for r in rank.with_order_key(frame(spark, values), "x", "k").withColumn("back", rank.key_value(F.col("k"))).collect():
        bits = int(np.array(abs(r["x"])).view(np.int64))
        assert r["k"] == (-bits if r["x"] < 0 else bits) and r["back"] == r["x"]
    both = rank.with_order_key(frame(spark, [math.nan, math.inf]).withColumn("size", F.lit(1)), "x")
    assert both.columns == ["x", "size", "key"] and both.orderBy("key").first()["x"] == math.inf


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_exact_quantiles(spark, name, broadcast, monkeypatch):
    monkeypatch.setattr(rank, "BROADCAST_ROWS", broadcast)
    values = CASES[name]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    n, found = quantiles(frame(spark, values).repartition(3), probabilities)
    assert n == len(values)
    assert found == pytest.approx(list(np.percentile(values, [100 * p for p in probabilities])), rel=1e-12)


def test_quantiles_of_hot_and_odd_groups(spark):
    """A hot group, a hot value, infinities, numbers that differ in the last bit, and names that clash with helpers."""
    near = [1.0 + i * 2.0**-52 for i in range(64)]
    groups = {"hot": [float(i % 977) for i in range(20000)] + [7.5] * 9000, "inf": [math.inf] * 3 + [-math.inf] * 2 + [0.0],
              "near": near, "one": [5e-324], "zeros": [0.0, -0.0, 0.0, -1e-320]}
    rows = [(g, v, "x") for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "`g.0` string, key double, at string").repartition(5)
    found = {r["g.0"]: (r["n"], r["quantiles"]) for r in rank.exact_quantiles(df, "key", [0.0, 0.3, 0.5, 1.0], by=["g.0"]).collect()}
    for g, values in groups.items():
        with np.errstate(invalid="ignore"):
            wanted = [sorted(values)[0], None, float(np.median(values)), sorted(values)[-1]]
        assert found[g][0] == len(values)
        for i in (0, 3) if g == "inf" else (0, 2, 3):
            assert found[g][1][i] == pytest.approx(wanted[i], rel=1e-15, abs=0)
    assert found["hot"][1][1] == pytest.approx(float(np.percentile(groups["hot"], 30)))


def test_exact_quantiles_skip_missing_and_group(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", None), ("a", float("nan")), ("b", 7.0), (None, 100.0)]
    rows += [("c", float(i)) for i in range(1000)] + [("c", 5.0)] * 500
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    found = {r["g"]: (r["n"], r["quantiles"][0]) for r in rank.exact_quantiles(df, "x", [0.5], by=["g"]).collect()}
    median = float(np.median([i for i in range(1000)] + [5] * 500))
    assert found == {"a": (2, 1.5), "b": (1, 7.0), "c": (1500, median)}


def test_quantiles_of_nothing(spark):
    assert rank.exact_quantiles(frame(spark, []), "x", [0.5]).collect() == []


@pytest.mark.parametrize("rows_per_task", [1, 3, 1_000_000])
@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_cross_cells(spark, rows_per_task, descending):
    """``rows_per_task=1`` reads all four digits."""
    counts = Counter()
    for i in range(400):
        counts[float(i % 40) / 7 - 2] += i % 3
    counts |= {math.inf: 5, -1e300: 1, 1.0: 2, math.nextafter(1.0, 2): 3}
    df = spark.createDataFrame(list(counts.items()), "`v.at` double, s long").repartition(3)
    totals = rank.running_totals(df, "v.at", ["s"], descending, rows_per_task)
    assert totals.columns == ["v.at", "s", "cum_s", "total_s", "next_s"]
    found = {r["v.at"]: r for r in totals.collect()}
    total, ordered = 0, sorted(counts, reverse=descending)
    for i, v in enumerate(ordered):
        total += counts[v]
        assert found[v]["cum_s"] == total
        assert found[v]["total_s"] == sum(counts.values())
        assert found[v]["next_s"] == (counts[ordered[i + 1]] if i + 1 < len(ordered) else None)


def digest(*parts, seed=7):
    return hashlib.md5("|".join([str(seed), *map(str, parts)]).encode()).hexdigest()


def test_find_cuts(spark):
    hashes = sorted([digest(i) for i in range(3000)] + [digest(5)] * 200 + [digest(9)[:8] + "0" * 24] * 3 + [digest(9)[:4] + "f" * 28])
    df = spark.createDataFrame([(h,) for h in hashes], "key string").repartition(3)
    ranks = [0, 1, 1500, 2999, 3199, hashes.index(digest(5)) + 77, hashes.index(digest(9)), hashes.index(digest(9)) - 1, len(hashes), 9000]
    n, cuts = rank.find_cuts(df, F.col("key"), ranks)
    assert n == len(hashes)
    for at, cut in zip(ranks, cuts):
        if at >= n:
            assert cut is None
        else:
            assert (cut.hash, cut.start, cut.rows) == (hashes[at], hashes.index(hashes[at]), hashes.count(hashes[at]))
    assert rank.find_cuts(df, F.col("key"), lambda n: [n - 1])[1][0].hash == hashes[-1]
    assert rank.find_cuts(df.filter("false"), F.col("key"), [0, 5]) == (0, [None, None])


CLASHING = "a long, hash string, _hash string, bucket int, c string, h string, row string, `dot.ted` int, split int, fold int, many int, chunk int"


def clashing(spark, n, copies=1):
    return spark.createDataFrame([(i, "h", "_h", i % 7, "abc"[i % 3], "x", "r", i % 2, i, i, 1, 2) for i in range(n)] * copies, CLASHING)


def test_helper_names_do_not_clash(spark):
    df = clashing(spark, 90)
    before = Counter(tuple(r) for r in df.drop("split", "fold").collect())
    for out, column in ((split.split_exact(df, "a", train=0.3), "split"), (split.assign_folds(df, "a", 3, stratify="c"), "fold"),
                        (split.assign_folds(df, "a", 3), "fold"), (split.split_counts(df, "a", 20, 70), "split")):
        assert Counter(tuple(r) for r in out.drop("split", "fold").collect()) == before
        assert set(out.columns) == set(df.columns) and column in out.columns
    assert split.sample_n(df, "a", 10).columns == df.columns
    copies = split.split_exact(clashing(spark, 3, 40), train=0.5)  # copies lie across the cut
    assert Counter(tuple(r) for r in copies.drop("split").collect()) == Counter(tuple(r) for r in clashing(spark, 3, 40).drop("split").collect())
    assert {r["split"]: r["n"] for r in split.split_sizes(copies).collect()} == {"train": 60, "test": 60}


def test_cuts_take_three_scans(spark, tmp_path, monkeypatch):
    """However many cuts there are."""
    jobs = []
    cells = rank._cells
    monkeypatch.setattr(rank, "_cells", lambda *a: jobs.append(a) or cells(*a))
    split._segments(spark.range(5000), ["id"], 1, [(str(i), 100) for i in range(40)], "part").count()
    assert len(jobs) == 3


def test_folds_of_copies(spark, monkeypatch):
    """200,000 equal rows, and as many of one key, are dealt out evenly by several tasks."""
    monkeypatch.setattr(split, "ROWS_PER_BUCKET", 1 << 14)
    same = spark.range(200_000).selectExpr("1L AS k", "'a' AS c", "0L AS v")
    rows = same.union(spark.range(100_000).selectExpr("2L AS k", "'b' AS c", "id AS v")).union(spark.range(20_000).selectExpr("id + 10 AS k", "'a' AS c", "id AS v"))
    for key in (["k", "c", "v"], ["k"]):
        folds = split.assign_folds(rows, key, 7, 3, stratify="c")
        counts = folds.groupBy("c", "fold").count().collect()
        for c, n in (("a", 220_000), ("b", 100_000)):
            sizes = [r["count"] for r in counts if r["c"] == c]
            assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and len(sizes) == 7
        assert folds.groupBy("k", "c", "v").count().exceptAll(rows.groupBy("k", "c", "v").count()).count() == 0
        largest = folds.filter("k = 1").select(F.spark_partition_id().alias("p")).groupBy("p").count()
        assert largest.count() >= 3


def test_split_exact_sizes_and_order(spark):
    df = spark.range(1001)
    parts = split.split_exact(df, "id", train=0.8, seed=7)
    train = {r["id"] for r in parts.filter("split = 'train'").collect()}
    test = {r["id"] for r in parts.filter("split = 'test'").collect()}
    assert train == set(sorted(range(1001), key=lambda i: digest(i))[:800])
    assert train | test == set(range(1001)) and not train & test
    sizes = {r["split"]: r["n"] for r in split.split_sizes(split.split_exact(df, "id", test=0.25, seed=1)).collect()}
    assert sizes == {"test": 251, "train": 750}


def test_split_edges(spark):
    df = spark.range(10)
    assert split.split_exact(df, "id", train=1.0).filter("split = 'train'").count() == 10
    assert split.split_exact(df, "id", train=0.0).filter("split = 'test'").count() == 10
    with pytest.raises(ValueError):
        split.split_exact(df, "id")


def test_split_repeated_rows_is_whole(spark):
    rows = [(1, None)] * 900 + [(2, "b")] * 50 + [(i, "c") for i in range(3, 53)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(3)
    for train in (0.1, 0.33, 0.5, 0.95):
        parts = split.split_exact(df, train=train, seed=3)
        sizes = {r["split"]: r["n"] for r in split.split_sizes(parts).collect()}
        assert sizes == {"train": math.floor(train * 1000), "test": 1000 - math.floor(train * 1000)}
        back = Counter((r["a"], r["b"]) for r in parts.collect())
        assert back == Counter(rows)


def test_copies_across_two_cuts(spark):
    df = spark.createDataFrame([(1,)] * 100, "a long")
    sizes = {r["split"]: r["n"] for r in split.split_sizes(split.split_counts(df, None, 30, 50)).collect()}
    assert sizes == {"train": 30, "validation": 50}


def test_key_that_does_not_identify_rows(spark):
    df = spark.createDataFrame([(1, i) for i in range(100)], "k long, v long")
    for frame in (df, df.union(df.filter("v < 30"))):
        parts = split.split_exact(frame, "k", train=0.3)
        n = frame.count()
        sizes = {r["split"]: r["n"] for r in split.split_sizes(parts).collect()}
        assert sizes == {"train": int(0.3 * n), "test": n - int(0.3 * n)}
        assert sorted(r["v"] for r in parts.collect()) == sorted(r["v"] for r in frame.collect())
    sizes = {r["split"]: r["n"] for r in split.split_sizes(split.split_counts(df, "k", 20, 30)).collect()}
    assert sizes == {"train": 20, "validation": 30}


@pytest.mark.parametrize("rows", [[("a|b", "c"), ("a", "b|c")], [(None, "x"), ("\\N", "x")], [("a\\", "b"), ("a", "\\b")]])
def test_rows_with_like_texts(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    assert {r["split"]: r["n"] for r in split.split_sizes(split.split_exact(df, train=0.5)).collect()} == {"train": 1, "test": 1}


def test_stratified_folds_keep_rows(spark):
    df = spark.createDataFrame([(i, [None, "\\N", "x"][i % 3]) for i in range(99)], "i long, c string")
    folds = split.assign_folds(df, "i", 3, 1, stratify="c").collect()
    assert sorted(r["i"] for r in folds) == list(range(99))
    for c in (None, "\\N", "x"):
        assert [sum(r["fold"] == f for r in folds if r["c"] == c) for f in range(3)] == [11, 11, 11]


def test_sample_n(spark):
    df = spark.range(500)
    found = {r["id"] for r in split.sample_n(df, "id", 40, seed=7).collect()}
    assert found == set(sorted(range(500), key=lambda i: digest(i))[:40])
    assert split.sample_n(df, "id", 900, seed=7).count() == 500


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    one = split.split_exact(df.coalesce(1), "id", train=0.3, seed=5)
    many = split.split_exact(df.repartition(7), "id", train=0.3, seed=5)
    assert one.exceptAll(many).count() == 0


def test_folds(spark):
    rows = [(i, None if i % 50 == 0 else "ab"[i % 3 == 0]) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, c string")
    plain = split.assign_folds(df, "id", 5, 7)
    assert plain.count() == 1003
    assert all(160 < r["count"] < 240 for r in plain.groupBy("fold").count().collect())
    dealt = split.assign_folds(df, "id", 5, 7, stratify="c").groupBy("c", "fold").count().collect()
    for c in (None, "a", "b"):
        sizes = [r["count"] for r in dealt if r["c"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    totals = Counter()
    for r in dealt:
        totals[r["fold"]] += r["count"]
    assert sum(totals.values()) == 1003 and max(totals.values()) - min(totals.values()) <= 1


def test_split_random_is_seeded(spark):
    df = spark.range(1000).repartition(2)
    first, again = (split.split_random(df, [0.7, 0.3], 100)[0] for _ in range(2))
    assert first.exceptAll(again).count() == 0
    assert 600 < first.count() < 800


def test_hash_of_null_is_not_hash_of_text(spark):
    df = spark.createDataFrame([(None,), ("",)], "a string")
    from millrace.functions import row_hash

    assert df.select(row_hash(["a"], 1).alias("h")).agg(F.countDistinct("h")).first()[0] == 2


def test_infinity_in_quartiles(spark):
    from millrace.operators import clean, profile

    df = spark.createDataFrame([(float("inf"),)] * 4 + [(1.0,)], "v double")
    fences = profile.iqr_fences(df, "v").first()
    assert (fences["q1"], fences["q3"], fences["iqr"]) == (float("inf"), float("inf"), 0.0)
    assert clean.drop_outliers(df, "v").count() == 4
