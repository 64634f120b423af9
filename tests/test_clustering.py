import numpy as np
from pyspark.sql import functions as F

from colloquy.operators import clustering

ROWS = "grp string, id long, cluster long, vector array<double>"


def vectors(seed, sizes):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g, n in sizes.items():
        centres = rng.standard_normal((3, 5))
        for _ in range(n):
            rows.append((g, k, int(rng.integers(0, 3)), (centres[rng.integers(0, 3)] + 0.6 * rng.standard_normal(5)).tolist()))
            k += 1
    return rows


def unit(rows):
    x = np.array([r[3] for r in rows])
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def merged(rows, clusters):
    """Average linkage one pair at a time over the matrix of all distances."""
    x = unit(rows)
    d = 1 - x @ x.T
    parts = [[k] for k in range(len(rows))]
    while len(parts) > max(2, min(clusters, len(rows))):
        i, j = min(((a, b) for a in range(len(parts)) for b in range(a)), key=lambda p: d[np.ix_(parts[p[0]], parts[p[1]])].mean())
        parts[j] += parts.pop(i)
    return {frozenset(rows[k][1] for k in p) for p in parts}


def test_average_linkage_against_one_pair_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK", 6)
    rows = vectors(1, {"a": 22, "b": 9, "c": 2, "d": 1})
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    for k in (2, 4):
        out = clustering.average_linkage(df.drop("cluster"), k).collect()
        for g in "abcd":
            found = {}
            for r in out:
                if r["grp"] == g:
                    found.setdefault(r["cluster"], set()).add(r["id"])
            assert set(map(frozenset, found.values())) == merged([r for r in rows if r[0] == g], k)
            assert [min(v) for _, v in sorted(found.items())] == sorted(min(v) for v in found.values())
    heights = [(r["grp"], r["height"]) for r in clustering.linkage(df.drop("cluster")).orderBy("grp", "height", "round").collect()]
    assert len(heights) == 21 + 8 + 1
    assert clustering.average_linkage(df.drop("cluster").limit(0), 3).count() == 0


def test_silhouette_and_confidence_against_all_pairs(spark):
    rows = [*vectors(2, {"a": 30, "b": 12}), ("c", 900, 0, [1.0, 0.0, 0.0, 0.0, 0.0]), ("c", 901, 0, [0.0, 1.0, 0.0, 0.0, 0.0]), ("d", 902, 1, [0.0, 1.0, 0.0, 0.0, 0.0]), ("a", 903, 9, [1.0, 1.0, 0.0, 0.0, 0.0]), ("b", 904, 0, [0.0] * 5)]
    df = spark.createDataFrame(rows, ROWS)
    got = {r["id"]: r["silhouette"] for r in clustering.silhouette(df).collect()}
    sure = {r["id"]: r["confidence"] for r in clustering.centroid_confidence(df).collect()}
    for g in "abcd":
        own = [r for r in rows if r[0] == g]
        x = unit(own)
        d, labels = 1 - x @ x.T, np.array([r[2] for r in own])
        for k, r in enumerate(own):
            same = [j for j in range(len(own)) if labels[j] == r[2] and j != k]
            others = [d[k][labels == c].mean() for c in set(labels.tolist()) - {r[2]}]
            want = 0.0 if not same or not others else (min(others) - d[k][same].mean()) / max(min(others), d[k][same].mean())
            assert abs(got[r[1]] - want) < 1e-9
            sums = np.array([x[labels == c].sum(axis=0) for c in sorted(set(labels.tolist()))])
            sims = np.sort((sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)) @ x[k])[::-1]
            assert abs(sure[r[1]] - (1.0 if len(sims) == 1 else min(1.0, max(0.0, (sims[0] - sims[1] + 1) / 2)))) < 1e-9


def test_two_means_against_a_loop(spark):
    rows = vectors(3, {"a": 25, "b": 7, "c": 1})
    df = spark.createDataFrame(rows, ROWS).withColumn("place", -F.col("id"))
    got = {r["id"]: (r["cluster"], r["overlap"]) for r in clustering.two_means(df, high=0.4, second=0.1, lead=0.5).collect()}
    for g in "abc":
        own = sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        x = unit(own)
        c = [x[0], x[-1]]
        for _ in range(8):
            labels = (x @ c[1] > x @ c[0]).astype(int)
            for k in (0, 1):
                if (labels == k).any():
                    m = x[labels == k].sum(axis=0)
                    c[k] = m / np.linalg.norm(m)
        for r, v, label in zip(own, x, labels):
            high, low = sorted((v @ c[0], v @ c[1]), reverse=True)
            assert got[r[1]] == (label, bool(len(own) > 1 and high >= 0.4 and low >= 0.1 and high - low < 0.5))
    assert {o for _, o in got.values()} == {True, False}
