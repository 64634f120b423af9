import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import nearest
from colloquy.tables import table

ROWS = "vec_id long, embedding array<float>"


def brute(rows, asked, k, dim):
    """The k nearest of each asked id over all rows that take part."""
    fit = lambda v: v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = [(i, np.array(np.float32(v), np.float64)) for i, v in rows if i is not None and fit(v)]
    out = {}
    for q in {i for i, _ in rows if i in asked}:
        x = min((v.tolist() for i, v in rows if i == q))
        near = sorted((float(np.sqrt(((v - np.array(x)) ** 2).sum())), i) for i, v in rows if i != q)[:k]
        out[q] = near
    return {q: v for q, v in out.items() if v}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        near = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(near) + 1
        near.append((r["score"], r["vec_id"]))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        assert [d for d, _ in got[q]] == pytest.approx([d for d, _ in near], abs=1e-12)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 24)) * 2 + 30
    vectors = (centres[rng.integers(0, 6, 1500)] + rng.standard_normal((1500, 24))).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(k, rows[100][1]) for k in range(2000, 2700)]  # copies
    rows += [(3, rows[4][1]), (3, rows[3][1]), (40, rows[900][1]), (None, rows[5][1]), (5000, None), (5001, []), (5002, [0.0] * 24), (5003, [math.nan] * 24),
             (5004, [math.inf, *[1.0] * 23]), (5005, [None, *[1.0] * 23]), (5006, [1.0] * 7), (5100, [1.0] * 7), (20, [1e30] * 24), (5200, [1e-30] * 24)]
    random.Random(1).shuffle(rows)
    return rows


def test_exact_when_all_lists_are_probed_and_nothing_is_abandoned_early(spark, rows, monkeypatch):
    monkeypatch.setattr(nearest, "EPSILON", 1e9)
    monkeypatch.setattr(nearest, "QUERIES_A_CHUNK", 5)
    df = spark.createDataFrame(rows, ROWS).repartition(4).select("*", F.lit(1).alias("list"), F.lit(2).alias("piece"), F.lit(3).alias("score"), F.lit(4).alias("vector"))
    index = nearest.build_index(df, piece_values=2000)
    asked = {k for k in range(0, 6000, 20)}
    same(found(nearest.search(index, df.where("vec_id % 20 = 0"), probes=1000)), brute(rows, asked, 10, 24))
    assert index.pieces.count() > len(index.centroids) and index.pieces.agg(F.max("n")).first()[0] <= 2000 // 24
    assert index.pieces.agg(F.sum("n")).first()[0] == sum(1 for i, v in rows if i is not None and i not in range(5000, 5200))


def test_recall_with_tests_and_probes(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    index = nearest.build_index(df, sample_values=20_000)
    got, want = found(nearest.search(index, df.where("vec_id % 20 = 0"))), brute(rows, set(range(0, 6000, 20)), 10, 24)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in near} & {i for _, i in got[q]}) for q, near in want.items())
    assert hits >= 0.9 * sum(len(near) for near in want.values())
    assert all(abs(d - math.dist(np.float32(dict(rows)[i]), np.float32(dict(rows)[q]))) < 1e-4 * max(d, 1) for q, near in got.items() if q not in (20, 40) for d, i in near if i not in (3, 20, 40))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    df = table(spark, f"/root/testdata/{sf}", "embeddings").select("vec_id", "embedding")
    rows = [(r[0], list(r[1])) for r in df.collect()]
    asked = df.where("vec_id % 100 = 0")
    got, want = found(nearest.search(nearest.build_index(df), asked)), brute(rows, {r[0] for r in rows if r[0] % 100 == 0}, 10, 64)
    assert sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(100, [1.0, 0.0]), (200, [1.0, 0.0]), (1, [0.0, 2.0])], ROWS)
    assert found(nearest.search(nearest.build_index(few), few.where("vec_id % 100 = 0"))) == {
        100: [(0.0, 200), (math.sqrt(5), 1)], 200: [(0.0, 100), (math.sqrt(5), 1)]
    }
    none = few.limit(0)
    assert nearest.build_index(none) is None
    assert nearest.search(None, few).count() == 0
    assert nearest.search(nearest.build_index(few), none).count() == 0
    one = few.where("vec_id = 1")
    assert nearest.search(nearest.build_index(one), one).count() == 0


def test_candidates_are_abandoned_early():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1000, 64))
    touched = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                touched.append(len(key))
            return super().__getitem__(key)

    blocks = [np.ascontiguousarray(x[:, a : a + 16]).astype(np.float32).view(Counted) for a in range(0, 64, 16)]
    blocks[0] = np.asarray(blocks[0])
    got = list(nearest._scan(x[:1] + 0.01, np.array([-1]), np.array([1.0]), np.arange(1000), x, blocks, np.zeros(64), np.eye(64), 5))
    assert got[0][1] == 0 and sum(touched) < 100
