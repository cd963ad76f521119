import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import ann


def make(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((8, 16))
    x = (centre[rng.integers(8, size=n)] + 0.5 * rng.standard_normal((n, 16))).astype(np.float32)
    x[100:400] = x[50]  # a large group of copies
    x[401:405] = x[400]
    rows = [(int(i), [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] + [1.0] * 15), (2300, [None] + [1.0] * 15), (2400, [float("inf")] * 16), (2500, []), (None, rows[0][1]), (2600, [1.0, 2.0]), (2601, [1.0, 2.5]), (7, rows[7][1])]
    return x, rows + [(i, v, 1) for i, v in odd]


def brute(x, k=10):
    out = {}
    for q in range(0, len(x), 100):
        far = np.sqrt(((x.astype(float)[q] - x.astype(float)) ** 2).sum(1))
        order = [int(i) for i in np.lexsort((np.arange(len(x)), far)) if i != q][:k]
        out[q] = [(i, far[i]) for i in order]
    return out


def test_recall_ranks_and_distances(spark):
    x, rows = make()
    df = spark.createDataFrame([(a, b, c, 9.0) for a, b, c in rows], "vec_id long, embedding array<float>, label int, far double")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0, fill=100).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(x)
    assert set(got) == set(want) | {2600}
    assert sorted(got[2600]) == [(1, 2601, 0.5)]
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert mine == sorted(mine, key=lambda m: (m[2], m[1]))
        for _, i, s in mine:
            assert abs(s - np.sqrt(((x[q].astype(float) - x[i].astype(float)) ** 2).sum())) < 1e-12
        # as near as the true ones counts
        hits += sum(s <= near[-1][1] + 1e-12 for _, _, s in mine)
    assert hits >= 0.9 * 10 * len(want)
    assert [i for _, i, _ in sorted(got[100])] == [50, *range(101, 110)]
    assert [i for _, i, _ in sorted(got[400])][:4] == [401, 402, 403, 404]


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ann.search(df, F.col("vec_id") % 100 == 0).collect()))
    assert [(a, b, c) for a, b, c, _ in got] == [(0, 1, 3), (0, 2, 100), (100, 1, 3), (100, 2, 0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_lonely_and_huge_vectors(spark):
    """Queries far from everything, of rare lengths or with squares that overflow still get all they can."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.standard_normal(8)]) for i in range(1, 300) if i % 100] + [(100, [1e6] * 8), (200, [-3e200] * 8), (300, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 4.0]), (300, [1.0, 2.0, 3.0]), (400, [1e-200] + [0.0] * 7)]
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: len(x) for q, x in got.items()} == {100: 10, 200: 10, 300: 1, 400: 10}
    assert abs(max(s for _, _, s in got[200]) / (3e200 * 8**0.5) - 1) < 1e-12
    near = sorted((np.sqrt(((np.array(v) - 1e6) ** 2).sum()), i) for i, v in rows if len(v) == 8 and i != 100)[:10]
    assert [i for _, i, _ in sorted(got[100])] == [i for _, i in near]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
def test_recall_on_the_test_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = df.toPandas()
    x, ids = np.stack(data["embedding"]).astype(float), data["vec_id"].to_numpy()
    hits = total = 0
    got = ann.search(df, F.col("vec_id") % 100 == 0).toPandas()
    for q, mine in got.groupby("query_id"):
        far = np.sqrt(((x[ids == q][0] - x) ** 2).sum(1))
        edge = np.sort(far[ids != q])[9]
        hits += (mine["score"] <= edge + 1e-12).sum()
        total += 10
        assert len(mine) == 10
    assert hits >= 0.9 * total


def test_an_outlier_does_not_widen_the_rerank(monkeypatch):
    rng = np.random.default_rng(3)
    q, x = rng.standard_normal((64, 32)), rng.standard_normal((2000, 32))
    plain, pairs = ann._nearest(q, x, np.arange(2000), 11), []
    far = ann._far
    monkeypatch.setattr(ann, "_far", lambda a, b: pairs.append(len(a)) or far(a, b))
    monkeypatch.setattr(ann, "RERANKED", 100)
    x[0] = 1e7
    out = ann._nearest(q, x, np.arange(2000), 11)
    assert sum(pairs) < 2000 and max(pairs) <= 100
    same = plain[1] != 0
    assert set(zip(plain[0][same], plain[1][same], strict=True)) <= set(zip(out[0], out[1], strict=True))
