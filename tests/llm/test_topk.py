import numpy as np
import pytest

from pyspark.sql import functions as F

from tablewright.llm import topk, vectors

SF_MID = "/root/testdata/sf0.01"


def brute(rows, is_query, k=topk.TOP, scale=topk.SCALE):
    """Every query against every row, in Python's whole numbers."""
    sound = [r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding) for r in rows]
    whole = [[int(np.floor(scale * float(x))) for x in r.embedding] if ok else None for r, ok in zip(rows, sound)]
    out = []
    for i, r in enumerate(rows):
        if sound[i] and r.vec_id is not None and is_query(r.vec_id):
            found = [(-sum(a * b for a, b in zip(whole[i], whole[j])), other.vec_id is None, other.vec_id or 0)
                     for j, other in enumerate(rows) if j != i and sound[j] and len(whole[j]) == len(whole[i])]
            out += [(r.vec_id, n + 1, None if no else v, -s) for n, (s, no, v) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()
    assert found(topk.op11_topk(spark, SF_MID)) == brute(rows, lambda i: i % 50 == 0)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.5, 0.25]), (0, [1.0, 0.5, 0.25]), (50, [1.0, 0.5, 0.25]), (1, [1.0, 0.5, 0.25]), (None, [1.0, 0.5, 0.25]),
            (2, [-3.0, 0.1, 0.0]), (3, None), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (100, [None, 1.0, 1.0]), (150, []),
            (6, []), (7, [0.0, 0.0, 0.0]), (200, [2.0]), (250, [-0.001, 0.0, 7.0]), (-50, [1e5, -1e5, 1e-9])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 node", "'x' x", "2 dim", "3 score", "4 rank", "5 least", "6 asks")
    assert found(topk.top_k(df, F.col("vec_id") % 50 == 0)) == brute(df.collect(), lambda i: i % 50 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("dim", [1, 2, 3, 7, 24, 40])
def test_many_blocks_and_ties(spark, monkeypatch, dim):
    """Few whole numbers, so many ties; more blocks, chunks and rows than the sample has."""
    for name, value in {"BLOCK": 64, "SPREAD": 32, "SAMPLE": 50}.items():
        monkeypatch.setattr(vectors, name, value)
    for name, value in {"ROWS": 16, "ASKED": 4}.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(dim)
    x = np.concatenate([rng.integers(-3, 4, (300, dim)) / 256, np.ones((40, dim)) / 64])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(rng.permutation(340), x)], "vec_id long, embedding array<double>")
    assert found(topk.top_k(df, F.col("vec_id") % 9 == 0)) == brute(df.collect(), lambda i: i % 9 == 0)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 48)).cumsum(axis=1)
    x = np.floor(256 * (centre[rng.integers(0, 6, 400)] + 0.3 * rng.standard_normal((400, 48)))).astype(np.int64)
    exact, last = x[:40] @ x.T, None
    for s in topk.resolutions(48):
        bound = topk.statistics(x[:40].astype(float), s) @ topk.statistics(x.astype(float), s).T
        assert (bound >= exact - 1e-6 * np.abs(exact)).all()
        assert last is None or bound.mean() <= last + 1e-9
        last = bound.mean()
    least = np.sort(exact, axis=1)[:, -6].astype(float)
    stats = [topk.statistics(x.astype(float), s) for s in topk.resolutions(48)]
    pair = topk.survivors([s[:40] for s in stats], stats, least, np.linalg.norm(x, axis=1))
    alive = np.zeros(exact.shape, bool)
    alive[pair] = True
    assert alive[exact >= least[:, None]].all() and alive.mean() < 0.5


def test_large_numbers():
    a = np.array([[2 ** 25, 3], [5, -(2 ** 25)]])
    assert vectors.products(a, a).tolist() == [[2 ** 50 + 9, 5 * 2 ** 25 - 3 * 2 ** 25], [5 * 2 ** 25 - 3 * 2 ** 25, 2 ** 50 + 25]]
    with pytest.raises(OverflowError):
        vectors.products(a * 16, a)
