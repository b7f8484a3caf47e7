import numpy as np
import pytest

from pyspark.sql import functions as F

from tablewright.llm import gnat, vectors

SF_MID = "/root/testdata/sf0.01"


def brute(rows, is_anchor, positives=gnat.POSITIVES, negatives=gnat.NEGATIVES, scale=gnat.SCALE):
    """Every anchor against every row, in Python's whole numbers."""
    sound = [r for r in rows if r.label is not None and r.embedding is not None
             and all(x is not None and np.isfinite(x) for x in r.embedding)]
    whole = [[int(np.floor(scale * float(x))) for x in r.embedding] for r in sound]
    rank = lambda r, s: (-s, r.vec_id is None, r.vec_id or 0)
    out = []
    for i, a in enumerate(sound):
        if a.vec_id is None or not is_anchor(a.vec_id):
            continue
        others = [(r, sum(p * q for p, q in zip(whole[i], whole[j]))) for j, r in enumerate(sound)
                  if j != i and len(whole[j]) == len(whole[i])]
        same = sorted((o for o in others if o[0].label == a.label), key=lambda o: rank(*o))[:positives]
        far = sorted((o for o in others if o[0].label != a.label), key=lambda o: rank(*o))
        for p, ps in same:
            hard = [(r, s) for r, s in far if 80 * ps <= 100 * s <= 100 * ps][:negatives]
            out += [(a.vec_id, p.vec_id, n + 1, r.vec_id, ps, s) for n, (r, s) in enumerate(hard)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect()), key=repr)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").withColumn(
        "label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")).collect()
    assert found(gnat.op12_gnat(spark, SF_MID)) == brute(rows, lambda i: i % 100 == 0)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.5, 0.25]
    data = [(0, one, 1), (0, one, 1), (1, one, 2), (2, [0.9, 0.5, 0.25], 2), (100, [0.95, 0.5, 0.25], 1), (3, None, 1), (4, [nan, 1.0, 1.0], 1),
            (5, [1.0, inf, 0.0], 2), (6, [None, 1.0, 1.0], 1), (200, one, None), (None, one, 2), (None, one, 1), (300, [], 1), (7, [], 2),
            (8, [], 1), (400, [1.0], 1), (9, [0.9], 2), (500, [0.0, 0.0, 0.0], 3), (10, [0.0, 0.0, 0.0], 3), (11, [0.0, 0.0, 0.0], 4),
            (600, [-1.0, -1.0, -1.0], 5), (12, [1.0, 1.0, 1.0], 5), (13, [0.9, 0.9, 0.9], 6), (700, [0.1, 0.2, 0.3], 9)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 node", "'x' x", "2 dim", "3 score", "4 place", "5 least", "6 leaf", "7 asks", "8 cell", "9 large")
    assert found(gnat.mine(df, F.col("vec_id") % 100 == 0)) == brute(df.collect(), lambda i: i % 100 == 0)
    assert gnat.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("kind", ["clusters", "ties"])
def test_deep_trees_and_blocks(spark, monkeypatch, kind):
    """A hot label and a crowd of copies beyond a block, trees of several levels, a sample of a part."""
    for name, value in {"BLOCK": 64, "SPREAD": 32, "SAMPLE": 200}.items():
        monkeypatch.setattr(vectors, name, value)
    for name, value in {"LEAF": 4, "LEAST_FIT": 12, "ASKED": 8, "ROWS": 16, "WAYS": 5}.items():
        monkeypatch.setattr(gnat, name, value)
    rng = np.random.default_rng(4)
    if kind == "clusters":
        x = rng.standard_normal((12, 10))[rng.integers(0, 12, 500)] + 0.2 * rng.standard_normal((500, 10))
        x[:120] = x[0]
    else:
        x = rng.integers(-2, 3, (500, 6)) / 256
    label = np.where(rng.random(500) < 0.4, 0, rng.integers(1, 8, 500))
    df = spark.createDataFrame([(int(i), v.tolist(), int(k)) for i, v, k in zip(rng.permutation(500), x, label)],
                               "vec_id long, embedding array<double>, label int")
    got = found(gnat.mine(df, F.col("vec_id") % 6 == 0))
    assert got == brute(df.collect(), lambda i: i % 6 == 0) and len(got) > 100


def test_ranges_hold_and_eliminate(monkeypatch):
    monkeypatch.setattr(gnat, "LEAST_FIT", 12)
    rng = np.random.default_rng(9)
    x = np.floor(256 * (rng.standard_normal((40, 8)) * 2)[rng.integers(0, 40, 4000)] + 20 * rng.standard_normal((4000, 8))).astype(np.int64)
    tree = gnat.fit(x[:1000], 0.001)
    leaf, steps = gnat.descend(tree, x)
    assert len(tree) > 5
    norm = gnat.squares(x)
    for k, rows, d, way in steps:
        for j in np.unique(way):
            mine = way == j
            tree[k].least[j], tree[k].most[j] = norm[rows[mine]].min(), norm[rows[mine]].max()
            tree[k].lo[:, j], tree[k].hi[:, j] = d[mine].min(axis=0), d[mine].max(axis=0)
    q = x[:60]
    s = q @ x.T
    top = np.sort(s, axis=1)
    low, high = np.stack([top[:, -10], top[:, -40]], 1).astype(float), np.stack([top[:, -5], top[:, -30]], 1).astype(float)
    who, cell = gnat.reached(tree, q, low, high)
    kept = set(zip(who.tolist(), cell.tolist()))
    inside = ((s[:, :, None] >= low[:, None]) & (s[:, :, None] <= high[:, None])).any(axis=2)
    assert all((i, leaf[j]) in kept for i, j in np.argwhere(inside))
    assert len(kept) < 0.5 * len(q) * len(set(leaf.tolist()))
