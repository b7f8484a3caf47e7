import numpy as np

from tablewright.llm import forest

SF_MID = "/root/testdata/sf0.01"


def brute(rows):
    """Links of all pairs within a label."""
    sound = [r.label is not None and r.embedding is not None and len(r.embedding) > 0 and all(x is not None for x in r.embedding)
             and np.isfinite(np.array(r.embedding, float)).all() and np.any(np.array(r.embedding, float)) for r in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = {}
    for i, r in enumerate(rows):
        if sound[i]:
            by.setdefault((r.label, len(r.embedding)), []).append(i)
    for members in by.values():
        x = np.array([rows[i].embedding for i in members], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in np.argwhere(np.triu(x @ x.T >= 0.98, 1)):
            i, j = members[a], members[b]
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r.vec_id), r.vec_id)
    return sorted((r.vec_id, links[i], low[find(i)], r.vec_id == low[find(i)]) for i, r in enumerate(rows))


def recall(got, want):
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    return sum(g[1] for g in got) / max(1, sum(w[1] for w in want))


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()
    assert sorted(map(tuple, forest.op7_forest(spark, SF_MID).collect())) == brute(rows)


def test_recall_with_crowds(spark, monkeypatch):
    """Deep trees, crowds beyond a block, chains and copies: all links but a few, and the same components."""
    monkeypatch.setattr(forest, "LEAF", 32)
    monkeypatch.setattr(forest, "BLOCK", 64)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((60, 24))
    x = np.concatenate([c + rng.standard_normal((k, 24)) * 0.12 for c, k in zip(centre, [300, 100, *[6] * 58])]
                       + [rng.standard_normal((700, 24))])
    x = np.concatenate([x, x[:40], x[:40] * 3])
    data = [(i, v.tolist(), int(i % 5 == 0)) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    want = brute(df.collect())
    got = sorted(map(tuple, forest.near_duplicates(df).collect()))
    assert recall(got, want) >= 0.97
    assert np.mean([g[2] == w[2] for g, w in zip(got, want)]) >= 0.99


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
            (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.01], 2),
            (12, [-0.0, 1.0], 2), (13, [0.0, 1.0], 2), (14, [1e30, 1e28], 2), (15, [1e-30, 0.0], 2)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 node", "'x' leaf")
    assert sorted(map(tuple, forest.near_duplicates(df).collect())) == brute(df.collect())
    assert forest.near_duplicates(df.limit(0)).count() == 0


def test_small_labels_are_compared_whole(spark, monkeypatch):
    """One tree without spill parts close vectors of a large label, but none of a label of one leaf."""
    monkeypatch.setattr(forest, "LEAF", 32)
    one = forest.fit
    monkeypatch.setattr(forest, "fit", lambda sample, depth: one(sample, depth, trees=1, spill=0.0))
    rng = np.random.default_rng(5)
    large = rng.standard_normal((4000, 16))
    small = np.repeat(rng.standard_normal((16, 16)), 2, axis=0) + rng.standard_normal((32, 16)) * 0.08
    data = [(i, v.tolist(), int(i >= 4000)) for i, v in enumerate(np.concatenate([large, small]))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, forest.near_duplicates(df).collect()))
    assert got[4000:] == brute(df.where("label = 1").collect())
    assert sum(g[1] for g in got[4000:]) >= 20


def test_the_sample_is_never_empty(spark):
    """A share of the hashes, not of millionths: the same number is expected of any input."""
    for every in (10 ** 5, 8_193_000_000, 10 ** 11, 10 ** 13):
        expected = (forest.hash_bound(forest.SAMPLE / 2 / every) + 2 ** 63) / 2.0 ** 64 * every
        assert abs(expected - forest.SAMPLE / 2) < 0.01 * forest.SAMPLE
    few = spark.range(100).selectExpr("id node", "array(id + 1D) embedding")
    assert len(forest.drawn(few, 10 ** 10)) > 0  # none below the first bound: drawn again


def test_close_pairs_share_a_leaf_of_deep_trees():
    """At the production parameters, cuts from a sample of half its bound: pairs just above the least cosine, at depths
    of labels from some ten thousand to a thousand million vectors."""
    rng = np.random.default_rng(21)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sample = unit(rng.standard_normal((forest.SAMPLE // 2, 64)))
    one = unit(rng.standard_normal((400, 64)))
    aside = rng.standard_normal((400, 64))
    aside = unit(aside - (aside * one).sum(1, keepdims=True) * one)
    cosine = rng.uniform(0.98, 0.985, (400, 1))
    two = cosine * one + np.sqrt(1 - cosine ** 2) * aside
    for depth in (5, 13, 22):
        trees, way = forest.fit(sample, depth), forest.directions(64, depth)
        in_one, in_two = (forest.leaves(x, trees, way, np.full(400, depth)) for x in (one, two))
        shared = set(zip(*(c.tolist() for c in in_one))) & set(zip(*(c.tolist() for c in in_two)))
        assert len({row for row, _ in shared}) >= 0.98 * 400
