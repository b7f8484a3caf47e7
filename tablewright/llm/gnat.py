"""Hard-negative mining by a multiway hyperplane tree with stored distance ranges.

A node of the tree has up to ``WAYS`` split points; a vector belongs to the subtree
of the closest one, so subtrees are parted by the hyperplanes between split points.
Each split point stores the range of its distances to every sibling's subtree, and a
subtree the range of its norms.  A score window [low, high] of an anchor q is, for a
subtree with norms in [n, m], the annulus of distances

    sqrt(|q|^2 + n^2 - 2 * high) ... sqrt(|q|^2 + m^2 - 2 * low)

and by the triangle inequality a sibling whose range doesn't meet the annulus, moved
by the anchor's distance to the split point, holds nothing of the window: it is
eliminated before its vectors are dealt.  What is left is compared exactly, leaf by
leaf (in blocks, see ``vectors.block_search``: a leaf of any size is many tasks).

Two searches go down the same tree.  Positives: the window is all scores from the
anchor's k-th best of its label in a bounded sample upwards; a label of at most one
block is compared whole.  Negatives: one window for each positive, [low share of its
score, its score], the lower end raised to the k-th best that the sample has in it.
Windows never exclude a row of the result, and scores are whole numbers.

The split points come from a bounded sample (``vectors.SAMPLE``); every vector is
indexed, and ranges are minima and maxima over all vectors.

Defined results: rows with a null label, a null vector or any null or non-finite
component take no part; a vector meets those of its own length; a row isn't its own
positive, another row of the same id may be; ties go to the smaller id, missing ids
last; repeated anchor rows each get their rows; an anchor alone with its label has
no row, nor has a positive without a negative in its window (a score below zero has
an empty one).  Other columns are ignored, whatever their names.  Vectors whose scores may
pass 2^53 fail the job.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm import vectors as V
from tablewright.llm.common import materialize, table

WAYS, TRIED, SEED = 16, 3, 23
#: Rows of a leaf that are aimed at, and sample rows without which a node isn't split.
LEAF, LEAST_FIT = 2048, 64
POSITIVES, NEGATIVES, EVERY, SCALE = 5, 5, 100, 256
#: Share of a positive's score from which a negative is hard, as two whole numbers.
SHARE = (80, 100)
#: Anchors and rows that are compared at a time.
ASKED, ROWS = 256, 4096
SLACK = 1e-6


def squares(x: np.ndarray) -> np.ndarray:
    return np.square(x, dtype=np.float64).sum(axis=1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    d = squares(x)[:, None] + squares(points) - 2 * (x.astype(np.float64) @ points.astype(np.float64).T)
    return np.sqrt(np.maximum(d, 0))


class Node:
    """Split points of a node with, for each, the number of its child node or leaf.

    ``lo[i, j]`` to ``hi[i, j]``: distances of split point i to the vectors of subtree j;
    ``least[j]`` to ``most[j]``: squared norms of subtree j; an empty subtree has no range."""

    def __init__(self, points: np.ndarray):
        k = len(points)
        self.points, self.node, self.leaf = points, [-1] * k, [-1] * k
        self.lo, self.hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        self.least, self.most = np.full(k, np.inf), np.full(k, -np.inf)


def split_points(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Far points among some of ``x``: each next one is that with the largest distance to those before."""
    some = x[rng.permutation(len(x))[:WAYS * TRIED]]
    taken = [0]
    far = distances(some, some[:1])[:, 0]
    while len(taken) < WAYS and far.max() > 0:
        taken.append(int(far.argmax()))
        far = np.minimum(far, distances(some, some[taken[-1:]])[:, 0])
    return some[taken]


def fit(sample: np.ndarray, share: float) -> list[Node]:
    """The tree over a sample that is ``share`` of all vectors; no node if it is too small to be split."""
    rng, tree, leaves = np.random.default_rng([SEED, sample.shape[1]]), [], 0
    todo = [(sample, None, 0)]
    while todo:
        x, parent, way = todo.pop()
        points = split_points(x, rng) if len(x) >= LEAST_FIT and (parent is None or len(x) / share > 4 * LEAF) else x[:1]
        if len(points) < 2:
            if parent is not None:
                parent.leaf[way], leaves = leaves, leaves + 1
            continue
        node = Node(points)
        tree.append(node)
        if parent is not None:
            parent.node[way] = len(tree) - 1
        near = distances(x, points).argmin(axis=1)
        todo += [(x[near == j], node, j) for j in range(len(points))]
    return tree


def descend(tree: list[Node], x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The leaf of every row, and for each node reached its number, the rows' distances to its points and their ways."""
    leaf, steps = np.zeros(len(x), np.int64), []
    todo = [(0, np.arange(len(x)))] if tree else []
    while todo:
        k, rows = todo.pop()
        if not len(rows):
            continue
        node = tree[k]
        d = distances(x[rows], node.points)
        way = d.argmin(axis=1)
        steps.append((k, rows, d, way))
        for j in range(len(node.points)):
            mine = rows[way == j]
            if node.node[j] >= 0:
                todo.append((node.node[j], mine))
            else:
                leaf[mine] = node.leaf[j]
    return leaf, steps


def reached(tree: list[Node], q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, leaf) that the ranges can't eliminate for any of the anchor's windows ``low`` to ``high``."""
    who, leaf = [], []
    todo = [(0, np.arange(len(q)))] if tree else []
    if not tree:
        who, leaf = [np.flatnonzero((low <= high).any(axis=1))], [np.zeros(int((low <= high).any(axis=1).sum()), np.int64)]
    norm = squares(q)
    while todo:
        k, rows = todo.pop()
        if not len(rows):
            continue
        node = tree[k]
        d = distances(q[rows], node.points)[:, None, :]  # anchor, window, split point
        lo, hi, n = low[rows], high[rows], norm[rows][:, None]
        for j in range(len(node.points)):
            if node.least[j] > node.most[j]:
                continue  # no vector went there
            slack = SLACK * (1 + np.sqrt(n) + np.sqrt(node.most[j]))
            outer = n + node.most[j] - 2 * lo
            near = np.sqrt(np.maximum(n + node.least[j] - 2 * hi, 0)) - slack
            far = np.sqrt(np.maximum(outer, 0)) + slack
            meets = (lo <= hi) & (outer >= -slack ** 2 - 1)
            meets &= ((np.maximum(d - far[:, :, None], near[:, :, None] - d) <= node.hi[:, j])
                      & (d + far[:, :, None] >= node.lo[:, j])).all(axis=2)
            mine = rows[meets.any(axis=1)]
            if node.node[j] >= 0:
                todo.append((node.node[j], mine))
            else:
                who.append(mine)
                leaf.append(np.full(len(mine), node.leaf[j], np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *who]), np.concatenate([none, *leaf])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, V.matrix(batch.column("x").take(pa.array(at)), int(dim))


def _indexed(trees: dict[int, list[Node]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for dim, at, x in _by_length(batch):
                leaf[at] = descend(trees.get(dim, []), x)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    return run


def _ranges(trees: dict[int, list[Node]]):
    """Minima and maxima of a task's rows: distances of split point i to subtree j, norms of j (i = -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int, int], tuple[float, float]] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                norm = squares(x)
                for k, rows, d, way in descend(trees.get(dim, []), x)[1]:
                    for j in np.unique(way):
                        mine = way == j
                        of = [(-1, norm[rows[mine]]), *enumerate(d[mine].T)]
                        for i, v in of:
                            lo, hi = found.get((dim, k, i, int(j)), (np.inf, -np.inf))
                            found[dim, k, i, int(j)] = min(lo, float(v.min())), max(hi, float(v.max()))
        if found:
            keys = list(zip(*found))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in keys),
                                              *(pa.array(c) for c in zip(*found.values()))], names=["dim", "k", "i", "j", "lo", "hi"])

    return run


def index(rows: DataFrame, sample: dict[int, tuple], share: float) -> tuple[DataFrame, dict[int, list[Node]]]:
    """``rows`` with their ``leaf``, written, and the trees by length of vectors with the ranges of all rows."""
    trees = {dim: fit(x, share) for dim, (_, _, x) in sample.items()}
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    leaves = materialize(rows.mapInArrow(_indexed(trees), schema + ", leaf long"), "leaves")
    ranges = leaves.select("dim", "x").mapInArrow(_ranges(trees), "dim int, k int, i int, j int, lo double, hi double")
    # One row for each pair of siblings of the trees, which the sample bounds.
    for dim, k, i, j, lo, hi in ranges.groupBy("dim", "k", "i", "j").agg(F.min("lo"), F.max("hi")).collect():
        node = trees[dim][k]
        if i < 0:
            node.least[j], node.most[j] = lo, hi
        else:
            node.lo[i, j], node.hi[i, j] = lo, hi
    return leaves, trees


def _some(sample: dict[int, tuple], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    return sample.get(dim, (none, none, np.zeros((0, dim), np.int64)))


def _spread(batch: pa.RecordBatch, who: list, cell: list, name: str, least: np.ndarray) -> pa.RecordBatch:
    """The rows of ``batch`` once for each cell, with the lower ends of their windows."""
    who = np.concatenate([np.zeros(0, np.int64), *who])
    cell = np.concatenate([np.zeros(0, np.int64), *cell])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(who) + 1) * least.shape[1], pa.int32()), pa.array(least[who].ravel()))
    return pa.RecordBatch.from_arrays([*(c.take(pa.array(who)) for c in batch.columns), pa.array(cell), lists],
                                      names=[*batch.schema.names, name, "least"])


def _positive_cells(sample: dict, trees: dict, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, who, cell = np.full((batch.num_rows, 1), -np.inf), [], []
            node, label = batch.column("node").to_numpy(), batch.column("label").to_numpy()
            large = np.asarray(batch.column("large").to_numpy(zero_copy_only=False))
            for dim, at, q in _by_length(batch):
                s_node, s_label, x = _some(sample, dim)
                for a in range(0, len(at), ASKED):
                    some = at[a:a + ASKED]
                    if len(s_node) >= k:
                        s = V.products(q[a:a + ASKED], x).astype(np.float64)
                        s[(label[some][:, None] != s_label) | (node[some][:, None] == s_node)] = -np.inf
                        least[some, 0] = np.partition(s, -k, axis=1)[:, -k]
                    big = large[some]
                    w, c = reached(trees.get(dim, []), q[a:a + ASKED][big], least[some[big]], np.full((int(big.sum()), 1), np.inf))
                    who += [some[big][w], some[~big]]
                    cell += [c, np.full(int((~big).sum()), -1, np.int64)]
            yield _spread(batch, who, cell, "cell", least)

    return run


def _positives(k: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        q, x = V.matrix(anchors["x"], dim), V.matrix(rows["x"], dim)
        order, node, other = V.id_order(rows["vec_id"]), anchors["node"].to_numpy(), rows["node"].to_numpy()
        least = V.matrix(anchors["least"], 1)[:, 0].copy()
        out = []
        for a in range(0, len(q), ASKED):
            edge = least[a:a + ASKED]
            who = row = score = np.zeros(0, np.int64)
            for start in range(0, len(x), ROWS):
                s = V.products(q[a:a + ASKED], x[start:start + ROWS])
                w, r = np.nonzero(s >= edge[:, None])
                own = node[a:a + ASKED][w] != other[start:start + ROWS][r]
                w, r = w[own], r[own]
                who, row, score = np.r_[who, w], np.r_[row, r + start], np.r_[score, s[w, r]]
                kept = V.best(who, score, order[row], k)
                who, row, score = who[kept], row[kept], score[kept]
                full, n = np.unique(who, return_counts=True)
                edge[full[n == k]] = score[(np.cumsum(n) - 1)[n == k]]
            out.append((who + a, row, score))
        who, row, score = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*out) if out else ((), (), ())))
        return pa.table({"node": pa.array(node[who], pa.int64()), "positive_id": rows["vec_id"].take(pa.array(row)), "score": pa.array(score)})

    return run


def windows(scores: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest negative score of each positive score; a missing one has no window."""
    low = np.ceil(share[0] * scores / share[1])
    low = np.where(share[0] * scores > share[1] * scores, np.inf, low)  # below zero: empty
    return np.where(np.isnan(scores), np.inf, low), np.where(np.isnan(scores), -np.inf, scores)


def _padded(column: pa.ListArray, k: int) -> np.ndarray:
    out = np.full((len(column), k), np.nan)
    for i, row in enumerate(column.to_pylist()):
        out[i, :len(row)] = row
    return out


def _negative_cells(sample: dict, trees: dict, positives: int, k: int, share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = windows(_padded(batch.column("scores"), positives), share)
            label, who, cell = batch.column("label").to_numpy(), [], []
            for dim, at, q in _by_length(batch):
                _, s_label, x = _some(sample, dim)
                for a in range(0, len(at), ASKED):
                    some = at[a:a + ASKED]
                    if len(s_label) >= k:
                        s = V.products(q[a:a + ASKED], x).astype(np.float64)
                        s[label[some][:, None] == s_label] = -np.inf
                        for w in range(positives):
                            inside = np.where(s <= high[some, w][:, None], s, -np.inf)
                            low[some, w] = np.maximum(low[some, w], np.partition(inside, -k, axis=1)[:, -k])
                    w, c = reached(trees.get(dim, []), q[a:a + ASKED], low[some], high[some])
                    who.append(some[w])
                    cell.append(c)
            yield _spread(batch, who, cell, "leaf", low)

    return run


def _negatives(positives: int, k: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        q, x = V.matrix(anchors["x"], dim), V.matrix(rows["x"], dim)
        label, other = anchors["label"].to_numpy(), rows["label"].to_numpy()
        order = V.id_order(rows["vec_id"])
        least = V.matrix(anchors["least"], positives).copy()
        most = np.full((0, positives), 0.0) if not len(q) else windows(_padded(anchors["scores"].combine_chunks(), positives), (1, 1))[1]
        out = []
        for a in range(0, len(q), ASKED):
            lo, hi, mine = least[a:a + ASKED], most[a:a + ASKED], label[a:a + ASKED]
            found = [[np.zeros(0, np.int64)] * 3 for _ in range(positives)]
            for start in range(0, len(x), ROWS):
                s = V.products(q[a:a + ASKED], x[start:start + ROWS])
                far = mine[:, None] != other[start:start + ROWS]
                who, row = np.nonzero(far & (s >= lo.min(axis=1, initial=np.inf)[:, None]) & (s <= hi.max(axis=1, initial=-np.inf)[:, None]))
                score = s[who, row]
                for w in range(positives):
                    at = np.flatnonzero((score >= lo[who, w]) & (score <= hi[who, w]))
                    f = [np.r_[old, new] for old, new in zip(found[w], (who[at], row[at] + start, score[at]))]
                    kept = V.best(f[0], f[2], order[f[1]], k)
                    found[w] = [c[kept] for c in f]
                    full, n = np.unique(found[w][0], return_counts=True)
                    lo[full[n == k], w] = np.maximum(lo[full[n == k], w], found[w][2][(np.cumsum(n) - 1)[n == k]])
            out += [(f[0] + a, f[1], f[2], np.full(len(f[0]), w)) for w, f in enumerate(found)]
        who, row, score, at = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*out) if out else ((),) * 4))
        return pa.table({"node": anchors["node"].take(pa.array(who)), "place": pa.array(at, pa.int32()),
                         "negative_id": rows["vec_id"].take(pa.array(row)), "negative_score": pa.array(score)})

    return run


def mine(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         share: tuple[int, int] = SHARE, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors``
    (vec_id, embedding, label) for which ``anchor`` holds: up to ``negatives`` rows of another label for each
    of up to ``positives`` rows of the same one.  Scores are inner products of floor(scale * component)."""
    rows = V.whole_numbers(vectors.where(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("long")),
                           scale, anchor, ["label"])
    drawn = V.drawn(rows, ["dim", "node", "label", "x"])
    by_dim: dict[int, list] = {}
    for r in drawn:
        by_dim.setdefault(r["dim"], []).append(r)
    sample = {dim: (np.array([r["node"] for r in some]), np.array([r["label"] for r in some]),
                    np.array([r["x"] for r in some], np.int64).reshape(len(some), dim)) for dim, some in by_dim.items()}
    rows, trees = index(rows, sample, len(drawn) / max(1, rows.count()))

    # Written: its join then knows its size and leaves the rows of a hot label where they are.
    large = materialize(rows.groupBy("dim", "label").agg(F.count("*").alias("n")).where(F.col("n") > V.BLOCK)
                        .select("dim", "label", F.lit(True).alias("large")), "labels")
    rated = rows.join(large, ["dim", "label"], "left").withColumn("large", F.coalesce("large", F.lit(False)))
    asked = rated.where("asks").select("dim", "label", "node", "x", "large")
    asked = materialize(asked.mapInArrow(_positive_cells(sample, trees, positives),
                                         "dim int, label long, node long, x array<long>, large boolean, cell long, least array<double>")
                        .drop("large"), "asked")
    same = rated.select("dim", "label", F.when(F.col("large"), F.col("leaf")).otherwise(F.lit(-1)).alias("cell"), "node", "vec_id", "x")
    found = V.block_search(asked, same, ["dim", "label", "cell"], _positives(positives), "node long, positive_id long, score long")
    place = Window.partitionBy("node").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"))
    found = materialize(found.withColumn("place", F.row_number().over(place) - 1).where(F.col("place") < positives), "positives")

    # At most ``positives`` of them are gathered for an anchor.
    lists = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("p")).select("node", F.col("p.score").alias("scores"))
    asked = rows.where("asks").select("dim", "label", "node", "x").join(lists, "node").select("dim", "label", "node", "x", "scores")
    asked = materialize(asked.mapInArrow(_negative_cells(sample, trees, positives, negatives, share),
                                         "dim int, label long, node long, x array<long>, scores array<long>, leaf long, least array<double>"), "asked")
    near = V.block_search(asked, rows.select("dim", "leaf", "label", "node", "vec_id", "x"), ["dim", "leaf"], _negatives(positives, negatives),
                          "node long, place int, negative_id long, negative_score long")
    place = Window.partitionBy("node", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    near = near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
    anchors = rows.where("asks").select("node", F.col("vec_id").alias("anchor_id"))
    return near.join(found.withColumnRenamed("score", "positive_score"), ["node", "place"]).join(anchors, "node").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_gnat(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(rows, F.col("vec_id") % EVERY == 0)


QUERIES = {"op12_gnat": op12_gnat}
#: For small tables: every anchor against every row.
OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS node, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.node, a.vec_id AS anchor_id, x.node AS other, x.vec_id, x.label = a.label AS same, list_inner_product(a.e, x.e)::BIGINT AS score
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND a.node <> x.node AND len(a.e) = len(x.e)),
p AS (SELECT node, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY node ORDER BY score DESC, vec_id NULLS LAST, other) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.node, place ORDER BY s.score DESC, s.vec_id NULLS LAST)::INTEGER AS rank
  FROM p JOIN s ON p.node = s.node AND NOT s.same AND place <= 5
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""

SQL = {"op12_gnat": OP12_SQL}
