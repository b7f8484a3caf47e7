"""Embedding near-dedup by a forest of random-projection trees with spill.

Every tree splits the vectors again and again by a random direction at the
median of a node; vectors within a margin of the cut go to both sides, so that
close vectors rarely part, and several trees catch those that do.  Vectors of
one label that share a leaf are compared, in double precision, and those with
cosine ``LEAST`` or more are linked and united.

The cuts are fitted on a sample of at most ``SAMPLE`` vectors (by hash, of all
labels); every vector is indexed, to the depth that follows the size of its
label, so leaves keep their size as the input grows, and a label of at most
``LEAF`` vectors is compared whole: below the depth that the sample supports,
cuts are the medians of the whole sample in the level's direction.

A leaf with more than ``BLOCK`` vectors is compared block against block, each
pair of blocks a task of its own, so a crowd of close vectors is dealt evenly.
No pair leaves a task: a pair is counted in the first leaf that both vectors
share, known from the leaves that each carries, and united vectors leave as
(vector, representative).  Equal vectors are one with its number of copies.

Defined results: null, zero and non-finite vectors, those with null components
and those without label link with nothing and are kept; vectors of different
length link with nothing of another length; equal vectors link; repeated ids
count as vectors of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.common import components, discard, materialize, table

LEAST = 0.98
TREES, LEAF, BLOCK = 6, 256, 512
#: Margin on either side of a cut, in standard deviations of the projections.
SPILL = 0.12
SAMPLE, SEED, LEAST_FIT = 16384, 11, 48


def directions(dim: int, depth: int, trees: int = TREES, seed: int = SEED) -> np.ndarray:
    """Unit directions of every tree and level, shape (trees, depth, dim)."""
    g = np.random.default_rng([seed, dim]).standard_normal((trees, max(depth, 1), dim))
    return g / np.linalg.norm(g, axis=2, keepdims=True)


def _spread(projected: np.ndarray, level: int, cut: np.ndarray, margin: float, rows: np.ndarray, node: np.ndarray):
    x = projected[rows, level]
    at = cut[np.minimum(node, len(cut) - 1)] if len(cut) else np.zeros(len(node))
    left, right = x < at + margin, x >= at - margin
    return np.concatenate([rows[left], rows[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])


def fit(sample: np.ndarray, depth: int, trees: int = TREES, spill: float = SPILL) -> list[list[tuple[np.ndarray, float]]]:
    """For every tree and level the cuts of its nodes and the margin."""
    way = directions(sample.shape[1], depth, trees)
    forest = []
    for t in range(trees):
        projected = sample @ way[t].T
        rows, node, levels = np.arange(len(sample)), np.zeros(len(sample), np.int64), []
        for level in range(depth):
            overall = float(np.median(projected[:, level])) if len(sample) else 0.0
            margin = spill * float(projected[:, level].std()) if len(sample) else 0.0
            cuts = np.full(1 << level if level < 12 and len(rows) >= LEAST_FIT << level else 1, overall)
            if len(cuts) > 1 or level == 0:
                order = np.argsort(node, kind="stable")
                ends = np.searchsorted(node[order], np.arange(len(cuts) + 1))
                for k in range(len(cuts)):
                    members = rows[order[ends[k]:ends[k + 1]]]
                    if len(members) >= LEAST_FIT:
                        cuts[k] = np.median(projected[members, level])
            rows, node = _spread(projected, level, cuts, margin, rows, node)
            levels.append((cuts, margin))
        forest.append(levels)
    return forest


def leaves(vectors: np.ndarray, forest: list, way: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``vectors`` and the leaves they are in: tree in the top bits, path
    below.  A row goes down ``depth`` levels; those that go down none are in one tree."""
    every_row, every_leaf = [], []
    for t, levels in enumerate(forest):
        projected = vectors @ way[t].T
        rows = np.arange(len(vectors)) if t == 0 else np.flatnonzero(depth > 0)
        node = np.zeros(len(rows), np.int64)
        for level, (cuts, margin) in enumerate(levels):
            ends = depth[rows] <= level
            every_row.append(rows[ends])
            every_leaf.append(node[ends] + (t << 48))
            rows, node = rows[~ends], node[~ends]
            rows, node = _spread(projected, level, cuts, margin, rows, node)
        every_row.append(rows)
        every_leaf.append(node + (t << 48))
    return np.concatenate(every_row), np.concatenate(every_leaf)


def _unit(column: list) -> np.ndarray:
    x = np.array(column, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither squares too large nor too small
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _indexed(distinct: DataFrame, dim: int, forest: list, depth: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = directions(dim, depth)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                levels = batch.column("depth").to_numpy()
                rows, leaf = leaves(_unit(batch.column("embedding").to_pylist()), forest, way, levels)
                order = np.lexsort((leaf, rows))
                rows, leaf = rows[order], leaf[order]
                ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
                signs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(leaf))
                yield pa.RecordBatch.from_arrays([*batch.columns, signs], names=[*batch.schema.names, "leaves"])

    return distinct.mapInArrow(run, "node long, label long, dim int, embedding array<double>, copies long, depth int, "
                                    "leaves array<long>").drop("depth")


def hash_bound(share: float) -> int:
    """The number that a ``share`` of all 64-bit hashes lies below."""
    return min(int(share * 2.0 ** 64) - 2 ** 63, 2 ** 63 - 1)


def drawn(some: DataFrame, every: int) -> list:
    """At most ``SAMPLE`` of the ``every`` vectors in ``some``, by hash: half as many are
    expected of a large input; if a quarter isn't reached, more are drawn."""
    share = 1.0 if every <= SAMPLE else SAMPLE / 2 / every
    while True:
        part = some if share >= 1 else some.where(F.xxhash64(F.lit(SEED), "node") < hash_bound(share))
        sample = [r[0] for r in part.select("embedding").limit(SAMPLE).collect()]
        if share >= 1 or len(sample) >= SAMPLE // 4:
            return sample
        share *= 2


def _compare(least: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = key[2], key[3], key[4]
        rows = rows.drop_duplicates("node")
        unit = _unit(rows["embedding"].tolist())
        block, node, copies = rows["block"].to_numpy(), rows["node"].to_numpy(), rows["copies"].to_numpy()
        a = np.flatnonzero(block == i)
        b = np.flatnonzero(block == j)
        x, y = np.nonzero(unit[a] @ unit[b].T >= least)
        x, y = a[x], b[y]
        once = x < y if i == j else np.ones(len(x), bool)
        x, y = x[once], y[once]
        links = np.zeros(len(rows), np.int64)
        root = np.arange(len(rows))
        if len(x):
            widest = max(map(len, rows["leaves"]))
            signs = np.array([list(s) + [-1 - k] * (widest - len(s)) for k, s in enumerate(rows["leaves"])])
            first = np.ones(len(x), bool)
            for c in range(widest):  # a leaf before this one that both are in
                mine = signs[x, c]
                first &= ~((mine < leaf) & (signs[y] == mine[:, None]).any(1))
            np.add.at(links, x[first], copies[y[first]])
            np.add.at(links, y[first], copies[x[first]])
            while True:
                low = np.minimum(root[x], root[y])
                before = root.copy()
                np.minimum.at(root, x, low)
                np.minimum.at(root, y, low)
                if np.array_equal(before, root):
                    break
        found = np.zeros(len(rows), bool)
        found[x] = found[y] = True
        return pd.DataFrame({"node": node[found], "links": links[found], "root": node[root[found]]})

    return run


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) with ``n_links``, ``component_id`` and ``kept``."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    sound = (F.col("label").isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(value, lambda x: x != 0))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), value.alias("embedding"),
                          F.coalesce(sound, F.lit(False)).alias("sound"))
    distinct = materialize(rows.where("sound").groupBy("label", "embedding").agg(F.min("vec_id").alias("first"),
                                                                                F.count("*").alias("copies")), "distinct")
    # Ids given once, to a written table: they stay the same for every later reading.
    distinct = materialize(distinct.select(F.monotonically_increasing_id().alias("node"), "label",
                                           F.size("embedding").alias("dim"), "embedding", "copies", "first"), "numbered")
    # Written: its join then knows its size and leaves the vectors, of which one label may have most, where they are.
    labels = materialize(distinct.groupBy("dim", "label").agg(F.count("*").alias("n")), "labels")
    largest = labels.groupBy("dim").agg(
        F.max("n").alias("largest"), F.sum("n").alias("all")).collect()  # a row for each length of vectors
    found = None
    for dim, n, every in sorted(map(tuple, largest)):
        depth = max(0, int(np.ceil(np.log2(n / LEAF))))
        some = distinct.where(F.col("dim") == dim)
        sample = drawn(some, every) if depth else []
        forest = fit(_unit(sample) if sample else np.zeros((0, dim)), depth)
        deep = labels.where((F.col("dim") == dim) & (F.col("n") > LEAF)).select(
            "label", F.ceil(F.log2(F.col("n") / LEAF)).cast("int").alias("depth"))
        some = some.join(deep, "label", "left").select("node", "label", "dim", "embedding", "copies",
                                                       F.coalesce("depth", F.lit(0)).alias("depth"))
        part = materialize(_indexed(some, dim, forest, depth)
                           .withColumn("leaf", F.explode("leaves")), "leaves")
        sizes = part.groupBy("label", "dim", "leaf").agg(F.count("*").alias("n")).where("n > 1").select(
            "label", "dim", "leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        dealt = part.join(sizes, ["label", "dim", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
            {"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        pairs = dealt.select("label", "dim", "leaf", "i", "j", "node", "embedding", "copies", "leaves", "block").groupBy(
            "label", "dim", "leaf", "i", "j").applyInPandas(_compare(least), "node long, links long, root long")
        pairs = materialize(pairs, "links")
        discard(part)
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node long, links long, root long")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).select(
        "node", F.col("root").alias("top"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.join(links, "node", "left").join(roots, "node", "left").select(
        "label", "embedding", "first", F.coalesce("top", "node").alias("top"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    ids = known.groupBy("top").agg(F.min("first").alias("component_id"))
    known = known.join(ids, "top").select("label", "embedding", "n_links", "component_id")
    linked = rows.where("sound").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_forest": op7_forest}
#: For small tables: all pairs within a label.
OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT low.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, low.vec_id = component_id AS kept FROM low LEFT JOIN n ON n.x = low.vec_id"""

SQL = {"op7_forest": OP7_SQL}
