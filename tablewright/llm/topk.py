"""Exact top-k search by segment statistics of several resolutions.

A vector is cut into segments, at each resolution into more of them, and a
segment is known by its mean and its deviation.  For a segment of l numbers

    |q - x|^2 >= l * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),

so the sum over the segments bounds the distance from below, coarse to fine more
tightly.  As |q - x|^2 = |q|^2 + |x|^2 - 2 * score, and the statistics keep the
norms (l * (mean^2 + dev^2) is the segment's sum of squares), the norms cancel: a
distance that is too large is a score of at most ``sum l * (mean_q * mean_x +
dev_q * dev_x)``.  A row goes on to the next resolution only while that reaches
the query's threshold; what reaches it at the finest is compared exactly.

The threshold is the k-th best exact score that a query has met: first in a
bounded sample of the rows, then among the rows of the block.  It is never above
the true k-th best score, so nothing of the result is lost, and scores are whole
numbers: no rounding decides between rows (``SLACK`` covers that of the bounds).
Queries and rows meet block by block (see ``vectors.block_search``).

Defined results: vectors that are null or hold null or non-finite components take
no part; a vector meets those of its own length, an empty one with score 0; a row
is never its own candidate, another row of the same id is; ties go to the smaller
id, missing ids last; repeated query rows each get a result; a missing id is never
a query.  Other columns are ignored, whatever their names.  Vectors whose
scores may pass 2^53 fail the job.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm import vectors as V
from tablewright.llm.common import materialize, table

TOP, EVERY, SCALE = 5, 50, 256
#: Rows and queries that are compared at a time, and the share of pairs above which a whole product is cheaper.
ROWS, ASKED, DENSE = 4096, 512, 0.05
SLACK = 1e-9


def resolutions(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16 ..., at last segments of two numbers."""
    out = [4 ** k for k in range(16) if 4 ** k < dim // 2]
    return [*out, dim // 2] if dim >= 2 else out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means, then deviations of the segments, weighted by the root of their lengths: the
    product of two rows bounds their score from above."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    length = np.diff(edges).astype(np.float64)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / length
    dev = np.sqrt(np.add.reduceat((x - np.repeat(mean, np.diff(edges), axis=1)) ** 2, edges[:-1], axis=1) / length)
    return np.concatenate([mean, dev], axis=1) * np.sqrt(np.concatenate([length, length]))


def survivors(asked: list[np.ndarray], rows: list[np.ndarray], least: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) whose bound reaches the query's threshold at every resolution."""
    alive = np.ones((len(least), len(norm)), bool)
    edge = least[:, None] - SLACK * (1 + np.linalg.norm(asked[-1], axis=1)[:, None] * norm) if asked else None
    pair = None
    for a, b in zip(asked, rows):
        if pair is None:
            alive &= a @ b.T >= edge
            if alive.mean() < DENSE:
                pair = np.nonzero(alive)
        else:
            keep = np.einsum("ij,ij->i", a[pair[0]], b[pair[1]]) >= edge[pair]
            pair = pair[0][keep], pair[1][keep]
    return pair if pair is not None else np.nonzero(alive)


def scores(q: np.ndarray, x: np.ndarray, pair: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact scores of the pairs: from one product if they are many, else pair by pair."""
    if len(pair[0]) > DENSE * len(q) * len(x):
        return V.products(q, x)[pair]
    out = np.empty(len(pair[0]), np.int64)
    V.check(q, x)
    for at in range(0, len(out), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.einsum("ij,ij->i", q[pair[0][part]], x[pair[1][part]])
    return out


def search(q: np.ndarray, q_node: np.ndarray, least: np.ndarray, x: np.ndarray, x_node: np.ndarray, order: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, rows and scores of the ``k`` best rows of each query that reach its threshold."""
    kinds = resolutions(x.shape[1])
    of_rows = [statistics(x.astype(np.float64), s) for s in kinds]
    norm = np.linalg.norm(x.astype(np.float64), axis=1)
    out = []
    for at in range(0, len(q), ASKED):
        mine = slice(at, at + ASKED)
        asked = [statistics(q[mine].astype(np.float64), s) for s in kinds]
        edge = least[mine].astype(np.float64)
        who = row = score = np.zeros(0, np.int64)
        for start in range(0, len(x), ROWS):
            part = slice(start, start + ROWS)
            pair = survivors(asked, [s[part] for s in of_rows], edge, norm[part])
            found = scores(q[mine], x[part], pair)
            good = (found >= edge[pair[0]]) & (q_node[mine][pair[0]] != x_node[part][pair[1]])
            who = np.concatenate([who, pair[0][good]])
            row = np.concatenate([row, pair[1][good] + start])
            score = np.concatenate([score, found[good]])
            kept = V.best(who, score, order[row], k)
            who, row, score = who[kept], row[kept], score[kept]
            full, n = np.unique(who, return_counts=True)
            last = np.cumsum(n) - 1
            edge[full[n == k]] = np.maximum(edge[full[n == k]], score[last[n == k]])
        out.append((who + at, row, score))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _threshold(sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Adds to the queries their k-th best score in the sample (none: minus infinity)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.full(batch.num_rows, -np.inf)
            dims, nodes = batch.column("dim").to_numpy(), batch.column("node").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                node, x = sample.get(int(dim), (np.zeros(0, np.int64), None))
                if len(node) <= k:
                    continue
                q = V.matrix(batch.column("x").take(pa.array(at)), int(dim))
                for some in np.array_split(np.arange(len(at)), len(at) // ASKED + 1):
                    s = V.products(q[some], x).astype(np.float64)
                    s[nodes[at[some]][:, None] == node] = -np.inf
                    least[at[some]] = np.partition(s, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=[*batch.schema.names, "least"])

    return run


def _in_blocks(k: int):
    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        q, x = V.matrix(queries["x"], dim), V.matrix(rows["x"], dim)
        who, row, score = search(q, queries["node"].to_numpy(), queries["least"].to_numpy(), x, rows["node"].to_numpy(),
                                 V.id_order(rows["vec_id"]), k)
        return pa.table({"node": queries["node"].take(pa.array(who)), "query_id": queries["vec_id"].take(pa.array(who)),
                         "vec_id": rows["vec_id"].take(pa.array(row)), "score": pa.array(score)})

    return run


def top_k(vectors: DataFrame, query: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` (vec_id, embedding) with the highest inner
    product with each row for which ``query`` holds, over components floor(scale * x)."""
    rows = V.whole_numbers(vectors, scale, query)
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    by_dim: dict[int, list] = {}
    for r in V.drawn(rows, ["dim", "node", "x"]):
        by_dim.setdefault(r["dim"], []).append(r)
    for dim, some in by_dim.items():
        sample[dim] = (np.array([r["node"] for r in some]), np.array([r["x"] for r in some], np.int64).reshape(len(some), dim))
    asked = rows.where("asks").select("dim", "node", "vec_id", "x")
    asked = materialize(asked.mapInArrow(_threshold(sample, k), "dim int, node long, vec_id long, x array<long>, least double"), "asked")
    found = V.block_search(asked, rows.select("dim", "node", "vec_id", "x"), ["dim"], _in_blocks(k),
                           "node long, query_id long, vec_id long, score long")
    place = Window.partitionBy("node").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


QUERIES = {"op11_topk": op11_topk}
#: For small tables: every query against every row.
OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS node, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.node, q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.node <> x.node AND len(q.e) = len(x.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

SQL = {"op11_topk": OP11_SQL}
