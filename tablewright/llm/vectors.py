"""Helpers for exact searches over whole-number vectors.

A search is a set of stated queries against all rows: both sides are dealt into
blocks of at most ``BLOCK`` rows and every pair of blocks that share a cell is a
task of its own, so no task grows with the input, whatever cell holds most rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import materialize

#: Rows of a side of one task; at least ``SPREAD`` of them before more tasks are made for the sake of cores.
BLOCK, SPREAD = 16384, 1024
#: Rows (and numbers) of the sample that thresholds and split points are taken from.
SAMPLE, SAMPLE_NUMBERS, SEED = 8192, 1 << 22, 17


def whole_numbers(vectors: DataFrame, scale: int, query: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The vectors that take part, written: node (a number for each row), vec_id,
    ``keep``, dim, x (floor(scale * component) as long) and ``asks`` (is a query)."""
    value = F.transform("embedding", lambda v: v.cast("double"))
    sound = F.col("embedding").isNotNull() & F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.coalesce(sound, F.lit(False))).select(
        "vec_id", *keep, F.size("embedding").alias("dim"), F.transform(value, lambda v: F.floor(v * scale)).alias("x"),
        F.coalesce(query, F.lit(False)).alias("asks"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("node"), "*"), "vectors")


def drawn(rows: DataFrame, columns: Sequence[str]) -> list:
    """A bounded sample of ``rows`` by hash of their number; all of a small table.

    It only sets thresholds and split points; results never depend on it."""
    size = rows.agg(F.count("*"), F.max("dim")).first()
    most = min(SAMPLE, SAMPLE_NUMBERS // max(1, size[1] or 1)) or 1
    if size[0] > most:
        bound = min(int(most * 0.9 / size[0] * 2.0 ** 64) - 2 ** 63, 2 ** 63 - 1)
        rows = rows.where(F.xxhash64(F.lit(SEED), "node") < bound)
    return rows.select(*columns).limit(most).collect()


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A column of equally long lists as an array of numbers, one row each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros((0, dim), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def check(a: np.ndarray, b: np.ndarray) -> None:
    """Fails if an inner product of whole-number rows might not be a whole number that a double holds exactly."""
    longest = lambda m: float(np.sqrt(np.square(m, dtype=np.float64).sum(axis=1)).max(initial=0))
    if longest(a) * longest(b) * (1 + 1e-9) >= 2.0 ** 53:  # no sum of absolute products is larger
        raise OverflowError("inner products of these vectors may pass 2^53")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, as long."""
    check(a, b)
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)


def best(who: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of each ``who``; ties by the smaller ``order``."""
    at = np.lexsort((order, -score, who))
    w = who[at]
    first = np.r_[True, w[1:] != w[:-1]] if len(w) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(w)), 0)) if len(w) else np.zeros(0, np.int64)
    return at[np.arange(len(w)) - start < k]


def id_order(ids: pa.ChunkedArray) -> np.ndarray:
    """The rank of every row by its id; missing ids are last."""
    missing = np.asarray(ids.is_null())
    number = ids.fill_null(0).to_numpy().astype(np.int64)
    rank = np.empty(len(number), np.int64)
    rank[np.lexsort((number, missing))] = np.arange(len(number))
    return rank


def block_search(queries: DataFrame, rows: DataFrame, cell: Sequence[str], search: Callable, schema: str) -> DataFrame:
    """``search(key, queries, rows)`` for every pair of blocks that share a cell.

    Both frames have the columns ``cell`` and ``node``; what is in no cell with
    the other side isn't dealt.  Each query meets each row of its cells once."""
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.least(F.lit(spread), F.ceil(n / SPREAD))).cast("int")
    many = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    few = queries.groupBy(*cell).agg(F.count("*").alias("m"))
    # Written: its joins then know its size and leave rows of a hot cell where they are.
    dealt = materialize(many.join(few, list(cell)).select(
        *cell, blocks(F.col("n")).alias("row_blocks"), F.ceil(F.col("m") / BLOCK).cast("int").alias("query_blocks")), "blocks")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = [*cell, "_i", "_j"]
    left = queries.join(dealt, list(cell)).withColumn("_i", own("query_blocks")).withColumn("_j", every("row_blocks"))
    right = rows.join(dealt, list(cell)).withColumn("_j", own("row_blocks")).withColumn("_i", every("query_blocks"))
    gone = ("row_blocks", "query_blocks")
    return left.drop(*gone).groupBy(*keys).cogroup(right.drop(*gone).groupBy(*keys)).applyInArrow(search, schema)
