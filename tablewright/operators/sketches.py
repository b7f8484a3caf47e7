"""Quantile sketches kept per group and period, merged for any period.

A KLL sketch holds a few thousand values of a group, whatever its size, and two
sketches merge into one of the same error.  A state of one sketch a month and group
(with its number of rows) is written once; quantiles of a year, of all time or of a
coarser group are merged from it without reading a fact row.  Groups of fewer than
about ``k`` values are kept whole, their quantiles are values of rank ``p``.

The error is one of rank: the value returned for ``p`` has a rank in
``p - rank_error(k) ... p + rank_error(k)`` of the exact order, but for a chance given
by ``z``.  Exact quantiles are in ``quantiles``; a sketch doesn't interpolate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.schema import q

K = 800
#: Two-sided normal quantiles: the sketch's own error is stated for 99 %, ours for all but one of 10^9 quantiles.
Z_STATED, Z = 2.576, 6.11


def rank_error(k: int = K, z: float = Z) -> float:
    """Largest distance of ranks (as a share of the rows) between a sketched quantile and the exact one."""
    return 2.296 / k ** 0.9723 * z / Z_STATED


def sketch_state(df: DataFrame, by: Sequence[str], values: Mapping[str, ColumnLike], k: int = K) -> DataFrame:
    """(by..., n, <name>...): rows and a sketch of each value per group; missing values and NaN aren't in it.

    Partial sketches of a task's rows are merged, so a group of any size is a few KB of shuffle a task."""
    keys = [F.col(q(b)) for b in by]
    cleaned = {n: col(c).cast("double") for n, c in values.items()}
    return df.select(*keys, *[F.when(~F.isnan(v), v).alias(n) for n, v in cleaned.items()]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(n, F.lit(k)).alias(n) for n in values])


def merged(state: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A state per group of ``by``: any columns of the state's rows, a period derived from its month among them."""
    return state.groupBy(*[F.col(q(b)) for b in by]).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(q(n)).alias(n) for n in names])


def sketched_quantiles(state: DataFrame, probs: Sequence[float], by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(by..., name, p, n_values, value): the quantiles of every group of ``by``, merged from ``state``; a group
    without a value has none."""
    whole = merged(state, by, names)
    one = [F.struct(F.lit(n).alias("name"), F.col(q(n)).alias("sketch")) for n in names]
    long = whole.select(*[F.col(q(b)) for b in by], F.inline(F.array(*one)))
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    n = F.kll_sketch_get_n_double("sketch")
    value = F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).otherwise(F.array_repeat(F.lit(None).cast("double"), len(probs)))
    return long.select(*[F.col(q(b)) for b in by], "name", n.alias("n_values"), F.inline(F.arrays_zip(ranks.alias("p"), value.alias("value"))))


def rank_bounds(df: DataFrame, quantiles: DataFrame, by: Sequence[str], value: ColumnLike, name: str) -> DataFrame:
    """``quantiles`` of ``name`` with ``below`` and ``up_to``: the shares of the group's values in ``df`` that are smaller
    than the quantile, and that are at most as large.  The exact quantile of any ``p`` between them is that value."""
    v = col(value).cast("double")
    keys = [F.col(q(b)) for b in by]
    wanted = quantiles.where(F.col("name") == name)
    values = df.select(*keys, F.when(~F.isnan(v), v).alias("_x")).where(F.col("_x").isNotNull())
    # Counted by value first, so that a row of the facts isn't multiplied by the quantiles asked for.
    values = values.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    asked = wanted.groupBy(*keys).agg(F.collect_list(F.struct("p", F.col("value").alias("_q"))).alias("_asked"))  # one a probability
    parts = values.join(asked, list(by)).select(*keys, "_x", "_c", F.inline("_asked"))
    counts = parts.groupBy(*keys, "p").agg(F.sum("_c").alias("_n"), F.sum(F.when(F.col("_x") < F.col("_q"), F.col("_c"))).alias("_l"),
                                           F.sum(F.when(F.col("_x") <= F.col("_q"), F.col("_c"))).alias("_u"))
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("_n")
    return wanted.join(counts, [*by, "p"]).withColumns({"below": share("_l"), "up_to": share("_u")}).drop("_n", "_l", "_u")
