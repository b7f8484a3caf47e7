"""Quantiles with linear interpolation, exact or approximate, per group.

``method="exact"`` ranks values without gathering a group:

1. ``value_counts`` pre-aggregates ``(group, value) -> multiplicity`` (map-side
   combined), deals the pairs to range partitions by group and value, and
   writes them with the number of their partition.
2. Per (partition, group) the rows are summed; a running sum over that small
   table (one row per partition and group) gives the rank at which every
   slice of a group begins.
3. Only slices that hold a wanted rank are ranked, each within its own range
   partition, and ``lo + (pos - floor(pos)) * (hi - lo)`` with
   ``pos = p * (n - 1)`` is the rule of pandas' default ``quantile``, Spark's
   ``percentile`` and DuckDB's ``quantile_cont``.

No task ever holds more than one range partition, whatever share of the rows
a group or a value has: equal values are one row, and a large group is spread
over as many partitions as its values need.  The written table also answers
counts, sums and means of the same groups, so a report reads its input once.
``method="approx"`` is plain ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.schema import q
from tablewright.session import materialize

_ONE = "_tw_one"  # constant key attaching a one-row statistics frame
SKETCH_ACCURACY = 100_000


def quantile_name(p: float) -> str:
    """Output column name for probability ``p``: 0.25 -> q25, 0.05 -> q5, 0.125 -> q12_5."""
    text = f"{p * 100:.6f}".rstrip("0").rstrip(".")
    return "q" + text.replace(".", "_")


def value_counts(df: DataFrame, value: ColumnLike, by: Sequence[str] = (),
                 sums: Mapping[str, ColumnLike] | None = None) -> DataFrame:
    """Written table (by..., ``_v``, ``_c``, ``_part``): every value of every
    group with its number of rows, dealt to range partitions.

    This is the one stage that runs a job when called: ``df`` is evaluated
    once, here.  Missing values (null, NaN) are kept as one null per group, so
    that a group without any value is still a group.  ``sums`` adds
    ``<name>`` and ``<name>_n``, the sum and number of non-missing values of
    further columns."""
    v = col(value).cast("double")
    extra = {n: col(c).cast("double") for n, c in (sums or {}).items()}
    base = df.select(*[F.col(q(k)) for k in by], F.when(~F.isnan(v), v).alias("_v"),
                     *[c.alias(n) for n, c in extra.items()])
    keys = [F.col(q(k)) for k in by]
    counts = base.groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_c"), *[F.sum(n).alias(n) for n in extra], *[F.count(n).alias(f"{n}_n") for n in extra])
    return dealt(counts, by)


def dealt(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counted values (by..., ``_v``, ``_c``) dealt to range partitions and written with their number."""
    keys = [F.col(q(k)) for k in by]
    return materialize(counts.repartitionByRange(*keys, F.col("_v")).withColumn("_part", F.spark_partition_id()), "value-counts")


def quantiles_of(counted: DataFrame, probs: Sequence[float], by: Sequence[str] = (),
                 names: Sequence[str] | None = None, n_name: str | None = None) -> DataFrame:
    """Quantiles of a ``value_counts`` table, or of any rows of one; ``n_name``
    adds the number of non-missing values.  A group without any has nulls."""
    probs = _checked(probs)
    names = list(names) if names else [quantile_name(p) for p in probs]
    keys = [F.col(q(k)) for k in by]
    present = counted.where(F.col("_v").isNotNull())
    slices = present.groupBy(*keys, "_part").agg(F.sum("_c").alias("_m"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    slices = slices.withColumns({
        "_n": F.sum("_m").over(group),
        "_before": F.sum("_m").over(group.orderBy("_part")) - F.col("_m")})
    n = F.col("_n")
    pos = [F.lit(p) * (n - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x) for x in pos for f in (F.floor, F.ceil)]))
    held = slices.where(F.exists(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_m"))))

    # The wanted slices, each ranked in its own range partition.
    other = held.select(*[F.col(q(k)).alias(f"_k{i}") for i, k in enumerate(by)],
                        F.col("_part").alias("_p"), "_n", "_before")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(by):
        same = same & F.col(q(k)).eqNullSafe(F.col(f"_k{i}"))
    rows = present.join(other, same)
    here = Window.partitionBy("_part", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("_before") + F.sum("_c").over(here)
    rows = rows.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_c"))
    at = lambda r: F.max(F.when((F.col("_start") <= r) & (r < F.col("_end")), F.col("_v")))
    found = rows.groupBy(*keys).agg(
        F.max("_n").alias("_n"), *[at(F.floor(x)).alias(f"_lo{i}") for i, x in enumerate(pos)],
        *[at(F.ceil(x)).alias(f"_hi{i}") for i, x in enumerate(pos)])

    def interpolate(i: int) -> Column:
        lo, hi, frac = F.col(f"_lo{i}"), F.col(f"_hi{i}"), pos[i] - F.floor(pos[i])
        return F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac)

    out = found.select(*keys, *[interpolate(i).alias(x) for i, x in enumerate(names)],
                       *([F.col("_n").alias(n_name)] if n_name else []))
    if not by:
        return out
    groups = counted.select(*keys).distinct()
    joined = null_safe_join(groups, out, by)
    return joined.withColumn(n_name, F.coalesce(F.col(n_name), F.lit(0))) if n_name else joined


def null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join on ``by`` in which missing keys match each other."""
    renamed = right.select(*[F.col(q(k)).alias(f"_j{i}") for i, k in enumerate(by)],
                           *[F.col(q(c)) for c in right.columns if c not in by])
    same = None
    for i, k in enumerate(by):
        one = F.col(q(k)).eqNullSafe(F.col(f"_j{i}"))
        same = one if same is None else same & one
    return left.join(renamed, same, "left").drop(*[f"_j{i}" for i in range(len(by))])


def _checked(probs: Sequence[float]) -> list[float]:
    probs = [float(p) for p in probs]
    if not probs or any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    return probs


def quantiles(df: DataFrame, value: ColumnLike, probs: Sequence[float], by: Sequence[str] = (),
              method: str = "exact", names: Sequence[str] | None = None, accuracy: int = SKETCH_ACCURACY,
              n_name: str | None = None) -> DataFrame:
    """One row per group of ``by`` with one double column per probability.

    Missing values are skipped; a group without any value has nulls.  The exact
    method evaluates ``df`` once, when called (``value_counts``)."""
    probs = _checked(probs)
    names = list(names) if names else [quantile_name(p) for p in probs]
    if method == "exact":
        return quantiles_of(value_counts(df, value, by), probs, by, names, n_name)
    if method != "approx":
        raise ValueError(f"unknown method {method!r}")
    v = col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    keys = [F.col(q(k)) for k in by]
    return (df.groupBy(*keys).agg(F.percentile_approx(v, probs, accuracy).alias("_q"), F.count(v).alias("_n"))
            .select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)],
                    *([F.col("_n").alias(n_name)] if n_name else [])))


def median(df: DataFrame, value: ColumnLike, by: Sequence[str] = (), name: str = "median",
           method: str = "exact") -> DataFrame:
    return quantiles(df, value, [0.5], by=by, method=method, names=[name])


def fence(bounds: DataFrame, k: float = 1.5) -> DataFrame:
    """``q1``, ``q3`` with the fence ``[q1 - k*iqr, q3 + k*iqr]``."""
    iqr = F.col("q3") - F.col("q1")
    return bounds.withColumns({"lower": F.col("q1") - k * iqr, "upper": F.col("q3") + k * iqr})


def iqr_bounds(df: DataFrame, value: ColumnLike, k: float = 1.5, by: Sequence[str] = (),
               method: str = "exact") -> DataFrame:
    """q1, q3 and the fence per group."""
    return fence(quantiles(df, value, [0.25, 0.75], by=by, method=method, names=["q1", "q3"]), k)


def attach(df: DataFrame, small: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attach per-group (or one global) statistics to every row.

    Per group: an equi-join on the group keys (AQE broadcasts the statistics
    side once measured small, else sort-merge with skew splitting).  Global:
    the single statistics row is broadcast to every task."""
    if by:
        return null_safe_join(df, small, by)
    # ungrouped: exactly one statistics row, broadcast; Spark runs this as a
    # broadcast nested-loop join against that single row (one partner per
    # row, no shuffle of ``df``)
    one = F.broadcast(small.withColumn(_ONE, F.lit(0)))
    return df.withColumn(_ONE, F.lit(0)).join(one, _ONE, "left").drop(_ONE)


def within(c: Column, lo: Column, hi: Column) -> Column:
    return (c >= lo) & (c <= hi)
