"""Market metrics: group medians, ratios, rankings, monthly trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.dates import month_key
from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.quantiles import dealt, null_safe_join, quantiles, quantiles_of, value_counts
from tablewright.operators.schema import q
from tablewright.session import materialize


def group_median(df: DataFrame, by: str | Sequence[str], value: ColumnLike, name: str = "median",
                 min_size: int | None = None, method: str = "exact") -> DataFrame:
    """(by..., n, median) with missing keys dropped; ``n`` counts non-missing
    values and ``min_size`` keeps groups with at least that many.  A group
    whose values are all missing has n = 0 and a missing median."""
    by = [by] if isinstance(by, str) else list(by)
    med = quantiles(_with_keys(df, by), value, [0.5], by=by, names=[name], method=method, n_name="n")
    if min_size is not None:
        med = med.where(F.col("n") >= min_size)
    return med.select(*[F.col(q(b)) for b in by], "n", name)


def _with_keys(df: DataFrame, by: Sequence[str]) -> DataFrame:
    for b in by:
        df = df.where(F.col(q(b)).isNotNull())
    return df


def top_n(df: DataFrame, measure: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``measure`` (missing last, ties by ``tiebreak``)."""
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc(t) for t in tiebreak]).limit(n)


def latest_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in the order of ``order`` (a key is required: row
    order is not defined otherwise)."""
    return df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], measure: str, n: int,
                    tiebreak: Sequence[str] = (), rank_name: str = "rank") -> DataFrame:
    """Top ``n`` rows per group by ``measure``.  The ``row_number() <= n``
    filter lets Spark cut each group to ``n`` rows before the shuffle."""
    w = Window.partitionBy(*group).orderBy(F.desc_nulls_last(measure), *[F.asc(t) for t in tiebreak])
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= n)


def volume_by(df: DataFrame, who: str, amount: ColumnLike, per: Sequence[Column | str] = ()) -> DataFrame:
    """Sales volume (sum of amount) and count per ``who`` (and per period)."""
    return (df.where(F.col(q(who)).isNotNull())
            .groupBy(*per, q(who))
            .agg(F.sum(col(amount)).alias("volume"), F.count(F.lit(1)).alias("n_sales")))


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den, null when den is 0 or either side is missing (no error under ANSI)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def monthly_counts(df: DataFrame, date: ColumnLike, name: str, key: str = "year_month") -> DataFrame:
    return (df.select(month_key(date).alias(key)).where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias(name)))


def new_vs_closed(listings: DataFrame, listing_date: ColumnLike, sales: DataFrame,
                  close_date: ColumnLike, key: str = "year_month") -> DataFrame:
    """(year_month, new_listings, closed_sales), months of either side, 0-filled."""
    a = monthly_counts(listings, listing_date, "new_listings", key)
    b = monthly_counts(sales, close_date, "closed_sales", key)
    return (a.join(b, key, "full")
            .select(key, F.coalesce("new_listings", F.lit(0)).alias("new_listings"),
                    F.coalesce("closed_sales", F.lit(0)).alias("closed_sales")))


def medians_by(df: DataFrame, by: Sequence[str], values: dict[str, ColumnLike],
               method: str = "exact") -> DataFrame:
    """(by..., n, <name>...) medians of several values per group; ``n`` counts
    the group's rows.  The values are stacked to (metric, value) and counted
    by group and metric in one evaluation of ``df``; medians and ``n`` (all
    rows of the first metric, missing values included) come from the counts."""
    pairs = [F.struct(F.lit(name).alias("_metric"), col(c).cast("double").alias("_x"))
             for name, c in values.items()]
    keys = [F.col(q(b)) for b in by]
    base = _with_keys(df, by).select(*keys, F.inline(F.array(*pairs)))
    if method != "exact":
        med = quantiles(base, "_x", [0.5], by=[*by, "_metric"], names=["_m"], method=method)
        sizes = _with_keys(df, by).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    else:
        return medians_of(value_counts(base, "_x", [*by, "_metric"]), by, list(values))
    return _wide(med, sizes, by, list(values))


def _wide(med: DataFrame, sizes: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    wide = med.groupBy(*[F.col(q(b)) for b in by]).agg(
        *[F.max(F.when(F.col("_metric") == name, F.col("_m"))).alias(name) for name in names])
    return null_safe_join(sizes, wide, by)


def medians_of(counted: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(by..., n, <name>...) of values counted by group and ``_metric``."""
    keys = [F.col(q(b)) for b in by]
    med = quantiles_of(counted, [0.5], [*by, "_metric"], ["_m"])
    sizes = counted.where(F.col("_metric") == names[0]).groupBy(*keys).agg(F.sum("_c").alias("n"))
    return _wide(med, sizes, by, names)


def medians_rollup(df: DataFrame, levels: dict[str, Sequence[str]], values: dict[str, ColumnLike]) -> DataFrame:
    """(level, keys..., n, <name>...): the medians of ``medians_by`` for several groupings of one table.

    ``levels``: the keys of each level by its name; keys that a level hasn't are null.  ``df`` is evaluated
    once, counted by value at the finest grouping and written; the counts of all levels are merged from that
    table by grouping sets, and ranked together.  A row whose key is missing is left out of the levels
    with that key only."""
    every = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    keys = [F.col(q(k)) for k in every]
    pairs = [F.struct(F.lit(n).alias("_metric"), col(c).cast("double").alias("_v")) for n, c in values.items()]
    fine = df.select(*keys, F.inline(F.array(*pairs))).withColumn("_v", F.when(~F.isnan("_v"), F.col("_v")))
    fine = materialize(fine.groupBy(*keys, "_metric", "_v").agg(F.count(F.lit(1)).alias("_c")), "fine-counts")
    sets = [[F.col(q(k)) for k in some] + [F.col("_metric"), F.col("_v")] for some in levels.values()]
    # The bits of the keys that a level hasn't, from the first key to the value.
    bit = {k: 1 << (len(every) + 1 - i) for i, k in enumerate(every)}
    number = {name: sum(bit[k] for k in every if k not in some) for name, some in levels.items()}
    if len(set(number.values())) < len(levels):
        raise ValueError("two levels have the same keys")
    merged = fine.groupingSets(sets, *keys, "_metric", "_v").agg(F.grouping_id().alias("_level"), F.sum("_c").alias("_c"))
    level, whole = F.lit(None).cast("string"), F.lit(False)
    for name, some in levels.items():
        mine = F.col("_level") == number[name]
        level = F.when(mine, name).otherwise(level)
        present = mine
        for k in some:
            present = present & F.col(q(k)).isNotNull()
        whole = whole | present
    merged = merged.where(whole).withColumn("level", level).drop("_level")
    return medians_of(dealt(merged, ["level", *every, "_metric"]), ["level", *every], list(values))
