"""Monthly resampling of a series and its join onto a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.dates import month_key
from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.schema import q

KEY = "year_month"


def with_month_key(df: DataFrame, date: ColumnLike, key: str = KEY) -> DataFrame:
    return df.withColumn(key, month_key(date))


def monthly_mean(series: DataFrame, date: ColumnLike, value: ColumnLike,
                 name: str = "rate", key: str = KEY) -> DataFrame:
    """Down-sample to calendar months: mean of the observations dated in each
    month (missing values skipped, undated observations dropped)."""
    return (series.select(month_key(date).alias(key), col(value).cast("double").alias("_v"))
            .where(F.col(key).isNotNull())
            .groupBy(key).agg(F.avg("_v").alias(name)))


def join_monthly(fact: DataFrame, monthly: DataFrame, date: ColumnLike, key: str = KEY, unique: bool = False) -> DataFrame:
    """Left join of a monthly table onto every fact row by the month of ``date``.

    Fact rows are kept one for one: a month that occurs twice in ``monthly``
    fails the job instead of doubling rows.  ``unique`` says that none does, as in a
    table that was just grouped by it (``monthly_mean``), and saves grouping it again.
    The broadcast side has a proven bound: keys that aren't ``yyyy-MM`` can't match and are
    left out, and a key occurs once, so it has at most 12 rows for each of 9999 years."""
    once = monthly.where(F.col(key).rlike("^[0-9]{4}-(0[1-9]|1[0-2])$"))
    if not unique:
        others = [c for c in monthly.columns if c != key]
        once = once.groupBy(key).agg(F.count(F.lit(1)).alias("_times"), *[F.first(q(c)).alias(c) for c in others])
        twice = F.raise_error(F.concat(F.lit("month occurs more than once: "), F.col(key)))
        once = once.where(F.when(F.col("_times") == 1, True).otherwise(twice.cast("boolean"))).drop("_times")
    return with_month_key(fact, date, key).join(F.broadcast(once), key, "left")


def join_validation(joined: DataFrame, value: str) -> DataFrame:
    """(n_rows, n_unmatched, passed): the join passes iff no row lacks a value."""
    return (joined.agg(F.count(F.lit(1)).alias("n_rows"),
                       F.count_if(F.col(value).isNull()).alias("n_unmatched"))
            .withColumn("passed", F.col("n_unmatched") == 0))


def unmatched_by_month(joined: DataFrame, value: str, key: str = KEY) -> DataFrame:
    """(key, n_rows, n_unmatched) for the months with an unmatched row."""
    return (joined.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(value).isNull()).alias("n_unmatched"))
            .where(F.col("n_unmatched") > 0))
