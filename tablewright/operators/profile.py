"""Table profiles: missing values, numeric summaries, fences, histograms, boxes.

Every report is computed in one pass over the data (one aggregate for all
columns, partial/final, so each task ships one small row per group) and
then reshaped to a long table with ``inline`` -- never one job per column.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.quantiles import attach, fence, iqr_bounds, quantiles, quantiles_of, value_counts, within
from tablewright.operators.schema import column_metadata, q
from tablewright.session import observed

DESCRIBE_PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) with the values cast to double."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("double").alias("value"))
             for c in columns]
    return df.select(*[F.col(q(k)) for k in keep], F.inline(F.array(*pairs)))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_count, missing_pct), highest share first, then by name."""
    columns = list(columns) if columns is not None else list(df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count_if(F.col(q(c)).isNull()).alias(f"_m{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_count"))
                     for i, c in enumerate(columns)])
    return (counts.select("_n", F.inline(rows))
            .withColumn("missing_pct", F.col("missing_count") / F.col("_n") * F.lit(100.0))
            .drop("_n")
            .orderBy(F.desc_nulls_last("missing_pct"), F.asc("column")))


def high_missing(report: DataFrame, threshold: float = 90.0) -> DataFrame:
    """Rows of a missing report strictly above ``threshold`` percent."""
    return report.where(F.col("missing_pct") > threshold)


def column_profile(spark: SparkSession, df: DataFrame, **classes) -> DataFrame:
    """Per column: position, category, Spark type and missing statistics."""
    meta = column_metadata(spark, df, **classes)
    return meta.join(missing_report(df), "column").orderBy("position")


def dtype_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("dtype").agg(F.count(F.lit(1)).alias("n"))


def dtype_profile(profile: DataFrame) -> DataFrame:
    """(dtype, n_columns, n_empty, n_missing): the columns of each type in a ``column_profile``, how many of them
    hold no value at all, and their missing values together."""
    return profile.groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"), F.count_if(F.col("missing_pct") == 100).alias("n_empty"),
                                        F.sum("missing_count").alias("n_missing"))


def numeric_summary(df: DataFrame, columns: Sequence[str],
                    percentiles: Sequence[float] = DESCRIBE_PERCENTILES,
                    method: str = "exact") -> DataFrame:
    """Long summary (column, statistic, value): count, mean, std, min, p%, max.

    ``std`` is the sample standard deviation; percentiles interpolate
    linearly.  All columns are counted by value in one evaluation of ``df``;
    every statistic comes from those counts (grouped by column)."""
    labels = [f"{p * 100:g}%" for p in percentiles]
    names = [f"_p{i}" for i in range(len(percentiles))]
    counted = value_counts(_long(df, columns), "value", ["column"])
    present = counted.where(F.col("_v").isNotNull())
    weight, v = F.col("_c"), F.col("_v")
    basic = present.groupBy("column").agg(
        F.sum(weight).alias("count"), (F.sum(v * weight) / F.sum(weight)).alias("mean"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    # around the mean, so that large values with small differences keep their digits
    spread = attach(present, basic.select("column", "mean"), ["column"]).groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(weight * F.pow(v - F.col("mean"), F.lit(2))), F.sum(weight) - 1)).alias("std"))
    qs = (quantiles_of(counted, percentiles, ["column"], names) if method == "exact"
          else quantiles(_long(df, columns), "value", percentiles, ["column"], method, names))
    wide = attach(attach(basic, spread, ["column"]), qs, ["column"])
    stats = [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min")]
    stats += [(lab, f"_p{i}") for i, lab in enumerate(labels)] + [("max", "max")]
    rows = F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(c).cast("double").alias("value")) for s, c in stats])
    return wide.select("column", F.inline(rows))


def column_summary(df: DataFrame, column: str, method: str = "exact") -> DataFrame:
    return numeric_summary(df, [column], (0.25, 0.5, 0.75), method=method)


def median_and_mean(df: DataFrame, value: ColumnLike, method: str = "exact") -> DataFrame:
    if method != "exact":
        med = quantiles(df, value, [0.5], names=["median"], method=method)
        return attach(df.agg(F.avg(col(value).cast("double")).alias("mean")), med)
    counted = value_counts(df, value)
    mean = counted.agg((F.sum(F.col("_v") * F.col("_c")) / F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")))).alias("mean"))
    return attach(mean, quantiles_of(counted, [0.5], names=["median"]))


def sign_shares(df: DataFrame, a: ColumnLike, b: ColumnLike) -> DataFrame:
    """Share of rows (in % of *all* rows) where a > b, a < b, a == b."""
    diff = col(a) - col(b)
    n = F.count(F.lit(1))
    pct = lambda p: F.count_if(p) / n * F.lit(100.0)
    return df.agg(pct(diff > 0).alias("above_pct"), pct(diff < 0).alias("below_pct"),
                  pct(diff == 0).alias("equal_pct"), n.alias("n_rows"))


def iqr_filter(df: DataFrame, value: ColumnLike, k: float = 1.5, by: Sequence[str] = (),
               method: str = "exact") -> DataFrame:
    """Rows whose value lies inside ``[q1 - k iqr, q3 + k iqr]`` (missing dropped)."""
    v = col(value)
    tagged = df.withColumn("_tw_v", v.cast("double"))
    bounds = iqr_bounds(tagged, "_tw_v", k, by=by, method=method).select(
        *by, F.col("lower").alias("_tw_lo"), F.col("upper").alias("_tw_hi"))
    kept = attach(tagged, bounds, by).where(within(F.col("_tw_v"), F.col("_tw_lo"), F.col("_tw_hi")))
    return kept.drop("_tw_v", "_tw_lo", "_tw_hi")


def _fenced(counted: DataFrame, k: float) -> DataFrame:
    """The rows of a ``value_counts`` table inside their own fence."""
    bounds = fence(quantiles_of(counted, [0.25, 0.75], names=["q1", "q3"]), k).select("lower", "upper")
    return (attach(counted, bounds).where(within(F.col("_v"), F.col("lower"), F.col("upper")))
            .drop("lower", "upper"))


def histogram(spark: SparkSession, df: DataFrame, value: ColumnLike, bins: int = 50,
              fence_k: float | None = None) -> DataFrame:
    """Equal-width histogram between min and max: (bin, bin_lo, bin_hi, count).

    The last bin is closed; empty bins are reported with count 0; a constant
    column is widened by 0.5 on both sides.  ``fence_k`` leaves out values
    beyond ``fence_k`` quartile ranges first.  Fence, range and bins are taken
    from one table of counted values."""
    counted = value_counts(df, value)
    vals = _fenced(counted, fence_k) if fence_k is not None else counted.where(F.col("_v").isNotNull())
    rng = vals.agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    rng = rng.select(F.when(F.col("_a") == F.col("_b"), F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_lo"),
                     F.when(F.col("_a") == F.col("_b"), F.col("_b") + 0.5).otherwise(F.col("_b")).alias("_hi"))
    idx = F.least(F.lit(bins).cast("bigint"),
                  F.floor((F.col("_v") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))) + 1)
    counts = attach(vals, rng).groupBy(idx.alias("bin")).agg(F.sum("_c").alias("count"))
    edges = attach(spark.range(1, bins + 1).withColumnRenamed("id", "bin"), rng)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    edges = edges.select("bin", (F.col("_lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                         (F.col("_lo") + F.col("bin") * width).alias("bin_hi"))
    return (edges.join(counts, "bin", "left")
            .withColumn("count", F.coalesce(F.col("count"), F.lit(0)))
            .where(F.col("bin_lo").isNotNull())
            .orderBy("bin"))


def box_stats(df: DataFrame, value: ColumnLike, k: float = 1.5, refenced: bool = True) -> DataFrame:
    """Box-plot numbers: q1, median, q3, whiskers, outlier count.

    ``refenced=True`` draws the box from the fenced data, as a box plot of
    the IQR-filtered values does; ``False`` uses all values.  The dependent
    steps (fence, quartiles, whiskers) read one table of counted values."""
    counted = value_counts(df, value)
    vals = _fenced(counted, k) if refenced else counted.where(F.col("_v").isNotNull())
    stats = quantiles_of(vals, [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    stats = stats.withColumns({"_lf": F.col("q1") - k * iqr, "_uf": F.col("q3") + k * iqr})
    inside = within(F.col("_v"), F.col("_lf"), F.col("_uf"))
    agg = attach(vals, stats).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_c"))).alias("n_outliers"), F.sum("_c").alias("n"))
    return attach(stats.drop("_lf", "_uf"), agg)


def nested_stage_counts(first: tuple[str, DataFrame], df: DataFrame,
                        stages: Sequence[tuple[str, Column, int]]) -> DataFrame:
    """``stage_counts`` of stages that narrow one frame: ``first`` is counted
    by itself, the others by their predicates in one pass over ``df``.
    ``stages``: (name, predicate, number of columns)."""
    name, raw = first
    kept = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"_s{i}") for i, (_, p, _) in enumerate(stages)])
    row = lambda i, s, n, c: F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), n.alias("n_rows"),
                                      F.lit(c).alias("n_columns"))
    both = attach(raw.agg(F.count(F.lit(1)).alias("_first")), kept)
    rows = [row(0, name, F.col("_first"), len(raw.columns))]
    rows += [row(i + 1, s, F.col(f"_s{i}"), c) for i, (s, _, c) in enumerate(stages)]
    return (both.select("_first", F.inline(F.array(*rows)))
            .withColumn("retained_pct", F.try_divide(F.col("n_rows"), F.col("_first")) * F.lit(100.0))
            .drop("_first").orderBy("step"))


def stage_counts(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(step, stage, n_rows, n_columns, retained_pct) with the first stage as 100 %."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n_rows",
                     F.lit(len(df.columns)).alias("n_columns"))
             for i, (name, df) in enumerate(stages)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    first = parts[0].select(F.col("n_rows").alias("_first"))
    return (attach(out, first)
            .withColumn("retained_pct", F.try_divide(F.col("n_rows"), F.col("_first")) * F.lit(100.0))
            .drop("_first").orderBy("step"))


class ObservedStages:
    """Rows of each stage, counted by the job that writes the result.

    ``mark`` names a stage and returns its frame with a counter (``DataFrame.observe``);
    ``run`` takes the action that evaluates the last of them, and ``table`` then has the
    rows of ``stage_counts`` without any further scan.

    Spark adds a counter up again when it repeats a finished task because an executor
    with its shuffle files was lost.  ``run`` sees that from the attempts of its stages;
    the counts are then taken by ``stage_counts`` instead, with a scan of their own.  So
    they are if a stage wasn't counted, because a later one turned out to be empty."""

    def __init__(self) -> None:
        self._marks: list[tuple[str, DataFrame, Observation]] = []
        self.repeated: bool | None = None

    def mark(self, name: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"{len(self._marks)}-{uuid.uuid4().hex}")
        self._marks.append((name, df, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def run(self, action: Callable[[], object]) -> None:
        if not self._marks:
            raise ValueError("no stage is marked")
        sc = self._marks[0][1].sparkSession.sparkContext
        keys = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
        before = {k: sc.getLocalProperty(k) for k in keys}
        group = uuid.uuid4().hex
        sc.setJobGroup(group, "stages counted while they are written")
        try:
            action()
        finally:
            for k, v in before.items():
                sc.setLocalProperty(k, v)
        tracker = sc.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = [tracker.getStageInfo(s) for j in jobs if j is not None for s in j.stageIds]
        self.repeated = any(s is not None and s.currentAttemptId > 0 for s in stages)

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, stage, n_rows, n_columns, retained_pct) with the first stage as 100 %."""
        if self.repeated is None:
            raise ValueError("run the action first")
        counts = [(i, name, observed(seen).get("n_rows"), len(df.columns)) for i, (name, df, seen) in enumerate(self._marks)]
        if self.repeated or any(n is None for _, _, n, _ in counts):
            return stage_counts([(name, df) for name, df, _ in self._marks])
        rows = spark.createDataFrame(counts, "step int, stage string, n_rows long, n_columns int")
        first = counts[0][2]
        return rows.withColumn("retained_pct", F.try_divide(F.col("n_rows"), F.lit(first)) * F.lit(100.0)).orderBy("step")


def category_share(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share_pct): share of *all* rows; missing values form no group.

    ``df`` is evaluated once: the total is that of the counts, one row for each value."""
    counts = df.groupBy(F.col(q(column)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return (counts.withColumn("share_pct", F.col("n") / total * F.lit(100.0))
            .where(F.col("value").isNotNull()))
