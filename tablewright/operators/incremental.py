"""Metrics kept up to date by month, without reading the other months again.

What a metric needs of a month is written as a state, one partition a month:

* ``values``: every value of every group with its number of rows, for medians;
* ``sums``: sums and counts of a group, for volumes and counts.

States of months are merged by adding counts and sums, so a metric over all months is
that of a full run.  When a file replaces a month (a ``_filled`` version, a correction),
``refresh`` writes the state of that month anew; rows of other months aren't read and
their partitions stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.quantiles import dealt, quantiles_of
from tablewright.operators.schema import q
from tablewright.session import materialize
from tablewright.sources.sinks import PARTITIONS, write_table


@dataclass(frozen=True)
class MonthlyState:
    """The states below ``path``: ``values`` by name, counted for the groups ``keys``; ``sums``: by name, the key and
    the amount that are summed per value of the key."""

    path: str
    month: str
    keys: tuple[str, ...] = ()
    values: Mapping[str, ColumnLike] = field(default_factory=dict)
    sums: Mapping[str, tuple[ColumnLike, ColumnLike]] = field(default_factory=dict)

    def refresh(self, rows: DataFrame, months: Sequence[str] = ()) -> None:
        """Write the states of all months of ``rows`` anew; ``rows`` has all rows of these months.

        ``months`` that have no row any more lose their state.  Rows without a month have none."""
        month, keys = F.col(q(self.month)), [F.col(q(k)) for k in self.keys]
        present = rows.where(month.isNotNull())
        # The rows are evaluated once, narrowed to what the states need.
        narrow = materialize(present.select(
            month.alias("_month"), *keys, *[col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(self.values.values())],
            *[c for i, (key, amount) in enumerate(self.sums.values())
              for c in (col(key).alias(f"_k{i}"), col(amount).cast("double").alias(f"_a{i}"))]), "months")
        out = narrow.withColumnRenamed("_month", self.month)
        if self.values:
            pairs = [F.struct(F.lit(n).alias("_metric"), F.when(~F.isnan(f"_v{i}"), F.col(f"_v{i}")).alias("_v")) for i, n in enumerate(self.values)]
            counts = out.select(month, *keys, F.inline(F.array(*pairs))).groupBy(month, *keys, "_metric", "_v").agg(F.count(F.lit(1)).alias("_c"))
            write_table(counts, f"{self.path}/values", partition_by=[self.month], replace=PARTITIONS)
        for i, name in enumerate(self.sums):
            sums = out.groupBy(month, F.col(f"_k{i}").alias("key")).agg(F.sum(f"_a{i}").alias("amount"), F.count(F.lit(1)).alias("n"))
            write_table(sums, f"{self.path}/sums-{name}", partition_by=[self.month], replace=PARTITIONS)
        if months:
            left = {str(r[0]) for r in narrow.where(F.col("_month").isin(list(months))).select("_month").distinct().collect()}
            for gone in set(months) - left:
                self._drop(rows.sparkSession, gone)

    def _drop(self, spark: SparkSession, month: str) -> None:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for part in (["values"] if self.values else []) + [f"sums-{n}" for n in self.sums]:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}/{self.month}={month}")
            folder.getFileSystem(conf).delete(folder, True)

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{part}").withColumn(self.month, F.col(q(self.month)).cast("string"))

    def medians(self, spark: SparkSession, by: Sequence[str], names: Sequence[str], months: Sequence[str] | None = None) -> DataFrame:
        """(by..., metric, n, value): the median and the number of values of each metric per group, of all
        months or of those given; ``by``: any of the keys and the month.  Missing keys form no group."""
        state = self._read(spark, "values").where(F.col("_metric").isin(list(names)))
        if months is not None:
            state = state.where(F.col(q(self.month)).isin(list(months)))
        for b in by:
            state = state.where(F.col(q(b)).isNotNull())
        keys = [F.col(q(b)) for b in by]
        counted = dealt(state.groupBy(*keys, "_metric", "_v").agg(F.sum("_c").alias("_c")), [*by, "_metric"])
        return quantiles_of(counted, [0.5], [*by, "_metric"], ["value"], n_name="n").withColumnRenamed("_metric", "metric").select(
            *keys, "metric", "n", "value")

    def totals(self, spark: SparkSession, name: str) -> DataFrame:
        """(key, amount, n) over all months; a missing key forms no group."""
        state = self._read(spark, f"sums-{name}").where(F.col("key").isNotNull())
        return state.groupBy("key").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"))
