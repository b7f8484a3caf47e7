"""The monthly mean of a series as a stream: sums and counts by month in event-time state.

Observations belong to the month of their own date, whenever they arrive.  The month is
the event time: a row is taken while its month begins no earlier than the latest month
seen less ``delay``; state of older months is dropped, so it holds a bounded number of
months however long the stream runs (Spark counts rows that come later than that as
``numRowsDroppedByWatermark``).

Every micro-batch emits the months it changed; their partitions of the output are
overwritten, so a batch that is replayed after a failure writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.functions.dates import month_start
from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.timeseries import KEY
from tablewright.session import settings
from tablewright.sources.sinks import PARTITIONS, write_table

#: Partitions of the state, at most: a task sends one row a month, and every stateful task of every batch reports to the driver.
STATE_PARTITIONS = 16


def monthly_sums(stream: DataFrame, date: ColumnLike, value: ColumnLike, delay: str) -> DataFrame:
    """(month, total, n) of a stream: sums and counts of the non-missing values by month, undated rows left out."""
    rows = stream.select(month_start(date).cast("timestamp").alias("month"), col(value).cast("double").alias("_v"))
    return (rows.where(F.col("month").isNotNull()).withWatermark("month", delay)
            .groupBy("month").agg(F.sum("_v").alias("total"), F.count("_v").alias("n")))


def start_monthly_mean(stream: DataFrame, date: ColumnLike, value: ColumnLike, out_path: str, checkpoint: str,
                       delay: str = "100 days", available_now: bool = False) -> StreamingQuery:
    """Keep the sums by month of ``stream`` in ``out_path``; ``available_now`` processes what is there and stops."""
    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        changed = batch.select(F.date_format("month", "yyyy-MM").alias(KEY), "total", "n")
        write_table(changed, out_path, partition_by=[KEY], replace=PARTITIONS)

    writer = (monthly_sums(stream, date, value, delay).writeStream.outputMode("update").foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    spark = stream.sparkSession
    parts = min(STATE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with settings(spark, {"spark.sql.shuffle.partitions": str(parts)}):  # the stream keeps the settings it starts with
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_monthly_sums(spark: SparkSession, out_path: str) -> DataFrame:
    """(year_month, total, n) as of the last batch; ``n`` counts non-missing values."""
    return spark.read.schema(f"total double, n long, {KEY} string").parquet(out_path).select(KEY, "total", "n")


def read_monthly_mean(spark: SparkSession, out_path: str, name: str = "rate") -> DataFrame:
    """(year_month, <name>) as ``timeseries.monthly_mean`` has it: a month without a value has none."""
    return read_monthly_sums(spark, out_path).select(KEY, F.try_divide("total", "n").alias(name))
