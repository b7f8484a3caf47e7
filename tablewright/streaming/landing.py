"""Incremental landing of a drop folder: the combine stage, run as files arrive.

A file stream over the folder yields only the *names* of new extract files
(``binaryFile`` with just the ``path`` column selected never reads file
contents).  Each micro-batch:

1. merges the new names into a manifest kept next to the output: one row a period, in
   a partition of its own, with the first name and the last preferred one.  The rule of
   ``select_versions`` needs no more, so a batch reads and writes the rows of the periods
   it touches, however many names came before;
2. re-decides the chosen version of every period the new files touch (a late
   ``_filled`` file replaces the plain one);
3. lands the chosen files of those periods (per header group, typed) and
   overwrites exactly those period partitions of the output table.

Steps 2-3 depend only on the manifest, and merging names once more changes nothing, so
replaying a batch after a failure writes the same partitions again (idempotent).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.session import observed
from tablewright.sources import csv as C
from tablewright.sources import files as FS
from tablewright.sources.sinks import PARTITIONS, write_table

PERIOD = "period"
# the fixed schema of Spark's binaryFile source
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
SOURCE = "_source_file"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def merge_names(spark: SparkSession, manifest_path: str, new_paths: Sequence[str], key_pattern: str,
                preferred: str = "_filled") -> dict[str, str]:
    """Merge new files into the manifest; the chosen path of each period that they touch.

    A manifest row is a period's first name and last preferred name with their paths: minimum and
    maximum, so merging is idempotent and the order of batches doesn't matter."""
    name, path = F.col("file_name"), F.col("file_path")
    found = FS.manifest(spark, list(new_paths)).select(
        F.regexp_extract("file_name", key_pattern, 1).alias(PERIOD), F.struct(name, path).alias("first"),
        F.when(name.contains(preferred), F.struct(name, path)).alias("preferred")).where(F.col(PERIOD) != "")
    touched = sorted(r[0] for r in found.select(PERIOD).distinct().collect())  # at most one for each new name
    if not touched:
        return {}
    known = [f"{manifest_path}/{PERIOD}={p}" for p in touched]
    known = [k for k in known if (lambda p, fs: fs.exists(p))(*_path(spark, k))]
    if known:
        old = spark.read.schema(found.schema).option("basePath", manifest_path).parquet(*known)
        found = found.unionByName(old.select(*found.columns))
    rows = found.groupBy(PERIOD).agg(F.min("first").alias("first"), F.max("preferred").alias("preferred")).collect()
    write_table(spark.createDataFrame(rows, found.schema), manifest_path, partition_by=[PERIOD], replace=PARTITIONS)
    return {r[PERIOD]: (r["preferred"] or r["first"])["file_path"] for r in rows}


def land_batch(spark: SparkSession, new_paths: Sequence[str], out_path: str, prefix: str,
               key_pattern: str | None = None, preferred: str = "_filled",
               types: Mapping[str, str] | None = None, drop: Sequence[str] = (), **csv_options) -> list[str]:
    """Land one batch of new files; returns the periods rewritten.

    A period whose chosen file has no rows loses its old partition.  Months
    may have different columns: read the output with ``mergeSchema``
    (``read_landed``)."""
    key_pattern = key_pattern or FS.period_pattern(prefix)
    # one row per touched period: the paths needed to plan the scans
    chosen = merge_names(spark, f"{out_path}/_manifest", new_paths, key_pattern, preferred)
    if not chosen:
        return []
    landed = C.read_csv_landed(spark, sorted(chosen.values()), types=types, drop=drop,
                               file_name_col=SOURCE, **csv_options)
    landed = landed.withColumn(PERIOD, F.regexp_extract(SOURCE, key_pattern, 1))
    # Which periods have rows is seen by the job that writes them.
    seen, periods = Observation(), sorted(chosen)
    landed = landed.observe(seen, *[F.max(F.when(F.col(PERIOD) == p, 1)).alias(p) for p in periods])
    write_table(landed, out_path, partition_by=[PERIOD], replace=PARTITIONS)
    rows = observed(seen)
    for period in periods:
        if not rows.get(period):
            old, fs = _path(spark, f"{out_path}/{PERIOD}={period}")
            fs.delete(old, True)
    return periods


def read_landed(spark: SparkSession, out_path: str) -> DataFrame:
    """The landed table with the columns of all months."""
    return spark.read.option("mergeSchema", True).parquet(out_path)


def start_landing(spark: SparkSession, folder: str, prefix: str, out_path: str,
                  suffix: str = ".csv", checkpoint: str | None = None, key_pattern: str | None = None,
                  preferred: str = "_filled", types: Mapping[str, str] | None = None,
                  drop: Sequence[str] = ("latfilled", "lonfilled"), max_files_per_trigger: int = 1000,
                  available_now: bool = False) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    names: DataFrame = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                        .option("pathGlobFilter", f"{prefix}*{suffix}")
                        .option("maxFilesPerTrigger", max_files_per_trigger)
                        .load(folder).select("path"))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]   # names only, at most max_files_per_trigger
        if paths:
            land_batch(spark, paths, out_path, prefix, key_pattern, preferred, types, drop)

    writer = (names.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint or f"{out_path}/_stream_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
