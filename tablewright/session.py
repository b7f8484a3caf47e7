"""Session construction and the shared scratch location.

Nothing here hard-codes a cluster: the builder only fills in defaults that
are unset, and scratch space always lives under the cluster-wide
``spark.checkpoint.dir`` so that written intermediate tables survive the
loss of any executor.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Defaults applied only when the caller did not set them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tablewright",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Set a private one only when the session names none (local tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # one machine, one process
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tablewright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tablewright-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: later passes reuse it instead of recomputing its lineage,
    and a lost executor costs a re-read, not a recomputation.

    Runs a job when called.  ``discard_scratch`` deletes what was written."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    _written.append(path)
    # With the schema at hand no job has to read a footer.
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def discard_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete the scratch tables written since the first ``keep`` ones of this
    process; call it when the results that read them have been consumed.
    Returns how many went."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = _written[keep:]
    del _written[keep:]
    for path in gone:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(gone)


@contextmanager
def scratch(spark: SparkSession):
    """A block at whose end the scratch tables written in it are deleted:
    consume results (write, collect) inside."""
    before = len(_written)
    try:
        yield
    finally:
        discard_scratch(spark, before)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """A block with other session settings; plan and run inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def observed(seen: Observation) -> dict:
    """The metrics of an observation, none if Spark left its part of the plan out: a part whose
    rows can't matter, because what it is joined with or filtered by turned out to be empty."""
    try:
        return seen.get
    except Py4JJavaError:  # raised for a row without columns
        return {}


def sizing(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Session settings for a given input volume.

    Scan splits and shuffle partitions of ~``partition_bytes`` keep every task's
    working set well inside executor memory; the shuffle partition count is an
    upper bound that AQE coalesces at run time, and AQE splits skewed
    partitions above the same size."""
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
