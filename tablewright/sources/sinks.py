"""Table sinks (overwrite), parquet by default, optionally partitioned.

A partitioned table is clustered before it is written: rows are dealt by the partition
columns, small partitions share a task and large ones are cut at the advisory size, so
the number of files of a partition follows its bytes and not the number of tasks that
held its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.schema import q
from tablewright.session import settings

TABLE, PARTITIONS = "table", "partitions"
#: Parts of a partition where Spark can't cut it by its measured bytes (adaptive execution is off).
SALTS = 16
#: Hash buckets at least: values in the bucket of a large one are cut along with it, so few should share one.
BUCKETS = 512


def clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` dealt by the columns ``by``, a large value of them over several tasks.

    Adaptive execution measures the shuffled bytes of each value: values below the
    advisory size are put together, one above it is cut.  Without it each value is
    salted by a hash of its rows."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        parts = max(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return df.hint("rebalance", parts, *[F.col(q(c)) for c in by])
    salt = F.pmod(F.xxhash64(*[F.col(q(c)) for c in df.columns]), F.lit(SALTS))
    return df.repartition(*[F.col(q(c)) for c in by], salt)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), header: bool = True, replace: str = TABLE,
                file_bytes: int | None = None) -> str:
    """Overwrite ``path`` with ``df``; CSV gets a header line.

    ``replace="partitions"`` replaces only the partitions of which ``df`` has rows, all
    others stay; a partition is moved in whole when the job commits, so a rerun after a
    failure gives the same table.  ``file_bytes``: shuffled bytes from which a partition
    gets one more file (default: the session's advisory size)."""
    if replace not in (TABLE, PARTITIONS):
        raise ValueError(f"replace: {replace!r}")
    if replace == PARTITIONS and not partition_by:
        raise ValueError("only a partitioned table can be replaced by partitions")
    w = (clustered(df, partition_by) if partition_by else df).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", header).option("quote", '"').option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if replace == PARTITIONS else "static")
    with settings(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)} if file_bytes else {}):
        w.save(path)
    return path
