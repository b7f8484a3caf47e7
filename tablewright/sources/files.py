"""File sets: listing by prefix/suffix and picking one version per period.

Listing is driver metadata (names only).  The version pick is a DataFrame
aggregate over *names*, so it works the same on a listing and on the
``_metadata.file_name`` of rows already scanned.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.operators.schema import q


def list_files(spark: SparkSession, folder: str, prefix: str = "", suffix: str = "") -> list[str]:
    """Sorted full paths of the files directly in ``folder`` matching prefix and suffix."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    out = []
    for status in fs.listStatus(path):
        if not status.isFile():
            continue
        name = status.getPath().getName()
        if name.startswith(prefix) and name.endswith(suffix):
            out.append(status.getPath().toString())
    return sorted(out, key=lambda p: p.rsplit("/", 1)[-1])


def manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, file_name) frame of a listing."""
    schema = StructType([StructField("file_path", StringType()), StructField("file_name", StringType())])
    return spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in paths], schema)


def select_versions(names: DataFrame, name_col: str = "file_name", key_pattern: str = r"(\d{6})",
                    preferred: str = "_filled", prefix: str = "", suffix: str = "",
                    key: str = "period", carry: str | None = None) -> DataFrame:
    """One file name per period key.

    In sorted name order the first file of a period is taken and any later
    name containing ``preferred`` replaces it; so the result is the *last*
    preferred name if there is one, else the *first* name.  Names without a
    key (``key_pattern`` group 1) or outside prefix/suffix are dropped.

    The decision is taken on ``name_col``, which must be the bare name: a
    folder may contain a period or the preferred mark, too.  ``carry`` names a
    column (the path) that comes along with the chosen name."""
    n = F.col(q(name_col))
    with_it = F.col(q(carry)) if carry else n
    cands = (names.select(n.alias("_name"), with_it.alias("_with")).where(F.col("_name").isNotNull())
             .where(F.col("_name").startswith(prefix) & F.col("_name").endswith(suffix))
             .select("_name", "_with", F.regexp_extract("_name", key_pattern, 1).alias(key))
             .where(F.col(key) != "")
             .distinct())
    pref = F.col("_name").contains(preferred)
    chosen = F.struct(F.col("_name"), F.col("_with"))
    picked = cands.groupBy(key).agg(F.coalesce(F.max(F.when(pref, chosen)), F.min(chosen)).alias("_pick"))
    out = [F.col(key), F.col("_pick._name").alias(name_col)]
    return picked.select(*out, *([F.col("_pick._with").alias(carry)] if carry else []))


def period_pattern(prefix: str) -> str:
    """The month after a literal prefix, in the bare name of a file."""
    return f"^{re.escape(prefix)}([0-9]{{6}})"


def keep_selected(rows: DataFrame, selected: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Rows whose file is the chosen version (left semi join on the name)."""
    return rows.join(selected.select(name_col), name_col, "left_semi")
