"""Column-level operators: drop, select by pattern, union by name, classify.

Column names and types are driver metadata; only the per-column *data*
statistics (missing counts) are Spark jobs, computed in ``profile``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Default column classes of the transaction schema.
CORE_FIELDS = frozenset({
    "ClosePrice", "ListPrice", "OriginalListPrice",
    "LivingArea", "LotSizeAcres", "BedroomsTotal", "BathroomsTotalInteger",
    "DaysOnMarket", "YearBuilt", "PropertyType", "PropertySubType",
    "CountyOrParish", "City", "PostalCode", "Latitude", "Longitude",
    "CloseDate", "ListingContractDate", "PurchaseContractDate",
    "ContractStatusChangeDate", "ListingKey", "ListingId",
})
METADATA_FIELDS = frozenset({
    "ListAgentFirstName", "ListAgentLastName", "ListAgentFullName", "ListAgentEmail",
    "CoListAgentFirstName", "CoListAgentLastName",
    "BuyerAgentFirstName", "BuyerAgentLastName", "BuyerAgentMlsId",
    "CoBuyerAgentFirstName", "ListOfficeName", "BuyerOfficeName",
    "CoListOfficeName", "BuyerOfficeAOR", "BuyerAgentAOR", "ListAgentAOR",
    "OriginatingSystemName", "OriginatingSystemSubName",
    "ListingKeyNumeric", "MlsStatus", "StreetNumberNumeric",
})
OTHER_CATEGORY = "market_analysis_other"


def q(name: str) -> str:
    """Backtick-quote a column name (dots, spaces) for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns by exact, case-sensitive name; unknown names are ignored."""
    gone = set(names)
    keep = [c for c in df.columns if c not in gone]
    return df if len(keep) == len(df.columns) else df.select(*[F.col(q(c)) for c in keep])


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[F.col(q(c)) for c in columns_matching(df, pattern)])


def drop_repeated_columns(df: DataFrame, pattern: str = r"\.1$") -> DataFrame:
    """Drop the copies a repeated CSV header produced (``X.1`` next to ``X``)."""
    return drop_columns(df, columns_matching(df, pattern))


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Rename repeats the way a CSV header is read: X, X.1, X.2 ..."""
    seen: dict[str, int] = {}
    taken = set(names)
    out = []
    for n in names:
        if n not in seen:
            seen[n] = 0
            out.append(n)
            continue
        k = seen[n]
        while True:
            k += 1
            cand = f"{n}.{k}"
            if cand not in taken:
                break
        seen[n] = k
        taken.add(cand)
        out.append(cand)
    return out


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; absent columns are null, duplicates kept."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def classify(name: str, core=CORE_FIELDS, metadata=METADATA_FIELDS) -> str:
    if name in metadata:
        return "metadata"
    if name in core:
        return "core"
    return OTHER_CATEGORY


def column_metadata(spark: SparkSession, df: DataFrame, core=CORE_FIELDS,
                    metadata=METADATA_FIELDS) -> DataFrame:
    """One row per column: position, name, category, Spark type name.

    Built from the schema held by the driver (one row per column)."""
    rows = [(i, f.name, classify(f.name, core, metadata), f.dataType.simpleString())
            for i, f in enumerate(df.schema.fields)]
    schema = StructType([StructField("position", StringType()), StructField("column", StringType()),
                         StructField("category", StringType()), StructField("dtype", StringType())])
    return (spark.createDataFrame([(str(i), n, c, t) for i, n, c, t in rows], schema)
            .withColumn("position", F.col("position").cast("int")))
