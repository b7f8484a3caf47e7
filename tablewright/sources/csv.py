"""CSV landing: every file read as text under its *own* header, missing
tokens turned into null, then cast to a declared schema or to types inferred
from all values.

Spark's multi-file CSV reader binds columns by the position of one header,
so files whose headers drift would be silently mislabelled.  Files are
therefore grouped by their header line, which a Spark job reads (no file is opened
by the driver), each group is one parallel scan with an all-string schema named
from that header (repeats become ``X.1``), and the groups are unioned by name.
"""

from __future__ import annotations

import csv
import io
from collections import OrderedDict
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, StringType, StructField, StructType

from tablewright.functions.nulls import DEFAULT_NA_TOKENS, missing_token_to_null, nan_to_null
from tablewright.operators import promotion
from tablewright.operators.schema import dedupe_names, drop_columns, q, union_by_name
from tablewright.session import settings


EXTRA = "_tw_extra"
AUTO = "auto"
#: Larger than any file: a task then reads one whole file, and of it the first line only.
ONE_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
                   "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}

Header = tuple[str, ...]


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"),
                                               F.col("_metadata.file_block_start").alias("start"))


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of the task's file; what comes after isn't read."""
    for batch in batches:
        if batch.num_rows:
            if batch.column("start")[0].as_py() == 0:
                yield batch.slice(0, 1).select(["path", "value"])
            return


def _names(line: str | None, delimiter: str) -> Header:
    line = (line or "").lstrip("\ufeff")  # byte-order mark
    return tuple(next(csv.reader(io.StringIO(line), delimiter=delimiter), []))


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, value): the first line of each file that has one, a task a file, read no further."""
    return _lines(spark, paths).mapInArrow(_first_line, "path string, value string")


def file_shapes(spark: SparkSession, paths: Sequence[str], delimiter: str = ",") -> DataFrame:
    """(path, value, spans): the first line of each file and whether a quoted field may reach over a line end.

    One aggregate over all lines.  A line whose quotes all belong to whole quoted fields (with doubled quotes
    inside) ends where its last field ends; if all lines of a file are such, it can be split at any line."""
    sep = "\\" + delimiter if not delimiter.isalnum() else delimiter
    bare = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    left = F.regexp_replace(bare, f'(^|{sep})"[^"]*"(?={sep}|$)', "$1")
    lines = _lines(spark, paths).withColumn("at", F.monotonically_increasing_id())
    return lines.groupBy("path").agg(F.min_by(F.when(F.col("start") == 0, F.col("value")), F.when(F.col("start") == 0, F.col("at"))).alias("value"),
                                     F.bool_or(F.col("value").contains('"') & left.contains('"')).alias("spans"))


def group_by_header(spark: SparkSession, paths: Sequence[str], delimiter: str = ",",
                    multiline: bool | str = AUTO) -> "OrderedDict[tuple[Header, bool], list[str]]":
    """The files of each header, those with line ends in quotes (``multiline`` says, or is found out) apart.

    The headers are gathered to plan a scan for each: a line and a path for each file."""
    if multiline not in (True, False, AUTO):
        raise ValueError(f"multiline: {multiline!r}")
    groups: OrderedDict[tuple[Header, bool], list[str]] = OrderedDict()
    if not paths:
        return groups
    if multiline == AUTO:
        found = {_plain(spark, r["path"]): (r["value"], r["spans"]) for r in file_shapes(spark, paths, delimiter).collect()}
    else:
        with settings(spark, ONE_FILE_A_TASK):
            found = {_plain(spark, r["path"]): (r["value"], multiline) for r in first_lines(spark, paths).collect()}
        missing = [p for p in paths if _plain(spark, p, encoded=False) not in found]
        if missing:  # empty, or the session doesn't let a task have one file: then by reading all lines
            found |= {_plain(spark, r["path"]): (r["value"], multiline) for r in file_shapes(spark, missing, delimiter).collect()}
    for path in paths:
        line, spans = found.get(_plain(spark, path, encoded=False), (None, False))
        groups.setdefault((_names(line, delimiter), bool(spans)), []).append(path)
    return groups


def _plain(spark: SparkSession, path: str, encoded: bool = True) -> str:
    """One spelling of a path for the listing's and the scan's (in which it is an encoded URI)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)) if encoded else jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def cast_columns(df: DataFrame, types: Mapping[str, DataType | str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes null.

    A column of whole numbers with gaps is often written as ``3.0``: for an
    integer type, text that is a whole number in any decimal form counts.  NaN
    in any spelling becomes null, so no NaN survives landing."""
    present = [c for c in types if c in df.columns]
    return df.withColumns({c: typed(F.col(q(c)), types[c]) for c in present}) if present else df


def typed(text: Column, kind: DataType | str) -> Column:
    kind = _parse(kind) if isinstance(kind, str) else kind
    out = text.try_cast(kind)
    if isinstance(kind, IntegralType):
        number = text.try_cast("decimal(38,9)")
        return F.coalesce(out, F.when(number == F.floor(number), number).try_cast(kind))
    return nan_to_null(out) if isinstance(kind, (DoubleType, FloatType)) else out


def _parse(kind: str) -> DataType:
    return StructType.fromDDL(f"c {kind}")["c"].dataType


def cast_failures(df: DataFrame, types: Mapping[str, DataType | str]) -> DataFrame:
    """(column, n_failed) for text columns of ``df``: texts that ``cast_columns``
    would turn into null, in one pass."""
    present = [c for c in types if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(q(c)).isNotNull() & typed(F.col(q(c)), types[c]).isNull()).alias(f"_f{i}")
                      for i, c in enumerate(present)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_f{i}").alias("n_failed"))
                                            for i, c in enumerate(present)])))


def land_groups(spark: SparkSession, paths: Sequence[str], na_tokens: Sequence[str] = DEFAULT_NA_TOKENS, drop: Sequence[str] = (),
                delimiter: str = ",", multiline: bool | str = AUTO, file_name_col: str | None = None,
                extra_fields: str = "fail") -> list[tuple[Header, DataFrame]]:
    """One frame of text columns for each header (and for files with line ends in quotes)."""
    if extra_fields not in ("fail", "drop", "keep"):
        raise ValueError(f"extra_fields: {extra_fields!r}")
    frames = []
    for (header, spans), files in group_by_header(spark, list(paths), delimiter, multiline).items():
        names = dedupe_names([h if h else f"Unnamed: {i}" for i, h in enumerate(header)])
        # One more column than the header has: it shows lines with too many fields.
        extra = [StructField(EXTRA, StringType())] if extra_fields != "keep" else []
        schema = StructType([*[StructField(n, StringType()) for n in names], *extra])
        df = (spark.read.schema(schema)
              .option("header", True).option("enforceSchema", True)
              .option("sep", delimiter).option("quote", '"').option("escape", '"')
              .option("multiLine", spans).option("mode", "PERMISSIVE")
              .csv(files))
        if extra_fields == "drop":
            df = df.where(F.col(EXTRA).isNull()).drop(EXTRA)
        elif extra:
            bad = F.raise_error(F.concat(F.lit("more fields than the header: "), F.col("_metadata.file_name")))
            df = df.where(F.when(F.col(EXTRA).isNull(), True).otherwise(bad.cast("boolean"))).drop(EXTRA)
        if file_name_col:
            df = df.withColumn(file_name_col, F.col("_metadata.file_name"))
        df = drop_columns(df, drop)
        df = df.withColumns({c: missing_token_to_null(F.col(q(c)), na_tokens)
                             for c in df.columns if c != file_name_col})
        frames.append((header, df))
    return frames


def read_csv_landed(spark: SparkSession, paths: Sequence[str], types: Mapping[str, DataType | str] | None = None,
                    na_tokens: Sequence[str] = DEFAULT_NA_TOKENS, drop: Sequence[str] = (),
                    delimiter: str = ",", multiline: bool | str = AUTO, file_name_col: str | None = None,
                    extra_fields: str = "fail") -> DataFrame:
    """Land CSV files with possibly different headers into one typed frame.

    Absent columns are null, repeated header names become ``X.1``;
    columns named in ``drop`` are removed per file group (unknown names
    ignored); ``types`` casts by name, other columns stay text.

    Quoted fields may hold line ends: a pass over the lines finds the files in which
    they may, and only those are read a task a file; all others are split.
    ``multiline=True`` or ``False`` says so beforehand and saves the pass.  A line with
    more fields than its header fails the job when it is read; ``extra_fields="drop"``
    leaves such lines out, and ``"keep"`` reads them without what is too much."""
    frames = land_groups(spark, paths, na_tokens, drop, delimiter, multiline, file_name_col, extra_fields)
    return cast_columns(union_by_name([df for _, df in frames]), types or {})


def infer_types(groups: Sequence[tuple[Header, DataFrame]], skip: Sequence[str] = ()) -> DataFrame:
    """(part, position, column, bits, n_rows, n_present, type, joined_type) of landed header groups: the type
    inferred from all values of a column in a group, and the one that holds those of all groups."""
    named = [(df, [c for c in df.columns if c not in skip]) for _, df in groups]
    return promotion.join_lattices([promotion.lattice(df, columns) for df, columns in named if columns])


def read_csv_inferred(spark: SparkSession, paths: Sequence[str], types: Mapping[str, DataType | str] | None = None,
                      file_name_col: str | None = None, **options) -> DataFrame:
    """Land CSV files with types inferred from all values: a boolean, bigint, double or date column where every
    present value of every file is one, else text.

    The types don't depend on the order or the grouping of the files.  Values are scanned twice, once for the types
    and once for the rows; ``types`` declares columns that aren't to be inferred.  Each group is cast below the
    union."""
    groups = land_groups(spark, paths, file_name_col=file_name_col, **options)
    if not groups:
        raise ValueError("nothing to read")
    found = infer_types(groups, [file_name_col] if file_name_col else [])
    # One row for each column: the schema of the scans.
    inferred = {r["column"]: r["joined_type"] for r in found.select("column", "joined_type").distinct().collect()
                if r["column"] not in (types or {})}
    return cast_columns(union_by_name([promotion.cast_inferred(df, inferred) for _, df in groups]), types or {})
