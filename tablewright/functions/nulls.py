"""Null-safe predicate builders.

Quality flags must never be null.  A comparison with a missing operand is
*false* for the ordering and equality rules, while "not equal to X" and
"outside a range" are *true* when the operand is missing.  NaN never
reaches these builders: landing turns NaN into null (``nan_to_null``),
because Spark treats NaN as a value that sorts above every number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

ColumnLike = Column | str

# The 19 default missing-value tokens of pandas.read_csv.
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def is_true(predicate: Column) -> Column:
    """``predicate`` with null read as false."""
    return F.coalesce(predicate, F.lit(False))


def lt(a: ColumnLike, b) -> Column:
    return is_true(col(a) < lit(b))


def le(a: ColumnLike, b) -> Column:
    return is_true(col(a) <= lit(b))


def gt(a: ColumnLike, b) -> Column:
    return is_true(col(a) > lit(b))


def ge(a: ColumnLike, b) -> Column:
    return is_true(col(a) >= lit(b))


def eq(a: ColumnLike, b) -> Column:
    return is_true(col(a) == lit(b))


def ne_or_missing(a: ColumnLike, value) -> Column:
    """True when ``a`` differs from ``value`` *or is missing*."""
    return ~col(a).eqNullSafe(lit(value))


def outside(a: ColumnLike, lo, hi) -> Column:
    """True unless ``lo <= a <= hi``; a missing ``a`` is outside."""
    return ~is_true(col(a).between(lit(lo), lit(hi)))


def outside_box(lat: ColumnLike, lon: ColumnLike, box: tuple[float, float, float, float]) -> Column:
    """True unless both coordinates are inside ``(lat_lo, lat_hi, lon_lo, lon_hi)``."""
    lat_lo, lat_hi, lon_lo, lon_hi = box
    return ~is_true(col(lat).between(lat_lo, lat_hi) & col(lon).between(lon_lo, lon_hi))


def any_missing(*cols: ColumnLike) -> Column:
    return reduce(lambda x, y: x | y, [col(c).isNull() for c in cols])


def any_of(*predicates: Column) -> Column:
    return is_true(reduce(lambda x, y: x | y, predicates))


def nan_to_null(c: ColumnLike) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def missing_token_to_null(c: ColumnLike, tokens=DEFAULT_NA_TOKENS) -> Column:
    c = col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def clean_nan(df):
    """Replace NaN by null in every float/double column (a no-op otherwise)."""
    fixes = {f.name: nan_to_null(F.col(f"`{f.name}`")) for f in df.schema.fields
             if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(fixes) if fixes else df
