"""Types inferred from values and promoted where tables disagree.

A value fits a set of types, kept as bits; the types that fit a column are those
that fit each of its values, a ``bit_and``.  It is commutative, associative and
idempotent, so partial results of tasks, files and header groups may be merged in
any order and give the same types:

    null < boolean, bigint < double, date < string

Missing values fit every type, text fits none of the narrow ones, and a column
takes the first of ``ORDER`` that is left.  Whole numbers fit ``double`` only up to
2^53, where it still holds them exactly, and ``bigint`` only if they don't overflow
it: beyond, text is the type that keeps the value.  Numbers with a decimal point are
the nearest double, as a CSV reader reads them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, FloatType, IntegralType, LongType, NullType,
                               StringType)

from tablewright.operators.schema import q, union_by_name

BOOLEAN, LONG, DOUBLE, DATE = 1, 2, 4, 8
ANY = BOOLEAN | LONG | DOUBLE | DATE
#: From the narrowest type; what fits none of them is text.
ORDER = ((BOOLEAN, "boolean"), (LONG, "bigint"), (DOUBLE, "double"), (DATE, "date"))
TEXT, NOTHING = "string", "null"
EXACT = 2 ** 53

WHOLE = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def fits(text: Column, date_format: str = "yyyy-MM-dd") -> Column:
    """The types that hold a text value without loss, as bits."""
    whole, number = text.try_cast("bigint"), text.try_cast("double")
    finite = F.abs(number) < float("inf")
    return (F.when(text.isNull(), ANY)
            .when(text.rlike(WHOLE), F.when(whole.between(-EXACT, EXACT), LONG | DOUBLE).when(whole.isNotNull(), LONG).otherwise(0))
            .when((text.rlike(NUMBER) & finite) | text.rlike(INFINITE), DOUBLE)
            .when(F.try_to_date(text, date_format).isNotNull(), DATE)
            .when(F.lower(text).isin("true", "false"), BOOLEAN)
            .otherwise(0))


def type_of(bits: int, n_present: int = 1) -> str:
    if not n_present:
        return NOTHING
    return next((name for bit, name in ORDER if bits & bit), TEXT)


def type_column(bits: Column, n_present: Column) -> Column:
    """``type_of`` as a column."""
    out = F.when(n_present == 0, NOTHING)
    for bit, name in ORDER:
        out = out.when(bits.bitwiseAND(F.lit(bit)) != 0, name)
    return out.otherwise(TEXT)


def lattice(df: DataFrame, columns: Sequence[str] | None = None, bits=fits) -> DataFrame:
    """(position, column, bits, n_rows, n_present) of text columns: one aggregate over all of them."""
    columns = list(df.columns if columns is None else columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.bit_and(bits(F.col(q(c)))).alias(f"_b{i}") for i, c in enumerate(columns)],
                 *[F.count(q(c)).alias(f"_p{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.coalesce(F.col(f"_b{i}"), F.lit(ANY)).alias("bits"),
                     F.col("_n").alias("n_rows"), F.col(f"_p{i}").alias("n_present")) for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))


def join_lattices(parts: Sequence[DataFrame]) -> DataFrame:
    """(part, position, column, bits, n_rows, n_present, type, joined_type): the lattices of several tables, with the
    type that holds the values of all of them.  One job, however many tables there are."""
    rows = reduce(DataFrame.unionByName, [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)])
    whole = rows.groupBy("column").agg(F.bit_and("bits").alias("_bits"), F.sum("n_present").alias("_present"))
    return rows.join(whole, "column").select(
        "part", "position", "column", "bits", "n_rows", "n_present", type_column(F.col("bits"), F.col("n_present")).alias("type"),
        type_column(F.col("_bits"), F.col("_present")).alias("joined_type"))


def kept(value: Column, out: Column, name: str) -> Column:
    """``out``, the cast of ``value``; a value that the cast would lose fails the job."""
    lost = F.raise_error(F.concat(F.lit(f"value of {name} doesn't fit its inferred type: "), value.cast("string")))
    return F.when(value.isNull() | out.isNotNull(), out).otherwise(lost)


def cast_inferred(df: DataFrame, types: Mapping[str, str], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Text columns cast to their inferred types; one without a value stays text.  A value that
    doesn't fit (it came after the types were inferred) fails the job."""
    def one(c: str) -> Column:
        text = F.col(q(c))
        if types.get(c, TEXT) in (TEXT, NOTHING):
            return text
        out = F.try_to_date(text, date_format) if types[c] == "date" else text.try_cast(types[c])
        return kept(text, out, c).alias(c)

    return df.select(*[one(c) for c in df.columns])


def type_bits(kind: DataType) -> int | None:
    """The bits of a column's type; None for one outside the lattice."""
    if isinstance(kind, NullType):
        return ANY
    if isinstance(kind, IntegralType):
        return LONG | DOUBLE
    if isinstance(kind, (DoubleType, FloatType)):
        return DOUBLE
    if isinstance(kind, DateType):
        return DATE
    if isinstance(kind, BooleanType):
        return BOOLEAN
    return 0 if isinstance(kind, StringType) else None


def promoted_types(frames: Sequence[DataFrame]) -> dict[str, str]:
    """The type of every column whose type differs between ``frames``: one that holds all values.

    Types decide alone but where long numbers meet doubles: whether all of them are
    whole in a double is counted, in one job over those columns only."""
    kinds: dict[str, list[DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    drifting = {c: k for c, k in kinds.items() if any(t != k[0] for t in k)}
    out = {}
    for c, k in drifting.items():
        known = [type_bits(t) for t in k]
        if None in known and any(not t.simpleString().startswith(("decimal", "timestamp", "string")) for t, b in zip(k, known) if b is None):
            raise TypeError(f"column {c}: no common type of {sorted({t.simpleString() for t in k})}")
        out[c] = type_of(reduce(int.__and__, [b or 0 for b in known]))
    at_risk = [c for c, t in out.items() if t == "double" and any(isinstance(k, LongType) for k in drifting[c])]
    parts = []
    for df in frames:
        longs = [c for c in at_risk if c in df.columns and isinstance(df.schema[c].dataType, LongType)]
        if longs:
            parts.append(lattice(df, longs, bits=lambda v: F.when(v.isNull() | v.between(-EXACT, EXACT), LONG | DOUBLE).otherwise(LONG)))
    if parts:  # one row for each such column and frame
        for r in reduce(DataFrame.unionByName, parts).collect():
            if not r["bits"] & DOUBLE:
                out[r["column"]] = TEXT
    return out


def union_promoted(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name where types drift: each column gets the narrowest type that holds the
    values of all frames, cast within each frame, below the union.  Absent columns are null, duplicates kept."""
    if not frames:
        raise ValueError("nothing to union")
    types = promoted_types(frames)
    return union_by_name([df.select(*[F.col(q(c)).cast(types[c]).alias(c) if c in types else F.col(q(c)) for c in df.columns])
                          for df in frames])
