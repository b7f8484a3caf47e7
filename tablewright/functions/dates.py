"""Date parsing and calendar-month keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.schema import q

MONTH_KEY_FORMAT = "yyyy-MM"


def parse_date_strict(c: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse text to a date; text that does not parse fails the job.

    Independent of ``spark.sql.ansi.enabled``: a non-null input that does
    not parse raises through ``raise_error``."""
    c = col(c)
    parsed = F.try_to_date(c, fmt)
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("unparseable date: "), c)).cast("date"))


def strict_dates(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the named text columns parsed by ``parse_date_strict``;
    columns that are dates or timestamps already stay as they are."""
    text = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: parse_date_strict(F.col(f"`{c}`")) for c in text}) if text else df


def parse_date_coerce(c: ColumnLike, formats=("yyyy-MM-dd",)) -> Column:
    """Parse text to a date; text matching none of ``formats`` becomes null."""
    c = col(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


# Formats that dates are commonly written in, tried in this order.
CANDIDATES = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyyMMdd", "dd.MM.yyyy", "yyyy/MM/dd")


def date_format_votes(df: DataFrame, columns: Sequence[str], candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """(column, position, format, n_present, n_parsed, n_blanked, chosen): how many texts of each column every
    candidate parses, and how many it would blank.

    All values vote, in one aggregate over all columns, so that the result depends neither on the order of the
    rows nor on the first value.  ``chosen`` is the format that parses most, the earlier one of a tie; a column
    in which none parses anything has none."""
    text = {c: F.col(q(c)).cast("string") for c in columns}
    one = df.agg(*[F.count(t).alias(f"_n{i}") for i, t in enumerate(text.values())],
                 *[F.count(F.try_to_date(t, f)).alias(f"_p{i}_{j}") for i, t in enumerate(text.values()) for j, f in enumerate(candidates)])
    rows = []
    for i, c in enumerate(columns):
        most = F.array_max(F.array(*[F.col(f"_p{i}_{j}") for j in range(len(candidates))]))
        first = F.array_position(F.array(*[F.col(f"_p{i}_{j}") for j in range(len(candidates))]), most) - 1
        rows += [F.struct(F.lit(c).alias("column"), F.lit(j).alias("position"), F.lit(f).alias("format"), F.col(f"_n{i}").alias("n_present"),
                          F.col(f"_p{i}_{j}").alias("n_parsed"), (F.col(f"_n{i}") - F.col(f"_p{i}_{j}")).alias("n_blanked"),
                          ((most > 0) & (first == j)).alias("chosen")) for j, f in enumerate(candidates)]
    return one.select(F.inline(F.array(*rows)))


def chosen_formats(votes: DataFrame, mixed: bool = False) -> dict[str, list[str]]:
    """The formats to coerce each column with: the chosen one, or with ``mixed`` all that parse any value, by votes.

    A row for each column and candidate is gathered."""
    out: dict[str, list] = {}
    for r in votes.where(F.col("n_parsed") > 0).collect():
        if mixed or r["chosen"]:
            out.setdefault(r["column"], []).append((-r["n_parsed"], r["position"], r["format"]))
    return {c: [f for _, _, f in sorted(some)] for c, some in out.items()}


def coerce_voted(df: DataFrame, columns: Sequence[str], candidates: Sequence[str] = CANDIDATES, mixed: bool = False) -> DataFrame:
    """``df`` with text columns parsed to dates by the format that their values vote for.

    One format a column: text in another one becomes null, as ``date_format_votes`` counts; ``mixed`` lets the
    other formats parse what the first can't.  A column in which no format parses anything is all null."""
    formats = chosen_formats(date_format_votes(df, columns, candidates), mixed)
    none = F.lit(None).cast("date")
    return df.withColumns({c: parse_date_coerce(F.col(q(c)).cast("string"), formats[c]) if c in formats else none for c in columns})


def parse_timestamp_coerce(c: ColumnLike, formats=("yyyy-MM-dd HH:mm:ss",)) -> Column:
    c = col(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def month_start(c: ColumnLike) -> Column:
    """First day of the calendar month of a date or timestamp."""
    return F.trunc(col(c).cast("date"), "month")


def month_key(c: ColumnLike) -> Column:
    """``yyyy-MM`` text key of the calendar month (null stays null)."""
    return F.date_format(col(c).cast("date"), MONTH_KEY_FORMAT)


def month_key_parts(key: ColumnLike) -> tuple[Column, Column]:
    """(month, year) integers of a ``yyyy-MM`` key; malformed keys give nulls."""
    d = F.try_to_date(col(key), MONTH_KEY_FORMAT)
    return F.month(d), F.year(d)


def after(a: ColumnLike, b: ColumnLike) -> Column:
    """``a`` strictly later than ``b``; false if either is missing."""
    return F.coalesce(col(a) > col(b), F.lit(False))
