"""The preparation stages as DataFrame compositions: combine -> enrich -> clean.

Defaults name the columns of the transaction extracts; every name, list
and threshold is a parameter.  Stages hand over DataFrames (or parquet
tables written with ``sources.sinks.write_table``), never CSV text, so no
stage has to re-parse types.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import dates as D
from tablewright.operators import quality as Q
from tablewright.operators import schema as S
from tablewright.operators import timeseries as T
from tablewright.sources import csv as C
from tablewright.sources import files as FS

# Columns the cleaning stage removes by default.
EMPTY_COLUMNS = (
    "TaxAnnualAmount", "AboveGradeFinishedArea", "TaxYear",
    "ElementarySchoolDistrict", "CoveredSpaces", "BusinessType",
    "MiddleOrJuniorSchoolDistrict", "FireplacesTotal",
)
SPARSE_COLUMNS = (
    "WaterfrontYN", "BelowGradeFinishedArea", "BuilderName",
    "LotSizeDimensions", "BuildingAreaTotal", "CoBuyerAgentFirstName",
)
REDUNDANT_COLUMNS = (
    "LotSizeArea", "LotSizeSquareFeet", "ListingKeyNumeric", "ListingId",
    "BuyerAgencyCompensationType", "BuyerAgencyCompensation",
    "OriginatingSystemName", "OriginatingSystemSubName", "StreetNumberNumeric",
    "MlsStatus", "PropertyType", "CoListAgentFirstName", "CoListAgentLastName",
    "BuyerAgentMlsId", "AssociationFeeFrequency", "SubdivisionName",
)
FILLED_EXTRA_COLUMNS = ("latfilled", "lonfilled")
SOLD_DATE_COLUMNS = ("CloseDate", "PurchaseContractDate", "ListingContractDate", "ContractStatusChangeDate")
LISTING_DATE_COLUMNS = ("ListingContractDate", "ContractStatusChangeDate")


def combine(spark: SparkSession, folder: str, prefix: str, types: Mapping[str, str] | None = None,
            suffix: str = ".csv", pick_versions: bool = True, preferred: str = "_filled",
            drop: Sequence[str] = FILLED_EXTRA_COLUMNS, category_col: str | None = "PropertyType",
            category: str | None = "Residential", **csv_options) -> DataFrame:
    """Land one family of monthly extracts (``<prefix>YYYYMM[...]<suffix>``).

    With ``pick_versions`` a month with several files keeps one (the last
    ``preferred`` name, else the first); without it every file is loaded.
    The category filter (missing category excluded) runs after the union
    and is pushed into each scan by the optimizer.  ``csv_options`` go to
    ``read_csv_landed``."""
    paths = FS.list_files(spark, folder, prefix, suffix)
    if pick_versions:
        chosen = FS.select_versions(FS.manifest(spark, paths), "file_name", carry="file_path",
                                    key_pattern=FS.period_pattern(prefix), preferred=preferred)
        # the chosen names are needed to plan the scans: one small row per month
        paths = sorted(r[0] for r in chosen.select("file_path").collect())
    df = C.read_csv_landed(spark, paths, types=types, drop=drop, **csv_options)
    if category_col and category is not None:
        df = df.where(F.col(S.q(category_col)) == category)
    return df


def enrich(fact: DataFrame, rates: DataFrame, date_col: str, rate_date: str = "date",
           rate_value: str = "rate_30yr_fixed") -> DataFrame:
    """Left-join the monthly mean of a (weekly) rate series onto every row.

    Dates given as text are parsed strictly on both sides: text that is no
    date fails the job instead of losing its rate."""
    fact, rates = D.strict_dates(fact, date_col), D.strict_dates(rates, rate_date)
    monthly = T.monthly_mean(rates, rate_date, rate_value, name=rate_value)
    return T.join_monthly(fact, monthly, date_col, unique=True)


def clean(df: DataFrame, date_cols: Sequence[str] = SOLD_DATE_COLUMNS,
          drop: Sequence[str] = EMPTY_COLUMNS + SPARSE_COLUMNS + REDUNDANT_COLUMNS,
          numeric_rules: Mapping | None = None, date_rules: Mapping | None = None,
          geo_rules: Mapping | None = None, month_key: str = "year_month") -> DataFrame:
    """Parse dates (unparseable -> null), add Month/Year from the month key,
    drop empty/redundant/repeated columns and add the quality flags."""
    present = [c for c in date_cols if c in df.columns]
    df = df.withColumns({c: D.parse_date_coerce(F.col(S.q(c)).cast("string")) for c in present})
    if month_key in df.columns:
        month, year = D.month_key_parts(F.col(month_key).cast("string"))
        df = df.withColumns({"Month": month, "Year": year})
    df = S.drop_repeated_columns(S.drop_columns(df, drop))
    rules = {}
    for part in (numeric_rules, date_rules, geo_rules):
        rules.update(part or {})
    return Q.apply_flags(df, rules)


def sold_rules() -> dict:
    return {**Q.invalid_numeric_rules(), **Q.date_order_rules(), **Q.geo_rules()}


def listing_rules() -> dict:
    return {**Q.invalid_numeric_rules(price=None), **Q.geo_rules()}
