"""Data-quality rules: rows are flagged, never deleted.

A rule set is a ``{flag_name: Column}`` dict; ``apply_flags`` adds every
flag in one ``withColumns`` (one projection, inside whole-stage codegen)
and wraps each predicate so that a flag is never null.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import nulls as N
from tablewright.functions.dates import after
from tablewright.functions.nulls import ColumnLike, col
from tablewright.operators.quantiles import attach, iqr_bounds
from tablewright.operators.schema import q

# The default state and its bounding box (lat_lo, lat_hi, lon_lo, lon_hi).
DEFAULT_STATE = "CA"
CA_BOX = (32.529508, 42.009503, -124.482003, -114.131211)

# Flag names of the cleaning stage.
SOLD_FLAGS = (
    "invalid_close_price", "invalid_living_area", "invalid_days_on_market", "invalid_bed_or_bath",
    "missing_coordinates", "zero_coordinates", "invalid_longitude",
    "listing_after_close_flag", "purchase_after_close_flag", "negative_timeline_flag",
    "out_of_state_flag", "out_of_bounds_flag",
)
LISTING_FLAGS = (
    "invalid_living_area", "invalid_days_on_market", "invalid_bed_or_bath",
    "missing_coordinates", "zero_coordinates", "invalid_longitude",
    "out_of_state_flag", "out_of_bounds_flag",
)


def apply_flags(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({name: N.is_true(rule) for name, rule in rules.items()})


def invalid_numeric_rules(price: ColumnLike | None = "ClosePrice",
                          area: ColumnLike | None = "LivingArea",
                          days: ColumnLike | None = "DaysOnMarket",
                          beds: ColumnLike | None = "BedroomsTotal",
                          baths: ColumnLike | None = "BathroomsTotalInteger") -> dict[str, Column]:
    """Impossible numbers; pass ``None`` to leave a rule out (listings have no price)."""
    rules = {}
    if price is not None:
        rules["invalid_close_price"] = N.le(price, 0)
    if area is not None:
        rules["invalid_living_area"] = N.le(area, 0)
    if days is not None:
        rules["invalid_days_on_market"] = N.lt(days, 0)
    if beds is not None and baths is not None:
        rules["invalid_bed_or_bath"] = N.lt(beds, 0) | N.lt(baths, 0)
    return rules


def date_order_rules(listing: ColumnLike = "ListingContractDate",
                     purchase: ColumnLike = "PurchaseContractDate",
                     close: ColumnLike = "CloseDate") -> dict[str, Column]:
    """Strict order violations; a missing date violates nothing."""
    return {
        "listing_after_close_flag": after(listing, close),
        "purchase_after_close_flag": after(purchase, close),
        "negative_timeline_flag": after(listing, purchase),
    }


def geo_rules(lat: ColumnLike = "Latitude", lon: ColumnLike = "Longitude",
              state: ColumnLike | None = "StateOrProvince", expected_state: str = DEFAULT_STATE,
              box: tuple[float, float, float, float] = CA_BOX) -> dict[str, Column]:
    """Coordinate checks.  ``out_of_state_flag`` and ``out_of_bounds_flag``
    are *true* when the input is missing; the other flags are false."""
    rules = {
        "missing_coordinates": N.any_missing(lat, lon),
        "zero_coordinates": N.eq(lat, 0) | N.eq(lon, 0),
        "invalid_longitude": N.gt(lon, 0),
    }
    if state is not None:
        rules["out_of_state_flag"] = N.ne_or_missing(state, expected_state)
    rules["out_of_bounds_flag"] = N.outside_box(lat, lon, box)
    return rules


def future_date_rules(columns: Iterable[str], as_of, suffix: str = "_in_future") -> dict[str, Column]:
    """``date > as_of`` per column; ``as_of`` is a parameter, never the clock."""
    limit = F.lit(as_of).cast("date")
    return {f"{c}{suffix}": N.gt(F.col(q(c)), limit) for c in columns}


def flag_outliers(df: DataFrame, value: ColumnLike, name: str = "outlier_flag", k: float = 1.5,
                  by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """Flag values outside the ``k``-IQR fence (per group); missing is no outlier."""
    v = col(value).cast("double")
    tagged = df.withColumn("_tw_v", v)
    bounds = iqr_bounds(tagged, "_tw_v", k, by=by, method=method).select(
        *by, F.col("lower").alias("_tw_lo"), F.col("upper").alias("_tw_hi"))
    flagged = attach(tagged, bounds, by).withColumn(
        name, N.is_true((F.col("_tw_v") < F.col("_tw_lo")) | (F.col("_tw_v") > F.col("_tw_hi"))))
    return flagged.drop("_tw_v", "_tw_lo", "_tw_hi")


def flag_summary(df: DataFrame, flags: Iterable[str] | None = None, suffix: str = "_flag") -> DataFrame:
    """(flag, n) true-counts; flags absent from ``df`` are skipped.

    Without a list, every column ending in ``suffix`` is summarised."""
    present = set(df.columns)
    names = [f for f in (flags if flags is not None else [c for c in df.columns if c.endswith(suffix)])
             if f in present]
    counts = df.agg(*[F.count_if(F.col(q(f))).alias(f"_f{i}") for i, f in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f).alias("flag"),
                              F.col(f"_f{i}").alias("n")) for i, f in enumerate(names)])
    return counts.select(F.inline(rows))
