"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
driver's tables (or fixtures Spark derives from them), built only from the
library's operators.  Floating results that two engines may round
differently in the last bit (means, deviations, interpolated quantiles,
sums) are rounded to 4 decimals here and in the oracle texts alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import dates as D
from tablewright.operators import metrics as M
from tablewright.operators import profile as P
from tablewright.operators import quality as Q
from tablewright.operators import schema as S
from tablewright.operators import sketches as K
from tablewright.operators import timeseries as T
from tablewright.operators.incremental import MonthlyState
from tablewright.operators.promotion import union_promoted as union_promoted_frames
from tablewright.operators.quantiles import null_safe_join, quantiles, quantiles_of, value_counts
from tablewright.plans import fixtures as X
from tablewright.session import scratch_dir
from tablewright.sources import csv as C
from tablewright.sources import files as FS
from tablewright.sources.sinks import write_table
from tablewright.streaming.monthly import read_monthly_sums, start_monthly_mean

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
SALES_CORE = ("property_type", "county", "zip", "list_price", "close_price", "living_area", "bedrooms",
              "bathrooms", "days_on_market", "close_date", "purchase_date", "listing_date",
              "latitude", "longitude")
SALES_METADATA = ("l_orderkey", "l_linenumber", "agent", "office")
SUMMARY_COLUMNS = ("list_price", "close_price", "living_area", "bedrooms", "bathrooms",
                   "days_on_market", "latitude", "longitude")
DATE_COLUMNS = ("listing_date", "purchase_date", "close_date")
AS_OF = "2000-01-01"
FILTER_COUNTY = "NATION_7"
MIN_GROUP_SIZE = 35
RERUN_MONTH = "1995-03"
VOTED = ("listed", "closed", "status")
SKETCH_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


def r4(c):
    """Round to 4 decimals the way a C library rounds a double: scale by
    10^4, round half away from zero, scale back (not via the decimal text)."""
    return F.round(F.col(c) * 10000.0 if isinstance(c, str) else c * 10000.0, 0) / 10000.0


def _sales_flag_rules():
    return {
        **Q.invalid_numeric_rules("close_price", "living_area", "days_on_market", "bedrooms", "bathrooms"),
        **Q.date_order_rules("listing_date", "purchase_date", "close_date"),
        **Q.geo_rules("latitude", "longitude", "state"),
    }


def _monthly_rates(spark, sf):
    series = S.rename_positional(X.rate_series(spark, sf), ["date", "rate_30yr_fixed"])
    return T.monthly_mean(series, "date", "rate_30yr_fixed", name="rate")


# -- sources -----------------------------------------------------------------

def month_version_select(spark, sf):
    rows = X.event_files(spark, sf)
    chosen = FS.select_versions(rows, "file_name", key_pattern=r"EVT(\d{8})", preferred="_filled",
                                prefix="EVT", suffix=".csv", key="day_key")
    return FS.keep_selected(rows, chosen, "file_name").select(
        "event_id", "user_id", "event_type", "value", "file_name")


def _orders_csv_variant(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_custkey"), F.lit(".0")))
         .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 11 == 0, "NA").when(F.col("o_orderkey") % 11 == 1, "null")
         .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 13 == 0, "N/A").when(F.col("o_orderkey") % 13 == 1, "NAN")
         .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 17 == 0, F.concat(F.lit("two\nlines, "), F.col("o_orderpriority")))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        (F.month("o_orderdate") % 2 == 0).alias("_even"))


def csv_typed_scan(spark, sf):
    """orders written as CSV under two drifting headers (with missing
    tokens, NaN, integers as ``7.0`` and line ends in quotes), then landed header
    group by header group and typed."""
    src = _orders_csv_variant(X.table(spark, sf, "orders"))
    folder = scratch_dir(spark, "csv")
    write_table(src.where("_even").drop("_even"), f"{folder}/even", fmt="csv")
    write_table(src.where("NOT _even").drop("_even", "o_orderpriority"), f"{folder}/odd", fmt="csv")
    paths = FS.list_files(spark, f"{folder}/even", suffix=".csv") + \
        FS.list_files(spark, f"{folder}/odd", suffix=".csv")
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "date"}
    return C.read_csv_landed(spark, paths, types=types)


def _drift_groups(spark, sf):
    folder = scratch_dir(spark, "drift")
    paths = []
    for name, text in (("odd", X.DRIFT_ODD_SQL), ("even", X.DRIFT_EVEN_SQL)):
        write_table(X.run(spark, sf, text), f"{folder}/{name}", fmt="csv")
        paths += FS.list_files(spark, f"{folder}/{name}", suffix=".csv")
    return paths


def csv_inferred_types(spark, sf):
    """Types inferred from all values of two extracts with drifting headers, each alone and both together."""
    groups = C.land_groups(spark, _drift_groups(spark, sf))
    return C.infer_types(groups).drop("bits")


def csv_inferred_scan(spark, sf):
    """The rows of both extracts, typed by inference."""
    return C.read_csv_inferred(spark, _drift_groups(spark, sf))


def series_csv_scan(spark, sf):
    """The rate series written as CSV, then landed with its date column parsed."""
    folder = write_table(X.rate_series(spark, sf), scratch_dir(spark, "series"), fmt="csv")
    series = C.read_csv_landed(spark, FS.list_files(spark, folder, suffix=".csv"), types={"value": "double"})
    series = D.strict_dates(S.rename_positional(series, ["date", "rate"]), "date")
    return T.monthly_mean(series, "date", "rate").withColumn("rate", r4("rate"))


def sink_roundtrip(spark, sf):
    data = T.with_month_key(X.sales(spark, sf), "close_date").select(
        "l_orderkey", "l_linenumber", "close_price", "close_date", "year_month")
    path = write_table(data, scratch_dir(spark, "sink"), partition_by=["year_month"])
    return spark.read.schema(data.schema).parquet(path)


def sink_partition_overwrite(spark, sf):
    """The table by month, then one month written again with other prices: all other months stay."""
    data = T.with_month_key(X.sales(spark, sf), "close_date").select(
        "l_orderkey", "l_linenumber", "close_price", "close_date", "year_month")
    path = write_table(data, scratch_dir(spark, "sink"), partition_by=["year_month"])
    again = data.where(F.col("year_month") == RERUN_MONTH).withColumn("close_price", F.col("close_price") * 2)
    write_table(again, path, partition_by=["year_month"], replace="partitions")
    return spark.read.schema(data.schema).parquet(path)


def union_by_name(spark, sf):
    o = X.table(spark, sf, "orders")
    early = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    late = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return S.union_by_name([early.select("o_orderkey", "o_custkey", "o_totalprice"),
                            late.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")])


def union_promoted(spark, sf):
    """Frames in which a name is a whole number, a decimal or text: each column gets the type that keeps all values."""
    o = X.table(spark, sf, "orders")
    day, third = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 3
    decimal = (F.col("o_orderkey") % 1000).cast("double") + 0.5
    return union_promoted_frames([
        o.where(third == 0).select("o_orderkey", F.col("o_custkey").cast("bigint").alias("amount"), F.col("o_custkey").cast("bigint").alias("mixed"),
                                   (F.lit(9007199254740992) + F.col("o_orderkey")).alias("big"), day.alias("day")),
        o.where(third == 1).select("o_orderkey", decimal.alias("amount"), decimal.alias("mixed"), decimal.alias("big"), day.alias("day")),
        o.where(third == 2).select("o_orderkey", F.col("o_custkey").cast("int").alias("amount"), F.col("o_orderpriority").alias("mixed"),
                                   F.col("o_orderstatus").alias("day"))])


def drop_columns(spark, sf):
    o = X.table(spark, sf, "orders").withColumns({
        "latfilled": F.col("o_totalprice"), "lonfilled": F.col("o_custkey"),
        "year_month": D.month_key("o_orderdate")})
    return S.drop_columns(o, ["latfilled", "lonfilled", "NotAColumn", "O_ORDERSTATUS"])


def drop_repeated_columns(spark, sf):
    o = X.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.col("o_custkey").alias("o_custkey.1"), F.col("o_totalprice").alias("o_totalprice.1"),
        F.col("o_totalprice").alias("o_totalprice.2"))
    return S.drop_repeated_columns(o)


# -- profiles ----------------------------------------------------------------

def column_profile(spark, sf):
    return P.column_profile(spark, X.sales(spark, sf), core=frozenset(SALES_CORE),
                            metadata=frozenset(SALES_METADATA))


def dtype_counts(spark, sf):
    return P.dtype_counts(S.column_metadata(spark, X.sales(spark, sf)))


def dtype_profile(spark, sf):
    """Columns, present and missing values by type, of all rows."""
    return P.dtype_profile(P.column_profile(spark, X.sales(spark, sf)))


def missing_report(spark, sf):
    return P.missing_report(X.sales(spark, sf))


def high_missing_columns(spark, sf):
    return P.high_missing(P.missing_report(X.sales(spark, sf)), 90.0)


def date_missing_counts(spark, sf):
    return P.missing_report(X.sales(spark, sf), list(DATE_COLUMNS))


def filter_category(spark, sf):
    return X.sales(spark, sf).where(F.col("property_type") == "R")


def filtered_count(spark, sf):
    s = X.sales(spark, sf)
    return s.agg(F.count(F.when(F.col("county") == FILTER_COUNTY, F.col("close_price"))).alias("n_close_price"))


def iqr_filter(spark, sf):
    return P.iqr_filter(X.sales(spark, sf), "close_price").select("l_orderkey", "l_linenumber", "close_price")


def quartiles(spark, sf):
    q = quantiles(X.sales(spark, sf), "close_price", [0.25, 0.5, 0.75])
    return q.select(*[r4(c).alias(c) for c in q.columns])


def histogram_bins(spark, sf):
    h = P.histogram(spark, X.sales(spark, sf), "close_price", 50, fence_k=1.5)
    return h.select("bin", r4("bin_lo").alias("bin_lo"), r4("bin_hi").alias("bin_hi"), "count")


def box_stats(spark, sf):
    b = P.box_stats(X.sales(spark, sf), "close_price", refenced=True)
    return b.select(*[r4(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
                    "n_outliers", "n")


def numeric_summary(spark, sf):
    s = P.numeric_summary(X.sales(spark, sf), list(SUMMARY_COLUMNS))
    return s.select("column", "statistic", r4("value").alias("value"))


def column_summary(spark, sf):
    s = P.column_summary(X.sales(spark, sf), "days_on_market")
    return s.select("column", "statistic", r4("value").alias("value"))


def global_median_mean(spark, sf):
    m = P.median_and_mean(X.sales(spark, sf), "close_price")
    return m.select(r4("median").alias("median"), r4("mean").alias("mean"))


def price_vs_list_share(spark, sf):
    s = P.sign_shares(X.sales(spark, sf), "close_price", "list_price")
    return s.select(*[r4(c).alias(c) for c in ("above_pct", "below_pct", "equal_pct")], "n_rows")


def stage_counts(spark, sf):
    sales = X.sales(spark, sf)
    enriched = T.join_monthly(sales, _monthly_rates(spark, sf), "close_date", unique=True)
    cleaned = Q.apply_flags(enriched, _sales_flag_rules())
    residential = F.col("property_type") == "R"
    c = P.nested_stage_counts(("raw", X.table(spark, sf, "lineitem")), cleaned, [
        ("joined", F.lit(True), len(sales.columns)), ("residential", residential, len(sales.columns)),
        ("enriched", residential, len(enriched.columns)), ("cleaned", residential, len(cleaned.columns))])
    return c.withColumn("retained_pct", r4("retained_pct"))


def stage_counts_observed(spark, sf):
    """The rows of ``stage_counts`` from the job that writes the cleaned table."""
    stages = P.ObservedStages()
    raw = stages.mark("raw", X.table(spark, sf, "lineitem"))
    joined = stages.mark("joined", X.sales(spark, sf, lineitem=raw))
    residential = stages.mark("residential", joined.where(F.col("property_type") == "R"))
    enriched = stages.mark("enriched", T.join_monthly(residential, _monthly_rates(spark, sf), "close_date", unique=True))
    cleaned = stages.mark("cleaned", Q.apply_flags(enriched, _sales_flag_rules()))
    stages.run(lambda: write_table(cleaned, scratch_dir(spark, "cleaned"), partition_by=["year_month"]))
    return stages.table(spark).withColumn("retained_pct", r4("retained_pct"))


def category_share(spark, sf):
    c = P.category_share(X.sales(spark, sf), "property_type")
    return c.withColumn("share_pct", r4("share_pct"))


# -- medians and rankings ----------------------------------------------------

def group_median_topk(spark, sf):
    g = M.group_median(X.sales(spark, sf), "county", "close_price")
    return M.top_n(g.withColumn("median", r4("median")), "median", 10, tiebreak=["county"])


def group_median_min_size(spark, sf):
    g = M.group_median(X.table(spark, sf, "lineitem"), "l_partkey", "l_extendedprice",
                       min_size=MIN_GROUP_SIZE)
    return g.withColumn("median", r4("median"))


def latest_n(spark, sf):
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return M.latest_n(o, ["o_orderdate", "o_orderkey"], 10)


# -- time series -------------------------------------------------------------

def month_key(spark, sf):
    return T.with_month_key(X.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


def monthly_mean(spark, sf):
    return _monthly_rates(spark, sf).withColumn("rate", r4("rate"))


def monthly_mean_stream(spark, sf):
    """The monthly mean of the series that arrives year by year, a seventh of each year's rows a year late."""
    series = S.rename_positional(X.rate_series(spark, sf), ["date", "value"])
    series = series.withColumn("arrives", F.year("date") + (F.day("date") % 7 == 0).cast("int"))
    drop, out, state = scratch_dir(spark, "arrivals"), scratch_dir(spark, "monthly"), scratch_dir(spark, "monthly-state")
    for year in sorted(r[0] for r in series.select("arrives").distinct().collect()):  # a row for each year
        series.where(F.col("arrives") == year).select("date", "value").hint("rebalance").write.parquet(f"{drop}/{year}")
        # All files of a year are one batch, so that the number of batches doesn't grow with the files.
        stream = spark.readStream.schema("date date, value double").option("recursiveFileLookup", True).parquet(drop)
        start_monthly_mean(stream, "date", "value", out, state, delay="800 days", available_now=True).awaitTermination()
    # Cents: a sum in another order may differ in its last bits.
    sums = read_monthly_sums(spark, out).withColumn("total", F.round("total", 2))
    return sums.withColumn("rate", r4(F.try_divide("total", "n")))


def monthly_rate_join(spark, sf):
    j = T.join_monthly(X.sales(spark, sf), _monthly_rates(spark, sf), "close_date", unique=True)
    return j.select("l_orderkey", "l_linenumber", "close_date", "year_month", r4("rate").alias("rate"))


def listings_rate_join(spark, sf):
    """The listings side of the enrichment: its key is the listing date, as text here."""
    listings = X.sales(spark, sf).select("l_orderkey", "l_linenumber", F.col("listing_date").cast("string").alias("listing_date"))
    j = T.join_monthly(D.strict_dates(listings, "listing_date"), _monthly_rates(spark, sf), "listing_date", unique=True)
    return j.select("l_orderkey", "l_linenumber", "listing_date", "year_month", r4("rate").alias("rate"))


def join_unmatched_by_month(spark, sf):
    j = T.join_monthly(X.sales(spark, sf), _monthly_rates(spark, sf), "close_date", unique=True)
    return T.unmatched_by_month(j, "rate")


def join_validation(spark, sf):
    j = T.join_monthly(X.sales(spark, sf), _monthly_rates(spark, sf), "close_date", unique=True)
    return T.join_validation(j, "rate")


def date_parse_coerce(spark, sf):
    d = X.date_text(spark, sf)
    return d.withColumn("close_date", D.parse_date_coerce("close_date_text"))


def date_format_votes(spark, sf):
    """Votes of all texts of three columns for the format they are written in."""
    return D.date_format_votes(X.run(spark, sf, X.DATE_FORMATS_SQL), list(VOTED))


def date_parse_voted(spark, sf):
    """The columns parsed by the format that wins."""
    return D.coerce_voted(X.run(spark, sf, X.DATE_FORMATS_SQL), list(VOTED))


def date_parse_strict(spark, sf):
    o = X.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("order_date_text"))
    return o.withColumn("order_date", D.parse_date_strict("order_date_text"))


def month_year_parts(spark, sf):
    d = X.date_text(spark, sf).select("l_orderkey", "l_linenumber",
                                      F.substring("close_date_text", 1, 7).alias("year_month"))
    month, year = D.month_key_parts("year_month")
    return d.withColumns({"Month": month, "Year": year})


# -- quality flags -----------------------------------------------------------

def _flags(spark, sf, rules):
    return Q.apply_flags(X.sales(spark, sf), rules).select("l_orderkey", "l_linenumber", *rules)


def invalid_numeric_flags(spark, sf):
    return _flags(spark, sf, Q.invalid_numeric_rules("close_price", "living_area", "days_on_market",
                                                     "bedrooms", "bathrooms"))


def date_order_flags(spark, sf):
    return _flags(spark, sf, Q.date_order_rules("listing_date", "purchase_date", "close_date"))


def geo_flags(spark, sf):
    return _flags(spark, sf, Q.geo_rules("latitude", "longitude", "state"))


def flag_summary(spark, sf):
    return Q.flag_summary(Q.apply_flags(X.sales(spark, sf), _sales_flag_rules()), Q.SOLD_FLAGS)


def listing_flag_summary(spark, sf):
    rules = {**Q.invalid_numeric_rules(None, "living_area", "days_on_market", "bedrooms", "bathrooms"),
             **Q.geo_rules("latitude", "longitude", "state")}
    return Q.flag_summary(Q.apply_flags(X.sales(spark, sf), rules), Q.LISTING_FLAGS)


def suffix_flag_summary(spark, sf):
    return Q.flag_summary(Q.apply_flags(X.sales(spark, sf), _sales_flag_rules()), suffix="_flag")


def future_date_flag(spark, sf):
    return _flags(spark, sf, Q.future_date_rules(["close_date", "listing_date"], AS_OF))


def outlier_flag(spark, sf):
    s = X.sales(spark, sf).select("l_orderkey", "l_linenumber", "close_price")
    return Q.flag_outliers(s, "close_price", "outlier_flag")


# -- KPIs --------------------------------------------------------------------

def _valid_sales(spark, sf):
    """Rows without any of the invalid-number flags."""
    rules = Q.invalid_numeric_rules("close_price", "living_area", "days_on_market", "bedrooms", "bathrooms")
    s = Q.apply_flags(X.sales(spark, sf), rules)
    for flag in rules:
        s = s.where(~F.col(flag))
    return s


def price_per_unit_median(spark, sf):
    s = _valid_sales(spark, sf).withColumn("price_per_unit", M.ratio("close_price", "living_area"))
    g = M.group_median(s, "county", "price_per_unit", name="median_price_per_unit")
    return g.withColumn("median_price_per_unit", r4("median_price_per_unit"))


def sale_to_list_by_month(spark, sf):
    s = T.with_month_key(_valid_sales(spark, sf), "close_date").withColumn(
        "sale_to_list", M.ratio("close_price", "list_price"))
    g = M.group_median(s, "year_month", "sale_to_list", name="median_sale_to_list")
    return g.withColumn("median_sale_to_list", r4("median_sale_to_list"))


def new_vs_closed(spark, sf):
    return M.new_vs_closed(X.table(spark, sf, "orders"), "o_orderdate",
                           X.table(spark, sf, "lineitem"), "l_shipdate")


def top_agents(spark, sf):
    v = M.volume_by(X.sales(spark, sf), "agent", "close_price").withColumn("volume", r4("volume"))
    return M.top_n(v, "volume", 10, tiebreak=["agent"])


def top_offices(spark, sf):
    v = M.volume_by(X.sales(spark, sf), "office", "close_price").withColumn("volume", r4("volume"))
    return M.top_n(v, "volume", 10, tiebreak=["office"])


def top_agents_by_month(spark, sf):
    s = T.with_month_key(X.sales(spark, sf), "close_date")
    v = M.volume_by(s, "agent", "close_price", per=["year_month"]).withColumn("volume", r4("volume"))
    return M.top_n_per_group(v, ["year_month"], "volume", 3, tiebreak=["agent"])


def regional_trend(spark, sf):
    s = T.with_month_key(X.sales(spark, sf), "close_date")
    m = M.medians_by(s, ["county", "year_month"],
                     {"median_close_price": "close_price", "median_days_on_market": "days_on_market"})
    return m.select("county", "year_month", "n", r4("median_close_price").alias("median_close_price"),
                    r4("median_days_on_market").alias("median_days_on_market"))


def zip_trend(spark, sf):
    s = T.with_month_key(X.sales(spark, sf), "close_date")
    m = M.medians_by(s, ["zip", "year_month"],
                     {"median_close_price": "close_price", "median_days_on_market": "days_on_market"})
    return m.select("zip", "year_month", "n", r4("median_close_price").alias("median_close_price"),
                    r4("median_days_on_market").alias("median_days_on_market"))


def monthly_medians(spark, sf):
    s = T.with_month_key(X.sales(spark, sf), "close_date")
    m = M.medians_by(s, ["year_month"],
                     {"median_close_price": "close_price", "median_days_on_market": "days_on_market"})
    return m.select("year_month", "n", r4("median_close_price").alias("median_close_price"),
                    r4("median_days_on_market").alias("median_days_on_market"))


def trend_hierarchy(spark, sf):
    """The trends by ZIP, by county and of all sales from one table of counted values."""
    s = T.with_month_key(X.sales(spark, sf), "close_date")
    levels = {"zip": ["zip", "year_month"], "county": ["county", "year_month"], "all": ["year_month"]}
    m = M.medians_rollup(s, levels, {"median_close_price": "close_price", "median_days_on_market": "days_on_market"})
    return m.select("level", "zip", "county", "year_month", "n", r4("median_close_price").alias("median_close_price"),
                    r4("median_days_on_market").alias("median_days_on_market"))


def sketch_quantile_error(spark, sf):
    """Quantiles by county and year merged from sketches by county and month: whether their exact ranks lie within
    the stated error, with the number of values."""
    s = T.with_month_key(X.sales(spark, sf), "close_date").where(F.col("county").isNotNull())
    state = write_table(K.sketch_state(s, ["county", "year_month"], {"close_price": "close_price"}), scratch_dir(spark, "sketches"),
                        partition_by=["year_month"])
    year = F.substring("year_month", 1, 4)
    state = spark.read.parquet(state).withColumn("year_month", F.col("year_month").cast("string")).withColumn("year", year)
    found = K.sketched_quantiles(state, SKETCH_PROBS, ["county", "year"], ["close_price"])
    ranked = K.rank_bounds(s.withColumn("year", year), found, ["county", "year"], "close_price", "close_price")
    error = K.rank_error()
    inside = (F.col("below") - error <= F.col("p")) & (F.col("up_to") + error >= F.col("p"))
    return ranked.select("county", "year", "p", "n_values", inside.alias("within_error"))


def _kpi_state(spark, path):
    valid = ~(F.coalesce(F.col("close_price") <= 0, F.lit(False)) | F.coalesce(F.col("living_area") <= 0, F.lit(False))
              | F.coalesce(F.col("days_on_market") < 0, F.lit(False)) | F.coalesce(F.col("bedrooms") < 0, F.lit(False))
              | F.coalesce(F.col("bathrooms") < 0, F.lit(False)))
    return MonthlyState(path, "year_month", ("county",), values={
        "price_per_unit": F.when(valid, M.ratio("close_price", "living_area")), "sale_to_list": F.when(valid, M.ratio("close_price", "list_price")),
        "close_price": F.col("close_price"), "days_on_market": F.col("days_on_market")},
        sums={"agents": (F.col("agent"), F.col("close_price")), "listed": (D.month_key("listing_date"), F.lit(None))})


def kpis_after_month_replaced(spark, sf):
    """K1 to K4 and K6 after one month of the landed sales was replaced: its state alone is written again."""
    landed = scratch_dir(spark, "landed")
    sales = T.with_month_key(X.sales(spark, sf), "close_date")
    write_table(sales, landed, partition_by=["year_month"])
    read = lambda: spark.read.schema(sales.schema).parquet(landed)
    state = _kpi_state(spark, scratch_dir(spark, "kpis"))
    state.refresh(read())
    month = F.col("year_month") == RERUN_MONTH
    filled = sales.where(month & (F.col("l_orderkey") % 10 != 0)).withColumn("close_price", F.col("close_price") * 2)
    write_table(filled, landed, partition_by=["year_month"], replace="partitions")
    state.refresh(read().where(month), [RERUN_MONTH])
    row = lambda df, kpi, key, n, value: df.select(kpi.alias("kpi"), key.alias("key"), n.alias("n"), r4(value).alias("value"))
    parts = [row(state.medians(spark, ["county"], ["price_per_unit"]), F.col("metric"), F.col("county"), F.col("n"), F.col("value")),
             row(state.medians(spark, ["year_month"], ["sale_to_list", "close_price", "days_on_market"]),
                 F.col("metric"), F.col("year_month"), F.col("n"), F.col("value")),
             row(M.top_n(state.totals(spark, "agents").withColumn("amount", r4("amount")), "amount", 10, tiebreak=["key"]),
                 F.lit("agent_volume"), F.col("key"), F.col("n"), F.col("amount")),
             row(state.totals(spark, "listed"), F.lit("new_listings"), F.col("key"), F.col("n"), F.lit(None).cast("double"))]
    return S.union_by_name(parts)


# -- the flagship: filter -> monthly rate -> join -> flags -> county medians --

def flagship(spark, sf):
    residential = X.sales(spark, sf).where(F.col("property_type") == "R")
    enriched = T.join_monthly(residential, _monthly_rates(spark, sf), "close_date", unique=True)
    flagged = Q.apply_flags(enriched, Q.date_order_rules("listing_date", "purchase_date", "close_date"))
    consistent = flagged.where(~(F.col("listing_after_close_flag") | F.col("purchase_after_close_flag")
                                 | F.col("negative_timeline_flag")))
    # medians, counts and mean rates from one evaluation of the joined rows
    counted = value_counts(consistent.where(F.col("county").isNotNull()), "close_price", ["county"], sums={"rates": "rate"})
    med = quantiles_of(counted, [0.5], ["county"], ["median_close_price"], n_name="n")
    rate = counted.groupBy("county").agg(F.try_divide(F.sum("rates"), F.sum("rates_n")).alias("avg_rate"))
    out = null_safe_join(med, rate, ["county"]).select(
        "county", "n", r4("median_close_price").alias("median_close_price"), r4("avg_rate").alias("avg_rate"))
    return M.top_n(out, "median_close_price", 10, tiebreak=["county"])


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    flagship, month_version_select, csv_typed_scan, csv_inferred_types, csv_inferred_scan, series_csv_scan, sink_roundtrip,
    sink_partition_overwrite, union_by_name,
    union_promoted, drop_columns,
    drop_repeated_columns, column_profile, dtype_counts, dtype_profile, missing_report, high_missing_columns,
    date_missing_counts, filter_category, filtered_count, iqr_filter, quartiles, histogram_bins,
    box_stats, numeric_summary, column_summary, global_median_mean, price_vs_list_share,
    stage_counts, stage_counts_observed, category_share, group_median_topk, group_median_min_size, latest_n, month_key,
    monthly_mean, monthly_mean_stream, monthly_rate_join, listings_rate_join, join_unmatched_by_month, join_validation, date_parse_coerce,
    date_format_votes, date_parse_voted, date_parse_strict, month_year_parts, invalid_numeric_flags, date_order_flags, geo_flags,
    flag_summary, listing_flag_summary, suffix_flag_summary, future_date_flag, outlier_flag,
    price_per_unit_median, sale_to_list_by_month, new_vs_closed, top_agents, top_offices, top_agents_by_month,
    regional_trend, zip_trend, monthly_medians, trend_hierarchy, sketch_quantile_error, kpis_after_month_replaced,
]}
