"""Profiles, flags and metrics on hand-made frames with known answers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import metrics as M
from tablewright.operators import profile as P
from tablewright.operators import quality as Q
from tablewright.operators import timeseries as T


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    n = 2000
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n), "x": rng.normal(100, 20, n).round(3),
                        "y": rng.integers(-2, 50, n).astype(float)})
    pdf.loc[pdf.index % 17 == 0, "x"] = np.nan
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None)), pdf


def test_missing_report(frame):
    df, pdf = frame
    rep = {r["column"]: (r["missing_count"], r["missing_pct"]) for r in P.missing_report(df).collect()}
    assert rep["x"][0] == int(pdf.x.isna().sum()) and rep["k"] == (0, 0.0)
    assert rep["x"][1] == pytest.approx(pdf.x.isna().mean() * 100)


def test_numeric_summary_matches_describe(frame):
    df, pdf = frame
    got = {(r["column"], r["statistic"]): r["value"] for r in P.numeric_summary(df, ["x", "y"]).collect()}
    exp = pdf[["x", "y"]].describe(percentiles=[.05, .25, .5, .75, .95])
    for c in ["x", "y"]:
        for stat in exp.index:
            assert got[(c, stat)] == pytest.approx(exp.loc[stat, c], rel=1e-9), (c, stat)


def test_histogram_counts_all_values(spark, frame):
    df, pdf = frame
    h = P.histogram(spark, df, "x", 50).collect()
    assert len(h) == 50 and sum(r["count"] for r in h) == int(pdf.x.notna().sum())
    counts, _ = np.histogram(pdf.x.dropna(), bins=50)
    assert [r["count"] for r in h] == pytest.approx(list(counts), abs=1)
    const = spark.createDataFrame([(5.0,)] * 3, "v double")
    hc = P.histogram(spark, const, "v", 4).collect()
    assert hc[0]["bin_lo"] == 4.5 and hc[-1]["bin_hi"] == 5.5 and sum(r["count"] for r in hc) == 3


def test_iqr_filter_and_box(frame):
    df, pdf = frame
    s = pdf.x.dropna()
    q1, q3 = s.quantile(.25), s.quantile(.75)
    kept = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
    assert P.iqr_filter(df, "x").count() == len(kept)
    box = P.box_stats(df, "x", refenced=True).first()
    assert box["median"] == pytest.approx(kept.median()) and box["n"] == len(kept)


def test_sign_shares_use_all_rows(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)], "a double, b double")
    r = P.sign_shares(df, "a", "b").first()
    assert (r["above_pct"], r["below_pct"], r["equal_pct"]) == (25.0, 25.0, 25.0)


def test_flags_and_summary(spark):
    df = spark.createDataFrame(
        [(0.0, 10.0, -1, 1, 1, None, None, "CA"), (5.0, None, 3, -1, 0, 0.0, -118.0, None),
         (None, 1.0, None, None, None, 34.0, -118.0, "CA")],
        "ClosePrice double, LivingArea double, DaysOnMarket int, BedroomsTotal int, "
        "BathroomsTotalInteger int, Latitude double, Longitude double, StateOrProvince string")
    flagged = Q.apply_flags(df, {**Q.invalid_numeric_rules(), **Q.geo_rules()})
    rows = flagged.collect()
    assert [r["invalid_close_price"] for r in rows] == [True, False, False]
    assert [r["invalid_days_on_market"] for r in rows] == [True, False, False]
    assert [r["invalid_bed_or_bath"] for r in rows] == [False, True, False]
    assert [r["missing_coordinates"] for r in rows] == [True, False, False]
    assert [r["zero_coordinates"] for r in rows] == [False, True, False]
    assert [r["out_of_state_flag"] for r in rows] == [False, True, False]
    assert [r["out_of_bounds_flag"] for r in rows] == [True, True, False]
    summ = {r["flag"]: r["n"] for r in Q.flag_summary(flagged, ["zero_coordinates", "not_there"]).collect()}
    assert summ == {"zero_coordinates": 1}


def test_monthly_join_keeps_rows(spark):
    fact = spark.createDataFrame([("2024-01-05",), ("2024-02-10",), ("2024-03-01",), (None,)], "d string") \
        .withColumn("d", F.col("d").cast("date"))
    series = spark.createDataFrame([("2024-01-04", 6.0), ("2024-01-11", 7.0), ("2024-02-01", 5.0)],
                                   "date string, rate double").withColumn("date", F.col("date").cast("date"))
    monthly = T.monthly_mean(series, "date", "rate")
    joined = T.join_monthly(fact, monthly, "d")
    assert joined.count() == 4
    v = T.join_validation(joined, "rate").first()
    assert (v["n_rows"], v["n_unmatched"], v["passed"]) == (4, 2, False)
    got = {r["year_month"]: r["rate"] for r in joined.collect()}
    assert got["2024-01"] == 6.5 and got["2024-03"] is None


def test_group_median_min_size_and_topn(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 99.0)], "k string, v double")
    g = {r["k"]: (r["n"], r["median"]) for r in M.group_median(df, "k", "v", min_size=2).collect()}
    assert g == {"a": (2, 2.0)}
    top = M.top_n(M.group_median(df, "k", "v"), "median", 1, tiebreak=["k"]).collect()
    assert top[0]["k"] == "b"


def test_strict_date_parse_fails_on_bad_text(spark):
    from tablewright.functions import dates as D
    good = spark.createDataFrame([("2024-01-05",), (None,)], "s string")
    assert [r[0] is None for r in good.select(D.parse_date_strict("s")).collect()] == [False, True]
    bad = spark.createDataFrame([("2024-02-30",)], "s string")
    with pytest.raises(Exception, match="unparseable date"):
        bad.select(D.parse_date_strict("s")).collect()


def test_enrich_stage_keeps_every_row(spark):
    from tablewright.plans import stages
    fact = spark.createDataFrame([("2024-01-05",), ("2024-01-20",), ("2024-05-01",)], "CloseDate string") \
        .withColumn("CloseDate", F.col("CloseDate").cast("date"))
    rates = spark.createDataFrame([("2024-01-04", 6.5), ("2024-01-25", 6.7)], "date string, rate_30yr_fixed double") \
        .withColumn("date", F.col("date").cast("date"))
    out = stages.enrich(fact, rates, "CloseDate").collect()
    assert len(out) == 3
    assert sorted((r["year_month"], r["rate_30yr_fixed"]) for r in out) == [
        ("2024-01", pytest.approx(6.6)), ("2024-01", pytest.approx(6.6)), ("2024-05", None)]


def test_sizing_scales_with_input():
    from tablewright.session import sizing
    small = sizing(10 * 1024 ** 3, 8)
    big = sizing(100 * 1024 ** 4, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 40
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600  # 100 TiB in partitions of 256 MiB
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_columns_by_pattern(spark):
    from tablewright.operators import schema as S

    df = spark.createDataFrame([(1, True, 2)], "`a.b` int, x_flag boolean, c int")
    assert S.select_matching(df, r"_flag$|\.").columns == ["a.b", "x_flag"]
    assert S.select_matching(df, "nothing").columns == []
