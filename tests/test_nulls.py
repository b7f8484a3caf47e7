"""Missing-value truth table: every flag is non-null and follows the
documented rule for null (and NaN, which landing turns into null)."""

import math

from pyspark.sql import functions as F

from tablewright.functions import nulls as N


def _rows(spark, values, dtype="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_comparisons_are_false_on_missing(spark):
    df = N.clean_nan(_rows(spark, [None, float("nan"), -1.0, 0.0, 2.0]))
    out = df.select(N.le("x", 0).alias("le"), N.lt("x", 0).alias("lt"), N.gt("x", 0).alias("gt"),
                    N.eq("x", 0).alias("eq")).collect()
    assert [tuple(r) for r in out] == [
        (False, False, False, False), (False, False, False, False),
        (True, True, False, False), (True, False, False, True), (False, False, True, False)]


def test_nan_is_above_everything_until_cleaned(spark):
    raw = _rows(spark, [float("nan")])
    assert raw.select((F.col("x") > 0).alias("p")).first().p is True
    assert N.clean_nan(raw).select(N.gt("x", 0).alias("p")).first().p is False
    assert raw.select(F.col("x").isNull().alias("p")).first().p is False
    assert N.clean_nan(raw).select(F.col("x").isNull().alias("p")).first().p is True


def test_not_equal_is_true_on_missing(spark):
    df = spark.createDataFrame([("CA",), ("NV",), (None,)], "s string")
    assert [r[0] for r in df.select(N.ne_or_missing("s", "CA")).collect()] == [False, True, True]


def test_outside_box_true_when_either_missing(spark):
    df = spark.createDataFrame([(35.0, -120.0), (None, -120.0), (35.0, None), (0.0, -120.0)], "a double, b double")
    out = [r[0] for r in df.select(N.outside_box("a", "b", (32.5, 42.0, -124.5, -114.1))).collect()]
    assert out == [False, True, True, True]


def test_missing_tokens(spark):
    tokens = ["", "NA", "N/A", "NULL", "null", "None", "NaN", "nan", "n/a", "#N/A", "<NA>", "-nan"]
    df = spark.createDataFrame([(t,) for t in tokens] + [("ok",), ("0",)], "s string")
    out = [r[0] for r in df.select(N.missing_token_to_null("s")).collect()]
    assert out == [None] * len(tokens) + ["ok", "0"]
    assert len(N.DEFAULT_NA_TOKENS) == 19


def test_any_missing_and_is_true(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(N.any_missing("a", "b")).collect()] == [True, False]
    assert [r[0] for r in df.select(N.is_true(F.col("b") > 0)).collect()] == [False, True]
    assert not math.isnan(0.0)
