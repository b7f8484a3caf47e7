"""Exact quantiles against a brute-force numpy reference, over few and many
range partitions, including a group holding a third of all rows and heavily
repeated values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators.quantiles import quantiles, quantiles_of, value_counts

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0, 1 / 3]


def _frame(spark, seed=7):
    rng = np.random.default_rng(seed)
    n = 6000
    g = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))     # group 0 holds a third
    v = np.round(rng.lognormal(10, 1, n), 2)
    v[rng.random(n) < 0.2] = 500.0                                       # a heavily repeated value
    rows = [(int(a), float(b)) for a, b in zip(g, v)]
    rows += [(int(a), None) for a in range(5)]
    return spark.createDataFrame(rows, "g int, v double"), g, v


def _expected(values):
    return [float(np.quantile(values, p, method="linear")) for p in PROBS]


@pytest.fixture(params=[1, 8, 37])
def partitions(request, spark):
    """Runs a test with so many range partitions, none of them merged."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], request.param)
    spark.conf.set(keys[1], "false")
    yield request.param
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def test_grouped_exact(spark, partitions):
    df, g, v = _frame(spark)
    out = quantiles(df, "v", PROBS, by=["g"], n_name="n").collect()
    got = {r["g"]: [r[c] for c in r.asDict() if c not in ("g", "n")] for r in out}
    assert set(got) == set(int(x) for x in np.unique(g))
    assert {r["g"]: r["n"] for r in out} == {int(k): int((g == k).sum()) for k in np.unique(g)}
    for key, qs in got.items():
        exp = _expected(v[g == key])
        assert qs == pytest.approx(exp, rel=1e-12, abs=1e-9), key


def test_global_exact(spark, partitions):
    df, _, v = _frame(spark, seed=3)
    row = quantiles(df, F.col("v"), PROBS).first()
    assert list(row) == pytest.approx(_expected(v), rel=1e-12)


def test_largest_task_is_bounded_when_one_group_has_all_rows(spark, partitions):
    """What a task ranks is a slice of one range partition: its values, not the group's."""
    n = 40_000
    df = spark.range(n).selectExpr("1 AS g", "CAST(id * 7919 % 40000 AS double) AS v")
    counted = value_counts(df, "v", ["g"])
    slices = [r["n"] for r in counted.groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert sum(slices) == n and max(slices) <= 2 * n / partitions
    assert quantiles_of(counted, [0.5], ["g"]).first()["q50"] == (n - 1) / 2


def test_rows_of_a_counted_table_and_dotted_or_missing_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 9.0), (None, 5.0), (None, 7.0), ("b", None)], "`k.x` string, v double")
    counted = value_counts(df, "v", ["k.x"])
    got = {r["k.x"]: (r["q50"], r["n"]) for r in quantiles_of(counted, [0.5], ["k.x"], n_name="n").collect()}
    assert got == {"a": (5.0, 2), None: (6.0, 2), "b": (None, 0)}
    kept = quantiles_of(counted.where("_v > 1"), [0.5], ["k.x"]).collect()
    assert {r["k.x"]: r["q50"] for r in kept} == {"a": 9.0, None: 6.0}


def test_single_value_and_empty_group(spark):
    df = spark.createDataFrame([(1, 4.0), (2, None)], "g int, v double")
    out = {r["g"]: r["q50"] for r in quantiles(df, "v", [0.5], by=["g"]).collect()}
    assert out == {1: 4.0, 2: None}


def test_approx_method_runs(spark):
    df, _, v = _frame(spark)
    row = quantiles(df, "v", [0.5], method="approx").first()
    assert abs(row[0] - np.median(v)) / np.median(v) < 0.01


def test_no_python_in_plan(spark):
    df, _, _ = _frame(spark)
    plan = quantiles(df, "v", [0.5], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 40)), min_size=30, max_size=300),
       st.sampled_from([0.01, 0.1, 0.5, 0.9, 0.99]))
def test_property_equals_bruteforce(spark, rows, p):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, v double")
    got = {r["g"]: r["q"] for r in quantiles(df, "v", [p], by=["g"], names=["q"]).collect()}
    for g in {g for g, _ in rows}:
        vals = np.array([v for k, v in rows if k == g], dtype=float)
        assert got[g] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


def test_fixture_matches_duckdb(spark):
    import duckdb

    from tables import SF_SMALL
    from tablewright.plans import fixtures as X

    sales = X.sales(spark, SF_SMALL)
    got = {r["county"]: (r["q5"], r["q50"], r["q95"]) for r in
           quantiles(sales, "close_price", [0.05, 0.5, 0.95], by=["county"]).collect()}
    con = duckdb.connect()
    for t in ["lineitem", "orders", "customer", "nation", "supplier"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    exp = {r[0]: r[1:] for r in con.sql(
        f"WITH sales AS ({X.for_duckdb(X.SALES_SQL)}) SELECT county, quantile_cont(close_price, 0.05), "
        "quantile_cont(close_price, 0.5), quantile_cont(close_price, 0.95) FROM sales "
        "WHERE close_price IS NOT NULL GROUP BY county").fetchall()}
    assert set(got) == set(exp)
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12), k
