"""Sketches merged for any period, medians of a hierarchy from one count table, metrics kept up to date by month."""

import os
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from tablewright import session
from tablewright.operators import metrics as M
from tablewright.operators import sketches as K
from tablewright.operators import timeseries as T
from tablewright.operators.incremental import MonthlyState
from tablewright.plans import catalog
from tablewright.plans import fixtures as X
from tablewright.sources.sinks import write_table

from tables import SF_MID, SF_SMALL


def _values(spark, n=200000):
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("2024-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("m"),
        F.when(F.rand(1) < 0.7, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 51 == 0, float("nan")).otherwise(F.exp(3 * F.rand(2))).alias("v"))


def test_sketched_ranks_lie_within_the_error(spark):
    rows = session.materialize(_values(spark), "rows")
    state = session.materialize(K.sketch_state(rows, ["m", "g"], {"v": "v"}, k=200), "state")
    assert state.count() == 12 * 6 and state.agg(F.sum("n")).first()[0] == 200000
    probs, error = (0.0, 0.01, 0.5, 0.9, 1.0), K.rank_error(200)
    assert 0.02 < error < 0.04
    for by in (["g"], ["m"], []):
        got = K.sketched_quantiles(state, probs, by, ["v"]).collect()
        for r in got:
            part = rows.where(" and ".join(["v is not null and not isnan(v)"] + [f"{b} = '{r[b]}'" for b in by]))
            x = np.sort([v[0] for v in part.select("v").collect()]) if by != [] or r["p"] == 0.5 else None
            if x is not None:
                assert r["n_values"] == len(x)
                below, up_to = np.searchsorted(x, r["value"], "left") / len(x), np.searchsorted(x, r["value"], "right") / len(x)
                assert below - error <= r["p"] <= up_to + error
        assert len(got) == len(probs) * {"g": 6, "m": 12}.get("".join(by), 1)


def test_a_replaced_month_replaces_its_sketches(spark, tmp_path):
    rows = _values(spark, 24000)
    path = write_table(K.sketch_state(rows, ["m", "g"], {"v": "v"}), str(tmp_path / "s"), partition_by=["m"])
    other = rows.where("m = '2024-02'").withColumn("v", F.lit(1000.0))
    write_table(K.sketch_state(other, ["m", "g"], {"v": "v"}), path, partition_by=["m"], replace="partitions")
    state = spark.read.parquet(path)
    top = {r["m"]: r["value"] for r in K.sketched_quantiles(state.withColumn("m", F.col("m").cast("string")), [0.5], ["m"], ["v"]).collect()}
    assert top["2024-02"] == 1000.0 and all(v < 30 for m, v in top.items() if m != "2024-02")


def test_small_groups_are_exact_and_empty_ones_have_no_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None), ("c", float("nan"))], "g string, v double")
    got = {(r["g"], r["p"]): (r["n_values"], r["value"]) for r in K.sketched_quantiles(
        K.sketch_state(df, ["g"], {"v": "v"}), [0.0, 0.5, 1.0], ["g"], ["v"]).collect()}
    assert got["a", 0.0] == (3, 1.0) and got["a", 0.5] == (3, 2.0) and got["a", 1.0] == (3, 3.0)
    assert got["b", 0.5] == (0, None) and got["c", 0.5] == (0, None)
    assert K.sketched_quantiles(K.sketch_state(df.limit(0), ["g"], {"v": "v"}), [0.5], ["g"], ["v"]).count() == 0


def test_sketch_query_stays_within_the_error(spark):
    rows = catalog.sketch_quantile_error(spark, SF_MID).collect()
    assert len(rows) > 500 and all(r["within_error"] for r in rows)


def test_hierarchy_agrees_with_each_level_and_reads_sales_once(spark, monkeypatch):
    plans = []
    plain = session.materialize
    for module in ("metrics", "quantiles"):
        monkeypatch.setattr(f"tablewright.operators.{module}.materialize",
                            lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), plain(df, *a))[1])
    got = catalog.trend_hierarchy(spark, SF_MID)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("lineitem.parquet") for p in plans) == 1
    monkeypatch.undo()
    rows = got.collect()
    numbers = ("n", "median_close_price", "median_days_on_market")
    for level, query, keys in (("zip", catalog.zip_trend, ("zip", "year_month")), ("county", catalog.regional_trend, ("county", "year_month")),
                               ("all", catalog.monthly_medians, ("year_month",))):
        mine = sorted(tuple(r[c] for c in keys + numbers) for r in rows if r["level"] == level)
        assert mine == sorted(tuple(r[c] for c in keys + numbers) for r in query(spark, SF_MID).collect())
        assert all(r[k] is None for r in rows if r["level"] == level for k in {"zip", "county"} - set(keys))


def test_hierarchy_of_missing_keys_and_values(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "x", 3.0), (None, "x", 5.0), (None, None, None), ("b", "y", None)],
                               "k string, j string, v double")
    got = sorted((tuple(r) for r in M.medians_rollup(df, {"kj": ["k", "j"], "k": ["k"], "all": []}, {"m": "v"}).collect()), key=repr)
    assert got == sorted([("kj", "a", "x", 1, 3.0), ("kj", "b", "y", 1, None), ("k", "a", None, 2, 2.0), ("k", "b", None, 1, None),
                          ("all", None, None, 5, 3.0)], key=repr)
    with pytest.raises(ValueError, match="same keys"):
        M.medians_rollup(df, {"a": ["k", "j"], "b": ["j", "k"]}, {"m": "v"})


def _state(path):
    return MonthlyState(path, "m", ("g",), values={"v": F.col("v")}, sums={"groups": (F.col("g"), F.col("v"))})


def test_refresh_reads_and_writes_one_month(spark, tmp_path, monkeypatch):
    rows = _values(spark, 24000).withColumn("v", F.when(~F.isnan("v"), F.round("v", 2)))
    table = write_table(rows, str(tmp_path / "t"), partition_by=["m"])
    read = lambda: spark.read.schema(rows.schema).parquet(table)
    state = _state(str(tmp_path / "state"))
    state.refresh(read())
    files = lambda: {d: sorted(os.listdir(tmp_path / "state" / "values" / d)) for d in os.listdir(tmp_path / "state" / "values") if "=" in d}
    before = files()
    write_table(rows.where("m = '2024-05'").withColumn("v", F.col("v") + 7), table, partition_by=["m"], replace="partitions")
    plans = []
    plain = session.materialize
    monkeypatch.setattr("tablewright.operators.incremental.materialize",
                        lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), plain(df, *a))[1])
    state.refresh(read().where("m = '2024-05'"), ["2024-05"])
    monkeypatch.undo()
    assert len(plans) == 1 and re.search(r"PartitionFilters: \[[^]]*m#\d+ = 2024-05", plans[0])
    assert {d for d in before if before[d] != files()[d]} == {"m=2024-05"}
    for by in (["g"], ["m"], ["g", "m"]):
        full = M.medians_by(read(), by, {"value": "v"}).drop("n").collect()
        assert sorted((*[r[b] for b in by], r["value"]) for r in full) == sorted(
            (*[r[b] for b in by], r["value"]) for r in state.medians(spark, by, ["v"]).collect())
    want = {r["g"]: (r["n"], round(r["s"], 2)) for r in read().groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert {r["key"]: (r["n"], round(r["amount"], 2)) for r in state.totals(spark, "groups").collect()} == want
    some = state.medians(spark, ["m"], ["v"], months=["2024-01", "2024-02"]).collect()
    assert sorted(r["m"] for r in some) == ["2024-01", "2024-02"]


def test_a_month_without_rows_loses_its_state(spark, tmp_path):
    df = spark.createDataFrame([("2024-01", "a", 1.0), ("2024-02", "b", 2.0), (None, "c", 3.0)], "m string, g string, v double")
    state = _state(str(tmp_path / "state"))
    state.refresh(df)
    state.refresh(df.limit(0), ["2024-02", "2024-07"])
    assert [tuple(r) for r in state.medians(spark, ["g"], ["v"]).collect()] == [("a", "v", 1, 1.0)]
    assert [tuple(r) for r in state.totals(spark, "groups").collect()] == [("a", 1.0, 1)]


def test_kpis_of_the_replaced_month_differ_from_before(spark):
    rows = {(r["kpi"], r["key"]): r for r in catalog.kpis_after_month_replaced(spark, SF_SMALL).collect()}
    month = catalog.RERUN_MONTH
    before = {r["year_month"]: r for r in M.medians_by(T.with_month_key(X.sales(spark, SF_SMALL), "close_date"), ["year_month"], {"v": "close_price"}).collect()}
    assert rows["close_price", month]["value"] > 1.5 * before[month]["v"]
    others = [m for m in before if m != month]
    assert all(abs(rows["close_price", m]["value"] - before[m]["v"]) < 1e-3 for m in others)
