"""Clustered partitioned sink and counts taken by the write."""

import os

import pytest

from pyspark.sql import functions as F

from tablewright.operators import profile as P
from tablewright.plans import catalog
from tablewright.plans import fixtures as X
from tablewright.sources.sinks import clustered, write_table

from tables import SF_MID, SF_SMALL


def _files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")) for d in os.listdir(path) if "=" in d}


def _rows(spark, n=40000, hot=0.95):
    month = F.when(F.rand(1) < hot, F.lit("2024-01")).otherwise(F.concat(F.lit("2024-"), F.lpad((F.col("id") % 11 + 2).cast("string"), 2, "0")))
    return spark.range(0, n, 1, 8).select("id", month.alias("m"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_files_of_a_partition_follow_its_bytes(spark, tmp_path):
    path = write_table(_rows(spark), str(tmp_path / "t"), partition_by=["m"], file_bytes=200_000)
    files = _files(path)
    assert len(files) == 12 and len(files["m=2024-01"]) >= 4
    assert all(len(f) == 1 for d, f in files.items() if d != "m=2024-01")  # 8 tasks held rows of each
    one = _files(write_table(_rows(spark), str(tmp_path / "u"), partition_by=["m"], file_bytes=1 << 30))
    assert all(len(f) == 1 for f in one.values())
    more = _files(write_table(_rows(spark).repartition(32), str(tmp_path / "v"), partition_by=["m"], file_bytes=1 << 30))
    assert all(len(f) == 1 for f in more.values())
    assert spark.read.parquet(path).count() == 40000


def test_salted_without_adaptive_execution(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in clustered(_rows(spark), ["m"]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) >= 4 and max(sizes) < 0.6 * 40000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rerun_of_one_partition_leaves_the_others(spark, tmp_path):
    path = write_table(_rows(spark), str(tmp_path / "t"), partition_by=["m"])
    before = _files(path)
    again = _rows(spark).where("m = '2024-03'").withColumn("text", F.lit("new"))
    write_table(again, path, partition_by=["m"], replace="partitions")
    after = _files(path)
    assert {d for d in before if before[d] != after[d]} == {"m=2024-03"}
    got = spark.read.parquet(path)
    assert got.count() == 40000 and {r[0] for r in got.where("m = '2024-03'").select("text").distinct().collect()} == {"new"}
    write_table(again, path, partition_by=["m"], replace="partitions")  # the same once more
    assert spark.read.parquet(path).count() == 40000
    write_table(again, path, partition_by=["m"])
    assert set(_files(path)) == {"m=2024-03"}
    with pytest.raises(ValueError):
        write_table(again, path, replace="partitions")
    with pytest.raises(ValueError):
        write_table(again, path, partition_by=["m"], replace="rows")


def test_sink_query_leaves_one_file_a_month(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, name: str(tmp_path / name))
    rows = catalog.sink_partition_overwrite(spark, SF_MID)
    assert rows.count() == X.sales(spark, SF_MID).count()
    assert all(len(f) == 1 for f in _files(str(tmp_path / "sink")).values())


def test_stages_are_counted_by_the_write(spark, tmp_path, monkeypatch):
    """Every frame is scanned once, by the one action, and the counts are those of separate scans."""
    scans = []
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, name: str(tmp_path / name))
    plain = catalog.write_table
    monkeypatch.setattr(catalog, "write_table",
                        lambda df, *a, **b: (scans.append(df._jdf.queryExecution().executedPlan().toString()), plain(df, *a, **b))[1])
    got = catalog.stage_counts_observed(spark, SF_SMALL)
    assert len(scans) == 1 and scans[0].count("lineitem.parquet") == 1
    assert "lineitem" not in got._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, catalog.stage_counts(spark, SF_SMALL).collect()))


def test_repeated_stages_are_counted_again(spark):
    stages = P.ObservedStages()
    first = stages.mark("first", spark.range(10))
    second = stages.mark("second", first.where("id > 6"))
    with pytest.raises(ValueError):
        stages.table(spark)
    sc = spark.sparkContext
    sc.setJobGroup("mine", "my jobs")
    try:
        stages.run(second.collect)
        assert sc.getLocalProperty("spark.jobGroup.id") == "mine"
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    want = [(0, "first", 10, 1, 100.0), (1, "second", 3, 1, 30.0)]
    assert stages.repeated is False and [tuple(r) for r in stages.table(spark).collect()] == want
    stages.repeated = True  # as after the loss of an executor
    assert [tuple(r) for r in stages.table(spark).collect()] == want
    with pytest.raises(ValueError):
        P.ObservedStages().run(lambda: None)
    none = P.ObservedStages()
    empty = none.mark("empty", spark.range(0))
    none.run(empty.collect)
    assert [tuple(r) for r in none.table(spark).collect()] == [(0, "empty", 0, 1, None)]


def test_a_stage_that_is_left_out_is_counted(spark):
    """Adaptive execution drops what is joined with nothing, its counter with it."""
    stages = P.ObservedStages()
    many = stages.mark("many", spark.range(1000).withColumn("k", F.col("id") % 7))
    none = spark.range(1000).where("id < 0").select((F.col("id") % 7).alias("k")).distinct()
    joined = stages.mark("joined", many.join(none, "k").repartition(3))
    stages.run(joined.collect)
    assert [tuple(r)[1:3] for r in stages.table(spark).collect()] == [("many", 1000), ("joined", 0)]
