"""Incremental landing: a late preferred file replaces its period."""

import os
import random

from tablewright import session
from tablewright.operators import timeseries as T
from tablewright.plans import catalog
from tablewright.sources import files as FS
from tablewright.streaming import landing, monthly
from tablewright.streaming.landing import start_landing

from tables import SF_SMALL


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def test_stream_lands_and_replaces_versions(spark, tmp_path):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    _write(drop, "SOLD202401.csv", "Id,ClosePrice\n1,10\n2,20\n")
    _write(drop, "SOLD202402.csv", "Id,ClosePrice\n3,30\n")
    q = start_landing(spark, str(drop), "SOLD", str(out), types={"Id": "int", "ClosePrice": "double"},
                      available_now=True)
    q.awaitTermination(120)
    first = {r["Id"]: str(r["period"]) for r in spark.read.parquet(str(out)).collect()}
    assert first == {1: "202401", 2: "202401", 3: "202402"}

    _write(drop, "SOLD202401_filled.csv", "Id,ClosePrice,latfilled\n4,40,1\n")
    q = start_landing(spark, str(drop), "SOLD", str(out), types={"Id": "int", "ClosePrice": "double"},
                      available_now=True)
    q.awaitTermination(120)
    second = spark.read.parquet(str(out))
    assert "latfilled" not in second.columns
    assert sorted(r["Id"] for r in second.collect()) == [3, 4]


def _names(spark, paths, manifest):
    return landing.merge_names(spark, manifest, paths, r"^SOLD([0-9]{6})", "_filled")


def test_manifest_stays_one_row_a_period(spark, tmp_path):
    """Many batches of names: a batch reads and writes the periods it touches only, and the choice is that of all names."""
    manifest = str(tmp_path / "m")
    months = [f"2024{m:02d}" for m in range(1, 6)]
    names = [f"/x/{k % 3}/SOLD{m}{v}.csv" for m in months for k, v in enumerate(["", "_b", "_filled", "_filled_c", "_a"])]
    rng = random.Random(1)
    rng.shuffle(names)
    said = {}
    for k in range(0, len(names), 4):
        said |= _names(spark, names[k:k + 4], manifest)
        files = {d: [f for f in os.listdir(os.path.join(manifest, d)) if f.endswith(".parquet")] for d in os.listdir(manifest) if "=" in d}
        assert all(len(f) == 1 for f in files.values())
    table = spark.read.parquet(manifest)
    assert table.count() == len(months)
    whole = FS.select_versions(FS.manifest(spark, names), "file_name", key_pattern=r"^SOLD([0-9]{6})", carry="file_path")
    assert said == {r["period"]: r["file_path"] for r in whole.collect()}
    before = {d: os.listdir(os.path.join(manifest, d)) for d in os.listdir(manifest) if "=" in d}
    assert _names(spark, ["/x/SOLD202403_filled_z.csv", "/x/other.csv"], manifest) == {"202403": "/x/SOLD202403_filled_z.csv"}
    after = {d: os.listdir(os.path.join(manifest, d)) for d in before}
    assert {d for d in before if before[d] != after[d]} == {"period=202403"}
    assert _names(spark, ["/x/SOLD202403_b.csv"], manifest) == {"202403": "/x/SOLD202403_filled_z.csv"}
    assert _names(spark, ["/x/other.csv"], manifest) == {}


def test_replayed_batch_writes_the_same(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    drop.mkdir()
    _write(drop, "SOLD202401.csv", "Id\n1\n")
    _write(drop, "SOLD202401_filled.csv", "Id\n2\n3\n")
    _write(drop, "SOLD202402.csv", "Id\n")
    paths = FS.list_files(spark, str(drop), "SOLD", ".csv")
    for _ in range(2):
        assert landing.land_batch(spark, paths, out, "SOLD") == ["202401", "202402"]
        assert sorted(r["Id"] for r in landing.read_landed(spark, out).collect()) == ["2", "3"]


def _series(spark, rows):
    return spark.createDataFrame(rows, "d string, v double").selectExpr("cast(d as date) d", "v")


def test_streamed_monthly_mean_equals_the_batch(spark, tmp_path):
    """Late rows of earlier months, a month without a value, undated rows; a second run goes on where the first ended."""
    drop, out, state = str(tmp_path / "drop"), str(tmp_path / "out"), str(tmp_path / "state")
    batches = [[("2024-01-03", 1.0), ("2024-02-05", 3.0), (None, 9.0)], [("2024-01-31", 2.0), ("2024-03-01", None)],
               [("2024-03-31", 5.0), ("2024-01-01", 6.0), ("2024-04-30", None)]]

    def run():
        stream = spark.readStream.schema("d date, v double").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(drop)
        monthly.start_monthly_mean(stream, "d", "v", out, state, delay="100 days", available_now=True).awaitTermination(120)
        return sorted(map(tuple, monthly.read_monthly_mean(spark, out).collect()))

    every = []
    for k, rows in enumerate(batches):
        _series(spark, rows).coalesce(1).write.parquet(f"{drop}/{k}")
        every += rows
        if k:
            want = sorted(map(tuple, T.monthly_mean(_series(spark, every), "d", "v").collect()))
            assert run() == want
    _series(spark, [("2023-06-01", 100.0), ("2024-05-02", 1.0)]).coalesce(1).write.parquet(f"{drop}/9")
    run()  # the watermark moves on after this batch
    _series(spark, [("2024-01-02", 1000.0)]).coalesce(1).write.parquet(f"{drop}/late")
    got = dict(run())
    assert got["2024-01"] == 3.0 and "2023-06" not in got and got["2024-05"] == 1.0  # beyond the delay: left out
    query = monthly.start_monthly_mean(spark.readStream.schema("d date, v double").option("recursiveFileLookup", True).parquet(drop),
                                       "d", "v", out, state, delay="100 days", available_now=True)
    query.awaitTermination(120)


def test_stream_query_runs_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, name: str(tmp_path / name))
    got = {r["year_month"]: r["rate"] for r in catalog.monthly_mean_stream(spark, SF_SMALL).collect()}
    want = {r["year_month"]: r["rate"] for r in catalog.monthly_mean(spark, SF_SMALL).collect()}
    assert got.keys() == want.keys() and all(abs(got[m] - want[m]) < 1.01e-4 for m in want)
    assert len([f for f in os.listdir(tmp_path / "monthly-state" / "commits") if f.isdigit()]) > 3


def test_batches_of_the_stream_follow_years_and_not_files(spark, tmp_path, monkeypatch):
    """Many files a year: two batches a year at most (the second moves the watermark), in few stateful tasks."""
    orders = spark.range(0, 6000, 1, 8).selectExpr(
        "id o_orderkey", "id o_custkey", "'O' o_orderstatus", "cast(id % 900 as double) o_totalprice",
        "cast(date_add(date'1995-01-01', cast(id % 700 as int)) as timestamp) o_orderdate", "'1-URGENT' o_orderpriority")
    sf = str(tmp_path / "sf")
    orders.write.parquet(f"{sf}/orders.parquet")
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, name: str(tmp_path / name))
    with session.settings(spark, {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}):  # 40 files a year
        got = {r["year_month"]: r["rate"] for r in catalog.monthly_mean_stream(spark, sf).collect()}
        want = {r["year_month"]: r["rate"] for r in catalog.monthly_mean(spark, sf).collect()}
    assert len(want) == 23 and got.keys() == want.keys() and all(abs(got[m] - want[m]) < 1.01e-4 for m in want)
    assert len(list((tmp_path / "arrivals" / "1995").glob("part-*"))) > 6
    assert len([f for f in os.listdir(tmp_path / "monthly-state" / "commits") if f.isdigit()]) <= 6
    assert len(os.listdir(tmp_path / "monthly-state" / "state" / "0")) <= monthly.STATE_PARTITIONS + 1
