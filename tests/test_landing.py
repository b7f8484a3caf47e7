"""CSV landing on a made-up drop folder: drifting and repeated headers,
preferred (_filled) versions, missing tokens, non-matching names."""

import os

import pytest

from pyspark.sql import functions as F

from tablewright.operators.schema import dedupe_names, drop_repeated_columns, union_by_name
from tablewright.plans import stages
from tablewright.sources import csv as C
from tablewright.sources import files as FS
from tablewright.streaming.landing import land_batch, read_landed


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def _drop_folder(tmp_path):
    d = str(tmp_path)
    _write(d, "SOLD202401.csv", "Id,PropertyType,ClosePrice,CloseDate\n1,Residential,100,2024-01-05\n2,Land,5,2024-01-06\n")
    _write(d, "SOLD202401_filled.csv",
           "Id,PropertyType,ClosePrice,CloseDate,latfilled,lonfilled\n"
           "3,Residential,300,2024-01-07,1,2\n4,Residential,NA,bad,1,2\n")
    _write(d, "SOLD202402.csv", "Id,PropertyType,ClosePrice,CloseDate,Extra\n5,Residential,N/A,2024-02-01,x\n")
    _write(d, "SOLD202403_filled.csv", "Id,PropertyType,ClosePrice,CloseDate\n6,Residential,1,2024-03-01\n")
    _write(d, "SOLD202403_filled_v2.csv", "Id,PropertyType,ClosePrice,ClosePrice,CloseDate\n7,Residential,70,71,2024-03-02\n")
    _write(d, "SOLDnotes.csv", "Id,PropertyType\n99,Residential\n")
    _write(d, "SOLD202404.txt", "Id\n98\n")
    return d


def test_list_and_pick_versions(spark, tmp_path):
    d = _drop_folder(tmp_path)
    paths = FS.list_files(spark, d, "SOLD", ".csv")
    assert [p.rsplit("/", 1)[-1] for p in paths] == [
        "SOLD202401.csv", "SOLD202401_filled.csv", "SOLD202402.csv", "SOLD202403_filled.csv",
        "SOLD202403_filled_v2.csv", "SOLDnotes.csv"]
    chosen = FS.select_versions(FS.manifest(spark, paths), "file_name", key_pattern=r"SOLD(\d{6})")
    got = {r["period"]: r["file_name"] for r in chosen.collect()}
    assert got == {"202401": "SOLD202401_filled.csv", "202402": "SOLD202402.csv",
                   "202403": "SOLD202403_filled_v2.csv"}


def test_header_groups_and_repeats(spark, tmp_path):
    d = _drop_folder(tmp_path)
    paths = FS.list_files(spark, d, "SOLD", ".csv")
    landed = C.read_csv_landed(spark, paths, types={"Id": "int", "ClosePrice": "double"},
                               drop=["latfilled", "lonfilled"])
    assert "latfilled" not in landed.columns and "ClosePrice.1" in landed.columns
    rows = {r["Id"]: r for r in landed.collect()}
    assert len(rows) == 8
    assert rows[4]["ClosePrice"] is None and rows[5]["ClosePrice"] is None   # NA, N/A tokens
    assert rows[5]["Extra"] == "x" and rows[1]["Extra"] is None              # added column
    assert rows[7]["ClosePrice"] == 70.0 and rows[7]["ClosePrice.1"] == "71"  # repeated header
    assert "ClosePrice.1" not in drop_repeated_columns(landed).columns


def test_combine_stage(spark, tmp_path):
    d = _drop_folder(tmp_path)
    sold = stages.combine(spark, d, "SOLD", types={"Id": "int", "ClosePrice": "double"})
    assert sorted(r["Id"] for r in sold.collect()) == [3, 4, 5, 7]
    everything = stages.combine(spark, d, "SOLD", pick_versions=False, category=None)
    assert everything.count() == 8


def test_clean_stage_flags_never_null(spark, tmp_path):
    d = _drop_folder(tmp_path)
    sold = stages.combine(spark, d, "SOLD", types={"Id": "int", "ClosePrice": "double"})
    sold = sold.withColumns({"LivingArea": F.lit(None).cast("double"), "Latitude": F.lit(35.0),
                             "Longitude": F.lit(-118.0), "StateOrProvince": F.lit("CA"),
                             "year_month": F.substring("CloseDate", 1, 7)})
    rules = {**stages.Q.invalid_numeric_rules(days=None, beds=None), **stages.Q.geo_rules()}
    out = stages.clean(sold, numeric_rules=rules)
    assert dict(out.dtypes)["CloseDate"] == "date"
    flags = [c for c in rules]
    for r in out.collect():
        assert all(r[f] is not None for f in flags)
    by_id = {r["Id"]: r for r in out.collect()}
    assert by_id[4]["CloseDate"] is None and by_id[4]["Month"] is None
    assert by_id[3]["Month"] == 1 and by_id[3]["Year"] == 2024


def test_union_by_name_and_dedupe(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    u = union_by_name([a, b])
    assert sorted(u.columns) == ["a", "b", "k"] and u.count() == 2
    assert dedupe_names(["a", "b", "a", "a", "a.1"]) == ["a", "b", "a.2", "a.3", "a.1"]


def test_clean_is_idempotent_and_counts_add_up(spark, tmp_path):
    from tablewright.operators import profile as P
    d = _drop_folder(tmp_path)
    sold = stages.combine(spark, d, "SOLD", types={"Id": "int", "ClosePrice": "double"})
    sold = sold.withColumns({"LivingArea": F.lit(1.0), "Latitude": F.lit(None).cast("double"),
                             "Longitude": F.lit(-118.0), "StateOrProvince": F.lit(None).cast("string")})
    rules = {**stages.Q.invalid_numeric_rules(days=None, beds=None), **stages.Q.geo_rules()}
    once = stages.clean(sold, numeric_rules=rules)
    twice = stages.clean(once, numeric_rules=rules)
    assert sorted(once.columns) == sorted(twice.columns)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    n = once.count()
    for r in P.missing_report(once).collect():
        present = once.where(F.col(f"`{r['column']}`").isNotNull()).count()
        assert r["missing_count"] + present == n


def test_header_with_byte_order_mark(spark, tmp_path):
    d = str(tmp_path)
    with open(os.path.join(d, "SOLD202405.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write("Id,ClosePrice\n1,5\n")
    landed = C.read_csv_landed(spark, FS.list_files(spark, d, "SOLD", ".csv"), types={"Id": "int"})
    assert landed.columns == ["Id", "ClosePrice"] and landed.first()["Id"] == 1


def _land(spark, folder, **options):
    return sorted(r["Id"] for r in stages.combine(spark, folder, "SOLD", types={"Id": "int"}, category=None, **options).collect())


def test_versions_are_picked_by_name_not_by_folder(spark, tmp_path):
    for folder in ("plain", "crmls_filled", "SOLD202312", "SOLD202401_filled"):
        d = tmp_path / folder
        d.mkdir()
        for k, name in enumerate(["SOLD202401.csv", "SOLD202401_filled.csv", "SOLD202401_v2.csv", "SOLD202402.csv"]):
            _write(str(d), name, f"Id\n{k}\n")
        assert _land(spark, str(d)) == [1, 3]
        out = str(tmp_path / f"out-{folder}")
        paths = FS.list_files(spark, str(d), "SOLD", ".csv")
        assert land_batch(spark, paths, out, "SOLD", types={"Id": "int"}) == ["202401", "202402"]
        assert sorted(r["Id"] for r in read_landed(spark, out).collect()) == [1, 3]


def test_prefix_is_literal(spark, tmp_path):
    _write(str(tmp_path), "A.B(1)202401.csv", "Id\n1\n")
    _write(str(tmp_path), "A.B(1)202402.csv", "Id\n2\n")
    got = stages.combine(spark, str(tmp_path), "A.B(1)", types={"Id": "int"}, category=None)
    assert sorted(r["Id"] for r in got.collect()) == [1, 2]
    out = str(tmp_path / "out")
    assert land_batch(spark, FS.list_files(spark, str(tmp_path), "A.B(1)", ".csv"), out, "A.B(1)") == ["202401", "202402"]


def test_period_without_rows_loses_its_partition_and_columns_may_differ(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    drop.mkdir()
    _write(str(drop), "SOLD202401.csv", "Id,A\n1,x\n")
    _write(str(drop), "SOLD202402.csv", "Id,B\n2,y\n")
    paths = FS.list_files(spark, str(drop), "SOLD", ".csv")
    land_batch(spark, paths[:1], out, "SOLD")
    land_batch(spark, paths[1:], out, "SOLD")
    assert {(r["Id"], r["A"], r["B"]) for r in read_landed(spark, out).collect()} == {("1", "x", None), ("2", None, "y")}
    _write(str(drop), "SOLD202401_filled.csv", "Id,A\n")
    land_batch(spark, FS.list_files(spark, str(drop), "SOLD202401_filled", ".csv"), out, "SOLD")
    assert [r["Id"] for r in read_landed(spark, out).collect()] == ["2"]


def test_quoted_line_ends(spark, tmp_path):
    _write(str(tmp_path), "SOLD202401.csv", 'Id,Remarks,ClosePrice\n1,"two\nlines, with ""quotes""",10\n2,plain,20\n')
    rows = C.read_csv_landed(spark, FS.list_files(spark, str(tmp_path), "SOLD", ".csv"),
                             types={"Id": "int", "ClosePrice": "double"}).collect()
    assert {(r["Id"], r["Remarks"], r["ClosePrice"]) for r in rows} == {
        (1, 'two\nlines, with "quotes"', 10.0), (2, "plain", 20.0)}


def test_whole_numbers_and_nan(spark, tmp_path):
    _write(str(tmp_path), "SOLD202401.csv", "Beds,Price\n3.0,NAN\n2, NaN\n2.5,1e3\nx,nan\n,7\n1e1,-Infinity\n")
    paths = FS.list_files(spark, str(tmp_path), "SOLD", ".csv")
    types = {"Beds": "int", "Price": "double"}
    rows = [(r["Beds"], r["Price"]) for r in C.read_csv_landed(spark, paths, types=types).collect()]
    assert sorted(rows, key=repr) == sorted([(3, None), (2, None), (None, 1000.0), (None, None), (None, 7.0),
                                             (10, float("-inf"))], key=repr)
    failed = {r["column"]: r["n_failed"] for r in C.cast_failures(C.read_csv_landed(spark, paths), types).collect()}
    assert failed == {"Beds": 2, "Price": 2}  # 2.5 and x; NAN and " NaN" ("nan" is a missing token)


def test_lines_with_too_many_fields(spark, tmp_path):
    _write(str(tmp_path), "SOLD202401.csv", "Id,B\n1,2,3\n4,5\n6\n")
    paths = FS.list_files(spark, str(tmp_path), "SOLD", ".csv")
    with pytest.raises(Exception, match="more fields than the header"):
        C.read_csv_landed(spark, paths).collect()
    read = lambda how: sorted((r["Id"], r["B"] or "") for r in C.read_csv_landed(spark, paths, extra_fields=how).collect())
    assert read("drop") == [("4", "5"), ("6", "")] and read("keep") == [("1", "2"), ("4", "5"), ("6", "")]


def test_enrich_is_strict_and_keeps_rows(spark):
    fact = spark.createDataFrame([("2024-01-05",), ("2024-02-01",)], "CloseDate string")
    rates = spark.createDataFrame([("2024-01-04", 6.5)], "date string, rate_30yr_fixed double")
    assert {(r["year_month"], r["rate_30yr_fixed"]) for r in stages.enrich(fact, rates, "CloseDate").collect()} == {
        ("2024-01", 6.5), ("2024-02", None)}
    for bad in ("bad", "2024"):
        other = spark.createDataFrame([(bad,)], "CloseDate string")
        with pytest.raises(Exception, match="unparseable date"):
            stages.enrich(other, rates, "CloseDate").collect()
        with pytest.raises(Exception, match="unparseable date"):
            stages.enrich(fact, rates.withColumn("date", F.lit(bad)), "CloseDate").collect()
    monthly = spark.createDataFrame([("2024-01", 1.0), ("2024-01", 2.0)], "year_month string, rate double")
    with pytest.raises(Exception, match="month occurs more than once"):
        stages.T.join_monthly(fact, monthly, "CloseDate").collect()


def test_scratch_goes_at_the_end_of_its_block(spark):
    from tablewright import session

    with session.scratch(spark):
        path = session.materialize(spark.range(3)).inputFiles()[0].replace("file:", "")
        assert os.path.exists(path)
    assert not os.path.exists(path)
