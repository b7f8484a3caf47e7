"""Types inferred from all values, promotion where tables disagree, headers read by a job."""

import itertools
import os

import pytest

from pyspark.sql import functions as F

from tablewright.operators import promotion as P
from tablewright.operators.schema import union_by_name
from tablewright.sources import csv as C
from tablewright.sources import files as FS


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)


VALUES = {
    "bigint": ["1", "-7", "+3", " 12 ", "007", "9007199254740993", "9223372036854775807", "-9223372036854775808"],
    "double": ["1.5", ".5", "1.", "-2e3", "1E-7", "inf", "-Infinity", " 3.25 "],
    "date": ["2024-02-29", "0001-01-01", "9999-12-31"],
    "boolean": ["true", "FALSE", "True"],
    "string": ["", " ", "x", "12d", "0x10", "1,5", "9223372036854775808", "1e999", "2024-02-30", "2024-1-5", "2024-01-05 00:00:00", "yes", "1 2", "NaN"],
}


def test_type_of_single_values(spark):
    rows = [(v, kind) for kind, values in VALUES.items() for v in values]
    df = spark.createDataFrame(rows, "v string, kind string").withColumn("bits", P.fits(F.col("v")))
    got = {r["v"]: P.type_of(r["bits"]) for r in df.collect()}
    assert got == dict(rows)
    types = spark.createDataFrame([(b, n) for b in range(16) for n in (0, 1)], "b int, n long")
    assert all(r["t"] == P.type_of(r["b"], r["n"]) for r in types.withColumn("t", P.type_column(F.col("b"), F.col("n"))).collect())


@pytest.mark.parametrize("values, kind", [
    ([None, None], "null"), ([], "null"), (["1", None], "bigint"), (["1", "1.5"], "double"), (["9007199254740992", "0.5"], "double"),
    (["9007199254740993", "0.5"], "string"), (["1", "2024-01-05"], "string"), (["true", "1"], "string"), (["true", None], "boolean"),
    (["1.5", "2024-01-05"], "string"), (["2024-01-05", "2023-01-05"], "date"), (["1", "2", "x"], "string")])
def test_type_of_columns_whatever_the_order(spark, values, kind):
    for some in itertools.islice(itertools.permutations(values), 6):
        df = spark.createDataFrame([(v,) for v in some], "v string").repartition(3)
        (r,) = P.lattice(df).collect()
        assert P.type_of(r["bits"], r["n_present"]) == kind and r["n_present"] == sum(v is not None for v in values)
    one = [P.lattice(spark.createDataFrame([(v,)], "v string")) for v in values]  # a table for each value
    if one:
        assert {r["joined_type"] for r in P.join_lattices(one).collect()} == {kind}


def test_types_of_files_agree_whatever_their_order(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "S202401.csv", "Id,A,B,C,D\n1,5,2024-01-05,true,NA\n2,NA,2024-01-06,False,\n")
    _write(d, "S202402.csv", "Id,A,B,C,D\n3,2.5,2024-02-01,,\n")
    _write(d, "S202403.csv", "Id,B,A,E\n4,bad,7,9007199254740993\n")
    _write(d, "S202404.csv", "Id,E\n5,1\n")
    paths = FS.list_files(spark, d, "S", ".csv")
    want = {"Id": "bigint", "A": "double", "B": "string", "C": "boolean", "D": "string", "E": "bigint"}
    for some in (paths, paths[::-1], [paths[2], paths[0], paths[3], paths[1]]):
        df = C.read_csv_inferred(spark, some)
        assert dict(df.dtypes) == want
        assert sorted((r["Id"], r["A"], r["B"], r["C"], r["E"]) for r in df.collect()) == [
            (1, 5.0, "2024-01-05", True, None), (2, None, "2024-01-06", False, None), (3, 2.5, "2024-02-01", None, None),
            (4, 7.0, "bad", None, 9007199254740993), (5, None, None, None, 1)]
    found = {(r["part"], r["column"]): (r["type"], r["joined_type"]) for r in C.infer_types(C.land_groups(spark, paths)).collect()}
    assert found[0, "B"] == ("date", "string") and found[0, "D"] == ("null", "null") and found[1, "A"] == ("bigint", "double")
    declared = C.read_csv_inferred(spark, paths, types={"A": "int"}, file_name_col="file")
    assert dict(declared.dtypes) | {"A": "int", "file": "string"} == dict(declared.dtypes)
    assert {r["file"] for r in declared.collect()} == {os.path.basename(p) for p in paths}


def test_a_value_that_came_later_fails(spark):
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(Exception, match="doesn't fit its inferred type"):
        P.cast_inferred(df, {"v": "bigint"}).collect()


def test_casts_are_below_the_union(spark):
    plan = P.union_promoted([spark.range(3).select(F.col("id").alias("a")), spark.range(2).select((F.col("id") + 0.5).alias("a"))])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Union") < text.index("cast(id") and dict(plan.dtypes) == {"a": "double"}


def test_union_promoted_keeps_values(spark):
    long, double, text = (spark.createDataFrame(rows, schema) for rows, schema in [
        ([(1, 2 ** 53 + 1, 5, None)], "k long, big long, v long, w int"), ([(2, 0.1, 2.5, 1.5)], "k int, big double, v double, w double"),
        ([(3, "x", True)], "k long, v string, z boolean")])
    u = P.union_promoted([long, double, text])
    assert dict(u.dtypes) == {"k": "bigint", "big": "string", "v": "string", "w": "double", "z": "boolean"}
    assert sorted((tuple(r) for r in u.collect())) == [
        (1, "9007199254740993", "5", None, None), (2, "0.1", "2.5", 1.5, None), (3, None, "x", None, True)]
    small = P.union_promoted([spark.createDataFrame([(2 ** 53,)], "a long"), spark.createDataFrame([(0.5,)], "a double")])
    assert dict(small.dtypes) == {"a": "double"} and {r[0] for r in small.collect()} == {float(2 ** 53), 0.5}
    same = [spark.createDataFrame([(1, [1])], "a int, b array<int>")] * 2
    assert P.union_promoted(same).dtypes == union_by_name(same).dtypes
    with pytest.raises(TypeError, match="no common type"):
        P.union_promoted([same[0], spark.createDataFrame([(1, 2)], "a int, b int")])
    with pytest.raises(ValueError):
        P.union_promoted([])


LINES = 'Id,Remarks\n1,"one ""quoted"" line"\n2,"a, b"\n3,plain\n4,""\n5,"x","too"\n'


@pytest.mark.parametrize("body, spans", [
    (LINES, False), ("Id\n1\n", False), ("", None), ('Id,R\n1,"two\nlines"\n', True), ('Id,R\n1,5" pipe\n', True), ('Id,R\n1,ab"c,"d\ne"\n', True),
    ('"Id","R"\n"1","""x"""\n', False), ('Id,R\n1,"a"""\n2,"""\n"\n', True), ('Id,R\r\n1,"x"\r\n', False)])
def test_files_that_may_be_split(spark, tmp_path, body, spans):
    _write(str(tmp_path), "S202401.csv", body)
    paths = FS.list_files(spark, str(tmp_path), "S", ".csv")
    found = [r["spans"] for r in C.file_shapes(spark, paths).collect()]
    assert found == ([] if spans is None else [spans])


def test_rows_are_the_same_split_or_not(spark, tmp_path):
    _write(str(tmp_path), "S202401.csv", "Id,R\n" + "".join(f'{i},"v ""{i}"", x"\n' for i in range(3000)))
    _write(str(tmp_path), "S202402.csv", "Id,R\n" + "".join(f'{i},"two\nlines {i}"\n' for i in range(50)))
    paths = FS.list_files(spark, str(tmp_path), "S", ".csv")
    rows = [sorted(map(tuple, C.read_csv_landed(spark, paths, multiline=m).collect())) for m in (True, C.AUTO)]
    assert rows[0] == rows[1] and len(rows[0]) == 3050
    groups = C.group_by_header(spark, paths)
    assert [spans for _, spans in groups] == [False, True]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        split = C.read_csv_landed(spark, paths[:1])
        assert split.rdd.getNumPartitions() > 3 and sorted(map(tuple, split.collect())) == sorted(
            (str(i), f'v "{i}", x') for i in range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ValueError, match="multiline"):
        C.read_csv_landed(spark, paths, multiline="maybe")


@pytest.mark.parametrize("multiline", [True, False, C.AUTO])
def test_headers_are_read_by_a_job(spark, tmp_path, multiline):
    """Many names, empty files and names that need encoding; large files are read no further than their first line."""
    for k in range(40):
        _write(str(tmp_path), f"S A%{k:02d}(ä).csv", f"Id,C{k % 3}\n{k},x\n")
    _write(str(tmp_path), "S empty.csv", "")
    _write(str(tmp_path), "S large.csv", "Id,Large\n" + "1,abcdefghijklmnop\n" * 200000)
    paths = FS.list_files(spark, str(tmp_path), "S", ".csv")
    groups = C.group_by_header(spark, paths, multiline=multiline)
    assert sum(map(len, groups.values())) == 42
    assert {h: len(p) for (h, _), p in groups.items()} == {("Id", "C0"): 14, ("Id", "C1"): 13, ("Id", "C2"): 13, (): 1, ("Id", "Large"): 1}
    assert {p.rsplit("/", 1)[1] for (h, _), some in groups.items() if h == ("Id", "C0") for p in some} == {f"S A%{k:02d}(ä).csv" for k in range(0, 40, 3)}


def test_driver_opens_no_file(spark, tmp_path, monkeypatch):
    _write(str(tmp_path), "S202401.csv", "Id\n1\n")
    paths = FS.list_files(spark, str(tmp_path), "S", ".csv")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        C.group_by_header(spark, paths, multiline=False)
        assert len(tracker.getJobIdsForGroup("headers")) >= 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not hasattr(C, "read_header")
