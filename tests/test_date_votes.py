"""Votes for the format that dates are written in."""

from tablewright.functions import dates as D


def _df(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "d string")


def _chosen(df, **options):
    return D.chosen_formats(D.date_format_votes(df, ["d"]), **options).get("d")


def test_all_values_vote(spark):
    assert _chosen(_df(spark, "01/02/2024", "03/04/2024", "31/12/2023")) == ["dd/MM/yyyy"]
    assert _chosen(_df(spark, "31/12/2023", "01/02/2024", "12/30/2023", "12/31/2023")) == ["MM/dd/yyyy"]
    assert _chosen(_df(spark, "01/02/2024", "2024-01-02", "2024-01-03")) == ["yyyy-MM-dd"]  # not that of the first value
    assert _chosen(_df(spark, "01/02/2024")) == ["MM/dd/yyyy"]  # a tie: the earlier candidate
    assert _chosen(_df(spark, "20240102", None, "x")) == ["yyyyMMdd"]
    assert _chosen(_df(spark, "x", None, "")) is None and _chosen(_df(spark, "x").limit(0)) is None


def test_counts_of_votes(spark):
    df = _df(spark, "01/02/2024", "31/12/2023", "2024-01-05", "bad", None)
    votes = {r["format"]: (r["n_present"], r["n_parsed"], r["n_blanked"], r["chosen"]) for r in D.date_format_votes(df, ["d"]).collect()}
    assert votes["dd/MM/yyyy"] == (4, 2, 2, True) and votes["MM/dd/yyyy"] == (4, 1, 3, False) and votes["yyyy-MM-dd"] == (4, 1, 3, False)
    assert sum(v[3] for v in votes.values()) == 1 and set(votes) == set(D.CANDIDATES)


def test_coercion_takes_the_winner(spark):
    df = _df(spark, "01/02/2024", "31/12/2023", "2024-01-05", "bad", None)
    days = lambda **o: sorted(str(r["d"]) for r in D.coerce_voted(df, ["d"], **o).collect())
    assert days() == ["2023-12-31", "2024-02-01", "None", "None", "None"]
    assert days(mixed=True) == ["2023-12-31", "2024-01-05", "2024-02-01", "None", "None"]
    none = D.coerce_voted(_df(spark, "x", None), ["d"])
    assert none.dtypes == [("d", "date")] and all(r["d"] is None for r in none.collect())
    votes = D.date_format_votes(df, ["d"]).where("chosen").first()
    assert votes["n_blanked"] == sum(r["d"] is None for r in D.coerce_voted(df, ["d"]).collect()) - 1  # less the missing one


def test_one_aggregate_for_all_columns(spark):
    df = spark.createDataFrame([("2024-01-02", "03.04.2024", 20240105)], "a string, `b.c` string, n int")
    plan = D.date_format_votes(df, ["a", "b.c", "n"])
    assert D.chosen_formats(plan) == {"a": ["yyyy-MM-dd"], "b.c": ["dd.MM.yyyy"], "n": ["yyyyMMdd"]}
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
