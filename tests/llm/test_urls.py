import datetime as dt

import duckdb

from tablewright.llm import urls

SF_MID = "/root/testdata/sf0.01"
D = dt.date


def test_whole_table(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF_MID}/pages.parquet'")
    want = con.sql(urls.OP8_SQL)
    got = urls.op8_urls(spark, SF_MID)
    rows = sorted(got.collect(), key=lambda r: r.page_id)
    cols = want.columns
    assert sorted(cols) == sorted(got.columns)
    assert [tuple(r[c] for c in cols) for r in rows] == sorted(want.fetchall())
    assert 0 < sum(r.blocked for r in rows) < len(rows) and any(r.n_active > 1 for r in rows)


def test_entries_in_time(spark):
    history = spark.createDataFrame([
        ("block", "example.com", D(2020, 1, 1), "add"), ("block", "example.com", D(2020, 2, 1), "add"),
        ("block", "example.com", D(2020, 3, 1), "remove"), ("block", "example.com", D(2020, 4, 1), "remove"),
        ("block", "example.com", D(2020, 5, 1), "add"), ("allow", "good.example.com", D(2020, 1, 1), "add"),
        ("block", "good.example.com", D(2020, 1, 1), "add"), ("block", "good.example.com/bad", D(2020, 1, 10), "add"),
        ("block", "once.org", D(2020, 1, 5), "add"), ("block", "once.org", D(2020, 1, 5), "remove"),
        ("block", None, D(2020, 1, 5), "add")], "list string, entry string, day date, action string")
    rows = [(1, "http://EXAMPLE.com./x", D(2020, 1, 1), True, 1), (2, "https://a.b.example.com:80/", D(2020, 2, 29), True, 1),
            (3, "http://example.com", D(2020, 3, 1), False, 0), (4, "http://example.com", D(2020, 6, 1), True, 1),
            (5, "http://notexample.com", D(2020, 1, 2), False, 0), (6, "http://u:p@good.example.com/ok", D(2020, 1, 2), False, 3),
            (7, "http://good.example.com/bad/more?x#y", D(2020, 1, 10), True, 4), (8, "http://once.org", D(2020, 1, 5), False, 0),
            (9, None, D(2020, 1, 5), False, 0), (10, "nonsense", D(2020, 1, 5), False, 0), (11, "http://example.com", None, False, 0),
            (11, "http://example.com", None, False, 0), (None, "http://example.com", D(2019, 1, 1), False, 0)]
    captures = spark.createDataFrame([(i, u, d, "clash") for i, u, d, _, _ in rows],
                                     "id long, url string, fetched_on date, entry string")
    got = urls.evaluate(captures, history).collect()
    key = lambda r: repr(r)
    assert sorted(((r.id, r.url, r.fetched_on, r.blocked, r.n_active) for r in got), key=key) == sorted(rows, key=key)
    assert urls.evaluate(captures.limit(0), history).count() == 0
    assert not any(r.blocked for r in urls.evaluate(captures, history.limit(0)).collect())


def test_deep_paths_and_spellings_of_entries(spark):
    """Entries of any depth match, whatever their capitals, scheme, port and closing slashes; the deepest path decides."""
    day = D(2020, 1, 1)
    history = spark.createDataFrame([(kind, e, day, "add") for kind, e in [
        ("block", "Example.org"), ("allow", "example.org/a/b"), ("block", "HTTPS://user@www.Example.org.:443/a/b/c/?q#f"), ("block", "deep.net/x/y/"),
        ("block", "case.com/Path"), ("block", ""), ("block", "/only/path"), ("block", "  "), ("allow", "long-host.example.org")]],
        "list string, entry string, day date, action string")
    rows = [(1, "http://example.org/", True, 1), (2, "http://example.org/a/b", False, 2), (3, "http://www.example.org/a/b/c/d", True, 3),
            (4, "http://www.example.org/a/bb", True, 1), (5, "http://deep.net/x", False, 0), (6, "http://deep.net/x/y?z", True, 1),
            (7, "http://deep.net//x/y", False, 0), (8, "http://CASE.com/Path/more", True, 1), (9, "http://case.com/path", False, 0),
            (10, "http://long-host.example.org/a/b", False, 3), (11, "http://deep.net/" + "x/" * 3000, False, 0),
            (12, "http://deep.net/x/y/" + "z/" * 3000, True, 1)]
    captures = spark.createDataFrame([(i, u, day) for i, u, _, _ in rows], "id long, url string, fetched_on date")
    got = urls.evaluate(captures, history).collect()
    assert sorted((r.id, r.url, r.blocked, r.n_active) for r in got) == rows
    assert {r.id: r.entry for r in got}[3] == "www.example.org/a/b/c"
