"""Shared fixtures over the driver's parquet tables.

Each fixture is one SQL text with ``{table}`` placeholders that both Spark
(``spark.sql(text, table=DataFrame)``) and DuckDB (plain view names) run
unchanged, so the Spark queries and their oracle SQL start from the same
rows.  Every fixture is a projection / join of the given tables, so its
size grows with them.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Transactions with deterministic nulls, zeros, negatives, bad coordinates,
# outliers and a 95 %-null column.  Roles: property_type = return flag,
# county = nation name, agent = supplier name, office = a group of suppliers.
SALES_SQL = """
SELECT l_orderkey, l_linenumber, l_returnflag AS property_type, n_name AS county, s_name AS agent,
  CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE 'OFFICE_' || CAST(l_suppkey % 37 AS STRING) END AS office,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE l_partkey % 40 END AS zip,
  l_extendedprice AS list_price,
  CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DOUBLE) WHEN l_partkey % 89 = 0 THEN NULL
       WHEN l_orderkey % 499 = 0 THEN l_extendedprice * 25
       WHEN l_partkey % 6 = 0 THEN l_extendedprice
       ELSE l_extendedprice * (1 - l_discount + l_tax) END AS close_price,
  CASE WHEN l_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE) WHEN l_orderkey % 103 = 0 THEN NULL ELSE l_quantity * 40 END AS living_area,
  CASE WHEN l_orderkey % 211 = 0 THEN -1 WHEN l_orderkey % 43 = 0 THEN NULL ELSE l_linenumber END AS bedrooms,
  CASE WHEN l_orderkey % 223 = 0 THEN -1 WHEN l_orderkey % 47 = 0 THEN NULL ELSE l_linenumber % 4 END AS bathrooms,
  CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE CAST(l_partkey % 45 + l_suppkey % 30 - 4 AS INT) END AS days_on_market,
  CAST(l_shipdate AS DATE) AS close_date,
  CASE WHEN l_orderkey % 73 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) - CAST(l_partkey % 45 - 3 AS INT) END AS purchase_date,
  CASE WHEN l_orderkey % 71 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) - CAST(l_partkey % 45 + l_suppkey % 30 - 4 AS INT) END AS listing_date,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_suppkey % 17 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(28 + l_suppkey % 18 AS DOUBLE) END AS latitude,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 19 = 0 THEN CAST(120 AS DOUBLE) ELSE CAST(-110 - l_partkey % 18 AS DOUBLE) END AS longitude,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN 'NV' ELSE 'CA' END AS state,
  CASE WHEN l_orderkey % 20 = 0 THEN l_tax END AS sparse
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey JOIN {supplier} ON l_suppkey = s_suppkey
"""

# Close dates as text, with unparseable rows chosen by l_orderkey % 9.
DATE_TEXT_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE l_orderkey % 9 WHEN 1 THEN 'bad' WHEN 2 THEN '2024-02-30' WHEN 3 THEN '01/02/2024'
       ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS close_date_text
FROM {lineitem}
"""

# Event rows tagged with the name of a made-up daily extract file: plain,
# preferred (_filled) and later variants, one name that carries no date key
# and one with another suffix.
EVENT_FILES_SQL = """
SELECT event_id, user_id, event_type, value,
  CASE event_id % 6
    WHEN 0 THEN 'EVT' || CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '.csv'
    WHEN 1 THEN 'EVT' || CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '_filled.csv'
    WHEN 2 THEN 'EVT' || CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '_b.csv'
    WHEN 3 THEN 'EVT' || CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '_filled_b.csv'
    WHEN 4 THEN 'EVTX' || CAST(month(ts) AS STRING) || '.csv'
    ELSE 'EVT' || CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '.txt'
  END AS file_name
FROM {events}
"""

# Weekly-style rate series stand-in: one observation per order.
RATE_SERIES_SQL = """
SELECT CAST(o_orderdate AS DATE) AS observation_date, o_totalprice AS value FROM {orders}
"""

# Dates as text in several formats: one column is mostly month first, one mostly day first, one has no date.
DATE_FORMATS_SQL = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 THEN d WHEN o_orderkey % 31 = 0 THEN NULL ELSE substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4) END AS listed,
  CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || substr(d, 1, 4) END AS closed,
  o_orderstatus AS status
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders})
"""

# Orders as the text of two extracts whose headers and types drift: whole numbers against decimals, dates
# against other text, numbers too long for a double, a column of missing tokens only.
DRIFT_ODD_SQL = """
SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS buyer,
  CASE WHEN o_orderkey % 13 = 0 THEN 'N/A' ELSE CAST(o_custkey AS STRING) END AS amount,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, CAST(o_orderkey % 7 AS STRING) AS code,
  CAST(9007199254740992 + o_orderkey AS STRING) AS big,
  CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS flag, 'NA' AS empty, o_orderpriority AS note
FROM {orders} WHERE month(o_orderdate) % 2 = 1
"""
DRIFT_EVEN_SQL = """
SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS buyer,
  CASE WHEN o_orderkey % 11 = 0 THEN 'NA' ELSE CAST(o_orderkey % 1000 AS STRING) || '.25' END AS amount,
  CASE WHEN o_orderkey % 5 = 0 THEN '31/12/1999' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day,
  CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_orderkey % 7 AS STRING) END AS code,
  CAST(o_orderkey % 1000 AS STRING) || '.5' AS big,
  CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS flag,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS shipped
FROM {orders} WHERE month(o_orderdate) % 2 = 0
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def tables_in(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def for_duckdb(sql: str) -> str:
    """The fixture text with placeholders replaced by the pre-registered view names."""
    return sql.format(**{t: t for t in tables_in(sql)})


def with_cte(name: str, fixture_sql: str, body: str) -> str:
    """``WITH name AS (fixture) body`` for DuckDB."""
    return f"WITH {name} AS ({for_duckdb(fixture_sql)})\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """Run a fixture text in Spark over the parquet tables of ``sf_dir``, or frames ``given`` for them."""
    frames = {t: given[t] if t in given else table(spark, sf_dir, t) for t in tables_in(sql)}
    return spark.sql(sql, **frames)


def sales(spark: SparkSession, sf_dir: str, **given: DataFrame) -> DataFrame:
    return run(spark, sf_dir, SALES_SQL, **given)


def date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, DATE_TEXT_SQL)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, EVENT_FILES_SQL)


def rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RATE_SERIES_SQL)


@lru_cache(maxsize=None)
def sales_columns() -> tuple[str, ...]:
    body = SALES_SQL.split("FROM {lineitem}")[0]
    return tuple(re.findall(r"AS (\w+)(?:,|\s*$)", body.replace("\n", " ")))
