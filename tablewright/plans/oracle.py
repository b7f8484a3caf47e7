"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Written independently of the Spark operators: plain SQL over the
pre-registered tables, with the fixtures as CTEs built from the very same
fixture texts.  Column names equal the Spark ones.
"""

from __future__ import annotations

from tablewright.plans import catalog as K
from tablewright.plans.fixtures import (DATE_FORMATS_SQL, DATE_TEXT_SQL, DRIFT_EVEN_SQL, DRIFT_ODD_SQL, EVENT_FILES_SQL, RATE_SERIES_SQL,
                                        SALES_SQL, for_duckdb)


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes.items()) + "\n"


SALES = for_duckdb(SALES_SQL)
RATES = (f"SELECT strftime(observation_date, '%Y-%m') AS year_month, avg(value) AS rate "
         f"FROM ({for_duckdb(RATE_SERIES_SQL)}) GROUP BY 1")
W_SALES = _with(sales=SALES)
W_SALES_RATES = _with(sales=SALES, rates=RATES)

SALES_TYPES = {
    "l_orderkey": "bigint", "l_linenumber": "int", "property_type": "string", "county": "string",
    "agent": "string", "office": "string", "zip": "bigint", "list_price": "double", "close_price": "double",
    "living_area": "double", "bedrooms": "int", "bathrooms": "int", "days_on_market": "int",
    "close_date": "date", "purchase_date": "date", "listing_date": "date", "latitude": "double",
    "longitude": "double", "state": "string", "sparse": "double",
}


def _category(c: str) -> str:
    if c in K.SALES_METADATA:
        return "metadata"
    if c in K.SALES_CORE:
        return "core"
    return "market_analysis_other"


def _missing_rows(columns, with_meta=False) -> str:
    parts = []
    for i, c in enumerate(columns):
        meta = f"{i} AS position, '{_category(c)}' AS category, '{SALES_TYPES[c]}' AS dtype, " if with_meta else ""
        parts.append(f"SELECT {meta}'{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
                     f"count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100.0 AS missing_pct FROM sales")
    return "\nUNION ALL\n".join(parts)


def _summary(columns, pcts) -> str:
    parts = []
    for c in columns:
        labels = ["count", "mean", "std", "min"] + [f"{p * 100:g}%" for p in pcts] + ["max"]
        vals = ([f"CAST(count({c}) AS DOUBLE)", f"avg({c})", f"stddev_samp({c})", f"CAST(min({c}) AS DOUBLE)"]
                + [f"quantile_cont({c}, {p})" for p in pcts] + [f"CAST(max({c}) AS DOUBLE)"])
        lab = ", ".join(f"'{x}'" for x in labels)
        parts.append(f"SELECT '{c}' AS \"column\", unnest([{lab}]) AS statistic, round(unnest(v), 4) AS value "
                     f"FROM (SELECT [{', '.join(vals)}] AS v FROM sales)")
    return W_SALES + "\nUNION ALL\n".join(parts)


FENCE = ("SELECT quantile_cont(close_price, 0.25) AS q1, quantile_cont(close_price, 0.75) AS q3 FROM sales")
IN_FENCE = "close_price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
FLAG_EXPR = {
    "invalid_close_price": "coalesce(close_price <= 0, false)",
    "invalid_living_area": "coalesce(living_area <= 0, false)",
    "invalid_days_on_market": "coalesce(days_on_market < 0, false)",
    "invalid_bed_or_bath": "(coalesce(bedrooms < 0, false) OR coalesce(bathrooms < 0, false))",
    "missing_coordinates": "(latitude IS NULL OR longitude IS NULL)",
    "zero_coordinates": "(coalesce(latitude = 0, false) OR coalesce(longitude = 0, false))",
    "invalid_longitude": "coalesce(longitude > 0, false)",
    "listing_after_close_flag": "coalesce(listing_date > close_date, false)",
    "purchase_after_close_flag": "coalesce(purchase_date > close_date, false)",
    "negative_timeline_flag": "coalesce(listing_date > purchase_date, false)",
    "out_of_state_flag": "NOT (state IS NOT DISTINCT FROM 'CA')",
    "out_of_bounds_flag": ("NOT coalesce(latitude BETWEEN 32.529508 AND 42.009503 "
                           "AND longitude BETWEEN -124.482003 AND -114.131211, false)"),
}
NUMERIC = ["invalid_close_price", "invalid_living_area", "invalid_days_on_market", "invalid_bed_or_bath"]
DATES = ["listing_after_close_flag", "purchase_after_close_flag", "negative_timeline_flag"]
GEO = ["missing_coordinates", "zero_coordinates", "invalid_longitude", "out_of_state_flag", "out_of_bounds_flag"]


def _flag_rows(names) -> str:
    cols = ", ".join(f"{FLAG_EXPR[n]} AS {n}" for n in names)
    return W_SALES + f"SELECT l_orderkey, l_linenumber, {cols} FROM sales"


def _flag_summary(names) -> str:
    rows = "\nUNION ALL\n".join(f"SELECT {i} AS position, '{n}' AS flag, count(*) FILTER (WHERE {FLAG_EXPR[n]}) AS n "
                                f"FROM sales" for i, n in enumerate(names))
    return W_SALES + rows


MEDIANS_BY = """{ctes}
SELECT {keys}, count(*) AS n,
  round(quantile_cont(close_price, 0.5), 4) AS median_close_price,
  round(quantile_cont(days_on_market, 0.5), 4) AS median_days_on_market
FROM (SELECT *, strftime(close_date, '%Y-%m') AS year_month FROM sales)
WHERE {notnull}
GROUP BY {keys}
"""

HIST = W_SALES + f"""
, b AS ({FENCE}), f AS (SELECT close_price AS v FROM sales, b WHERE {IN_FENCE}),
r AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM f),
c AS (SELECT least(50, floor((v - lo) * 50 / (hi - lo)) + 1) AS bin, count(*) AS n FROM f, r GROUP BY 1)
SELECT t.bin AS bin, round(lo + (t.bin - 1) * ((hi - lo) / 50), 4) AS bin_lo,
       round(lo + t.bin * ((hi - lo) / 50), 4) AS bin_hi, coalesce(c.n, 0) AS count
FROM range(1, 51) t(bin) CROSS JOIN r LEFT JOIN c ON c.bin = t.bin
WHERE lo IS NOT NULL
"""

BOX = W_SALES + f"""
, b AS ({FENCE}), f AS (SELECT close_price AS v FROM sales, b WHERE {IN_FENCE}),
s AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM f)
SELECT round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
  round(max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
  count(*) FILTER (WHERE NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers,
  count(*) AS n
FROM f, s GROUP BY q1, median, q3
"""

# The type of all values of v, by one regular expression for each.
TYPE_OF = r"""CASE WHEN count(v) = 0 THEN 'null' WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'boolean'
  WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+') AND try_cast(v AS BIGINT) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'bigint'
  WHEN bool_and(CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN abs(try_cast(v AS HUGEINT)) <= 9007199254740992
                ELSE regexp_full_match(v, '[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') END) THEN 'double'
  WHEN bool_and(regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(v, '%Y-%m-%d') IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'date'
  ELSE 'string' END"""
DRIFT = _with(odd=for_duckdb(DRIFT_ODD_SQL), even=for_duckdb(DRIFT_EVEN_SQL))
DRIFT_COLUMNS = {"odd": ("id", "buyer", "amount", "day", "code", "big", "flag", "empty", "note"),
                 "even": ("id", "buyer", "amount", "day", "code", "big", "flag", "shipped")}


def _inferred_types() -> str:
    rows = "\nUNION ALL\n".join(
        f"""SELECT {part} AS part, {i} AS position, '{c}' AS "column", CASE WHEN {c} NOT IN ('NA', 'N/A') THEN {c} END AS v FROM {name}"""
        for part, (name, columns) in enumerate(DRIFT_COLUMNS.items()) for i, c in enumerate(columns))
    return DRIFT + f""", v AS ({rows}),
j AS (SELECT "column", {TYPE_OF} AS joined_type FROM v GROUP BY 1)
SELECT part, position, "column", count(*) AS n_rows, count(v) AS n_present, {TYPE_OF} AS type, joined_type
FROM v JOIN j USING ("column") GROUP BY part, position, "column", joined_type"""


def _inferred_scan() -> str:
    value = lambda c: f"CASE WHEN {c} NOT IN ('NA', 'N/A') THEN {c} END"
    same = f"id::BIGINT AS id, buyer::BIGINT AS buyer, ({value('amount')})::DOUBLE AS amount, day, code, big, lower(flag) = 'true' AS flag"
    return DRIFT + f"""SELECT {same}, NULL::VARCHAR AS empty, note FROM odd
UNION ALL BY NAME SELECT {same}, shipped::DATE AS shipped FROM even"""


_ENRICHED = ("SELECT s.*, r.rate FROM sales s LEFT JOIN rates r ON strftime(s.close_date, '%Y-%m') = r.year_month")

SQL: dict[str, str] = {
    "flagship": W_SALES_RATES + f"""
, c AS (SELECT * FROM ({_ENRICHED}) WHERE property_type = 'R'
        AND NOT ({FLAG_EXPR['listing_after_close_flag']} OR {FLAG_EXPR['purchase_after_close_flag']}
                 OR {FLAG_EXPR['negative_timeline_flag']}))
SELECT county, count(close_price) AS n, round(quantile_cont(close_price, 0.5), 4) AS median_close_price,
       round(avg(rate), 4) AS avg_rate
FROM c WHERE county IS NOT NULL GROUP BY county
ORDER BY median_close_price DESC NULLS LAST, county LIMIT 10
""",
    "month_version_select": _with(ev=for_duckdb(EVENT_FILES_SQL)) + """
, c AS (SELECT DISTINCT file_name AS name, regexp_extract(file_name, 'EVT(\\d{8})', 1) AS k
        FROM ev WHERE file_name LIKE 'EVT%' AND file_name LIKE '%.csv'),
sel AS (SELECT k, coalesce(max(name) FILTER (WHERE contains(name, '_filled')), min(name)) AS file_name
        FROM c WHERE k <> '' GROUP BY k)
SELECT event_id, user_id, event_type, value, file_name FROM ev WHERE file_name IN (SELECT file_name FROM sel)
""",
    "csv_typed_scan": """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 11 IN (0, 1) THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 13 IN (0, 1) THEN NULL ELSE o_totalprice END AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate,
  CASE WHEN month(o_orderdate) % 2 = 0 THEN CASE WHEN o_orderkey % 17 = 0 THEN 'two' || chr(10) || 'lines, ' || o_orderpriority
       ELSE o_orderpriority END END AS o_orderpriority
FROM orders
""",
    "series_csv_scan": f"SELECT year_month, round(rate, 4) AS rate FROM ({RATES})",
    "sink_roundtrip": W_SALES + """
SELECT l_orderkey, l_linenumber, close_price, close_date, strftime(close_date, '%Y-%m') AS year_month FROM sales
""",
    "sink_partition_overwrite": W_SALES + f"""
SELECT l_orderkey, l_linenumber, CASE WHEN strftime(close_date, '%Y-%m') = '{K.RERUN_MONTH}' THEN close_price * 2 ELSE close_price END AS close_price,
  close_date, strftime(close_date, '%Y-%m') AS year_month FROM sales
""",
    "union_by_name": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL BY NAME
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""",
    "csv_inferred_types": _inferred_types(),
    "csv_inferred_scan": _inferred_scan(),
    "union_promoted": """
SELECT o_orderkey, o_custkey::DOUBLE AS amount, o_custkey::VARCHAR AS mixed, (9007199254740992 + o_orderkey)::VARCHAR AS big,
  CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders WHERE o_orderkey % 3 = 0
UNION ALL BY NAME
SELECT o_orderkey, o_orderkey % 1000 + 0.5::DOUBLE AS amount, (o_orderkey % 1000)::VARCHAR || '.5' AS mixed,
  (o_orderkey % 1000)::VARCHAR || '.5' AS big, CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders WHERE o_orderkey % 3 = 1
UNION ALL BY NAME
SELECT o_orderkey, o_custkey::DOUBLE AS amount, o_orderpriority AS mixed, o_orderstatus AS day FROM orders WHERE o_orderkey % 3 = 2
""",
    "drop_columns": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       strftime(o_orderdate, '%Y-%m') AS year_month FROM orders
""",
    "drop_repeated_columns": """
SELECT o_orderkey, o_custkey, o_totalprice, o_totalprice AS "o_totalprice.2" FROM orders
""",
    "column_profile": W_SALES + _missing_rows(list(SALES_TYPES), with_meta=True),
    "dtype_counts": f"SELECT dtype, count(*) AS n FROM (VALUES {', '.join(f'({chr(39)}{t}{chr(39)})' for t in SALES_TYPES.values())}) v(dtype) GROUP BY dtype",
    "missing_report": W_SALES + _missing_rows(list(SALES_TYPES)),
    "high_missing_columns": W_SALES + f"SELECT * FROM ({_missing_rows(list(SALES_TYPES))}) WHERE missing_pct > 90",
    "date_missing_counts": W_SALES + _missing_rows(list(K.DATE_COLUMNS)),
    "filter_category": W_SALES + "SELECT * FROM sales WHERE property_type = 'R'",
    "filtered_count": W_SALES + f"SELECT count(close_price) FILTER (WHERE county = '{K.FILTER_COUNTY}') AS n_close_price FROM sales",
    "iqr_filter": W_SALES + f", b AS ({FENCE}) SELECT l_orderkey, l_linenumber, close_price FROM sales, b WHERE {IN_FENCE}",
    "quartiles": W_SALES + """
SELECT round(quantile_cont(close_price, 0.25), 4) AS q25, round(quantile_cont(close_price, 0.5), 4) AS q50,
       round(quantile_cont(close_price, 0.75), 4) AS q75 FROM sales
""",
    "histogram_bins": HIST,
    "box_stats": BOX,
    "numeric_summary": _summary(K.SUMMARY_COLUMNS, (0.05, 0.25, 0.5, 0.75, 0.95)),
    "column_summary": _summary(["days_on_market"], (0.25, 0.5, 0.75)),
    "global_median_mean": W_SALES + "SELECT round(quantile_cont(close_price, 0.5), 4) AS median, round(avg(close_price), 4) AS mean FROM sales",
    "price_vs_list_share": W_SALES + """
SELECT round(count(*) FILTER (WHERE close_price - list_price > 0) / count(*) * 100.0, 4) AS above_pct,
       round(count(*) FILTER (WHERE close_price - list_price < 0) / count(*) * 100.0, 4) AS below_pct,
       round(count(*) FILTER (WHERE close_price - list_price = 0) / count(*) * 100.0, 4) AS equal_pct,
       count(*) AS n_rows FROM sales
""",
    "stage_counts": W_SALES_RATES + """
, st AS (
  SELECT 0 AS step, 'raw' AS stage, count(*) AS n_rows, 11 AS n_columns FROM lineitem
  UNION ALL SELECT 1, 'joined', count(*), 20 FROM sales
  UNION ALL SELECT 2, 'residential', count(*), 20 FROM sales WHERE property_type = 'R'
  UNION ALL SELECT 3, 'enriched', count(*), 22 FROM sales s LEFT JOIN rates r
            ON strftime(s.close_date, '%Y-%m') = r.year_month WHERE property_type = 'R'
  UNION ALL SELECT 4, 'cleaned', count(*), 34 FROM sales s LEFT JOIN rates r
            ON strftime(s.close_date, '%Y-%m') = r.year_month WHERE property_type = 'R')
SELECT step, stage, n_rows, n_columns,
       round(n_rows / (SELECT n_rows FROM st WHERE step = 0) * 100.0, 4) AS retained_pct FROM st
""",
    "category_share": W_SALES + """
SELECT property_type AS value, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM sales) * 100.0, 4) AS share_pct
FROM sales WHERE property_type IS NOT NULL GROUP BY property_type
""",
    "group_median_topk": W_SALES + """
SELECT county, count(close_price) AS n, round(quantile_cont(close_price, 0.5), 4) AS median
FROM sales WHERE county IS NOT NULL GROUP BY county
ORDER BY median DESC NULLS LAST, county LIMIT 10
""",
    "group_median_min_size": f"""
SELECT l_partkey, count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS median
FROM lineitem GROUP BY l_partkey HAVING count(l_extendedprice) >= {K.MIN_GROUP_SIZE}
""",
    "latest_n": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10",
    "month_key": "SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders",
    "monthly_mean": f"SELECT year_month, round(rate, 4) AS rate FROM ({RATES})",
    "monthly_rate_join": W_SALES_RATES + """
SELECT l_orderkey, l_linenumber, close_date, strftime(close_date, '%Y-%m') AS year_month, round(r.rate, 4) AS rate
FROM sales s LEFT JOIN rates r ON strftime(s.close_date, '%Y-%m') = r.year_month
""",
    "listings_rate_join": W_SALES_RATES + """
SELECT l_orderkey, l_linenumber, listing_date, strftime(listing_date, '%Y-%m') AS year_month, round(r.rate, 4) AS rate
FROM sales s LEFT JOIN rates r ON strftime(s.listing_date, '%Y-%m') = r.year_month
""",
    "join_unmatched_by_month": W_SALES_RATES + """
SELECT strftime(close_date, '%Y-%m') AS year_month, count(*) AS n_rows, count(*) FILTER (WHERE r.rate IS NULL) AS n_unmatched
FROM sales s LEFT JOIN rates r ON strftime(s.close_date, '%Y-%m') = r.year_month
GROUP BY 1 HAVING count(*) FILTER (WHERE r.rate IS NULL) > 0
""",
    "join_validation": W_SALES_RATES + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE r.rate IS NULL) AS n_unmatched,
       count(*) FILTER (WHERE r.rate IS NULL) = 0 AS passed
FROM sales s LEFT JOIN rates r ON strftime(s.close_date, '%Y-%m') = r.year_month
""",
    "date_parse_coerce": _with(d=for_duckdb(DATE_TEXT_SQL)) + """
SELECT l_orderkey, l_linenumber, close_date_text, CAST(try_strptime(close_date_text, '%Y-%m-%d') AS DATE) AS close_date FROM d
""",
    "date_parse_strict": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date_text, CAST(o_orderdate AS DATE) AS order_date FROM orders
""",
    "month_year_parts": _with(d=for_duckdb(DATE_TEXT_SQL)) + """
SELECT l_orderkey, l_linenumber, substr(close_date_text, 1, 7) AS year_month,
  CAST(month(try_strptime(substr(close_date_text, 1, 7), '%Y-%m')) AS INTEGER) AS "Month",
  CAST(year(try_strptime(substr(close_date_text, 1, 7), '%Y-%m')) AS INTEGER) AS "Year"
FROM d
""",
    "invalid_numeric_flags": _flag_rows(NUMERIC),
    "date_order_flags": _flag_rows(DATES),
    "geo_flags": _flag_rows(GEO),
    "flag_summary": _flag_summary(["invalid_close_price", "invalid_living_area", "invalid_days_on_market",
                                   "invalid_bed_or_bath", "missing_coordinates", "zero_coordinates",
                                   "invalid_longitude", "listing_after_close_flag", "purchase_after_close_flag",
                                   "negative_timeline_flag", "out_of_state_flag", "out_of_bounds_flag"]),
    "listing_flag_summary": _flag_summary(["invalid_living_area", "invalid_days_on_market", "invalid_bed_or_bath",
                                           "missing_coordinates", "zero_coordinates", "invalid_longitude",
                                           "out_of_state_flag", "out_of_bounds_flag"]),
    "suffix_flag_summary": _flag_summary(["listing_after_close_flag", "purchase_after_close_flag",
                                          "negative_timeline_flag", "out_of_state_flag", "out_of_bounds_flag"]),
    "future_date_flag": W_SALES + f"""
SELECT l_orderkey, l_linenumber, coalesce(close_date > DATE '{K.AS_OF}', false) AS close_date_in_future,
       coalesce(listing_date > DATE '{K.AS_OF}', false) AS listing_date_in_future FROM sales
""",
    "outlier_flag": W_SALES + f"""
, b AS ({FENCE})
SELECT l_orderkey, l_linenumber, close_price,
  coalesce(close_price < q1 - 1.5 * (q3 - q1) OR close_price > q3 + 1.5 * (q3 - q1), false) AS outlier_flag
FROM sales, b
""",
    "price_per_unit_median": W_SALES + """
SELECT county, count(close_price / living_area) AS n,
       round(quantile_cont(close_price / living_area, 0.5), 4) AS median_price_per_unit
FROM sales
WHERE {valid} AND county IS NOT NULL
GROUP BY county
""".format(valid=" AND ".join(f"NOT {FLAG_EXPR[n]}" for n in NUMERIC)),
    "sale_to_list_by_month": W_SALES + """
SELECT strftime(close_date, '%Y-%m') AS year_month, count(close_price / list_price) AS n,
       round(quantile_cont(close_price / list_price, 0.5), 4) AS median_sale_to_list
FROM sales WHERE {valid} AND close_date IS NOT NULL GROUP BY 1
""".format(valid=" AND ".join(f"NOT {FLAG_EXPR[n]}" for n in NUMERIC)),
    "new_vs_closed": """
WITH a AS (SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS new_listings FROM orders GROUP BY 1),
b AS (SELECT strftime(l_shipdate, '%Y-%m') AS year_month, count(*) AS closed_sales FROM lineitem GROUP BY 1)
SELECT coalesce(a.year_month, b.year_month) AS year_month, coalesce(new_listings, 0) AS new_listings,
       coalesce(closed_sales, 0) AS closed_sales
FROM a FULL OUTER JOIN b ON a.year_month = b.year_month
""",
    "top_agents": W_SALES + """
SELECT agent, round(sum(close_price), 4) AS volume, count(*) AS n_sales FROM sales
WHERE agent IS NOT NULL GROUP BY agent ORDER BY volume DESC NULLS LAST, agent LIMIT 10
""",
    "top_offices": W_SALES + """
SELECT office, round(sum(close_price), 4) AS volume, count(*) AS n_sales FROM sales
WHERE office IS NOT NULL GROUP BY office ORDER BY volume DESC NULLS LAST, office LIMIT 10
""",
    "top_agents_by_month": W_SALES + """
, v AS (SELECT strftime(close_date, '%Y-%m') AS year_month, agent, round(sum(close_price), 4) AS volume,
               count(*) AS n_sales FROM sales WHERE agent IS NOT NULL GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year_month ORDER BY volume DESC NULLS LAST, agent) AS INTEGER) AS rank FROM v)
WHERE rank <= 3
""",
    "regional_trend": MEDIANS_BY.format(ctes=W_SALES, keys="county, year_month",
                                        notnull="county IS NOT NULL AND year_month IS NOT NULL"),
    "zip_trend": MEDIANS_BY.format(ctes=W_SALES, keys="zip, year_month",
                                   notnull="zip IS NOT NULL AND year_month IS NOT NULL"),
    "monthly_medians": MEDIANS_BY.format(ctes=W_SALES, keys="year_month", notnull="year_month IS NOT NULL"),
}
SQL["stage_counts_observed"] = SQL["stage_counts"]

SQL["monthly_mean_stream"] = f"""
SELECT year_month, total, n, round(total / n, 4) AS rate
FROM (SELECT strftime(observation_date, '%Y-%m') AS year_month, round(sum(value), 2) AS total, count(value) AS n
      FROM ({for_duckdb(RATE_SERIES_SQL)}) GROUP BY 1)"""

# The candidate formats as DuckDB writes them.
FORMATS = {"yyyy-MM-dd": "%Y-%m-%d", "MM/dd/yyyy": "%m/%d/%Y", "dd/MM/yyyy": "%d/%m/%Y", "yyyyMMdd": "%Y%m%d",
           "dd.MM.yyyy": "%d.%m.%Y", "yyyy/MM/dd": "%Y/%m/%d"}
SQL["date_format_votes"] = _with(f=for_duckdb(DATE_FORMATS_SQL)) + ", t AS (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", {j} AS position, '{spark}' AS format, count({c}) AS n_present,
  count(try_strptime({c}, '{duck}')) AS n_parsed FROM f""" for c in K.VOTED for j, (spark, duck) in enumerate(FORMATS.items())) + """)
SELECT *, n_present - n_parsed AS n_blanked,
  n_parsed > 0 AND row_number() OVER (PARTITION BY "column" ORDER BY n_parsed DESC, position) = 1 AS chosen FROM t"""
SQL["date_parse_voted"] = _with(f=for_duckdb(DATE_FORMATS_SQL)) + """
SELECT o_orderkey, CAST(try_strptime(listed, '%m/%d/%Y') AS DATE) AS listed, CAST(try_strptime(closed, '%d/%m/%Y') AS DATE) AS closed,
  CAST(NULL AS DATE) AS status FROM f"""

MONTHS = W_SALES + ", m AS (SELECT *, strftime(close_date, '%Y-%m') AS year_month FROM sales)"
_TREND = """SELECT '{level}' AS level, {zip} AS zip, {county} AS county, year_month, count(*) AS n,
  round(quantile_cont(close_price, 0.5), 4) AS median_close_price, round(quantile_cont(days_on_market, 0.5), 4) AS median_days_on_market
FROM m WHERE year_month IS NOT NULL AND {notnull} GROUP BY ALL"""
SQL["trend_hierarchy"] = MONTHS + "\nUNION ALL\n".join([
    "\n" + _TREND.format(level="zip", zip="zip", county="NULL", notnull="zip IS NOT NULL"),
    _TREND.format(level="county", zip="NULL", county="county", notnull="county IS NOT NULL"),
    _TREND.format(level="all", zip="NULL", county="NULL", notnull="true")])
SQL["sketch_quantile_error"] = MONTHS + f"""
SELECT county, year_month[1:4] AS year, p::DOUBLE AS p, count(close_price) AS n_values, true AS within_error
FROM m, (SELECT unnest({list(K.SKETCH_PROBS)}) AS p) WHERE county IS NOT NULL GROUP BY ALL HAVING count(close_price) > 0"""
_VALID = " AND ".join(f"NOT {FLAG_EXPR[n]}" for n in NUMERIC)
SQL["kpis_after_month_replaced"] = MONTHS + f""",
r AS (SELECT * REPLACE (CASE WHEN year_month = '{K.RERUN_MONTH}' THEN close_price * 2 ELSE close_price END AS close_price) FROM m
      WHERE NOT (year_month = '{K.RERUN_MONTH}' AND l_orderkey % 10 = 0)),
v AS (SELECT *, CASE WHEN {_VALID} AND living_area <> 0 THEN close_price / living_area END AS price_per_unit,
      CASE WHEN {_VALID} AND list_price <> 0 THEN close_price / list_price END AS sale_to_list FROM r)
SELECT 'price_per_unit' AS kpi, county AS key, count(price_per_unit) AS n, round(quantile_cont(price_per_unit, 0.5), 4) AS value
FROM v WHERE county IS NOT NULL GROUP BY county
UNION ALL SELECT 'sale_to_list', year_month, count(sale_to_list), round(quantile_cont(sale_to_list, 0.5), 4) FROM v GROUP BY year_month
UNION ALL SELECT 'close_price', year_month, count(close_price), round(quantile_cont(close_price, 0.5), 4) FROM v GROUP BY year_month
UNION ALL SELECT 'days_on_market', year_month, count(days_on_market), round(quantile_cont(days_on_market, 0.5), 4) FROM v GROUP BY year_month
UNION ALL SELECT 'agent_volume', agent, n, volume FROM (SELECT agent, count(*) AS n, round(sum(close_price), 4) AS volume FROM v
  WHERE agent IS NOT NULL GROUP BY agent ORDER BY volume DESC NULLS LAST, agent LIMIT 10)
UNION ALL SELECT 'new_listings', strftime(listing_date, '%Y-%m'), count(*), NULL FROM v WHERE listing_date IS NOT NULL GROUP BY 2
"""

SQL["dtype_profile"] = W_SALES + f"""
SELECT dtype, count(*) AS n_columns, count(*) FILTER (WHERE missing_pct = 100) AS n_empty, sum(missing_count)::BIGINT AS n_missing
FROM ({_missing_rows(list(SALES_TYPES), with_meta=True)}) GROUP BY dtype
"""
