"""URL filters by a temporal list join.

A list is a history: dated entries that add or remove a host (with all hosts
below it) or a path of any depth below a host (with all that is below it).  The
history of each entry becomes validity intervals, and an as-of join evaluates
every capture against the entries that were active when it was fetched, not
against the list of today.  The most specific active entry decides: the path with
most segments, then the longer entry, ``allow`` before ``block`` where both lists
hold the same one.

Entries are read as URLs are: a scheme, a user, a port, a query and closing dots
and slashes are left out, the host is in lower case.

A capture is expanded into the keys that could match it (its host's suffixes,
alone and with each of its leading paths, as deep as the list has any), and keys
are joined to entries by equality, with the interval as a condition on the matched pair.  An
entry has at most one interval at a time, so the join adds no rows; a host with
a third of all captures is split by the join's skew handling, since the side of
the list has one entry's intervals only.

Defined results: a null or malformed URL has no host and an unknown date no
active entries, so neither is blocked; repeated captures are evaluated each;
on one day a removal comes after an addition; adding what is active or
removing what isn't changes nothing; an entry without removal stays active;
empty tables give empty results.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import materialize, table

#: Scheme, user and port are left out; a host ends at a slash, question mark, hash or colon (fixed patterns).
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)"
FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    """The host of a URL in lower case without a closing dot; empty if there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", ""), F.lit(""))


def segments(path: Column) -> Column:
    """The leading segments of a path that begins with a slash, up to an empty one."""
    def leading(parts: Column) -> Column:
        gap = F.array_position(parts, "")
        return F.slice(parts, 1, F.when(gap > 0, (gap - 1).cast("int")).otherwise(F.size(parts)))

    return F.transform(F.array(F.slice(F.split(path, "/"), 2, F.length(path) + 1)), leading)[0]


def keys(url: Column, depth: int = 1) -> Column:
    """The list entries that could match: suffixes of the host, alone and with the paths of up to ``depth`` segments."""
    def suffixes(parts: Column) -> Column:
        return F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))

    def paths(parts: Column) -> Column:
        most = F.least(F.size(parts), F.lit(depth))
        return F.transform(F.slice(parts, 1, most), lambda _, i: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i + 1), "/")))

    hosts = F.transform(F.array(F.split(host(url), r"\.")), suffixes)[0]
    below = F.transform(F.array(segments(F.regexp_extract(url, PATH, 1))), paths)[0]
    both = F.flatten(F.transform(hosts, lambda h: F.concat(F.array(h), F.transform(below, lambda p: F.concat(h, p)))))
    return F.when(F.coalesce(host(url), F.lit("")) == "", F.array().cast("array<string>")).otherwise(both)


def normalised(entry: Column) -> Column:
    """A list entry as ``keys`` writes it; null if it has no host."""
    plain = F.when(entry.rlike(SCHEME), entry).otherwise(F.concat(F.lit("http://"), F.ltrim(entry)))
    path = F.array_join(segments(F.regexp_extract(plain, PATH, 1)), "/")
    name = host(F.trim(plain))
    return F.when(name != "", F.concat(name, F.when(path == "", "").otherwise(F.concat(F.lit("/"), path))))


def intervals(history: DataFrame) -> DataFrame:
    """``history`` (list, entry, day, action ``add`` or ``remove``) as rows
    (list, entry, valid_from, valid_to), the last day left out."""
    known = history.withColumn("entry", normalised(F.col("entry"))).where("entry is not null and day is not null")
    last = known.groupBy("list", "entry", "day").agg(
        F.max("action").alias("action"))  # remove sorts after add
    by = Window.partitionBy("list", "entry").orderBy("day")
    turns = last.withColumn("before", F.lag("action").over(by)).where(
        "action <> coalesce(before, 'remove')")
    return turns.withColumn("valid_to", F.coalesce(F.lead("day").over(by), F.lit(FOREVER).cast("date"))).where(
        "action = 'add'").select("list", "entry", F.col("day").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, history: DataFrame) -> DataFrame:
    """Every row of ``captures`` (id, url, fetched_on): ``host``, number of
    active entries, the one that decides and whether it blocks."""
    rows = captures.select("id", "url", "fetched_on")
    each = rows.groupBy("id", "url", "fetched_on").agg(F.count("*").alias("copies"))
    active = materialize(intervals(history), "intervals")
    levels = F.size(F.split("entry", "/")) - 1
    depth = active.agg(F.max(levels)).first()[0] or 0
    keyed = each.select("*", F.explode_outer(keys(F.col("url"), depth)).alias("key"))
    met = keyed.join(active, (F.col("key") == F.col("entry")) & (F.col("fetched_on") >= F.col("valid_from"))
                     & (F.col("fetched_on") < F.col("valid_to")), "left")
    place = F.struct(levels.alias("path"), F.length("entry").alias("length"),
                     (F.col("list") == "allow").cast("int").alias("allow"), "entry", "list")
    out = met.groupBy("id", "url", "fetched_on", "copies").agg(
        F.count("entry").alias("n_active"), F.max(F.when(F.col("entry").isNotNull(), place)).alias("top"))
    return out.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "id", "url", host(F.col("url")).alias("host"), "fetched_on", "n_active", F.col("top.entry").alias("entry"),
        F.coalesce(F.col("top.list") == "block", F.lit(False)).alias("blocked"))


def derived_captures(pages: DataFrame) -> DataFrame:
    """The captures of ``pages``, which has no dates: a page's id gives its day in four years."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("page_id") * 37 % 1461).cast("int"))
    return pages.select(F.col("page_id").alias("id"), "url", day.alias("fetched_on"))


def _draw(column: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(column.cast("binary")), at, 4), 16, 10).cast("long")


def derived_history(pages: DataFrame) -> DataFrame:
    """A list history over the hosts of ``pages``: every fourth site is blocked,
    freed and blocked again, every third host below a blocked site is allowed for
    a while, and every fifth first path segment of a host is blocked."""
    hosts = pages.select(host(F.col("url")).alias("host"), F.regexp_extract("url", SEGMENT, 1).alias("segment")).where("host <> ''").distinct()
    site = F.array_join(F.slice(F.split("host", r"\."), -3, 3), ".")
    sites = hosts.where(F.size(F.split("host", r"\.")) >= 3).select(site.alias("entry")).distinct()
    paths = hosts.where("segment <> ''").select(F.concat("host", F.lit("/"), "segment").alias("entry")).distinct()

    def events(entries: DataFrame, kind: str, modulus: int, rest: int, spans: int) -> DataFrame:
        e = F.col("entry")
        days = [_draw(e, 5) % 700, _draw(e, 9) % 700, _draw(e, 13) % 700][:spans]
        upto = [sum(days[1:k + 1], days[0]) for k in range(spans)]
        rows = F.array(*[F.struct(F.date_add(F.lit("2020-01-01").cast("date"), d.cast("int")).alias("day"),
                                  F.lit("remove" if k % 2 else "add").alias("action")) for k, d in enumerate(upto)])
        return entries.where(_draw(e, 1) % modulus == rest).select(
            F.lit(kind).alias("list"), "entry", F.explode(rows).alias("e")).select("list", "entry", "e.day", "e.action")

    return events(sites, "block", 4, 0, 3).unionByName(
        events(hosts.select(F.col("host").alias("entry")).distinct(), "allow", 3, 0, 2)).unionByName(
        events(paths, "block", 5, 0, 2))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return evaluate(derived_captures(pages), derived_history(pages)).select(
        F.col("id").alias("page_id"), "host", "fetched_on", "n_active", "entry", "blocked")


_HOST_SQL = "regexp_replace(lower(regexp_extract(url, '{}', 1)), '\\.$', '')".format(HOST)
_DRAW = "('0x' || substr(md5(entry), {}, 4))::BIGINT"
_DAYS = [f"({_DRAW.format(a)} % 700)" for a in (5, 9, 13)]


def _events_sql(entries: str, kind: str, modulus: int, spans: int) -> str:
    picked = f"SELECT entry FROM ({entries}) WHERE {_DRAW.format(1)} % {modulus} = 0"
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS list, entry, DATE '2020-01-01' + ({' + '.join(_DAYS[:k + 1])})::INT AS day, "
        f"'{'remove' if k % 2 else 'add'}' AS action FROM ({picked})" for k in range(spans))


OP8_SQL = f"""
WITH c AS (SELECT page_id, url, {_HOST_SQL} AS host, regexp_extract(url, '{SEGMENT}', 1) AS segment,
                  DATE '2020-01-01' + (page_id * 37 % 1461)::INT AS fetched_on FROM pages),
h AS (SELECT DISTINCT host, segment FROM c WHERE host <> ''),
sites AS (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') AS entry FROM h
          WHERE len(string_split(host, '.')) >= 3),
hosts AS (SELECT DISTINCT host AS entry FROM h),
paths AS (SELECT DISTINCT host || '/' || segment AS entry FROM h WHERE segment <> ''),
history AS ({_events_sql('SELECT * FROM sites', 'block', 4, 3)} UNION ALL {_events_sql('SELECT * FROM hosts', 'allow', 3, 2)}
            UNION ALL {_events_sql('SELECT * FROM paths', 'block', 5, 2)}),
last AS (SELECT list, entry, day, max(action) AS action FROM history GROUP BY ALL),
turns AS (SELECT *, lag(action) OVER (PARTITION BY list, entry ORDER BY day) AS before FROM last),
spans AS (SELECT list, entry, action, day AS valid_from,
                 coalesce(lead(day) OVER (PARTITION BY list, entry ORDER BY day), DATE '9999-12-31') AS valid_to
          FROM turns WHERE action <> coalesce(before, 'remove')),
parts AS (SELECT page_id, url, fetched_on, segment, string_split(host, '.') AS p, unnest(range(1, len(string_split(host, '.')) + 1)) AS i
          FROM c WHERE host <> ''),
suffixes AS (SELECT page_id, fetched_on, segment, array_to_string(list_slice(p, i, -1), '.') AS s FROM parts),
keys AS (SELECT page_id, fetched_on, s AS key FROM suffixes
         UNION ALL SELECT page_id, fetched_on, s || '/' || segment FROM suffixes WHERE segment <> ''),
met AS (SELECT k.page_id, s.list, s.entry FROM keys k JOIN spans s ON k.key = s.entry AND s.action = 'add'
        AND k.fetched_on >= s.valid_from AND k.fetched_on < s.valid_to),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY contains(entry, '/')::INT DESC, length(entry) DESC,
                  (list = 'allow')::INT DESC, entry DESC) AS r, count(*) OVER (PARTITION BY page_id) AS n FROM met)
SELECT c.page_id, c.host, c.fetched_on, coalesce(r.n, 0) AS n_active, r.entry, coalesce(r.list = 'block', false) AS blocked
FROM c LEFT JOIN ranked r ON r.page_id = c.page_id AND r.r = 1"""

QUERIES = {"op8_urls": op8_urls}
SQL = {"op8_urls": OP8_SQL}
