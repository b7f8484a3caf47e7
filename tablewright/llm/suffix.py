"""Suffix-array dedup: repeated passages from merged Burrows-Wheeler transforms.

A place of a text is repeated if its next ``LENGTH`` bytes also start anywhere
else; every byte that such a string covers is removed.

1. Every start is dealt to the smallest hash among the ``GRAM``-byte windows of
   its string.  Equal strings have equal smallest windows, so a string repeats
   only among the starts of its window's hash, and consecutive starts of one
   window (86 on average) are one row, a run.  Hashes with one run in all
   documents hold no repeat; counts with map-side combining find the others.
2. The bytes of the remaining runs, strings of at most ``2 * LENGTH``, are
   compared by content: equal ones are one string with its number of copies.
3. The strings of a partition of hashes are dealt to shards, each shard's
   transform is built and the transforms are merged by interleave refinement
   (``bwt.py``); its intervals of common prefix ``LENGTH`` are the repeats.
4. A hash with more than ``CROWD`` runs (a passage in very many documents) would
   put all of them into one task.  Its strings are told apart by grouped
   counts instead: a range of starts whose whole bytes occur elsewhere repeats,
   one whose common core doesn't occur elsewhere doesn't, and only what is
   neither is divided again (in four), down to single starts.  Strings that are
   equal in a range go on as one.  Counts combine map-side, so no group meets
   in a task, and nothing is left out.
5. Runs get the repeats of their strings, and documents their spans.

Defined results: null and empty texts have no bytes and no spans; texts shorter
than ``LENGTH`` have none; repeated rows are occurrences of their own, so a text
that is there twice is removed whole, whatever the ids; texts of any length
are read in blocks; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.llm.bwt import repeated_places
from tablewright.llm.common import discard, materialize, table

LENGTH = 200
GRAM = 32
#: Runs of one hash up to which they are merged in one task (at most 100 KB).
CROWD = 256
#: Bytes of a text hashed at a time, and of strings merged at a time.
BLOCK, BUCKET = 1 << 17, 1 << 18
SPLIT = 4
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_PLACE = np.uint64((1 << 24) - 1)


def runs(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the starts of ``text``: hash (signed), first start, number of
    starts, and the place of their window."""
    found = []
    last = len(text) - length  # the last start
    for at in range(0, last + 1, BLOCK):
        n = min(BLOCK, last + 1 - at)  # starts of this block
        size = n + length - gram  # windows
        words = np.ndarray((size + gram - 8,), "<u8", text, at, (1,)).copy()
        h = words[:size] * _FACTORS[0]
        for k in range(8, gram, 8):
            h ^= h >> np.uint64(31)
            h += words[k:k + size]
            h *= _FACTORS[k // 8 % 4]
        h ^= h >> np.uint64(29)
        h *= _FACTORS[1]
        least = (h & ~_PLACE) | np.arange(size, dtype=np.uint64)  # ties: the leftmost
        wide, width = 1, length - gram + 1
        while 2 * wide <= width:
            least = np.minimum(least[:len(least) - wide], least[wide:])
            wide *= 2
        least = np.minimum(least[:n], least[width - wide:width - wide + n])
        cut = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        place = (least[cut] & _PLACE).astype(np.int64)
        found.append((h[place].view(np.int64), cut + at, np.diff(np.append(cut, n)), place + at))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, text_hash, key, start, n, anchor) for every run of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, source = [], []
            for i, text in enumerate(batch.column(2)):
                if text.is_valid and len(raw := text.as_buffer()) >= length:
                    parts.append(runs(raw.to_pybytes(), length, gram))
                    source.append(np.full(len(parts[-1][0]), i))
                if parts and (sum(map(len, source)) > 100_000 or i == batch.num_rows - 1):
                    pick = pa.array(np.concatenate(source))
                    columns = [np.concatenate(x) for x in zip(*parts)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(columns[0]),
                         *(pa.array(c.astype(np.int64)) for c in columns[1:])],
                        names=["doc_id", "text_hash", "key", "start", "n", "anchor"])
                    parts, source = [], []

    schema = "doc_id long, text_hash long, key long, start long, n long, anchor long"
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary")).mapInArrow(run, schema)


def _strings_of(docs: DataFrame, length: int) -> DataFrame:
    """For each run of ``runs`` its string's digest, and the string with the first
    run of a digest in a batch only.  ``docs``: doc_id, text_hash, text (binary), runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh128_digest

        names = ["doc_id", "text_hash", "start", "n", "key", "crowd", "lead", "digest", "string"]
        for batch in batches:
            seen, rows, size = set(), [], 0
            for doc_id, text_hash, text, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                     batch.column(2), batch.column(3).to_pylist()):
                text = text.as_buffer().to_pybytes()
                for r in some:
                    string = text[r["start"]:r["start"] + r["n"] + length - 1]
                    digest = xxh128_digest(string, r["key"] & 0xFFFFFFFFFFFFFFFF)
                    rows.append((doc_id, text_hash, r["start"], r["n"], r["key"], r["crowd"], r["anchor"] - r["start"], digest,
                                 None if digest in seen else string))
                    seen.add(digest)
                    size += len(string)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    kinds = [*[pa.int64()] * 5, pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
    return docs.mapInArrow(run, "doc_id long, text_hash long, start long, n long, key long, crowd boolean, lead long, "
                                "digest binary, string binary")


def _merged(strings: DataFrame, length: int) -> DataFrame:
    """(digest, ranges) of the strings that share a place with another, as ranges
    (first, last) of repeated starts: hashes are partitioned, and each task merges
    its strings bucket by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merge(some):
            places = repeated_places([s for _, _, s in some], length)
            found = []
            for (_, digest, _), p in zip(some, places):
                if len(p):
                    gap = np.flatnonzero(np.diff(p) > 1)
                    found.append((digest, p[np.append(0, gap + 1)].tolist(), p[np.append(gap, len(p) - 1)].tolist()))
            kinds = [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)],
                                              names=["digest", "first", "last"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if size > BUCKET and row[0] != held[-1][0]:  # rows come sorted by hash
                    yield merge(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield merge(held)

    return (strings.select("key", "digest", "string").repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "digest binary, first array<long>, last array<long>")
            .select("digest", F.arrays_zip("first", "last").alias("ranges")))


def _halved(strings: DataFrame, length: int, gram: int) -> DataFrame:
    """(digest, ranges) like ``_merged`` by grouped counts of ever shorter ranges
    of starts.  A range [r, r + size) is of distances from a start to its window."""
    most = length - gram + 1
    size = 1
    while size * SPLIT < most:
        size *= SPLIT
    ends = (F.col("lead") - F.col("n") + 1, F.col("lead"))  # distances that a string has
    ranges = strings.withColumn("r", F.explode(F.filter(F.array(*[F.lit(r).cast("long") for r in range(0, most, size)]),
                                                        lambda r: (r <= ends[1]) & (r + size > ends[0]))))
    found = []
    while True:
        low, high = F.col("r"), F.least(F.col("r") + size, F.lit(most))  # distances
        has_low, has_high = F.greatest(low, ends[0]), F.least(high, ends[1] + 1)
        cut = lambda a, b: F.expr("substring(string, cast(_a + 1 as int), cast(_b - _a as int))")  # noqa: E731, ARG005
        rows = ranges.withColumns({"_a": F.col("lead") - low, "_b": F.col("lead") - high + 1 + length})
        rows = rows.withColumn("core", F.unhex(F.md5(cut("_a", "_b"))))
        rows = rows.withColumns({"_a": F.col("lead") - high + 1, "_b": F.col("lead") - low + length})
        whole = (has_low == low) & (has_high == high)
        rows = rows.withColumn("content", F.when(whole, F.unhex(F.md5(cut("_a", "_b"))))).drop("_a", "_b")
        rows = materialize(rows, "ranges")
        # Strings with the same bytes in a range are one content; one that holds part of the range only is its own.
        place = ["key", "r", "core"]
        content = F.coalesce("content", "digest").alias("bytes")
        contents = rows.groupBy(*place, content).agg(
            F.sum("copies").alias("total"), F.min("digest").alias("first"), (F.count("content") > 0).alias("whole"))
        # What isn't known yet: a string without copies that nothing equals here, beside others with the same core.
        unknown = (F.col("total") == 1)
        groups = contents.groupBy(*place).agg(F.count("*").alias("contents"), F.count_if(unknown).alias("unknown"))
        judged = rows.withColumn("bytes", content).join(contents.join(groups, place), [*place, "bytes"])
        twice = F.col("whole") & (F.col("total") > 1)
        found.append(materialize(judged.where(twice & (F.col("copies") == 1)).select(
            "digest", F.struct((F.col("lead") - has_high + 1).alias("first"), (F.col("lead") - has_low).alias("last")).alias("range")),
            "found"))
        # Of what is known, one string of each content stays for the unknown to be compared with.
        rest = judged.where((F.col("contents") > 1) & (F.col("unknown") > 0) & (unknown | (F.col("digest") == F.col("first"))))
        rest = rest.withColumn("copies", F.col("total"))
        if size == 1:
            discard(rows)
            break
        rest = rest.select(*strings.columns, "r")
        last, size = size, size // SPLIT
        parts = F.transform(F.sequence(F.lit(0), F.lit(last // size - 1)), lambda i: F.col("r") + i * size)  # noqa: B023
        rest = materialize(rest.withColumn("r", F.explode(F.filter(
            parts, lambda r: (r <= ends[1]) & (r + size > ends[0]) & (r < most)))), "rest")  # noqa: B023
        discard(rows)
        ranges = rest
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy("digest").agg(F.collect_list("range").alias("ranges"))


def _spans(ranges: Column, length: int) -> Column:
    """Sorted disjoint spans (first, behind) covered by the strings at sorted ranges of starts."""
    some = lambda x: x.isNotNull()
    first = F.filter(F.transform(ranges, lambda r, i: F.when(
        (i == 0) | (r["first"] - F.get(ranges, i - 1)["last"] > length), r["first"])), some)
    last = F.filter(F.transform(ranges, lambda r, i: F.when(
        (i == F.size(ranges) - 1) | (F.get(ranges, i + 1)["first"] - r["last"] > length), r["last"])), some)
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), (b + length).alias("behind")))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, spans) for every text of ``docs`` (doc_id, text) that has repeats."""
    every = materialize(_runs_of(docs.select("doc_id", "text"), length, gram), "runs")
    # Written before the join: its two sides are then dealt for the join alone, which can split a hot hash.
    shared = materialize(every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(
        "key", (F.col("c") > CROWD).alias("crowd")), "shared")
    hits = materialize(every.join(shared, "key"), "hits")
    discard(every, shared)
    wanted = hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "n", "anchor", "key", "crowd")).alias("runs"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.col("text").cast("binary").alias("raw"))
    met = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")))
    strings = materialize(_strings_of(met.select("_id", "_hash", "raw", "runs"), length), "strings")
    discard(hits)
    copies = strings.groupBy("digest").agg(F.count("*").alias("copies"))
    one = (strings.where("string is not null").groupBy("digest")
           .agg(F.min(F.struct("key", "crowd", "lead", "n", "string")).alias("s")))
    one = materialize(one.join(copies, "digest").select("digest", "copies", "s.*"), "distinct")
    # A hash whose strings are all alike needs no comparison, and a string with copies repeats throughout.
    several = one.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    several = one.join(several, "key")
    partly = _merged(several.where("not crowd"), length).unionByName(_halved(several.where("crowd"), length, gram))
    span = F.struct(F.lit(0).cast("long").alias("first"), (F.col("n") - 1).alias("last"))
    throughout = one.where("copies > 1").select("digest", F.array(span).alias("ranges"))
    partly = partly.join(throughout.select("digest"), "digest", "left_anti")
    ranges = materialize(partly.unionByName(throughout), "ranges")
    moved = F.transform("ranges", lambda r: F.struct((r["first"] + F.col("start")).alias("first"),
                                                     (r["last"] + F.col("start")).alias("last")))
    per = (strings.select("doc_id", "text_hash", "start", "digest").distinct().join(ranges, "digest")
           .select("doc_id", "text_hash", moved.alias("ranges"))
           .groupBy("doc_id", "text_hash").agg(F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges")))
    found = materialize(per.select("doc_id", "text_hash", F.transform(F.array("ranges"), lambda r: _spans(r, length))[0]
                                   .alias("spans")), "spans")
    discard(ranges)
    discard(strings, one)
    return found


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with ``spans`` (empty where there are none) and ``kept``, the
    pieces of its text (binary) that no span covers."""
    found = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans"))
    out = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    spans_ = F.coalesce("spans", F.array())
    behind = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans_, lambda s: s["behind"]))
    first = F.concat(F.transform(spans_, lambda s: s["first"]), F.array(F.octet_length(raw).cast("long")))
    pieces = F.zip_with(behind, first, lambda a, b: raw.substr((a + 1).cast("int"), (b - a).cast("int")))
    return out.select(*docs.columns, spans_.alias("spans"), pieces.alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the repeated passages of its texts.  A character that a
    span covers in part goes with it, so the text stays valid; ``n_chars``
    follows.  Null texts stay null."""
    rows = docs.select("doc_id", F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    done = remove_spans(rows, repeated_spans(rows.select("doc_id", "text")))
    whole = F.array_join(F.transform("kept", _whole_characters), "")
    new = F.when(F.size("spans") == 0, F.col("text")).otherwise(whole)
    changed = {text: new} | ({"n_chars": F.length(new).cast("long")} if "n_chars" in docs.columns else {})
    return done.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def _whole_characters(piece: Column) -> Column:
    """A piece as text, without the bytes of characters cut at its ends: invalid
    bytes become U+FFFD, at most three on either side, which are told from real
    ones by being replaced only where the piece isn't valid."""
    bad = F.regexp_replace(F.regexp_replace(F.make_valid_utf8(piece.cast("string")), "^�{1,3}", ""), "�{1,3}$", "")
    return F.when(F.is_valid_utf8(piece.cast("string")), piece.cast("string")).otherwise(bad)


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_spans(docs, repeated_spans(docs))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["behind"] - s["first"])
    kept = F.aggregate("kept", F.lit(b""), lambda a, b: F.concat(a, b))
    return done.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


QUERIES = {"op3_suffix": op3_suffix}
#: For small tables: every 200-byte string is a row.
OP3_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS raw FROM documents),
starts AS (SELECT r, unnest(range(0, octet_length(raw) - 199)) AS i, raw FROM d WHERE octet_length(raw) >= 200),
strings AS (SELECT r, i, array_slice(raw, i + 1, i + 200) AS s FROM starts),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM strings) WHERE n > 1),
turns AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 200, true)::INT AS new FROM twice),
runs AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM turns),
spans AS (SELECT r, min(i) AS first, max(i) + 200 AS behind FROM runs GROUP BY r, run),
lists AS (SELECT r, list(first ORDER BY first) AS f, list(behind ORDER BY first) AS b, sum(behind - first) AS gone FROM spans GROUP BY r),
cut AS (SELECT doc_id, raw, octet_length(raw) AS n, list_concat(coalesce(f, []), [octet_length(raw)]) AS f,
               list_concat([0], coalesce(b, [])) AS b, coalesce(gone, 0) AS gone FROM d LEFT JOIN lists USING (r))
SELECT doc_id, n::BIGINT AS n_bytes, gone::BIGINT AS n_removed, (len(f) - 1)::BIGINT AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(f) + 1), lambda k: hex(array_slice(raw, b[k] + 1, f[k]))), ''))) AS kept_sha256
FROM cut"""

SQL = {"op3_suffix": OP3_SQL}
