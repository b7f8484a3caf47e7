"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint per document; fingerprints within ``distance`` differing
bits are linked, and linked documents form groups.

Candidates come from the ring of segments: if two fingerprints differ in at
most ``t`` bits, some chain of consecutive segments, begun at the right
place of the ring, keeps its cumulative differences within ``l * t / m`` for
every length ``l``.  A first segment must then be equal, and with it at least
``m - t`` of the ``m`` segments, so equal values of every choice of that many
segments are the join keys; the chain condition prunes the pairs that meet
there before the full Hamming distance is taken.

Only distinct fingerprints are compared, so a group of exact copies is one
row.  A key shared by more than ``MOST_PAIRED`` fingerprints isn't expanded
into pairs: two fingerprints are within two bits of each other exactly if
some value lies within one bit of both, so those fingerprints are grouped by
the 65 values around them and linked to the smallest of each group.  That
costs 65 rows a fingerprint, whatever the size of the group, and loses no link.

Defined results: null and empty texts have no words and fingerprint zero, and
are linked like any other; a text shorter than the shingle is one shingle;
repeated rows share a fingerprint; a null id never becomes a component id
unless its whole component has none; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import components, materialize, table

SHINGLE = 3
DISTANCE = 2
SEGMENTS = 4
#: A key's fingerprints are paired up to this number: beyond it, n / 2 pairs
#: for each are more than the values in the ball around it.
MOST_PAIRED = 130


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []  # bytes: lower() is A-Z, split() is \x20\x09-\x0D
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, grams), repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        some = hashes[at:at + 4096]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint16)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(text)


def _masks(m: int) -> list[int]:
    edges = [64 * k // m for k in range(m + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def chain_holds(a: Column, b: Column, m: int, t: int) -> Column:
    """Some chain of consecutive segments of the ring keeps every cumulative
    difference within its proportional budget."""
    parts = [F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(x))) for x in _masks(m)]
    found = F.lit(False)
    for start in range(m):
        total, held = F.lit(0), F.lit(True)
        for length in range(1, m):
            total = total + parts[(start + length - 1) % m]
            held = held & (total * m <= length * t)
        found = found | held
    return found


def links(distinct: DataFrame, distance: int = DISTANCE, m: int = SEGMENTS) -> DataFrame:
    """Links ``(a, b)`` that connect the same fingerprints (column ``fp``,
    distinct) as all pairs within ``distance`` bits do."""
    masks = _masks(m)
    choices = list(combinations(range(m), m - distance))
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(sum(masks[s] for s in c))))
                              .alias("v")) for k, c in enumerate(choices)])
    keyed = materialize(distinct.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v"), "keys")
    shared = keyed.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    keyed = materialize(keyed.join(shared, ["k", "v"]), "shared")
    few = keyed.where(F.col("n") <= MOST_PAIRED).select("k", "v", "fp")
    a, b = F.col("fp"), F.col("other")
    near = (few.join(few.withColumnRenamed("fp", "other"), ["k", "v"])
            .where((a < b) & chain_holds(a, b, m, distance) & (F.bit_count(a.bitwiseXOR(b)) <= distance))
            .select(a.alias("a"), b.alias("b")).distinct())
    if distance != 2:  # the ball argument is that of two bits
        raise ValueError("distance must be 2")
    ball = F.concat(F.array(F.col("fp")), F.transform(F.array(*[F.lit(_signed(1 << k)) for k in range(64)]),
                                                      lambda bit: F.col("fp").bitwiseXOR(bit)))
    many = keyed.where(F.col("n") > MOST_PAIRED).select("fp").distinct().select("fp", F.explode(ball).alias("v"))
    low = many.groupBy("v").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("v", "a")
    star = many.join(low, "v").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return near.unionByName(star)


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Every row's ``doc_id``, ``fp`` (long), hash of its text, ``component_id``,
    the smallest id of its group, and ``root``, its group's smallest fingerprint."""
    marked = materialize(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                                     fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return marked.join(classes, "fp")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each group: that of the smallest
    id (among rows with the same id, the one with the smallest text hash; in a
    group without ids, any row without id by the same rule)."""
    found = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))).alias("k"))
    kept = kept.select("k.*")
    # Rows travel as one column, so columns of any name stay as they are.
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*docs.columns).alias("row"))
    alone = Window.partitionBy("_id", "_hash").orderBy(F.lit(0))
    return (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
            .withColumn("_n", F.row_number().over(alone)).where("_n = 1").select("row.*"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
SQL: dict[str, str] = {}
