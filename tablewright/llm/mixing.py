"""Mixing sources to target weights by capped water-filling.

Every source has a weight; the mix has as many words as the input.  A source
whose share is above ``max_epochs`` times its own words is clamped there and
the excess goes to the others in proportion to their weights, again and again
until no source is above its cap.  A document is then repeated as often as the
whole part of target / source size says; the fractional part is made of
further repetitions of documents in a seeded order, the last one in part, so
that the words taken meet the rounded target exactly (``mixed_documents`` takes
it whole or not at all: every text of the mix is a whole text of the input).

The seeded order is found without sorting a source: the bucket of hash values
in which the fractional part runs out is narrowed eight bits at a time by
grouped sums, and only the documents of the last bucket (one in 2^24) are
ordered.  A source that holds most rows is therefore summed map-side like any
other.

Defined results: a null text has size 0; a null source is a source, ordered
last; a source without words has target 0; repeated rows are documents of
their own; an empty table gives an empty result.  Ties of the seeded hash are
ordered by document id, then size.  Only the id, source and text columns are
read, so extra columns neither clash nor travel through the sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import materialize, table, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240607
BITS, LEVELS = 8, 3


def order_key(doc_id, seed: int):
    """The seeded place of a document: 24 hash bits."""
    return F.xxhash64(F.lit(seed), doc_id).bitwiseAND((1 << BITS * LEVELS) - 1)


def source_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``.

    One row per source: the only rows that meet in one task are those of the
    ranking by code point.  The water level is a single number, raised by one
    small aggregate per round."""
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    ranked = materialize(ranked.select("source", "source_size", pick.alias("weight")), "sources")
    cap = F.col("source_size") * max_epochs
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        above = F.col("weight") * level > cap
        full, held, weight = ranked.agg(F.count(F.when(above, 1)), F.sum(F.when(above, cap)),
                                        F.sum(F.when(~above, F.col("weight")))).first()
        if full == clamped or not weight:
            break
        clamped, level = full, (total - (held or 0)) / weight
    return ranked.withColumn("target", F.when(F.col("weight") * level > cap, cap.cast("double"))
                             .otherwise(F.col("weight") * level))


def _thresholds(base: DataFrame, plan: DataFrame) -> DataFrame:
    """For each source the hash value at which its extra words run out
    (``edge``) and the words still to take there (``left``)."""
    plan = plan.withColumn("edge", F.lit(0).cast("long")).withColumn("left", F.col("extra"))
    same = base["source"].eqNullSafe(F.col("p.source"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        bucket = F.shiftright(F.col("place"), shift).bitwiseAND((1 << BITS) - 1)
        inside = F.shiftright(F.col("place"), shift + BITS) == F.col("edge")
        sums = (base.join(plan.select("source", "edge", "left").alias("p"), same).where(inside)
                .groupBy("p.source", "p.edge", "p.left", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        over = (sums.withColumn("upto", upto).where("upto > left")
                .groupBy(F.col("source").alias("s")).agg(F.min_by(F.struct("bucket", (F.col("left") - F.col("upto")
                                                                                     + F.col("words")).alias("rest")),
                                                                  "bucket").alias("b")))
        # No bucket holds a word too many: everything is taken, the edge lies behind the last value.
        plan = (plan.join(over, plan["source"].eqNullSafe(over["s"]) & over["b"].isNotNull(), "left")
                .withColumn("edge", F.when(F.col("b").isNull(), F.lit((1 << BITS * (level + 1)) - 1) + 1)
                            .otherwise(F.col("edge") * (1 << BITS) + F.col("b.bucket")))
                .withColumn("left", F.coalesce(F.col("b.rest"), F.lit(0)).cast("long")).drop("s", "b"))
        plan = materialize(plan, "edges")
    return plan


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, parts: bool = True) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, size and any others) with
    ``source_size``, ``target`` of its source and ``taken`` words.  Without ``parts`` the document at
    which a source's fractional part runs out is taken whole or not, whichever is nearer to the target."""
    base = materialize(docs.select("source", F.col("size").cast("long").alias("size"),
                                   order_key(F.col("doc_id"), seed).alias("place")), "sizes")
    targets = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    whole = F.least(F.floor(share), F.lit(max_epochs)).cast("long")
    plan = targets.withColumn("whole", whole).withColumn(
        "extra", F.when(whole >= max_epochs, 0).otherwise(
            F.greatest(F.round("target").cast("long") - whole * F.col("source_size"), F.lit(0))).cast("long"))
    plan = _thresholds(base, materialize(plan, "plan")).select(
        F.col("source").alias("_source"), F.col("source_size"), "target", "whole", "edge", "left")
    kept = [c for c in docs.columns if c not in ("source_size", "target", "taken", "_source", "whole", "edge", "left")]
    rows = docs.select(*kept).join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_place", order_key(F.col("doc_id"), seed))
    before = F.sum("size").over(Window.partitionBy("_source").orderBy("doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, -1))
    still = F.col("left") - F.coalesce(before, F.lit(0))
    more = F.greatest(F.lit(0), F.least(F.col("size"), still)) if parts else F.when(2 * still >= F.col("size"), F.col("size")).otherwise(0)
    at_edge = rows.where("_place = edge and left > 0").withColumn("_more", more.cast("long"))
    others = rows.where("not (_place = edge and left > 0)").withColumn(
        "_more", F.when(F.col("_place") < F.col("edge"), F.col("size")).otherwise(0).cast("long"))
    both = others.unionByName(at_edge)
    return both.select(*kept, "source_size", "target", (F.col("whole") * F.col("size") + F.col("_more")).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, always whole, so a source meets its target to
    within half a document.  Columns of ``docs``."""
    rows = docs.select("doc_id", "source", word_count(F.col(text)).alias("size"), F.struct(*docs.columns).alias("row"))
    mixed = mix(rows, parts=False, **options).where("taken > 0")
    times = mixed.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), (F.col("taken") / F.col("size")).cast("long"))))
    return times.select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(materialize(docs, "sized")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op6_mixing": op6_mixing}
SQL: dict[str, str] = {}
