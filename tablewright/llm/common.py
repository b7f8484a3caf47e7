"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright import session

#: The characters between words, as a class of Java's patterns (fixed value).
SPACE = r"[\x20\x09-\x0D]"
#: The same characters as a plain list (fixed value).
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.  The
    shuffle files of the job go as soon as it has ended: what was written
    replaces them."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return session.materialize(df, name)
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = hadoop(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def word_list(text: Column) -> Column:
    """The words of a text column in order; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text column (long), 0 for null."""
    bare = F.btrim(text, F.lit(SPACES))
    n = F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE + "+")))
    return F.coalesce(n, F.lit(0)).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``(a, b)`` between long node ids.

    Returns ``(node, root)`` with the smallest id of the component for every
    node that has a link.  Alternating large-star and small-star steps: every
    step is a grouped minimum joined back to the edges, nothing is gathered per
    node, and each round is written to the shared checkpoint folder so that a
    lost executor costs a re-read.  Ends when a round changes nothing."""
    edge = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), "links")
    mark = None
    while True:
        now = edge.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edge.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edge.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edge = edge, materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(last)
