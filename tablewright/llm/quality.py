"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Statistics of every whole text are transformed into a vector; the vectors of a
language and source form a cell, and each cell gets a location and a scatter
from the half of its documents whose covariance determinant is smallest, found
by concentration steps: estimate from the closest documents, measure all by
Mahalanobis distance, keep the closest half, again until the determinant no
longer falls.  The steps begin at three starts, and the least determinant is
kept.  Documents far from their cell's estimate are rejected, besides those that
fail base rules: beyond ``TAIL`` times the distance that 99 % of the cell's clean
documents keep, and not below the chi-square distribution's 99.9 %.  With half a
cell held, outliers up to nearly a half, copies of one text also, can't pull the
estimate to themselves.

Everything is a DataFrame expression: word windows are hashed, sorted and
compared within the row, cells are summed with map-side combining, medians and
held shares come from counts of rounded values, and the triangular factor of
the covariance is written out as columns.  Vectors are whole numbers (units of
1/1000) and sums exact, so reruns agree and no order of rows matters.

A cell of fewer than ``LEAST`` documents is judged with the other small cells of
its language, those with the other small ones of all languages; a pool that
is still smaller has no estimate, and only the base rules decide there.
Variances have a floor, ``FLOOR``: most texts have no symbols or repeats at
all, and without it the first one would be infinitely far away.

Defined results: null and empty texts have no words and fail the base rules;
repeated rows are judged each, alike; null languages and sources are values of
their own; an empty table gives an empty result.  Ids may be of any type; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import SPACES, materialize, table, word_list

WINDOW = 5
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
#: Least rows of a cell; the steps end where the determinant's logarithm falls by less than ``FALL``.
LEAST, FALL = 60, 1e-4
#: Words with which rates of short texts are drawn to the usual ones.
PRIOR = 30
#: Floor of a standard deviation, in units of 1/1000.
FLOOR = 100.0
#: Texts are spread wider than normal: so many times the squared distance of 99 % of the clean documents is still near.
TAIL, CLEAN = 5.0, 0.99
DIMENSIONS = ("v0", "v1", "v2", "v3")
#: Median and 99.9 % of the chi-square distribution with four degrees of freedom (fixed values).
CHI_MEDIAN, CHI_FAR = 3.3567, 18.467


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more: windows sorted by hash show
    their equals next to them; their positions in order give the words covered."""
    def spread(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def equals(s: Column) -> Column:
        marks = F.transform(s, lambda p, j: F.when((F.get(s, j - 1)["h"] == p["h"]) | (F.get(s, j + 1)["h"] == p["h"]), p["i"]))
        return _let(F.array_sort(F.array_compact(marks)), spread)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(ordered, equals))


def _words(words: Column) -> Column:
    def windows(w: Column) -> Column:
        every = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW))))
        return F.slice(every, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))

    return _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                          _let(windows(w), _covered).cast("long").alias("n_repeat_words")))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five statistics of its texts (long)."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return docs.select(
        *docs.columns, _words(word_list(t)).alias("_w"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select(*docs.columns, "_w.n_words", "word_chars", "n_symbols", "n_dup_lines", "_w.n_repeat_words")


def _vector() -> list[Column]:
    n = F.col("n_words") + PRIOR
    values = [4 * F.log((F.col("word_chars") + 5 * PRIOR) / n), F.log1p(20 * F.col("n_symbols") / n),
              F.log1p(20 * F.col("n_dup_lines") / n), F.log1p(5 * F.col("n_repeat_words") / n)]
    return [F.round(1000 * v).cast("long").alias(d) for v, d in zip(values, DIMENSIONS)]


def _cells(rows: DataFrame) -> DataFrame:
    """The cell (long) of each ``lang`` and ``source``, small ones pooled."""
    n = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang")
    small = F.col("n") < LEAST
    level = F.when(~small, 0).when(F.sum(F.when(small, F.col("n"))).over(by_lang) >= LEAST, 1).otherwise(2)
    at = n.withColumn("level", level)
    return at.select("lang", "source", F.xxhash64(
        "level", F.when(F.col("level") < 2, F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))),
        F.when(F.col("level") < 1, F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))).alias("cell"))


#: Rows that the estimate rests on: (n + p + 1) / 2.
HALF = f"floor((_all + {len(DIMENSIONS)} + 1) / 2)"


def _ranked(rows: DataFrame, keys: list[str], value: Column, share: float | str, name: str) -> DataFrame:
    """For each key the least whole ``value`` that at least ``share`` of its rows (an
    expression: so many of them) don't exceed: from counts by value, not by sorting rows."""
    least = F.expr(share) if isinstance(share, str) else share * F.col("_all")
    counts = rows.groupBy(*keys, value.alias("_v")).agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*keys)
    return (counts.withColumn("_upto", F.sum("_n").over(by.orderBy("_v"))).withColumn("_all", F.sum("_n").over(by))
            .where(F.col("_upto") >= least).groupBy(*keys).agg(F.min("_v").alias(name)))


def _estimate(held: DataFrame) -> DataFrame:
    """For each cell and start the means ``m``, the lower triangular factor ``l`` of
    the covariance and the logarithm of its determinant, ``det``."""
    p = range(len(DIMENSIONS))
    exact = lambda c: F.sum(c.cast("decimal(38,0)")).cast("double")
    v = [F.col(d) for d in DIMENSIONS]
    sums = held.groupBy("cell", "start").agg(F.count("*").alias("n"), *(exact(v[i]).alias(f"s{i}") for i in p),
                                    *(exact(v[i] * v[j]).alias(f"s{i}{j}") for i in p for j in range(i + 1)))
    out = sums.select("cell", "start", *((F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in p),
                      *((F.col(f"s{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n")
                         + (FLOOR ** 2 if i == j else 0)).alias(f"c{i}{j}") for i in p for j in range(i + 1)))
    for j in p:
        for i in range(j, len(DIMENSIONS)):
            rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            # The floor bounds the pivots from below; greatest() only guards against rounding.
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.drop(*(f"c{i}{j}" for i in p for j in range(i + 1))).withColumn(
        "det", sum((2 * F.log(F.col(f"l{i}{i}")) for i in p), F.lit(0.0)))


def _distance(rows: DataFrame, model: DataFrame, how: str = "left", *more: str) -> DataFrame:
    """``rows`` with ``d``, the squared Mahalanobis distance, and ``more`` columns of the model."""
    out = rows.join(model, "cell", how)
    for i in range(len(DIMENSIONS)):
        back = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", (F.col(f"v{i}") - F.col(f"m{i}") - back) / F.col(f"l{i}{i}"))
    d = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(DIMENSIONS))), F.lit(0.0))
    return out.withColumn("d", d).select(*rows.columns, *more, "d")


def _step() -> Column:
    """Squared distances are compared by their logarithm in steps of 1/16 octave."""
    return F.floor(16 * F.log2(F.col("d") + 1e-6)).cast("int")


def _starts(fit: DataFrame) -> DataFrame:
    """For each cell three first estimates: the medians with the median deviations,
    the medians with equal deviations, and the means and covariance of all rows."""
    p = range(len(DIMENSIONS))
    long = fit.select("cell", F.posexplode(F.array(*DIMENSIONS)).alias("k", "v"))
    mid = materialize(_ranked(long, ["cell", "k"], F.col("v"), 0.5, "mid"), "medians")
    dev = _ranked(long.join(mid, ["cell", "k"]), ["cell", "k"], F.abs(F.col("v") - F.col("mid")), 0.5, "dev")
    at = mid.join(dev, ["cell", "k"]).groupBy("cell").agg(
        *(F.max(F.when(F.col("k") == i, F.col("mid"))).cast("double").alias(f"m{i}") for i in p),
        *(F.max(F.when(F.col("k") == i, F.sqrt(F.pow(1.4826 * F.col("dev"), F.lit(2)) + FLOOR ** 2))).alias(f"l{i}{i}") for i in p))
    at = at.select("*", *(F.lit(0.0).alias(f"l{i}{j}") for i in p for j in range(i)))
    found = at.withColumn("start", F.lit(0)).unionByName(
        at.withColumns({f"l{i}{i}": F.lit(FLOOR) for i in p}).withColumn("start", F.lit(1))).unionByName(
        _estimate(fit.withColumn("start", F.lit(2))).drop("det"))
    return materialize(found.withColumn("det", F.lit(float("inf"))), "starts")


def _concentrated(fit: DataFrame) -> DataFrame:
    """For each cell the estimate of least determinant that the steps reach from any start."""
    model, found = _starts(fit), None
    while True:
        near = _distance(fit, model, "inner", "start").withColumn("step", _step())
        edge = materialize(_ranked(near, ["cell", "start"], F.col("step"), HALF, "edge"), "edge")
        after = _estimate(near.join(edge, ["cell", "start"]).where("step <= edge"))
        after = materialize(after.join(model.select("cell", "start", F.col("det").alias("before")), ["cell", "start"]), "estimate")
        found = after if found is None else found.unionByName(after)
        model = after.where(F.col("det") < F.col("before") - FALL).drop("before")
        if model.isEmpty():
            break
    what = [c for c in found.columns if c not in ("cell", "det", "start", "before")]
    return materialize(found.groupBy("cell").agg(F.min(F.struct("det", "start", *what)).alias("x")).select(
        "cell", *(f"x.{c}" for c in what)), "estimate")


def judge(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, ``lang``, ``source``, hash of its text, the five
    statistics, ``base_failed``, ``distance`` (null where its cell has no
    estimate or the base rules failed) and ``kept``."""
    rows = statistics(docs.select("doc_id", "lang", "source", "text"))
    n, again = F.col("n_words"), F.col("n_repeat_words")
    rows = materialize(rows.select(
        "doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"), "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words", ((n < LEAST_WORDS) | (100 * again > MOST_REPEATED_PERCENT * n)).alias("base_failed"),
        *_vector()), "statistics")
    # Tables of cells are written: a join then knows their size and leaves the rows, of which one cell may have most, where they are.
    cells = materialize(_cells(rows.where("not base_failed")).select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "cell"),
                        "cells")
    fit = materialize(rows.where("not base_failed").join(cells, F.col("lang").eqNullSafe(F.col("_l"))
                                                         & F.col("source").eqNullSafe(F.col("_s")))
                      .select("cell", *DIMENSIONS), "vectors")
    model = _concentrated(fit)
    far = _distance(fit, model).withColumn("step", _step())
    scale = materialize(_ranked(far, ["cell"], F.col("step"), 0.5, "mid").join(
        fit.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST), "cell").select(
        "cell", F.greatest(F.pow(F.lit(2.0), (F.col("mid") + 0.5) / 16) / CHI_MEDIAN, F.lit(1.0)).alias("scale")), "scale")
    clean = _ranked(far.join(scale, "cell").where(F.col("d") <= CHI_FAR * F.col("scale")), ["cell"], F.col("step"), CLEAN, "most")
    scale = materialize(scale.join(clean, "cell", "left").select("cell", "scale", F.greatest(
        F.lit(CHI_FAR), TAIL * F.pow(F.lit(2.0), (F.col("most") + 1) / 16) / F.col("scale")).alias("cutoff")), "cutoff")
    judged = rows.join(cells, ~F.col("base_failed") & F.col("lang").eqNullSafe(F.col("_l"))
                       & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")
    model = materialize(model.join(scale.select("cell"), "cell"), "estimate")
    judged = _distance(judged, model).join(
        scale, "cell", "left").withColumn("distance", F.col("d") / F.col("scale"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.col("cutoff"), F.lit(True))).select(
        "doc_id", "lang", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "distance", "kept")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass; a verdict follows from text, language and source alone.  Rows travel as
    one column, so columns of any name stay as they are."""
    good = judge(docs).where("kept").select(F.col("text_hash").alias("_h"), F.col("lang").alias("_l"), F.col("source").alias("_s"))
    rows = docs.select(F.xxhash64("text").alias("text_hash"), "lang", "source", F.struct(*docs.columns).alias("row"))
    return rows.join(good, (F.col("text_hash") == F.col("_h")) & F.col("lang").eqNullSafe(F.col("_l"))
                     & F.col("source").eqNullSafe(F.col("_s")), "left_semi").select("row.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
