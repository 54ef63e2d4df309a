"""Quality rules with robust multivariate outliers (op 3; DataFrame functions only).

Counts of every whole text give a vector of transformed statistics.  For each
language and source a minimum-covariance-determinant estimate (MCD) of centre and
covariance is fitted over all its documents, and vectors whose squared
Mahalanobis distance is above a chi-square quantile are rejected.

MCD by concentration steps: from medians and quartiles, the ``SHARE`` of a group's
documents nearest to the current estimate gives the next mean and covariance,
``STEPS`` times; each step cannot raise the determinant.  The order statistic that
cuts the nearest share is read off a histogram of distances (fine logarithmic
buckets), so a step is two sums per group with map-side combining, never a sort
of a group.  Sums are of integers (values times ``SCALE``), so the result does not
depend on the order of rows.

* Groups of fewer than ``LEAST`` documents are pooled by language, and small pools
  into one.
* ``FLOORS`` are added to the variances: statistics that are nearly always zero
  must not turn a single repeated line into an outlier.
* Counts are smoothed by ``PRIOR`` typical words, so short clean texts stay near
  the centre.

Defined results: null and empty texts have zero words and fail the base rule;
null languages and sources are groups of their own; repeated rows get the same
verdict; other columns are carried by the filter stage untouched; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialize, table
from .words import BLANKS, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SHARE = 0.75
STEPS = 3
LEAST = 100
SCALE = 1_000_000
PRIOR = 50
TYPICAL_LENGTH = 5
DIMS = ("x0", "x1", "x2", "x3")
#: Added to the standard deviations: of log word length, and of the square roots of three shares.
FLOORS = (0.06, 0.08, 0.06, 0.10)
#: Probability that a clean document of a normal group is kept.
KEEP = 0.9999


def chi2_cdf(x: float, even: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(even // 2))


def chi2_quantile(p: float, even: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, even) < p else (low, mid)
    return high


def repeated_words(w: Column) -> Column:
    """Words covered by a ``WINDOW``-word window that the text holds twice or more."""

    def covered(h: Column, w: Column) -> Column:
        at = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            def same(e: Column, o: Column) -> Column:
                return (o["h"] == e["h"]) & (F.slice(w, o["i"] + 1, WINDOW) == F.slice(w, e["i"] + 1, WINDOW))

            flag = F.transform(s, lambda e, j: F.when(F.coalesce(same(e, F.get(s, j - 1)), F.lit(False)) | F.coalesce(same(e, F.get(s, j + 1)), F.lit(False)), e["i"]))
            return F.array_sort(F.filter(flag, lambda x: x.isNotNull()))

        def total(p: Column) -> Column:
            return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)

        return let(let(at, marked), total)

    hashes = F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h, w))).cast("long")


def text_counts(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
        return let(
            words(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        )

    return let(F.coalesce(text.cast("string"), F.lit("")), counts)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics(counted: DataFrame) -> DataFrame:
    """The transformed vector of each row, as integers of 1 / SCALE."""
    n, chars = F.col("n_words") + PRIOR, F.col("word_chars") + PRIOR * TYPICAL_LENGTH
    xs = (F.log(chars / n), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n))
    return counted.withColumns({d: F.rint(x * SCALE).cast("long") for d, x in zip(DIMS, xs, strict=True)})


def _pools(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pool``: language and source, or a larger pool for the few."""
    small = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    of_lang = Window.partitionBy("lang")
    rest = F.sum(F.when(F.col("n") < LEAST, F.col("n")).otherwise(0)).over(of_lang)
    name = F.when(F.col("n") >= LEAST, F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})).when(rest >= LEAST, F.to_json(F.struct("lang"), {"ignoreNullFields": "false"})).otherwise(F.lit("all"))
    names = small.select(F.col("lang").alias("l2"), F.col("source").alias("s2"), name.alias("pool"))
    return rows.join(names, rows.lang.eqNullSafe(F.col("l2")) & rows.source.eqNullSafe(F.col("s2"))).drop("l2", "s2")


def _start(v: DataFrame) -> DataFrame:
    """First estimate of each pool: medians, and a diagonal covariance from quartiles."""
    step = SCALE // 1000
    long = v.select("pool", F.posexplode(F.array(*[F.floor(F.col(d) / step) for d in DIMS])).alias("dim", "at"))
    hist = long.groupBy("pool", "dim", "at").agg(F.count("*").alias("n"))
    own = Window.partitionBy("pool", "dim")
    hist = hist.withColumn("upto", F.sum("n").over(own.orderBy("at"))).withColumn("all", F.sum("n").over(own))
    quart = hist.groupBy("pool", "dim").agg(*[F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("at"))).alias(f"q{k}") for k in (1, 2, 3)])
    mid = [F.max(F.when(F.col("dim") == i, F.col("q2") / 1000)).alias(f"m{i}") for i in range(len(DIMS))]
    spread = [F.max(F.when(F.col("dim") == i, F.pow((F.col("q3") - F.col("q1")) / 1000 / 1.349, 2))).alias(f"c{i}{i}") for i in range(len(DIMS))]
    off = {f"c{i}{j}": F.lit(0.0) for i in range(len(DIMS)) for j in range(i)}
    return quart.groupBy("pool").agg(*mid, *spread).withColumns(off)


def _factor(est: DataFrame, consistency: float) -> DataFrame:
    """Cholesky factor of each covariance, with the floors on its diagonal."""
    p = len(DIMS)
    for i in range(p):
        for j in range(i + 1):
            c = F.col(f"c{i}{j}") * consistency
            for k in range(j):
                c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(0.0)) + FLOORS[i] ** 2) if i == j else c / F.col(f"l{j}{j}"))
    return est.select("pool", *[f"m{i}" for i in range(p)], *[f"l{i}{j}" for i in range(p) for j in range(i + 1)])


def with_distance(v: DataFrame, est: DataFrame) -> DataFrame:
    """``v`` with ``d2``, the squared Mahalanobis distance from its pool's estimate."""
    out = v.join(est, "pool")
    p = len(DIMS)
    for i in range(p):
        y = F.col(DIMS[i]) / SCALE - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    return out.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, p)), F.col("y0") * F.col("y0"))).select(*v.columns, "d2")


def _concentrate(v: DataFrame, est: DataFrame) -> DataFrame:
    """Mean and covariance of the share of each pool that lies nearest to the estimate."""
    near = with_distance(v, est).withColumn("at", F.floor(F.log2(1 + F.col("d2")) * 64))
    hist = near.groupBy("pool", "at").agg(F.count("*").alias("n"))
    own = Window.partitionBy("pool")
    hist = hist.withColumn("before", F.sum("n").over(own.orderBy("at")) - F.col("n")).withColumn("all", F.sum("n").over(own))
    cut = hist.filter(F.col("before") < F.col("all") * SHARE).groupBy("pool").agg(F.max("at").alias("cut"))
    p = range(len(DIMS))
    sums = near.join(cut, "pool").filter("at <= cut").groupBy("pool").agg(
        F.count("*").alias("n"),
        *[F.sum(DIMS[i]).alias(f"s{i}") for i in p],
        *[F.sum(F.rint(F.col(DIMS[i]).cast("double") * F.col(DIMS[j]) / SCALE).cast("long")).alias(f"p{i}{j}") for i in p for j in range(i + 1)],
    )
    mean = {f"m{i}": F.col(f"s{i}") / F.col("n") / SCALE for i in p}
    out = sums.withColumns(mean)
    return out.select("pool", *mean, *[(F.col(f"p{i}{j}") / F.col("n") / SCALE - F.col(f"m{i}") * F.col(f"m{j}")).alias(f"c{i}{j}") for i in p for j in range(i + 1)])


def fit(v: DataFrame) -> DataFrame:
    """The MCD estimate of each pool: centre and Cholesky factor."""
    p = len(DIMS)
    # the nearest share of a normal sample spreads less than the whole
    consistency = SHARE / chi2_cdf(chi2_quantile(SHARE, p), p + 2)
    est = materialize(_factor(_start(v), 1.0), "quality-start")
    for i in range(STEPS):
        est = materialize(_factor(_concentrate(v, est), consistency), f"quality-step{i}")
    return est


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, d2 and kept of each row."""
    c = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text_counts(F.col("text")).alias("c"))
    c = c.select("doc_id", "lang", "source", *[F.col(f"c.{x}").alias(x) for x in COUNTS])
    v = materialize(_pools(materialize(statistics(c), "quality-counts")), "quality-vectors")
    d = with_distance(v, fit(v))
    failed = base_failed()
    return d.select("doc_id", "lang", "source", *COUNTS, failed.alias("base_failed"), "d2", (~failed & (F.col("d2") <= chi2_quantile(KEEP, len(DIMS)))).alias("kept"))


def passing_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that neither the base rule nor the outlier rule rejects."""
    v = docs.withColumn("quality_row", F.struct(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("t"), F.col("doc_id").cast("long").alias("d")))
    keyed = docs.select(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("t"), F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text")
    verdict = judged(keyed.withColumn("doc_id", F.struct("doc_id", "t")).drop("t"))
    # rows alike in id, text, language and source have the same verdict
    kept = verdict.filter("kept").select(F.col("doc_id").alias("quality_key"), F.col("lang").alias("quality_lang"), F.col("source").alias("quality_source")).distinct()
    same = F.col("quality_row.d").eqNullSafe(F.col("quality_key.doc_id")) & (F.col("quality_row.t") == F.col("quality_key.t")) & F.col("lang").eqNullSafe(F.col("quality_lang")) & F.col("source").eqNullSafe(F.col("quality_source"))
    return v.join(kept, same, "left_semi").select(*docs.columns)


def op3_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    d = judged(table(spark, sf_dir, "documents"))
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), *COUNTS, "base_failed", "kept", "d2")
