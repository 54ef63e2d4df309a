"""Mixing sources to target weights by Pareto order sampling (op 2; DataFrame functions only).

Every document has an expected number of copies.  Whole copies are certain; the
fraction is an inclusion probability p, and documents of a source are ranked by
random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``.  The sample is
of fixed size, counted in words: the first documents by rank that fill what the
certain copies leave of the source's target are taken.

* Expected copies fall slowly with a document's length class (``1 / (CLASS_BASE +
  bits of its size)``), so that one very long document rarely decides a source; they
  never exceed ``MAX_COPIES``.
* ``u`` comes from a digest of the document's id and text: reruns agree, and ties
  of equal rank are broken by id and digest.
* The cut by rank is found in a histogram: the ranks of a source are put into
  2**``BUCKET_BITS`` buckets, buckets are summed first, and only the bucket that holds the cut is
  divided again, ``LEVELS`` times.  Only what is left of one bucket is put in order row by row,
  so a source with a third of all rows never meets in one task.
* What the cut leaves open (less than the next document) is filled by one more
  cut among the documents that fit, then by the one document nearest to the rest.

Defined results: null text has size 0; documents of size 0 are never taken;
null sources form one source that comes last; null ids are documents like
others; repeated rows are sampled each for itself, except that rows alike in id
and text share their rank and may be ordered either way; an empty table gives an
empty result.  Other columns of the input are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialize, table
from .words import word_count

MAX_COPIES = 3
CLASS_BASE = 8
BUCKET_BITS = 11
LEVELS = 3
#: Bits of the integer form of a rank.
KEY_BITS = 50
SHARE_CYCLE = 3
#: Scale of the integer weights of length classes, so that sums are exact in any order.
SCALE = 1_000_000


def source_targets(per_source: DataFrame, cycle: int = SHARE_CYCLE, most: int = MAX_COPIES) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row (source, source_size) a source.

    Sources by code point, null last, weigh 1, 2, .. ``cycle``, repeating, and share the sum of all
    sizes; a target stops at ``most`` times the size and the excess is shared again by weight.
    Filling up in order of (cap / weight): the first j sources stop at their caps, the others get
    ``level * weight``, for the smallest j at which no other is above its cap.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").asc_nulls_last())
    s = per_source.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long")).withColumn("cap", F.col("source_size") * most)
    fill = everything.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(fill), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(fill), F.lit(0)))
    total, weights = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    s = s.withColumn("level", (total - F.col("capped")).cast("double") / (weights - F.col("weight_before")).cast("double"))
    ok = F.col("level") * F.col("weight") <= F.col("cap")
    s = s.withColumn("final", F.min(F.when(ok, F.struct("capped", F.col("level").alias("level")))).over(everything)["level"])
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap").cast("double"), F.coalesce(F.col("final"), F.lit(float("inf"))) * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def digest_of(doc_id: Column, text: Column) -> Column:
    """A digest of id and text, from which a row's random number comes."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))))


def _class(size: Column) -> Column:
    return F.length(F.bin(size)).cast("long") - 1


def expected_copies(classes: DataFrame, targets: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """Expected copies of each (source, length class): ``level * weight`` up to ``most``, their words the target."""
    w = classes.withColumn("weight", F.floor(F.lit(SCALE) / (F.lit(CLASS_BASE) + F.col("class"))).cast("decimal(38,0)"))
    w = w.join(targets, F.col("of") == F.col("of_target"))
    own = Window.partitionBy("of")
    before = own.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("words").cast("decimal(38,0)")
    w = w.withColumn("full", F.coalesce(F.sum(F.col("words")).over(before), F.lit(0)))
    w = w.withColumn("open", F.sum(words * F.col("weight")).over(own) - F.coalesce(F.sum(words * F.col("weight")).over(before), F.lit(0)))
    w = w.withColumn("level", (F.col("target") - F.lit(most) * F.col("full")) / F.col("open").cast("double"))
    w = w.withColumn("weight", F.col("weight").cast("double"))
    ok = F.col("level") * F.col("weight") <= most
    w = w.withColumn("final", F.min(F.when(ok, F.struct("class", "level"))).over(own)["level"])
    copies = F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.coalesce(F.col("final"), F.lit(float("inf"))) * F.col("weight")))
    return w.select("of", "class", "source_size", "target", copies.alias("copies"))


def _cut(rows: DataFrame, gap: DataFrame) -> DataFrame:
    """Of ``rows`` (of, size, key, doc_id, digest ..) those that come first by ``key`` and together fit their source's ``gap``."""
    state = gap.select("of", "gap", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    shift = KEY_BITS
    for level in range(LEVELS):
        coarse, shift = shift, shift - BUCKET_BITS
        live = rows.select("of", "size", "key").join(state, "of").filter(F.shiftright("key", coarse) == F.col("prefix"))
        hist = live.groupBy("of", F.shiftright("key", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.max("gap").alias("gap"), F.max("before").alias("before"))
        hist = hist.withColumn("end", F.col("before") + F.sum("words").over(Window.partitionBy("of").orderBy("bucket")))
        over = hist.filter(F.col("end") > F.col("gap")).groupBy("of").agg(F.min_by(F.struct("gap", "bucket", (F.col("end") - F.col("words")).alias("before")), "bucket").alias("b"))
        found = over.select(F.col("of").alias("of_found"), F.col("b.bucket").alias("bucket"), F.col("b.before").alias("before_found"))
        # where nothing is too much, all rows lie before the end of the keys
        state = state.join(found, F.col("of") == F.col("of_found"), "left").select("of", "gap", F.coalesce("bucket", F.lit(1 << (KEY_BITS - shift)).cast("long")).alias("prefix"), F.coalesce("before_found", F.lit(0)).alias("before"))
        state = materialize(state, f"mix-cut-{level}")
    there = rows.join(state, "of").withColumn("bucket", F.shiftright("key", shift))
    whole = there.filter(F.col("bucket") < F.col("prefix"))
    order = Window.partitionBy("of").orderBy("key", "doc_id", "digest")
    part = there.filter(F.col("bucket") == F.col("prefix")).withColumn("end", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return whole.select(*rows.columns).unionByName(part.filter(F.col("end") <= F.col("gap")).select(*rows.columns))


def pareto_mix(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``sized`` (doc_id, source, size, digest) with ``copies`` taken of each, and its target.

    Rows alike in id and digest are rows like others that share their rank.
    """
    d = sized.withColumn("of", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).withColumn("class", _class(F.col("size")))
    t = targets.withColumn("of_target", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    classes = d.filter("size > 0").groupBy("of", "class").agg(F.sum("size").alias("words"))
    plan = materialize(expected_copies(classes, t), "mix-copies")
    odds = (F.conv(F.substring("digest", 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))
    x = d.join(plan.drop("source_size", "target"), ["of", "class"], "left").withColumn("copies", F.coalesce("copies", F.lit(0.0)))
    x = x.withColumn("sure", F.floor("copies").cast("long")).withColumn("p", F.col("copies") - F.floor("copies"))
    up, down = odds * (1 - F.col("p")), (1 - odds) * F.col("p")  # rank = up / down, as a share of up + down
    x = x.withColumn("key", F.floor(up / (up + down) * F.lit(float(1 << KEY_BITS))).cast("long"))
    x = materialize(x.select(*sized.columns, "of", "sure", "p", F.when(F.col("p") > 0, F.col("key")).alias("key")), "mix-ranked")
    sure = x.groupBy("of").agg(F.sum(F.col("sure") * F.col("size")).alias("words"))
    gap = t.join(sure, F.col("of") == F.col("of_target")).select("of", (F.rint("target").cast("long") - F.col("words")).alias("gap"))
    cols = ["of", "size", "key", "doc_id", "digest"]
    ranked = x.filter(F.col("key").isNotNull()).select(*cols)
    gap = materialize(gap.filter("gap > 0"), "mix-gap")
    taken = materialize(_cut(ranked, gap), "mix-taken")
    # what the cut left open: one more cut among those that fit, then the one document nearest to the rest
    for step in ("fit", "nearest"):
        used = taken.groupBy("of").agg(F.sum("size").alias("used"))
        gap2 = gap.join(used, "of", "left").select("of", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")).filter("gap > 0")
        left = ranked.alias("r").join(taken.select(F.col("doc_id").alias("d2"), F.col("digest").alias("g2")).distinct(), F.col("r.doc_id").eqNullSafe(F.col("d2")) & (F.col("r.digest") == F.col("g2")), "left_anti")
        if step == "fit":
            fits = left.join(gap2.withColumnRenamed("gap", "room"), "of").filter("size <= room").select(*cols)
            more = _cut(fits, gap2)
        else:
            near = left.join(gap2, "of").filter("size < 2 * gap")
            more = near.groupBy("of").agg(F.min_by(F.struct(*[c for c in cols if c != "of"]), F.struct(F.abs(F.col("size") - F.col("gap")), "key", "doc_id", "digest")).alias("b")).select("of", "b.*").select(*cols)
        taken = materialize(taken.unionByName(more), f"mix-{step}")
    # rows alike in id and text share a rank: of n such rows as many get a copy as were taken
    hits = taken.groupBy(F.col("doc_id").alias("d2"), F.col("digest").alias("g2")).agg(F.count("*").alias("hits"))
    alike = Window.partitionBy("doc_id", "digest").orderBy("of")
    out = x.withColumn("nth", F.row_number().over(alike)).join(hits, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("digest") == F.col("g2")), "left")
    out = out.withColumn("copies", F.col("sure") + F.when(F.col("nth") <= F.coalesce("hits", F.lit(0)), 1).otherwise(0))
    return out.join(t, F.col("of") == F.col("of_target"), "left").select(*sized.columns, "source_size", "target", "copies")


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and a digest of id and text, once for every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), digest_of(F.col("doc_id"), F.col("text")).alias("digest"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, digest, size, source_size, target, copies of each row of ``docs``, whose sources weigh 1, 2, 3, repeating."""
    sized = materialize(sized_documents(docs), "mix-sized")
    per_source = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = materialize(source_targets(per_source), "mix-targets")
    return pareto_mix(sized, targets)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row as often as the mix takes it."""
    def key(doc_id: Column, digest: Column) -> list[Column]:
        i = doc_id.cast("long")
        return [F.coalesce(i, F.lit(0)).alias("mix_id"), i.isNull().alias("mix_null"), digest.alias("mix_digest")]

    names = ["mix_id", "mix_null", "mix_digest"]
    chosen = mix(docs).filter("copies > 0").groupBy(*key(F.col("doc_id"), F.col("digest"))).agg(F.collect_list("copies").alias("mix_copies"))
    # texts are dealt and sorted once, for the join and the numbers alike
    out = docs.select(*docs.columns, *key(F.col("doc_id"), digest_of(F.col("doc_id"), F.col("text")))).join(chosen, names)
    out = out.withColumn("mix_nth", F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0))))
    out = out.withColumn("mix_n", F.get("mix_copies", F.col("mix_nth") - 1)).filter(F.col("mix_n").isNotNull())
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_n"))).alias("mix_copy")).select(*docs.columns)


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``."""
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
