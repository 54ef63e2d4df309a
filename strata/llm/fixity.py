"""Merkle fixity audit of WARC files (op 9).

Records are hashed, and hashes of ordered offset ranges are hashed again: ranges of
``2**RANGE_BITS[0]`` bytes of a file, then of more, up to the file.  Two replicas are compared at
the roots; only children of nodes that differ are looked at, level by level, down to
the records: a corrupt record is named by file, offset and length.

A node's digest covers start, length and digest of its children in order of offset, so a
record that is missing, moved or cut is found like one whose bytes have changed.  A group holds the
children of one range: at most as many as start in it.

Defined results: records with null parts are written with empty ones; null page ids form the file -1;
repeated rows are records of their own, in order of their content; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialize, table

FILE_PAGES = 1000
#: Hexadecimal digits of the hash that part the records of one id.
PART_DIGITS = 2
RANGE_BITS = (16, 20, 24)
ROOT = len(RANGE_BITS)
#: One record in this many is damaged in the query's second replica.
DAMAGE = 50


def warc_record(url: Column, body: Column) -> Column:
    """A resource record as bytes."""
    body = F.coalesce(body, F.lit(""))
    size = F.octet_length(body).cast("string")
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), size, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def raw_records(pages: DataFrame) -> DataFrame:
    """page_id, record, file_no, n_bytes, sha256 of each page, without its place."""
    r = pages.select(F.col("page_id").cast("long").alias("page_id"), warc_record(F.col("url"), F.col("html")).alias("record"))
    r = r.withColumn("file_no", F.coalesce(F.floor(F.col("page_id") / FILE_PAGES), F.lit(-1)).cast("long")).withColumn("n_bytes", F.octet_length("record").cast("long"))
    return r.withColumn("sha256", F.sha2(F.col("record").cast("binary"), 256))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (file_no, page_id, n_bytes, sha256 and what follows from the record, but not itself) with ``offset``.

    Equal records are summed first.  Those of one id are in parts by the first digits of the hash: sizes run within a
    part, and over the parts of a file, of which each id has at most ``16**PART_DIGITS``.
    """
    once = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")).withColumn("part", F.substring("sha256", 1, PART_DIGITS))
    size = F.col("n_bytes") * F.col("copies")
    sums = once.groupBy("file_no", "page_id", "part").agg(F.sum(size).alias("size"))
    parts = Window.partitionBy("file_no").orderBy(F.col("page_id").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("file_no").alias("f"), F.col("page_id").alias("p"), F.col("part").alias("q"), F.coalesce(F.sum("size").over(parts), F.lit(0)).alias("base"))
    own = Window.partitionBy("file_no", "page_id", "part").orderBy("sha256").rowsBetween(Window.unboundedPreceding, -1)
    once = once.withColumn("before", F.coalesce(F.sum(size).over(own), F.lit(0)))
    out = once.join(sums, (F.col("file_no") == F.col("f")) & F.col("page_id").eqNullSafe(F.col("p")) & (F.col("part") == F.col("q")))
    out = out.select(*rows.columns, "base", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("nth"))
    return out.select(*rows.columns, (F.col("base") + F.col("before") + F.col("nth") * F.col("n_bytes")).cast("long").alias("offset"))


def records(pages: DataFrame) -> DataFrame:
    """file_no, offset, n_bytes, page_id, record: pages laid out in files of ``FILE_PAGES`` ids."""
    r = raw_records(pages)
    bodies = r.groupBy("file_no", F.col("page_id").alias("p"), "sha256").agg(F.first("record").alias("record"))
    at = placed(r.select("file_no", "page_id", "n_bytes", "sha256"))
    out = at.join(bodies.withColumnsRenamed({"file_no": "f", "sha256": "h"}), (F.col("file_no") == F.col("f")) & F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha256") == F.col("h")))
    return out.select("file_no", "offset", "n_bytes", "page_id", "record")


def leaves(recs: DataFrame) -> DataFrame:
    """file_no, offset, n_bytes, sha256 of each record (which may come with its hash instead of its bytes)."""
    sha256 = F.col("sha256") if "sha256" in recs.columns else F.sha2(F.col("record").cast("binary"), 256)
    return recs.select("file_no", "offset", "n_bytes", sha256.alias("sha256"))


def tree(leaf: DataFrame) -> list[DataFrame]:
    """Levels of a replica from its records up to one root a file: file_no, idx, offset, n_bytes, sha256."""
    out = [leaf.withColumn("idx", F.col("offset"))]
    for level in range(ROOT + 1):
        up = F.lit(0).cast("long") if level == ROOT else F.shiftright("offset", RANGE_BITS[level])
        kids = F.array_sort(F.collect_list(F.struct("offset", "n_bytes", "sha256")))
        text = F.array_join(F.transform("kids", lambda k: F.concat_ws(":", k["offset"].cast("string"), k["n_bytes"].cast("string"), k["sha256"])), "\n")
        nodes = out[-1].groupBy("file_no", up.alias("idx")).agg(kids.alias("kids"))
        size = F.aggregate("kids", F.lit(0).cast("long"), lambda a, k: a + k["n_bytes"])
        out.append(nodes.select("file_no", F.col("kids")[0]["offset"].alias("offset"), size.alias("n_bytes"), F.sha2(text, 256).alias("sha256"), "idx"))
    return out


def _up(level: int) -> Column:
    """The node above, for the children of a level."""
    return F.lit(0).cast("long") if level == ROOT else F.shiftright("offset", RANGE_BITS[level])


def damaged(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """file_no, offset, status of records that differ: found by descending from roots that differ."""

    def differing(x: DataFrame, y: DataFrame) -> DataFrame:
        x = x.select("file_no", "idx", F.struct("offset", "n_bytes", "sha256").alias("va"))
        y = y.select("file_no", "idx", F.struct("offset", "n_bytes", "sha256").alias("vb"))
        return x.join(y, ["file_no", "idx"], "full").filter(~F.col("va").eqNullSafe(F.col("vb")))

    bad = differing(a[-1], b[-1]).select(F.col("file_no").alias("f"), F.col("idx").alias("up"))
    for level in range(ROOT, -1, -1):
        below = [side[level].join(bad, (F.col("file_no") == F.col("f")) & (_up(level) == F.col("up")), "left_semi") for side in (a, b)]
        last = differing(*below)
        bad = last.select(F.col("file_no").alias("f"), F.col("idx").alias("up"))
    status = F.when(F.col("vb").isNull(), "missing").when(F.col("va").isNull(), "extra").otherwise("corrupt")
    return last.select("file_no", F.col("idx").alias("offset"), status.alias("status"))


def audit(a: DataFrame, b: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The first replica's tree and the records in which the replicas (file_no, offset, n_bytes, record or sha256) differ."""
    trees = []
    for name, side in (("a", a), ("b", b)):
        low = materialize(leaves(side), f"fixity-{name}")
        trees.append([low.withColumn("idx", F.col("offset"))] + [materialize(x, f"fixity-{name}-up") for x in tree(low)[1:]])
    return trees[0], damaged(*trees)


def op9_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` as WARC records, audited against a copy in which one record in ``DAMAGE`` has a changed byte."""
    raw = raw_records(table(spark, sf_dir, "pages"))
    hurt = (F.col("page_id") % DAMAGE == 7) & (F.col("n_bytes") > 40)
    other = F.concat(F.expr("substring(record, 1, length(record) - 5)"), F.lit("~"), F.expr("substring(record, length(record) - 3)"))
    size2, sha2 = F.when(hurt, F.octet_length(other).cast("long")).otherwise(F.col("n_bytes")), F.when(hurt, F.sha2(other.cast("binary"), 256)).otherwise(F.col("sha256"))
    both = materialize(placed(raw.select("file_no", "page_id", "n_bytes", "sha256", size2.alias("size2"), sha2.alias("sha2"))), "fixity-placed")
    first = both.select("file_no", "offset", "n_bytes", "page_id", "sha256")
    levels, bad = audit(first, both.select("file_no", "offset", F.col("size2").alias("n_bytes"), F.col("sha2").alias("sha256")))
    root = levels[-1].select("file_no", F.col("sha256").alias("root_sha256"))
    out = first.join(bad, ["file_no", "offset"], "left").join(root, "file_no")
    return out.select("file_no", "offset", "n_bytes", "page_id", "sha256", F.coalesce("status", F.lit("ok")).alias("status"), "root_sha256")


def _sql() -> str:
    level = "SELECT file_no, {up} AS idx, min(\"offset\") AS \"offset\", sum(n_bytes) AS n_bytes, sha256(string_agg(\"offset\" || ':' || n_bytes || ':' || sha256, chr(10) ORDER BY \"offset\")) AS sha256 FROM {of} GROUP BY ALL"
    ups = [f'("offset" >> {b})' for b in RANGE_BITS] + ["0"]
    levels = ", ".join(f"l{i + 1} AS ({level.format(up=u, of=f'l{i}')})" for i, u in enumerate(ups))
    return f"""
WITH r AS (SELECT page_id, coalesce(CAST(floor(page_id / {FILE_PAGES}) AS BIGINT), -1) AS file_no,
 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages),
s AS (SELECT *, octet_length(encode(record)) AS n_bytes, sha256(record) AS sha256 FROM r),
l0 AS (SELECT file_no, page_id, n_bytes, sha256, CAST(coalesce(sum(n_bytes) OVER (PARTITION BY file_no ORDER BY page_id NULLS FIRST, sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM s),
{levels}
SELECT l0.file_no, l0."offset", l0.n_bytes, l0.page_id, l0.sha256, CASE WHEN page_id % {DAMAGE} = 7 AND l0.n_bytes > 40 THEN 'corrupt' ELSE 'ok' END AS status, t.sha256 AS root_sha256
FROM l0 JOIN l{ROOT + 1} t ON t.file_no = l0.file_no
"""


ORACLE_SQL = _sql()
