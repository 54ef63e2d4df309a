"""Landing-folder sources: file listing, drift-tolerant parquet set, month manifest
(S01, S02, S03, S12).

Files of one landing folder may disagree on column types (an integer passenger
count in one month, a double in the next; text timestamps).  ``mergeSchema``
refuses such sets, and one read per file is one job per file.  Instead each
file's footer is probed, files are grouped by schema, and each group is read with
a single scan, standardised and unioned.

Footers are read by pyarrow on the executors where every node sees the path
(``file:``), and otherwise through the Hadoop file system that Spark itself reads by, so any
store that Spark opens can be loaded.

A footer says nothing about the pages.  The scan skips what it cannot decode, the rows are
staged once, and the rows staged from each file are held against its footer: a
file that came short is rejected as a whole and reported, the others are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TripSourceSpec
from ..operators.standardize import MissingColumnError, standardize, union_all
from ..session import scratch_path

FOOTER_SCHEMA = "path string, uri string, schema_json string, n_rows long, error string"
#: Paths that one row of a group, or one round of footers, holds at most.
PATHS = 10_000
#: Footers that the driver reads at a time where executors cannot open the store.
READERS = 32
#: Skip what cannot be decoded, or differs from its page's checksum (where pages have one).
TOLERANT = {"ignoreCorruptFiles": "true", "parquet.page.verify-checksum.enabled": "true"}
#: The column that carries a row's file through standardisation.
FILE = "_file"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file under ``folder`` (recursive), with size and mtime.

    Only the listing columns are selected, so file contents are never read.  ``uri`` is the path as
    ``_metadata.file_path`` gives it to the rows of any scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.col("path"), F.col("length"), F.col("modificationTime"), F.col("_metadata.file_path").alias("uri"))
    )


def _probe_here(files: DataFrame) -> DataFrame:
    """Footers of files that every node sees by path, read on the executors.

    The probe is defined inside this function so it is shipped to the workers by
    value and needs nothing from this package there (only pandas and pyarrow).
    """

    def probe(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        for pdf in batches:
            out = []
            for p, uri in zip(pdf["path"], pdf["uri"]):
                try:
                    meta = pq.read_metadata(p[len("file:") :] if p.startswith("file:") else p)
                    text = meta.schema.to_arrow_schema().to_string(show_schema_metadata=False)
                    out.append((p, uri, text, meta.num_rows, None))
                except (pa.ArrowException, ValueError, OSError) as e:
                    out.append((p, uri, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "uri", "schema_json", "n_rows", "error"]).astype({"n_rows": "Int64"})

    return files.select("path", "uri").mapInPandas(probe, FOOTER_SCHEMA)


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    while chunk := list(itertools.islice(rows, size)):
        yield chunk


def _probe_through_spark(files: DataFrame) -> DataFrame:
    """Footers by the file system of Spark's own readers, ``PATHS`` files at a time.

    A footer is one small read; the driver never holds more than one round of paths.
    """
    spark = files.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    input_file, reader = jvm.org.apache.parquet.hadoop.util.HadoopInputFile, jvm.org.apache.parquet.hadoop.ParquetFileReader

    def footer(f: Row) -> tuple:
        try:
            r = reader.open(input_file.fromPath(jvm.org.apache.hadoop.fs.Path(f.path), conf))
            try:
                return f.path, f.uri, r.getFileMetaData().getSchema().toString(), r.getRecordCount(), None
            finally:
                r.close()
        except Exception as e:  # noqa: BLE001 - whatever the store or the footer says is the file's verdict
            return f.path, f.uri, None, None, str(e).splitlines()[0][:500]

    out = scratch_path(spark, "footers")
    spark.createDataFrame([], FOOTER_SCHEMA).write.mode("overwrite").parquet(out)
    with ThreadPoolExecutor(READERS) as pool:
        for chunk in _chunks(files.select("path", "uri").toLocalIterator(), PATHS):
            spark.createDataFrame(list(pool.map(footer, chunk)), FOOTER_SCHEMA).coalesce(1).write.mode("append").parquet(out)
    return spark.read.schema(FOOTER_SCHEMA).parquet(out)


def probe_schemas(files: DataFrame) -> DataFrame:
    """S03 (probe): path, uri, schema text, number of rows of each file; one that has no footer carries an error.

    Only footers are touched, and each file's once: the result is a written table.
    """
    local = (F.col("path").startswith("file:")) | ~F.col("path").contains(":/")
    out = scratch_path(files.sparkSession, "probed")
    _probe_here(files.filter(local)).write.mode("overwrite").parquet(out)
    far = files.filter(~local)
    if not far.isEmpty():
        _probe_through_spark(far).write.mode("append").parquet(out)
    return files.sparkSession.read.schema(FOOTER_SCHEMA).parquet(out)


@dataclass
class LoadResult:
    data: DataFrame  # standardised rows of every accepted file
    manifest: DataFrame  # one row per file: path, status, reason


def _same_schema_groups(probed: DataFrame) -> Iterator[tuple[str, list[str]]]:
    """(schema text, paths): rows of some ``PATHS`` paths of one schema, one after the other."""
    good = probed.filter(F.col("error").isNull())
    parts = good.count() // PATHS + 1
    groups = good.groupBy("schema_json", F.pmod(F.xxhash64("path"), F.lit(parts)).alias("part")).agg(F.sort_array(F.collect_list("path")).alias("paths"))
    for g in groups.select("schema_json", "paths").toLocalIterator():
        yield g["schema_json"], g["paths"]


def load_parquet_set(
    spark: SparkSession,
    folder: str,
    spec: TripSourceSpec,
    case_sensitive: bool = False,
    pattern: str = "*.parquet",
) -> LoadResult:
    """S01 + S03: read every parquet file of ``folder`` onto the trip schema.

    Files whose footer cannot be read, that lack a required column, or whose pages cannot all be
    decoded are rejected and reported in the manifest; the others are read one scan per
    distinct schema, and staged below the scratch folder.  A scan needs the names of its files, which Spark's own file index
    holds on the driver as well; they come in groups of some ``PATHS`` and never rows.
    """
    probed = probe_schemas(list_files(spark, folder, pattern))
    frames: list[DataFrame] = []
    verdicts: dict[str, tuple[str, str | None]] = {}
    for schema, paths in _same_schema_groups(probed):
        if verdicts.get(schema, ("accepted",))[0] == "rejected":
            continue
        try:
            # what cannot be decoded is skipped here and found by its missing rows below
            rows = spark.read.options(**TOLERANT).parquet(*paths).withColumn(FILE, F.col("_metadata.file_path"))
            frames.append(standardize(rows, spec, case_sensitive, keep=(FILE,)))
            verdicts[schema] = ("accepted", None)
        except (MissingColumnError, AnalysisException) as e:  # of this schema alone: the others are still read
            verdicts[schema] = ("rejected", str(e))
    # a row per distinct schema joins the probed files; a file without a schema carries its own reason
    known = spark.createDataFrame([(k, *v) for k, v in verdicts.items()], "schema_json string, status string, reason string")
    judged = probed.join(known, "schema_json", "left").select(
        "path", "uri", "n_rows", F.coalesce("status", F.lit("rejected")).alias("status"), F.coalesce("reason", "error").alias("reason")
    )
    if not frames:
        empty = spark.createDataFrame([], _empty_schema(spark, spec))
        return LoadResult(empty, judged.select("path", "status", "reason"))
    staged = _written(union_all(frames), "staged")
    read = staged.groupBy(F.col(FILE).alias("uri")).agg(F.count(F.lit(1)).alias("n_read"))
    n_read = F.coalesce("n_read", F.lit(0))
    short = (F.col("status") == "accepted") & (n_read < F.col("n_rows"))
    judged = _written(
        judged.join(read, "uri", "left").select(
            "path",
            "uri",
            F.when(short, "rejected").otherwise(F.col("status")).alias("status"),
            F.when(short, F.concat(F.lit("damaged data: "), n_read, F.lit(" of "), "n_rows", F.lit(" rows can be read"))).otherwise(F.col("reason")).alias("reason"),
            short.alias("damaged"),
        ),
        "manifest",
    )
    # written, so its size is known: few damaged files travel to the rows, many are joined by their names
    damaged = _written(judged.filter("damaged").select(F.col("uri").alias(FILE)), "damaged")
    data = staged if damaged.isEmpty() else staged.join(damaged, FILE, "left_anti")
    return LoadResult(data.drop(FILE), judged.select("path", "status", "reason"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _empty_schema(spark: SparkSession, spec: TripSourceSpec) -> T.StructType:
    from ..operators.standardize import _TYPES

    fields = [T.StructField(f.target, _TYPES[f.dtype]) for f in spec.fields]
    return T.StructType(fields + [T.StructField("taxi_type", T.StringType())])


def _strip(c):
    # ``trim`` removes spaces only; file names may carry a newline or tab
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def landed_names(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """S02 for the manifest: ``file_name`` of each landed file of ``folder``, from the listing alone.

    A file that a Spark job wrote as a folder of parts counts by the folder's name, plain or as a
    partition ``file_name=...``.
    """
    name = F.regexp_extract("path", r"([^/]+)(?:/part-[^/]*)?$", 1)
    return list_files(spark, folder, pattern).select(F.regexp_replace(name, "^file_name=", "").alias("file_name")).distinct()


def month_manifest(
    spark: SparkSession,
    first_month: str,
    last_month: str,
    prefixes: list[str],
    present: DataFrame | None = None,
    suffix: str = ".parquet",
) -> DataFrame:
    """The expected monthly file names ``<prefix>YYYY-MM<suffix>`` for every
    month in [first_month, last_month], optionally reconciled with ``present``
    (a frame with a ``file_name`` column): ``present`` flags what arrived.

    Names are trimmed, so a trailing newline in a configured name is harmless.
    """
    months = spark.range(1).select(
        F.explode(
            F.sequence(
                F.to_date(F.lit(first_month + "-01")),
                F.to_date(F.lit(last_month + "-01")),
                F.expr("INTERVAL 1 MONTH"),
            )
        ).alias("month_start")
    )
    # every month x every prefix, generated by exploding a literal list (no join)
    expected = months.select(
        "month_start", F.explode(F.array(*[F.lit(p.strip()) for p in prefixes])).alias("prefix")
    ).select(
        F.col("prefix"),
        F.date_format("month_start", "yyyy-MM").alias("month"),
        _strip(F.concat(F.col("prefix"), F.date_format("month_start", "yyyy-MM"), F.lit(suffix))).alias("file_name"),
    )
    if present is None:
        return expected
    got = present.select(_strip(F.col("file_name")).alias("file_name")).distinct().withColumn("_present", F.lit(True))
    return expected.join(got, "file_name", "left").select(
        "prefix", "month", "file_name", F.coalesce(F.col("_present"), F.lit(False)).alias("present")
    )
