"""Incremental silver loading of a landing folder with Structured Streaming.

The batch path (``plans.silver``) re-reads every landed file on each run.  When
monthly files keep arriving, the same operator chain can run as a stream: the
file source remembers in its checkpoint which files it has processed, so each
file is standardised, validated and enriched exactly once, and the file sink
commits each micro-batch atomically.  ``availableNow`` processes whatever has
arrived and stops, which suits a scheduled job.

The chain is stateless (projection and filters only), so no watermark or state
store is involved.  A streaming file source needs one fixed schema: land files
with a different physical layout in their own folder and start one stream per
layout (the batch loader in ``sources.files`` groups them automatically).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import TRIP_FILLS, TripRules, TripSourceSpec
from ..operators.standardize import standardize
from ..plans.silver import clean_trips


def trip_stream(
    spark: SparkSession,
    landing_dir: str,
    spec: TripSourceSpec,
    file_schema: T.StructType,
    rules: TripRules = TripRules(),
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame of silver trips from the parquet files in ``landing_dir``."""
    reader = spark.readStream.schema(file_schema).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.parquet(landing_dir)
    return clean_trips(standardize(src, spec), rules, TRIP_FILLS)


def load_new_files(
    spark: SparkSession,
    landing_dir: str,
    spec: TripSourceSpec,
    file_schema: T.StructType,
    output_dir: str,
    checkpoint_dir: str,
    rules: TripRules = TripRules(),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Process every not-yet-seen file of ``landing_dir`` into ``output_dir`` and stop.

    ``checkpoint_dir`` must be on shared storage (e.g. under the cluster's
    ``spark.checkpoint.dir``) so a restarted driver resumes where it stopped.
    Returns the finished query (``awaitTermination`` already done).
    """
    q = (
        trip_stream(spark, landing_dir, spec, file_schema, rules)
        .writeStream.format(fmt)
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
