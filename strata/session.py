"""SparkSession construction and the few session-level settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library gets.  The reference never pinned the
# session time zone; all calendar parts here are computed in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM never compiles a method of more than 8,000 bytes; one operator that grows beyond it (a wide
    # projection over both trip flavours) is then run operator by operator instead of being interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str = "local[*]",
    shuffle_partitions: int | None = None,
    app_name: str = "strata",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with UTC, AQE and a sized shuffle-partition count.

    On a cluster, leave ``master`` to the launcher and size ``shuffle_partitions``
    so that one post-shuffle partition is ~128-256 MB at the target scale; AQE then
    coalesces small ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor; the 1 GB default heap
        # makes long sessions spend their time in GC
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        if k in conf:
            spark.conf.set(k, conf[k])
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and it is used as is.
    Only when it is unset (local tests) a scratch folder is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="strata-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - some deployments refuse core settings at run time
        pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local on a
    cluster): used for landed copies and materialised tables.  It goes when the session ends."""
    import uuid

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path
