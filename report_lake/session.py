"""Session helpers: a local session for tests/bench and the shared scratch folder.

Every job that writes intermediate files (fixtures, CSV hops, tables built by a
registered query) writes below the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared by all executors; a
machine-local temporary folder would not be. Only when the setting is absent
(local tests, the bench) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import urllib.parse
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "report_lake",
                  raw_local_fs: bool = False) -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    ``raw_local_fs`` skips the ``.crc`` sidecar file Hadoop's local file system
    writes next to every file (local disks only; no effect on HDFS/object stores).
    """
    builder = SparkSession.builder
    if raw_local_fs:
        builder = builder.config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small shuffles here feed CPU-heavy stages (explode, windows): do not let
        # AQE coalesce them below the core count just because the bytes are few
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # one machine: list folders in a few tasks, not in one a folder
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("REPORT_LAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; set one only where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = configured or tempfile.mkdtemp(prefix="report-lake-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder (not created)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def to_local_or_uri(path: str) -> str:
    """Normalise ``file:/x y`` (Hadoop form) to the URI ``file:///x%20y``."""
    if path.startswith("file:"):
        return "file://" + urllib.parse.quote(path[len("file:"):].removeprefix("//"), safe="/%")
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def drop_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings give it: with its scheme, unescaped."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


BUCKET_BYTES = 128 << 20


def bucket_count(spark: SparkSession, input_bytes: int | None) -> int:
    """Buckets of about 128 MB of input each, and at least one per shuffle
    partition: a bucketed scan cannot be split later, so the count follows the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(input_bytes or 0) // BUCKET_BYTES))


def stage(df, name: str, droppable: bool = False):
    """Write ``df`` once to the shared folder and read it back: several readers
    then share one computation, and a lost executor re-reads these files.
    ``droppable``: large ones, which are compressed more and go with :func:`drop_staged`."""
    path = scratch_path(df.sparkSession, name)
    if droppable:
        _STAGED[path] = path
    df.write.option("compression", "zstd" if droppable else "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df, cols, name: str, input_bytes: int | None = None):
    """Write ``df`` once as a table bucketed by ``cols`` in the shared folder and
    read it back.

    ``df`` must already be partitioned by ``cols`` into ``bucket_count`` parts.
    Later aggregations, windows and joins keyed on ``cols`` then read it with a
    known hash layout and shuffle nothing but the other (small) side. The table
    is unmanaged; :func:`drop_staged` removes its catalog entry and its files.
    """
    spark = df.sparkSession
    table = f"rl_{name}_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, name)
    df.write.format("parquet").bucketBy(bucket_count(spark, input_bytes), *cols).option("path", path).saveAsTable(table)
    _STAGED[table] = path
    return spark.table(table)


#: Tables staged by this process: catalog name -> folder (for a frame without a table, the folder twice).
_STAGED: dict[str, str] = {}


def drop_staged(spark: SparkSession, before: set | None = None) -> None:
    """Drop the staged tables (those not in ``before``) once their results are written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for table in [t for t in _STAGED if t not in (before or ())]:
        if table != _STAGED[table]:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = jvm.org.apache.hadoop.fs.Path(_STAGED.pop(table))
        p.getFileSystem(conf).delete(p, True)


def staged_tables() -> set:
    return set(_STAGED)
