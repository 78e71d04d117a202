"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. Skewed sort-merge joins are split
# even when that costs an extra exchange, because one key may hold a large share
# of all rows. Shuffle files go when the query that wrote them has ended; a frame that is
# executed again writes them again.
RUNTIME_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings a session takes only when it starts. The report compiles to more generated
# classes than the default cache holds, and builds thousands of column objects, each of
# which would record where it was made.
STARTUP_SETTINGS = {
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def with_startup_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in STARTUP_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A session that names none (a local test) uses a folder of its warehouse, which driver
    and executors share as well. There is no machine-local fallback.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder below the shared one, removed when the application ends."""
    context = spark.sparkContext
    if context.applicationId not in _SCRATCH:
        root = f"{shared_folder(spark)}/eodledger-{uuid.uuid4().hex}"
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _SCRATCH[context.applicationId] = root
    return _SCRATCH[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the application's shared folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str = "frame") -> DataFrame:
    """The frame's rows, written once below the shared folder: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_stage(spark: SparkSession) -> Callable[[str, DataFrame], DataFrame]:
    """Stage function that writes a shared frame once below the shared folder.

    Frames read by several branches of the report are then computed a single time, the
    result survives lost executors, and its readers still prune columns and know its size.
    """

    return lambda name, df: stored(df, name)
