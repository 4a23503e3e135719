"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that every job here relies on. All of them may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed side is split even where that costs one more exchange further up the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes; longer generated methods would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A bucketed table is read by buckets, so that a lookup of one id reads one of them.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # Rows may hold long texts: a batch for a Python worker stays at two megabytes, or one row.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
}

# By application: the stand-in folder of a local session, and the scratch paths not yet removed.
_LOCAL_ROOTS: dict[str, str] = {}
_HANDED_OUT: dict[str, list[str]] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "punctual", master: str | None = None, **settings: str) -> SparkSession:
    """Create a tuned session; ``settings`` use ``__`` in place of dots (``spark__driver__memory``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession, root: str | None = None) -> str:
    """The folder that driver and executors all reach: ``root``, else what ``spark.checkpoint.dir`` names.

    A temporary folder stands in only on a ``local`` master, where driver and executors are one process;
    anywhere else a missing folder is an error.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="punctual-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_path(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new, unused path under the shared folder; ``release_scratch`` removes it."""
    path = f"{shared_root(spark, root)}/punctual/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders handed out so far; call it when every result that reads them was consumed."""
    jvm, removed = spark.sparkContext._jvm, 0
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _HANDED_OUT.pop(spark.sparkContext.applicationId, []):
        target = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(target.getFileSystem(configuration).delete(target, True))
    return removed


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage that outlives executors."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
