"""Staged intermediate tables.

A staged table is a parquet table in the shared folder that the session names in
``spark.checkpoint.dir``. It cuts lineage, survives executor loss, and gives Spark the
true byte size of a small side, so the ordinary broadcast threshold decides about
broadcasting instead of a hint.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def _application(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", "local")


def staging_root(spark: SparkSession) -> str:
    """Shared folder of this session; a temporary one only for an unset local session."""
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    app = _application(spark)
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="terracover-")
    return _local_roots[app]


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(_application(spark), []).append(path)
    return path


def drop_staged(spark: SparkSession) -> int:
    """Delete what this application staged so far; results that still read it must be written first.

    Returns the number of tables that were there.
    """
    context, gone = spark.sparkContext, 0
    for path in _made.pop(_application(spark), []):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        gone += place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return gone


def stage(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` once to the staging folder and return the table read back.

    With ``free`` the shuffle files of this write go when it is done, and not at some later
    garbage collection of the driver. The setting for that is put back afterwards.
    """
    spark = df.sparkSession
    path, before = staging_path(spark, name), spark.conf.get(FREE_KEY, None)
    if free:
        spark.conf.set(FREE_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(FREE_KEY) if before is None else spark.conf.set(FREE_KEY, before)
    return spark.read.schema(df.schema).parquet(path)
