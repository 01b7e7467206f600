"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where that is unset (tests, one machine) a folder of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def small_batches(spark: SparkSession, size: str = "16m") -> None:
    """Rows of whole texts go to Python workers in batches of this size, where the session has not set one of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/docloom/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: lineage ends there, and any executor can read it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession | None = None) -> None:
    """Delete the tables that stash() wrote."""
    for session, path in list(_made):
        if spark is None or session is spark:
            try:
                jvm = session.sparkContext._jvm
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            except Exception:  # the session has ended
                pass
            _made.remove((session, path))


atexit.register(clear)
