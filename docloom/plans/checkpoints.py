"""Where checkpoints and tables between steps go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_folder(spark: SparkSession) -> str:
    """The session's own setting stands; only where there is none (tests, one machine) a temporary folder is set."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="docloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def kept(df: DataFrame) -> DataFrame:
    """df, written once as Parquet in the shared folder and read back: computed once, without lineage, and readable by any executor."""
    path = f"{ensure_folder(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
