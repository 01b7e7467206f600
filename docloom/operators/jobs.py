"""Job rows as a relation. The supplied events stand in for them; SQL is the same relation for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SQL = """jobs AS (SELECT event_id AS id, event_type AS kind, CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'ws' || CAST(user_id AS VARCHAR) END AS workspace, ts AS created_at,
  CASE event_id % 7 WHEN 0 THEN 'running' WHEN 1 THEN 'succeeded' WHEN 2 THEN 'failed' ELSE 'queued' END AS status, event_id % 4 AS attempts, event_id % 5 = 0 AS cancel_requested,
  CASE event_id % 3 WHEN 0 THEN 'parsing' WHEN 1 THEN 'chunking' ELSE 'inserting' END AS stage, CASE WHEN event_id % 6 = 0 THEN event_id - event_id % 5 - 1 END AS parent_id,
  CASE WHEN event_id % 4 = 0 THEN 'k' || CAST(event_id % 500 AS VARCHAR) END AS idem_key, 'w' || CAST(event_id % 8 AS VARCHAR) AS worker, value FROM events)"""


def jobs(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    i, u = F.col("event_id"), F.col("user_id")
    return e.select(
        i.alias("id"),
        F.col("event_type").alias("kind"),
        F.when(u % 10 != 0, F.concat(F.lit("ws"), u.cast("string"))).alias("workspace"),
        F.col("ts").alias("created_at"),
        F.when(i % 7 == 0, "running").when(i % 7 == 1, "succeeded").when(i % 7 == 2, "failed").otherwise("queued").alias("status"),
        (i % 4).alias("attempts"),
        (i % 5 == 0).alias("cancel_requested"),
        F.when(i % 3 == 0, "parsing").when(i % 3 == 1, "chunking").otherwise("inserting").alias("stage"),
        F.when(i % 6 == 0, i - i % 5 - 1).alias("parent_id"),
        F.when(i % 4 == 0, F.concat(F.lit("k"), (i % 500).cast("string"))).alias("idem_key"),
        F.concat(F.lit("w"), (i % 8).cast("string")).alias("worker"),
        "value",
    )
