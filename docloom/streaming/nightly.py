"""Event-time streams: touches per user and day behind a watermark, and the newest state of each key, kept by a stateful fold."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def touches(events: DataFrame, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Counts by user in windows of event time; state of windows past the watermark is dropped."""
    at = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return at.groupBy(F.window("at", window), "user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id")).select(F.col("window.start").alias("start"), "user_id", "n", "last_id")


def _newest(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    best = state.get if state.exists else (-1, "")
    for p in parts:
        row = p.loc[p["event_id"].idxmax()]
        if int(row["event_id"]) > best[0]:
            best = (int(row["event_id"]), str(row["event_type"]))
    state.update(best)
    yield pd.DataFrame({"user_id": [key[0]], "event_id": [best[0]], "event_type": [best[1]]})


def newest_state(events: DataFrame) -> DataFrame:
    """After each batch the newest event of every user that the batch touched; one small state a user."""
    return events.select("user_id", "event_id", "event_type").groupBy("user_id").applyInPandasWithState(_newest, "user_id long, event_id long, event_type string", "event_id long, event_type string", "update", GroupStateTimeout.NoTimeout)
