"""The change history as a stream (an extension: the batch operators are in
``stratiq.operators.versioning``).

Actions arrive as files or any other source of (``delta``, ``action``, ``at``);
the state per change set is how often it stands applied.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HISTORY = "delta string, action string, at timestamp"


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(HISTORY).json(path)


def windowed_counts(history: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Actions per event-time window; rows later than ``late`` are dropped."""
    return history.withWatermark("at", late).groupBy(F.window("at", window).alias("w"), "action").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "action", "n")


def standing(history: DataFrame) -> DataFrame:
    """(``delta``, ``depth``) after each batch, for the change sets it touched."""
    def fold(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        depth = state.get[0] if state.exists else 0
        for rows in batches:
            for action in rows.sort_values("at")["action"]:
                depth = depth + 1 if action == "apply" else max(0, depth - 1)
        state.update((depth,))
        yield pd.DataFrame({"delta": [key[0]], "depth": [depth]})

    return history.groupBy("delta").applyInPandasWithState(fold, "delta string, depth long", "depth long", "update", GroupStateTimeout.NoTimeout)
