"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratiq.session import scratch


scratch_path = scratch


def materialise(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    outlives the executors that computed it.  ``few`` rebalances what is much
    smaller than its input, so that it does not end in many small files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.hint("rebalance") if few else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: what is worked out of them is several times their size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
