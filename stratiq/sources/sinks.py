"""Sinks: whole-file rewrites, append-only logs and guarded outputs."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """One JSON-lines file in a fixed order: the same rows give the same bytes.
    Meant for ledgers of a size that people keep under version control."""
    df.repartitionByRange(1, *order).sortWithinPartitions(*order).write.mode("overwrite").json(path)


def append_log(spark: SparkSession, path: str, rows: list[tuple[str, str, str, str | None]]) -> None:
    """Appends (delta, action, revision, sha256) with the time of writing."""
    log = spark.createDataFrame(rows, "delta string, action string, revision string, sha256 string")
    log.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_document(spark: SparkSession, path: str, document: dict, overwrite: bool = False) -> str:
    """A JSON document with sorted keys; returns its SHA-256.  An existing file
    with other content is never replaced unless ``overwrite``."""
    body = (json.dumps(document, ensure_ascii=False, sort_keys=True, indent=2) + "\n").encode()
    digest = hashlib.sha256(body).hexdigest()
    p, fs = _file(spark, path)
    if fs.exists(p) and not overwrite:
        if read_document_bytes(spark, path) == body:
            return digest
        raise FileExistsError(path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(body))
    finally:
        out.close()
    return digest


def read_document_bytes(spark: SparkSession, path: str) -> bytes:
    row = spark.read.format("binaryFile").load(path).select("content").head()
    return bytes(row[0])


def write_new(df: DataFrame, path: str) -> None:
    """Writes Parquet where nothing is yet; anything there is an error."""
    df.write.mode("errorifexists").parquet(path)


def report(findings: DataFrame, title: str) -> str:
    """Markdown summary of findings: a table of counts by severity, family and rule."""
    rows = findings.groupBy("severity", "family", "rule").count().orderBy("severity", "family", "rule").collect()  # a row per rule
    lines = [f"# {title}", "", "| severity | family | rule | count |", "|---|---|---|---|"]
    return "\n".join(lines + [f"| {r[0]} | {r[1]} | {r[2]} | {r[3]} |" for r in rows]) + "\n"
