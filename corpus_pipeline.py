"""The corpus pipeline: ``documents`` from raw to packed, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiq.llm import toxicity
from stratiq.llm.common import materialise, table
from stratiq.llm.decontam import uncontaminated
from stratiq.llm.ngramjoin import one_per_group
from stratiq.llm.packing import pack_documents
from stratiq.llm.secrets import redact_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold.

    Null and empty texts are scored too and repeated rows all treated alike; an
    empty table stays empty; a column of any name in ``docs`` is left as it is.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = "__toxicity"
    while name in docs.columns:
        name += "_"
    return toxicity.score(docs, model, score_col=name).where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by word five-grams at 0.8 or more.

    Texts without words and rows without an id all stay; equal rows (id and
    text) are one, different texts of one id are never merged by their id.
    """
    return one_per_group(docs, size=5, numerator=80, denominator=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no near copy of a benchmark item.

    Null and empty texts and items match nothing; nothing is merged.
    """
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark.

    Null texts stay null; rows keep their number; other columns are not read.
    """
    return redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in bins: null and empty texts are pieces of one
    byte, long texts several pieces, repeated rows packed one by one."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Compression distances have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
