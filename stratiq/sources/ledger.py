"""Scans of ledgers, corpus tables and file layers."""

from __future__ import annotations

import itertools
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiq.functions.text import squeeze
from stratiq.session import settled
from stratiq.sources.schemas import FAMILIES, ddl


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _names(spark: SparkSession, pattern: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []]


def read_family(spark: SparkSession, path: str, family: str) -> tuple[DataFrame, DataFrame]:
    """(records, findings) of one JSON-lines file: blank lines are skipped, a
    malformed line is an ERROR with its text and the others are kept; a missing
    file is an ERROR and no records.  Records carry ``file`` and ``raw``."""
    columns = ddl(family)
    empty = spark.createDataFrame([], f"{columns}, file string, raw string")
    findings = "severity string, family string, rule string, file string, record_id string, other_id string, detail string"
    if not _exists(spark, path):
        return empty, spark.createDataFrame([("ERROR", "scan", "S01", f"{family}.jsonl", None, None, "missing file")], findings)
    lines = spark.read.text(path).where(squeeze(F.col("value")) != "")
    parsed = lines.select(F.from_json("value", f"{columns}, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}).alias("r"), F.col("value").alias("raw"))
    bad = F.col("r._bad").isNotNull() | F.col("r").isNull()
    records = parsed.where(~bad).select("r.*", F.lit(f"{family}.jsonl").alias("file"), "raw").drop("_bad")
    wrong = parsed.where(bad).select(F.lit("ERROR").alias("severity"), F.lit("scan").alias("family"), F.lit("S01").alias("rule"), F.lit(f"{family}.jsonl").alias("file"), F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("other_id"), F.concat(F.lit("invalid JSON: "), F.substr("raw", F.lit(1), F.lit(80))).alias("detail"))
    return records, wrong


def read_ledger(spark: SparkSession, records: str, views: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(data, findings) of a directory of ledger files; families whose file is
    absent are empty.  On a name clash the records' file wins over the views'.
    A file of no known family is an ERROR and is not read."""
    data: dict[str, DataFrame] = {}
    findings: DataFrame | None = None
    for family in FAMILIES:
        path = f"{records}/{family}.jsonl"
        if not _exists(spark, path) and views:
            path = f"{views}/{family}.jsonl"
        found, wrong = read_family(spark, path, family)
        data[family] = found
        if _exists(spark, path):
            findings = wrong if findings is None else findings.unionByName(wrong)
    if findings is None:
        _, findings = read_family(spark, f"{records}/*.jsonl", "claims")
    strange = sorted(name for name in _names(spark, f"{records}/*.jsonl") if name.removesuffix(".jsonl") not in FAMILIES)
    unknown = spark.createDataFrame([("ERROR", "scan", "SCH4", name, None, None, "no schema for this file") for name in strange], findings.schema)
    return data, findings.unionByName(unknown)


def frame(spark: SparkSession, family: str, records: list[dict]) -> DataFrame:
    """A family from Python records, through the same parser as files."""
    return parsed(spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in records], "raw string"), family)


def parsed(texts: DataFrame, family: str) -> DataFrame:
    """A family from JSON texts (``raw``), in its declared schema."""
    return texts.select(F.from_json("raw", ddl(family)).alias("r"), "raw").select("r.*", F.lit(f"{family}.jsonl").alias("file"), "raw")


def dataset(spark: SparkSession, families: dict[str, list[dict]]) -> dict[str, DataFrame]:
    """A whole ledger from Python records."""
    return {f: frame(spark, f, families.get(f, [])) for f in FAMILIES}


def ledger(data: dict[str, DataFrame]) -> DataFrame:
    """All records of all families as (``file``, ``id``, ``prefix``, ``record_status``, ``raw``);
    other tables that stand beside them (counts, change sets) are passed over."""
    out = None
    for df in data.values():
        if not {"file", "id", "record_status", "raw"} <= set(df.columns):
            continue
        part = df.select("file", "id", F.substring_index("id", "-", 1).alias("prefix"), "record_status", "raw")
        out = part if out is None else out.unionByName(part)
    return out


def active(df: DataFrame, strict: bool = False) -> DataFrame:
    """Active records; a missing status counts as active unless ``strict``."""
    status = F.col("record_status")
    return df.where(status == "active") if strict else df.where(F.coalesce(status, F.lit("active")) == "active")


def read_csv_strict(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header whose ragged rows abort the read."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", multiLine=True)


def read_csv_tolerant(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV whose short rows are padded and long rows trimmed; ``_ragged`` keeps such a row's text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_ragged"]])
    return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_ragged", multiLine=True)


def read_claims_registry(spark: SparkSession, directory: str, columns: list[str], key: str = "#") -> tuple[DataFrame, DataFrame]:
    """(rows with their ``section``, repeated keys) of a directory of CSV files, one per section."""
    rows = read_csv_strict(spark, f"{directory}/*.csv", columns).withColumn("section", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1))
    return rows, rows.groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def markdown_tables(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Pipe tables of Markdown texts: (``key``, ``table_no``, ``row_no``, ``header``,
    ``cells``).  A table is a header line, a separator line and the lines that
    follow with pipes; ``\\|`` is a literal bar."""
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    piped = F.col("line").rlike(r"^\s*\|.*\|\s*$")
    w = Window.partitionBy(key).orderBy("line_no")
    grouped = lines.withColumn("piped", piped).withColumn("island", F.sum(F.when(piped, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("piped")
    bare = F.regexp_replace(F.col("line"), r"^\s*\||\|\s*$", "")
    cells = F.transform(F.split(bare, r"(?<!\\)\|"), lambda c: squeeze(F.replace(c, F.lit("\\|"), F.lit("|"))))
    island = Window.partitionBy(key, "island").orderBy("line_no")
    rows = grouped.withColumn("cells", cells).withColumn("r", F.row_number().over(island))
    whole = Window.partitionBy(key, "island").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("header", F.first("cells").over(whole)).withColumn("second", F.nth_value("line", 2).over(whole))
    body = rows.where((F.col("r") > 2) & F.col("second").rlike(r"^\s*\|(\s*:?-+:?\s*\|)+\s*$"))
    number = F.dense_rank().over(Window.partitionBy(key).orderBy("island"))
    return body.select(key, number.alias("table_no"), (F.col("r") - 2).alias("row_no"), "header", "cells")


def layer_files(spark: SparkSession, path: str) -> DataFrame:
    """(``path``, ``sha256``, ``bytes``) of all files below a directory."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return read.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def read_metadata(spark: SparkSession, base: str) -> dict:
    """What a layer says of itself: ``VERSION`` and ``manifest.json``, each if there."""
    text = lambda name: next((r["value"].strip() for r in spark.read.text(f"{base}/{name}", wholetext=True).collect()), None) if _exists(spark, f"{base}/{name}") else None
    told = json.loads(text("manifest.json") or "{}")
    return {"corpus": told.get("corpus"), "version": text("VERSION"), "cutoff": told.get("fecha_de_corte_bibliografico"), "declared_state": told.get("estado"), "counts": told.get("counts")}


def read_json_tree(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, findings) of all ``.json`` and ``.jsonl`` files below a directory:
    (``file``, ``raw``) of every object, be it a line, a document or an entry of
    an array; what is no JSON is an ERROR, what is no object is passed over."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}")
    lines = files.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    split = lines.where(F.col("file").endswith(".jsonl")).select("file", F.posexplode(F.split("value", r"\r?\n")).alias("n", "value")).where(squeeze(F.col("value")) != "").select("file", (F.col("n") + 1).alias("line"), "value")
    each = split.unionByName(lines.where(F.col("file").endswith(".json")).select("file", F.lit(None).cast("int").alias("line"), "value"))
    v = each.withColumn("v", F.try_parse_json("value"))
    kind = F.schema_of_variant("v")
    view = f"__tree_{id(each)}"
    v.where(kind.startswith("ARRAY") & ~F.col("file").endswith(".jsonl")).createOrReplaceTempView(view)
    entries = spark.sql(f"SELECT t.file, e.value AS v FROM {view} t, LATERAL variant_explode(t.v) AS e")
    spark.catalog.dropTempView(view)
    records = v.select("file", "v").unionByName(entries).where(F.schema_of_variant("v").startswith("OBJECT")).select("file", F.to_json("v").alias("raw"))
    wrong = v.where("v is null").select(F.lit("ERROR").alias("severity"), "file", F.concat_ws(" ", F.lit("invalid JSON"), F.concat(F.lit("in line "), F.col("line").cast("string"))).alias("detail"))
    return records, wrong


def successions(rows: DataFrame, retired: str, successors: str) -> DataFrame:
    """(``retired``, ``successors``) of a table whose successors are ``;``-separated."""
    parts = F.filter(F.transform(F.split(successors, ";"), squeeze), lambda x: x != "")
    return rows.select(F.col(retired).alias("retired"), parts.alias("successors"))


def walk(records: DataFrame, ident: str = "id", raw: str = "raw") -> DataFrame:
    """(``id``, ``path``, ``key``, ``value``) of every key at every depth of JSON texts.

    Each level of nesting is one variant explode, written down before the next,
    so that no level is worked out twice; it ends with the level below which
    nothing is nested."""
    spark = records.sparkSession
    level = records.select(F.col(ident).alias("id"), F.lit("").alias("path"), F.col(raw).alias("value"))
    out = None
    for depth in itertools.count():
        view = f"__walk_{id(records)}_{depth}"
        level.select("id", "path", F.try_parse_json("value").alias("v")).createOrReplaceTempView(view)
        each = spark.sql(f"SELECT t.id, concat(t.path, CASE WHEN e.key IS NULL THEN concat('[', e.pos, ']') WHEN t.path = '' THEN e.key ELSE concat('.', e.key) END) AS path, e.key AS key, e.value AS v FROM {view} t, LATERAL variant_explode(t.v) AS e")
        spark.catalog.dropTempView(view)
        named = settled(each.select("id", "path", "key", F.to_json("v").alias("value"), F.schema_of_variant("v").alias("kind")))
        out = named if out is None else out.unionByName(named)
        level = named.where(F.col("kind").startswith("OBJECT") | F.col("kind").startswith("ARRAY")).select("id", "path", "value")
        if level.isEmpty():
            return out


_WALKED: dict[str, tuple[list[DataFrame], DataFrame]] = {}


def walked(data: dict[str, DataFrame], name: str, records: DataFrame) -> DataFrame:
    """:func:`walk` of ``records``, made once for all rules that look at ``name`` of
    the same ledger."""
    frames = list(data.values())
    kept = _WALKED.get(name)
    if kept is None or len(kept[0]) != len(frames) or any(a is not b for a, b in zip(kept[0], frames, strict=True)):
        kept = _WALKED[name] = (frames, walk(records))
    return kept[1]
