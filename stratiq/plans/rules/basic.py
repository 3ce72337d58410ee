"""Built-in families: schema, references, coverage, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.functions.text import well_formed_id
from stratiq.operators.relational import dangling
from stratiq.plans.findings import Ledger, both, found, rule
from stratiq.sources.ledger import ledger
from stratiq.sources.schemas import FAMILIES

col = F.col

#: Required fields by family.
REQUIRED = {
    "sections": ("id", "title", "received_at", "original_content_path", "content_hash", "schema_version", "dataset_revision"),
    "passages": ("id", "section_id", "ordinal", "text", "character_offsets"),
    "mentions": ("id", "section_id", "passage_id", "original_text", "normalized_form", "mention_type", "character_offsets", "resolution"),
    "sources": ("id", "title", "source_type", "verification_status"),
    "occurrences": ("id", "entity_id", "location_precision", "evidence_basis"),
    "claims": ("id", "claim_type", "subject_id", "predicate", "object"),
    "evidence": ("id", "evidence_type", "description", "source_id", "supports_claim_ids", "challenges_claim_ids"),
    "events": ("id", "event_type", "participants"),
    "hypotheses": ("id", "name", "included_claim_ids"),
    "conflict-groups": ("id", "name", "description"),
    "temporal-expressions": ("id", "temporal_type"),
    "issues": ("id", "issue_type", "title", "severity", "affects", "resolution"),
}


@rule("schema", "SCH1")
def schema(data: Ledger) -> DataFrame:
    """Required fields, the one-object-branch rule, and keys no schema knows."""
    parts = []
    for family, fields in REQUIRED.items():
        df = data[family]
        missing = F.array_compact(F.array(*[F.when(col(f).isNull(), f) for f in fields]))
        parts.append(found(df.withColumn("missing", missing), F.size("missing") > 0, "ERROR", F.concat(F.lit("missing: "), F.array_join("missing", ", "))))
    branches = F.size(F.array_compact(F.array(*[F.when(col(f"object.{b}").isNotNull(), b) for b in ("entity_id", "temporal_expression_id", "value", "category")])))
    claims = data["claims"]
    parts.append(found(claims, col("object").isNotNull() & (branches > 1), "ERROR", "more than one object branch"))
    for family in FAMILIES:
        df = data[family]
        known = [c for c in df.columns if c not in ("file", "raw")]
        extra = F.array_except(F.json_object_keys("raw"), F.array(*[F.lit(k) for k in known]))
        parts.append(found(df.withColumn("extra", extra), F.size("extra") > 0, "ERROR", F.concat(F.lit("unknown: "), F.array_join("extra", ", "))))
    return both(*parts)


@rule("references", "REF1")
def malformed_ids(data: Ledger) -> DataFrame:
    return found(ledger(data), ~well_formed_id(col("id")), "ERROR", "malformed id")


@rule("references", "REF2")
def repeated_ids(data: Ledger) -> DataFrame:
    seen = ledger(data).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("file")), ", ").alias("files"))
    return found(seen, col("n") > 1, "ERROR", col("files"))


@rule("references", "REF3")
def dangling_ids(data: Ledger) -> DataFrame:
    """Entries of top-level ``*_ids`` lists that name no record.  Scalar ids and
    nested lists are not looked at here."""
    ids = ledger(data).select("id")
    parts = []
    for df in data.values():
        lists = [f.name for f in df.schema.fields if f.name.endswith("_ids") and f.dataType.simpleString() == "array<string>"]
        if lists:
            each = df.select("file", "id", F.explode(F.array_distinct(F.flatten(F.array(*[F.coalesce(c, F.expr("cast(array() as array<string>)")) for c in lists])))).alias("other_id"))
            parts.append(dangling(each, "other_id", ids, "id"))
    lost = parts[0]
    for p in parts[1:]:
        lost = lost.unionByName(p)
    return found(lost, F.lit(True), "ERROR", "names no record", col("other_id"))


@rule("coverage", "COV1")
def undisposed(data: Ledger) -> DataFrame:
    return found(data["mentions"], col("disposition").isNull() | (col("disposition") == ""), "ERROR", "no disposition")


@rule("coverage", "COV2")
def unexplained(data: Ledger) -> DataFrame:
    return found(data["mentions"], (col("disposition") == "discarded") & (F.coalesce(F.size("notes"), F.lit(0)) <= 0), "ERROR", "discarded without notes")


@rule("provenance", "PRV1")
def section_sources(data: Ledger) -> DataFrame:
    return found(data["sources"], (col("source_type") == "section_provided") & ~col("verification_status").eqNullSafe("pending_verification"), "ERROR", "provided by a section, not pending")


@rule("provenance", "PRV2")
def untraceable(data: Ledger) -> DataFrame:
    none = lambda c: col(c).isNull() | (col(c) == "")
    return found(data["sources"], (col("source_type") != "section_provided") & none("doi") & none("url"), "WARNING", "neither DOI nor URL")


@rule("provenance", "PRV3")
def floating(data: Ledger) -> DataFrame:
    return found(data["mentions"], col("passage_id").isNull() | (col("passage_id") == ""), "ERROR", "no passage")


@rule("provenance", "PRV4")
def guides(data: Ledger) -> DataFrame:
    """Needs a ``guides`` frame (``path``, ``sha256`` as recorded, ``archived``) and a
    ``guide-files`` frame (``path``, ``sha256`` as found); without them, nothing to say."""
    if "guides" not in data:
        return found(data["sources"], F.lit(False), "ERROR")
    kept = data["guide-files"].select("path", col("sha256").alias("now"))
    met = data["guides"].join(kept, "path", "left").withColumnRenamed("path", "id")
    severity = F.when(col("now").isNull() | col("archived"), "ERROR").otherwise("WARNING")
    return found(met, col("now").isNull() | (col("now") != col("sha256")), severity, F.when(col("now").isNull(), "guide is gone").otherwise("guide differs from its recorded hash"))
