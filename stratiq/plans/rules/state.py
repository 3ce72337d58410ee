"""State: conservation, deprecation, migrations, epistemic axes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiq.functions.text import ids_in, key_tokens, version_order
from stratiq.plans.findings import Ledger, both, found, rule
from stratiq.sources.ledger import ledger, walked

col = F.col

#: Statuses, axes and field names of the state family.
CLOSED = ("deprecated", "merged", "replaced", "archived")
AXES = {
    "acceptance": ("broad_consensus", "majority_acceptance", "mixed_acceptance", "minority_position", "not_assessed", "abandoned"),
    "evidence_strength": ("high", "medium", "low", "unknown"),
    "resolution": ("resolved", "partially_resolved", "unresolved", "insufficient_information"),
    "historical_status": ("current", "historical", "superseded", "rejected"),
}
AXIS_TOKENS = ("acceptance", "evidence_strength", "resolution", "historical_status", "record_status", "view_role")
COLLAPSED = (
    "epistemic_status", "epistemic_state", "epistemic_level", "epistemic_score", "epistemic_summary", "epistemics", "status_epistemico",
    "estado_epistemico", "overall_status", "combined_status", "global_status", "consolidated_status", "overall_score", "reliability_score",
    "trust_score", "quality_score", "truth_value", "truth_score",
)
CONFIDENCE = "(confidence|confianza|certainty|certeza|credence|probabilit|probabilid|likelihood|verosimilit|belief|creencia|fiabilidad)"
CONFIDENCE_SAFE = ("uncertainty", "uncertainties", "incertidumbre", "unknown")
SUCCESSOR_KEYS = ("superseded_by", "superseded_by_id", "replaced_by", "replaced_by_id", "replacement_id", "merged_into", "merged_into_id", "successor_id")
PLACEHOLDERS = ("", "-", "--", "?", "n/a", "na", "tbd", "todo", "pendiente", "sin razón", "sin razon", "por determinar", "sin especificar", "ninguna", "none", "null")
REMOVAL = "(removed|deleted|purged|dropped|erased|borrad|elimin)"
LEAST_REASON = 4


def successor(records: DataFrame) -> DataFrame:
    """``records`` (``id``, ``raw``) with ``successor`` (first key that names one, else
    another record's id in the notes) and ``reason`` (the first real one)."""
    get = lambda k: F.nullif(F.trim(F.get_json_object("raw", f"$.{k}")), F.lit(""))
    notes = F.concat_ws(" ", F.get_json_object("raw", "$.deprecation_reason"), F.get_json_object("raw", "$.reason"), F.get_json_object("raw", "$.notes"))
    named = F.try_element_at(F.filter(ids_in(notes), lambda x: x != col("id")), F.lit(1))
    texts = F.array_compact(F.concat(F.array(get("deprecation_reason"), get("reason")), F.coalesce(F.from_json(F.get_json_object("raw", "$.notes"), "array<string>"), F.array(get("notes")))))
    real = F.filter(texts, lambda x: ~F.lower(F.trim(x)).isin(*PLACEHOLDERS) & (F.length(F.trim(x)) >= LEAST_REASON))
    return records.withColumn("successor", F.coalesce(*[get(k) for k in SUCCESSOR_KEYS], named)).withColumn("why", F.try_element_at(real, F.lit(1)))


@rule("state", "STA1")
def conservation(data: Ledger) -> DataFrame:
    """Needs a ``snapshot-counts`` frame (``grp``, ``was``, ``undone``); without one, nothing to say."""
    if "snapshot-counts" not in data:
        return found(data["claims"], F.lit(False), "ERROR")
    now = ledger(data).groupBy(F.regexp_replace("file", r"\.jsonl$", "").alias("grp")).agg(F.count(F.lit(1)).alias("now"))
    met = data["snapshot-counts"].join(now, "grp", "left").select(col("grp").alias("id"), "was", "undone", F.coalesce("now", F.lit(0)).alias("now"))
    return found(met, col("now") < col("was") - col("undone"), "ERROR", F.concat_ws(" ", F.lit("fewer than the snapshot's"), col("was").cast("string")))


@rule("state", "STA2")
def removals(data: Ledger) -> DataFrame:
    """Needs a ``deltas`` frame (``id``, ``raw``, ``applied``)."""
    if "deltas" not in data:
        return found(data["claims"], F.lit(False), "ERROR")
    each = data["deltas"].select("id", F.explode(F.from_json("raw", "map<string,string>")).alias("k", "v"))
    return found(each, F.lower("k").rlike(REMOVAL) & ~F.coalesce(F.trim("v"), F.lit("")).isin("", "[]", "{}", "null", "0", "false"), "ERROR", "declares a removal", col("k"))


#: Fixed value: keys of a change set that list record ids.
DELTA_KEYS = ("records_added", "records_updated", "records_deprecated", "claims_added", "events_added", "hypotheses_added", "issues_added", "issues_resolved")


@rule("state", "STA3")
def declared(data: Ledger) -> DataFrame:
    if "deltas" not in data:
        return found(data["claims"], F.lit(False), "ERROR")
    each = data["deltas"].where(F.coalesce("applied", F.lit(True))).select("id", F.explode(F.from_json("raw", "map<string,string>")).alias("k", "v")).where(col("k").isin(*DELTA_KEYS))
    lists = each.withColumn("ids", F.from_json("v", "array<string>"))
    odd = found(each, ~F.trim("v").startswith("["), "ERROR", "not a list", col("k"))
    lost = lists.select("id", F.explode("ids").alias("x")).join(ledger(data).select(col("id").alias("x")), "x", "left_anti")
    return both(odd, found(lost, F.lit(True), "ERROR", "declared record is gone", col("x")))


def _closed(data: Ledger) -> DataFrame:
    return successor(ledger(data).where(col("record_status").isin(*CLOSED)))


@rule("state", "STA4")
def no_successor(data: Ledger) -> DataFrame:
    return found(_closed(data), col("record_status").isin("merged", "replaced") & col("successor").isNull(), "ERROR", F.when(F.get_json_object("raw", "$.epistemic_dimensions.historical_status") == "superseded", "the idea is superseded; the record needs a successor").otherwise("no successor"))


@rule("state", "STA5")
def no_reason(data: Ledger) -> DataFrame:
    return found(_closed(data), col("record_status").isin("deprecated", "archived") & col("successor").isNull() & col("why").isNull(), "ERROR", "closed without successor or reason")


@rule("state", "STA6")
def lost_successor(data: Ledger) -> DataFrame:
    met = _closed(data).where("successor is not null").join(ledger(data).select(col("id").alias("successor")), "successor", "left_anti")
    return found(met, F.lit(True), "WARNING", "successor is not there", col("successor"))


def _versions(data: Ledger) -> DataFrame:
    """Adjacent schema versions in use, in SemVer order."""
    v = ledger(data).select(F.get_json_object("raw", "$.schema_version").alias("version")).where(col("version").rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$")).distinct()
    return v.withColumn("before", F.lag("version").over(Window.orderBy(version_order(col("version"))))).where("before is not null")  # a row per version


@rule("state", "STA7")
def migrations(data: Ledger) -> DataFrame:
    """Needs a ``migrations`` frame (``text``) when several versions coexist."""
    v = _versions(data)
    if "migrations" in data:
        docs = data["migrations"].select("text")
        v = v.join(docs, F.contains("text", col("before")) & F.contains("text", col("version")), "left_anti")
    return found(v.withColumn("id", col("version")), F.lit(True), "ERROR", F.concat(F.lit("no migration from "), "before"))


@rule("state", "STA8")
def recorded_migrations(data: Ledger) -> DataFrame:
    if "deltas" not in data:
        return found(data["claims"], F.lit(False), "ERROR")
    told = F.contains("raw", F.lit("MIGRATE_SCHEMA"))
    none = "migrations" not in data or data["migrations"].isEmpty()
    return found(data["deltas"], told & F.lit(none), "ERROR", "migration recorded, not documented")


@rule("state", "STA9")
def revision_chain(data: Ledger) -> DataFrame:
    if "deltas" not in data:
        return found(data["claims"], F.lit(False), "ERROR")
    n = lambda k: F.regexp_extract(F.get_json_object("raw", f"$.{k}"), r"^REV-([0-9]{6})$", 1).cast("long")
    d = data["deltas"].select("id", n("dataset_revision_before").alias("a"), n("dataset_revision_after").alias("b"), F.get_json_object("raw", "$.revision_gap_reason").alias("told")).where("b is not null")
    chain = d.withColumn("prev", F.lag("b").over(Window.orderBy("b")))  # a row per change set
    return found(chain, col("prev").isNotNull() & (col("a") != col("prev")), F.when(col("told").isNotNull(), "INFO").otherwise("ERROR"), "revision chain jumps")


def _keys(data: Ledger) -> DataFrame:
    return walked(data, "ledger", ledger(data)).where("key is not null")


@rule("state", "STA10")
def collapsed(data: Ledger) -> DataFrame:
    return found(_keys(data), F.lower("key").isin(*COLLAPSED), "ERROR", "field collapses axes", col("path"))


@rule("state", "STA11")
def confidence(data: Ledger) -> DataFrame:
    piece = F.exists(key_tokens(col("key")), lambda t: t.rlike(CONFIDENCE) & ~t.isin(*CONFIDENCE_SAFE))
    return found(_keys(data), piece, "ERROR", "field puts a number on certainty", col("path"))


@rule("state", "STA12")
def mixed(data: Ledger) -> DataFrame:
    held = F.filter(F.array(*[F.lit(a) for a in AXIS_TOKENS]), lambda a: F.contains(F.lower(col("key")), a))
    return found(_keys(data), (F.size(held) >= 2), "ERROR", "field mixes axes", col("path"))


@rule("state", "STA13")
def axes(data: Ledger) -> DataFrame:
    k = _keys(data)
    top, inside = ~F.contains("path", F.lit(".")), F.startswith("path", F.lit("epistemic_dimensions."))
    name = F.regexp_replace("path", r"^epistemic_dimensions\.", "")
    return both(
        found(k, top & col("key").isin(*AXES) & ~((col("key") == "resolution") & col("kind").startswith("OBJECT")), "ERROR", "axis at the root", col("path")),
        found(k, inside & (name == "record_status"), "ERROR", "record status inside the axes", col("path")),
        found(k, inside & ~name.isin(*AXES, "evidence_strength_reason", "record_status"), "ERROR", "unknown axis", col("path")),
    )


@rule("state", "STA14")
def strength_reason(data: Ledger) -> DataFrame:
    r = ledger(data).select("file", "id", F.get_json_object("raw", "$.epistemic_dimensions.evidence_strength").alias("s"), F.get_json_object("raw", "$.epistemic_dimensions.evidence_strength_reason").alias("why"))
    empty = F.lower(F.trim(F.coalesce("why", F.lit("")))).isin(*PLACEHOLDERS) | (F.length(F.trim(F.coalesce("why", F.lit("")))) < LEAST_REASON)
    return found(r, col("s").isNotNull() & (col("s") != "unknown") & empty, "ERROR", "strength without a real reason")


@rule("state", "STA15")
def mirrored(data: Ledger) -> DataFrame:
    """Two axes that always move together are one: every superseded idea is a replaced record."""
    r = ledger(data).select("record_status", F.get_json_object("raw", "$.epistemic_dimensions.historical_status").alias("h")).where(col("h").isin("superseded", "rejected"))
    n = r.agg(F.count(F.lit(1)).alias("n"), F.count_if(col("record_status") == "replaced").alias("m")).withColumn("id", F.lit(None).cast("string"))
    return found(n, (col("n") >= 2) & (col("n") == col("m")), "WARNING", "superseded ideas are all replaced records")


@rule("state", "STA16")
def legacy(data: Ledger) -> DataFrame:
    return found(ledger(data), col("record_status") == "superseded", "ERROR", "legacy record status")
