"""Time: intervals, determination, plausibility, innovation, cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.operators.graph import acyclicity, self_loops
from stratiq.operators.temporal import AGO_REFERENCES, UNIT_YEARS, overlaps, span, strictly_younger
from stratiq.plans.findings import Ledger, both, found, rule

col = F.col

#: Vocabularies of temporal expressions and events.
DEEP_TYPES = ("occurrence_date", "observed_taxon_range", "inferred_lineage_range", "divergence_estimate", "event_date", "trait_evidence_date")
TYPES = (*DEEP_TYPES, "publication_date", "classification_validity_period")
UNITS = (*UNIT_YEARS, "generations", "geological_interval")
DETERMINATIONS = ("observed", "inferred", "modelled", "reported_without_basis", "unknown")
COEXISTENCE_EVENTS = (
    "hybridization", "introgression", "gene_flow", "hybrid_origin", "horizontal_transfer", "vector_mediated_transfer", "viral_integration",
    "endosymbiosis", "organelle_capture", "population_absorption", "partial_replacement", "competition", "predation",
    "host_pathogen_relationship", "coevolution", "cultural_transmission", "intergroup_learning", "technological_replacement",
)
INNOVATION_EVENTS = ("innovation", "trait_acquisition")
STRICT_ANCESTRY = ("descends_from",)
MODAL_ANCESTRY = ("possible_ancestor_of", "possible_sampled_ancestor_of", "stem_lineage_of")
ENVELOPE_TYPES = ("observed_taxon_range", "inferred_lineage_range", "occurrence_date")

iv = lambda f: col(f"interval.{f}")


def _times(data: Ledger) -> DataFrame:
    return data["temporal-expressions"].where(col("id").rlike("^TIME-[0-9]{6}$"))


def _usable(data: Ledger) -> DataFrame:
    """Expressions whose interval has a known unit: the others get no further checks."""
    return _times(data).where(col("interval").isNotNull() & iv("unit").isin(*UNITS)).withColumn("ref", F.coalesce(F.nullif(iv("reference_point"), F.lit("")), F.lit("not_stated")))


@rule("time", "TIM1")
def types(data: Ledger) -> DataFrame:
    t = _times(data)
    kind, dated = F.coalesce("temporal_type", F.lit("")), col("calendar_date").isNotNull()
    return both(
        found(t, ~kind.isin(*TYPES), "ERROR", "unknown temporal type"),
        found(t, (kind == "publication_date") & ~dated, "ERROR", "publication without calendar date"),
        found(t, col("interval").isNull() & kind.isin(*DEEP_TYPES), "ERROR", "deep time without interval"),
        found(t, col("interval").isNull() & ~kind.isin(*DEEP_TYPES, "publication_date") & ~dated, "ERROR", "neither interval nor date"),
    )


@rule("time", "TIM2")
def units(data: Ledger) -> DataFrame:
    t = _times(data).where(col("interval").isNotNull())
    unit = F.coalesce(iv("unit"), F.lit(""))
    return both(found(t, unit == "", "ERROR", "no unit"), found(t, (unit != "") & ~unit.isin(*UNITS), "ERROR", "unknown unit"))


@rule("time", "TIM3")
def unbounded(data: Ledger) -> DataFrame:
    return found(_usable(data), iv("oldest_bound").isNull() & iv("youngest_bound").isNull() & (iv("unit") != "geological_interval"), "WARNING", "no bound")


@rule("time", "TIM4")
def inverted(data: Ledger) -> DataFrame:
    calendar = col("ref") == "calendar"
    return found(_usable(data), (calendar & (iv("oldest_bound") > iv("youngest_bound"))) | (~calendar & (iv("oldest_bound") < iv("youngest_bound"))), "ERROR", "inverted interval")


@rule("time", "TIM5")
def negative(data: Ledger) -> DataFrame:
    t = _usable(data).where(col("ref").isin(*AGO_REFERENCES))
    return both(*[found(t, iv(b) < 0, "ERROR", f"negative {b}") for b in ("oldest_bound", "youngest_bound")])


@rule("time", "TIM6")
def geologic(data: Ledger) -> DataFrame:
    t = _usable(data).where(iv("unit") == "geological_interval")
    name = F.coalesce(iv("geological_interval"), F.lit(""))
    return both(found(t, name == "", "ERROR", "geological unit without name"), found(t, iv("oldest_bound").isNotNull() | iv("youngest_bound").isNotNull(), "WARNING", "geological unit with numbers"))


@rule("time", "TIM7")
def no_reference(data: Ledger) -> DataFrame:
    """The key is absent: a null one was stated."""
    keys = F.coalesce(F.json_object_keys(F.get_json_object("raw", "$.interval")), F.expr("cast(array() as array<string>)"))
    return found(_usable(data), (iv("unit") != "geological_interval") & ~F.array_contains(keys, "reference_point"), "INFO", "no reference point")


@rule("time", "TIM8")
def uncertainty(data: Ledger) -> DataFrame:
    t, kind = _usable(data), F.coalesce(col("uncertainty.kind"), F.lit(""))
    size = F.coalesce(*[col(f"uncertainty.{f}") for f in ("plus_minus", "lower", "upper")])
    return both(
        found(t, kind == "", "ERROR", "no uncertainty"),
        found(t, kind.isin("symmetric", "asymmetric") & size.isNull(), "WARNING", "uncertainty without magnitude"),
        found(t, kind.isin("credible_interval", "confidence_interval") & col("uncertainty.level").isNull(), "WARNING", "interval without level"),
    )


@rule("time", "TIM9")
def calibration(data: Ledger) -> DataFrame:
    return found(_usable(data), F.coalesce(col("calibration.system"), F.lit("")) == "", "ERROR", "no calibration")


@rule("time", "TIM10")
def determination(data: Ledger) -> DataFrame:
    t, d = _times(data), col("determination")
    ok = d.isin(*DETERMINATIONS)
    return both(
        found(t, d.isNull(), "ERROR", "no determination"),
        found(t, ~ok, "ERROR", "unknown determination"),
        found(t, (col("temporal_type") == "observed_taxon_range") & d.isin("inferred", "modelled"), "ERROR", "observed range by inference"),
        found(t, col("temporal_type").isin("inferred_lineage_range", "divergence_estimate") & (d == "observed"), "ERROR", "estimate as observation"),
        found(t, (col("method_type") == "molecular_clock") & (d == "observed"), "ERROR", "molecular clock as observation"),
        found(t, d == "reported_without_basis", "WARNING", "reported without basis"),
        found(t, (col("calibration.system") == "molecular_clock") & (d == "observed"), "ERROR", "clock calibration as observation"),
    )


@rule("time", "TIM11")
def inferred_traits(data: Ledger) -> DataFrame:
    each = data["trait-observations"].where(col("observation_basis").isin("phylogenetic_inference", "reconstruction")).select("file", "id", F.explode("temporal_expression_ids").alias("tid"))
    seen = _times(data).where(col("determination") == "observed").select(col("id").alias("tid"))
    return found(each.join(seen, "tid"), F.lit(True), "ERROR", "inference dated as observed", col("tid"))


def envelopes(data: Ledger) -> DataFrame:
    """(``entity``, ``old``, ``young``, ``observed``) of comparable dated envelopes."""
    ok, old, young = span(iv("oldest_bound"), iv("youngest_bound"), iv("unit"), iv("reference_point"))
    t = _times(data).where(col("temporal_type").isin(*ENVELOPE_TYPES)).where(ok).select(col("id").alias("tid"), old.alias("old"), young.alias("young"), (col("determination") == "observed").alias("observed"))
    dated = data["claims"].where((col("record_status") == "active") & (col("predicate") == "dated_to")).select(col("subject_id").alias("entity"), col("object.temporal_expression_id").alias("tid"))
    return dated.join(t, "tid").select("entity", "old", "young", F.coalesce("observed", F.lit(False)).alias("observed"))


def _no_overlap(pairs: DataFrame, data: Ledger, detail: str) -> DataFrame:
    """Findings for pairs (``id``, ``a``, ``b``) none of whose envelopes overlap."""
    e = envelopes(data)
    side = lambda s: e.select(col("entity").alias(s), *[col(c).alias(f"{s}_{c}") for c in ("old", "young", "observed")])
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    g = met.groupBy("id", "a", "b").agg(F.bool_or(overlaps(col("a_old"), col("a_young"), col("b_old"), col("b_young"))).alias("any"), F.bool_and(col("a_observed") & col("b_observed")).alias("observed"))
    return found(g, ~col("any"), F.when(col("observed"), "WARNING").otherwise("ERROR"), F.concat_ws(" ", F.lit(detail), "a", "b"), col("b"))


@rule("time", "TIM12")
def coexistence(data: Ledger) -> DataFrame:
    events = data["events"].where((col("record_status") == "active") & col("event_type").isin(*COEXISTENCE_EVENTS))
    each = events.select("id", F.posexplode("participants").alias("i", "p")).select("id", "i", col("p.entity_id").alias("a"))
    pairs = each.join(each.select("id", col("i").alias("j"), col("a").alias("b")), "id").where("i < j and a <> b").select("id", "a", "b").distinct()
    return _no_overlap(pairs, data, "participants never met:")


@rule("time", "TIM13")
def event_dates(data: Ledger) -> DataFrame:
    ok, old, young = span(iv("oldest_bound"), iv("youngest_bound"), iv("unit"), iv("reference_point"))
    t = _times(data).where(ok).select(col("id").alias("tid"), old.alias("b_old"), young.alias("b_young"), F.coalesce(col("determination") == "observed", F.lit(False)).alias("b_observed"))
    events = data["events"].where((col("record_status") == "active") & col("event_type").isin(*COEXISTENCE_EVENTS))
    dates = events.select("id", F.explode("temporal_expression_ids").alias("tid")).join(t, "tid")
    who = events.select("id", F.explode("participants").alias("p")).select("id", col("p.entity_id").alias("a")).distinct()
    e = envelopes(data).select(col("entity").alias("a"), *[col(c).alias(f"a_{c}") for c in ("old", "young", "observed")])
    met = who.join(e, "a").join(dates, "id")
    g = met.groupBy("id", "a").agg(F.bool_or(overlaps(col("a_old"), col("a_young"), col("b_old"), col("b_young"))).alias("any"), F.bool_and(col("a_observed") & col("b_observed")).alias("observed"))
    return found(g, ~col("any"), F.when(col("observed"), "WARNING").otherwise("ERROR"), "event outside a participant's existence", col("a"))


def ancestry_edges(data: Ledger) -> DataFrame:
    """(``id``, ``scope``, ``src`` descendant, ``dst`` ancestor, ``modal``) of active claims.
    The possible-ancestor predicates run from ancestor to descendant."""
    c = data["claims"].where((col("record_status") == "active") & col("predicate").isin(*STRICT_ANCESTRY, *MODAL_ANCESTRY))
    modal = col("predicate").isin(*MODAL_ANCESTRY)
    return c.select("id", F.when(modal, col("object.entity_id")).otherwise(col("subject_id")).alias("src"), F.when(modal, col("subject_id")).otherwise(col("object.entity_id")).alias("dst"), modal.alias("modal"), col("scope.hypothesis_ids").alias("hyps"))


@rule("time", "TIM14")
def young_ancestors(data: Ledger) -> DataFrame:
    """All envelopes of an ancestor lie after all of its descendant."""
    e = envelopes(data)
    side = lambda s, k: e.select(col("entity").alias(k), *[col(c).alias(f"{s}_{c}") for c in ("old", "young", "observed")])
    met = ancestry_edges(data).select("id", "src", "dst").join(side("d", "src"), "src").join(side("a", "dst"), "dst")
    g = met.groupBy("id", "src", "dst").agg(F.bool_and(strictly_younger(col("a_old"), col("d_young"))).alias("every"), F.bool_and(col("a_observed") & col("d_observed")).alias("observed"))
    return found(g, col("every"), F.when(col("observed"), "WARNING").otherwise("ERROR"), "ancestor younger than descendant", col("dst"))


@rule("time", "TIM15")
def early_innovation(data: Ledger) -> DataFrame:
    """An innovation before all evidence of its trait, its own date set aside."""
    ok, old, young = span(iv("oldest_bound"), iv("youngest_bound"), iv("unit"), iv("reference_point"))
    t = _times(data).where(ok).select(col("id").alias("tid"), old.alias("old"), young.alias("young"), (col("determination") == "observed").alias("observed"))
    events = data["events"].where((col("record_status") == "active") & col("event_type").isin(*INNOVATION_EVENTS))
    dates = events.select("id", F.explode("temporal_expression_ids").alias("tid")).join(t, "tid").groupBy("id").agg(F.min("young").alias("event_young"), F.bool_and("observed").alias("observed"))
    traits = events.select("id", F.explode("result_entity_ids").alias("trait_id")).where(col("trait_id").startswith("TRAIT-"))
    own = events.select(col("id").alias("eid"), F.explode("temporal_expression_ids").alias("tid"))
    seen = data["trait-observations"].select("trait_id", F.explode("temporal_expression_ids").alias("tid")).join(t, "tid")
    met = traits.join(seen, "trait_id").join(own, (col("id") == col("eid")) & (seen["tid"] == own["tid"]), "left_anti")
    g = met.groupBy("id", "trait_id").agg(F.max("old").alias("evidence_old")).join(dates, "id")
    return found(g, col("event_young") > col("evidence_old"), F.when(col("observed"), "ERROR").otherwise("INFO"), "innovation before its trait's evidence", col("trait_id"))


@rule("time", "TIM16")
def own_ancestor(data: Ledger) -> DataFrame:
    return found(self_loops(ancestry_edges(data)), F.lit(True), "ERROR", "own ancestor", col("dst"))


@rule("time", "TIM17")
def cycles(data: Ledger) -> DataFrame:
    """Acyclic in every hypothesis; the union of rivals may hold cycles."""
    edges = ancestry_edges(data).where("src <> dst")
    h = data["hypotheses"].where(col("record_status") == "active")
    nothing = F.expr("cast(array() as array<string>)")
    member = h.select(col("id").alias("scope"), F.explode(F.array_except(F.array_union(F.coalesce("included_claim_ids", nothing), F.coalesce("required_claim_ids", nothing)), F.coalesce("excluded_claim_ids", nothing))).alias("cid"))
    said = edges.select(F.explode("hyps").alias("scope"), col("id").alias("cid"))
    left_out = h.select(col("id").alias("scope"), F.explode("excluded_claim_ids").alias("cid"))
    scopes = member.unionByName(said).distinct().join(left_out, ["scope", "cid"], "left_anti")
    claimed = scopes.select("cid").distinct()
    free = edges.join(claimed, edges["id"] == claimed["cid"], "left_anti").select(F.lit("(no hypothesis)").alias("scope"), "src", "dst", "modal")
    inside = edges.join(scopes, edges["id"] == scopes["cid"]).select("scope", "src", "dst", "modal")
    c = acyclicity(inside.unionByName(free))
    return c.select("severity", F.lit(None).cast("string").alias("file"), col("node").alias("record_id"), col("scope").alias("other_id"), F.concat(F.lit("cycle of "), "cycle").alias("detail"))


@rule("time", "TIM18")
def incomparable(data: Ledger) -> DataFrame:
    ok, _, _ = span(iv("oldest_bound"), iv("youngest_bound"), iv("unit"), iv("reference_point"))
    n = _times(data).where(col("interval").isNotNull() & ~F.coalesce(ok, F.lit(False))).agg(F.count(F.lit(1)).alias("n"))
    return n.where("n > 0").select(F.lit("INFO").alias("severity"), F.lit("temporal-expressions.jsonl").alias("file"), F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("other_id"), F.concat(col("n").cast("string"), F.lit(" intervals cannot be compared")).alias("detail"))
