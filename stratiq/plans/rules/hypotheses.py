"""Hypotheses: requirements, incompatible choices, topology, rivals, links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.operators.graph import cycle_members, multi_parent
from stratiq.operators.relational import both_selected, rivals
from stratiq.plans.findings import Ledger, both, found, rule

col = F.col

#: Conflict predicates, ancestry predicates and formats of trees.
HARD = ("incompatible_with", "rejects_claim")
SOFT = ("alternative_to",)
MODAL = ("possible_ancestor_of", "possible_sampled_ancestor_of")
TREE_FORMATS = ("newick", "clade_list")


def _none():
    return F.expr("cast(array() as array<string>)")


def _list(c: str):
    return F.coalesce(col(c), _none())


@rule("hypotheses", "HYR1")
def requirements(data: Ledger) -> DataFrame:
    h = data["hypotheses"]
    inc, req, exc = (_list(f"{k}_claim_ids") for k in ("included", "required", "excluded"))
    status = data["claims"].select(col("id").alias("x"), F.coalesce("record_status", F.lit("active")).alias("st"))
    needs = h.select("file", "id", F.explode(req).alias("x")).join(status, "x")
    holds = h.select("file", "id", F.explode(F.array_except(inc, req)).alias("x")).join(status, "x")
    return both(
        found(h, F.size(F.array_except(req, inc)) > 0, "ERROR", "required but not included"),
        found(h, F.size(F.array_intersect(req, exc)) > 0, "ERROR", "required and excluded"),
        found(h, F.size(F.array_intersect(inc, exc)) > 0, "ERROR", "included and excluded"),
        found(needs, col("st") != "active", "WARNING", "inactive requirement", col("x")),
        found(holds, col("st") != "active", "WARNING", "inactive inclusion", col("x")),
    )


def selections(data: Ledger) -> DataFrame:
    """(``owner``, ``member``) of hypotheses' and views' chosen claims."""
    h = data["hypotheses"].select(col("id").alias("owner"), F.explode(_list("included_claim_ids")).alias("member"))
    for v in ("phylogenetic-views", "classification-views"):
        h = h.unionByName(data[v].select(col("id").alias("owner"), F.explode(_list("selected_claim_ids")).alias("member")))
    return h.distinct()


@rule("hypotheses", "HYR2")
def incompatible(data: Ledger) -> DataFrame:
    c = data["claims"].select("predicate", col("subject_id").alias("a"), col("object.entity_id").alias("b")).where(col("a").startswith("CLAIM-") & col("b").startswith("CLAIM-"))
    picks = selections(data)
    named = lambda df: df.withColumnRenamed("owner", "id")
    hard = named(both_selected(c.where(col("predicate").isin(*HARD)).select("a", "b"), picks))
    soft = named(both_selected(c.where(col("predicate").isin(*SOFT)).select("a", "b"), picks))
    pair = F.concat_ws(" ", "a", "b")
    return both(found(hard, F.lit(True), "ERROR", pair, col("b")), found(soft, F.lit(True), "WARNING", pair, col("b")))


def selected_edges(data: Ledger) -> DataFrame:
    """(``scope``, ``src``, ``dst``, ``modal``): ancestry among an owner's choices."""
    c = data["claims"].where(col("predicate").isin("descends_from", *MODAL))
    modal = col("predicate").isin(*MODAL)
    e = c.select(col("id").alias("member"), F.when(modal, col("object.entity_id")).otherwise(col("subject_id")).alias("src"), F.when(modal, col("subject_id")).otherwise(col("object.entity_id")).alias("dst"), modal.alias("modal"))
    return selections(data).join(e, "member").select(col("owner").alias("scope"), "src", "dst", "modal")


@rule("hypotheses", "HYR3")
def topology(data: Ledger) -> DataFrame:
    e = selected_edges(data)
    strict = cycle_members(e.where("not modal"), ("scope",))
    modal = cycle_members(e.where("modal"), ("scope",))
    named = lambda df: df.select(col("scope").alias("id"), "node", "cycle")
    return both(found(named(strict), F.lit(True), "ERROR", F.concat(F.lit("cycle of "), "cycle"), col("node")), found(named(modal), F.lit(True), "WARNING", F.concat(F.lit("modal cycle of "), "cycle"), col("node")))


@rule("hypotheses", "HYR4")
def reticulation(data: Ledger) -> DataFrame:
    e = selected_edges(data).where("not modal")
    many = e.groupBy(col("scope").alias("id"), "src").agg(F.countDistinct("dst").alias("n")).where("n > 1")
    v = data["phylogenetic-views"].where(col("topology.format").isin(*TREE_FORMATS)).select("file", "id", col("topology.reticulation").alias("declared"), F.size(_list("simplifications")).alias("told"))
    met = v.join(many, "id")
    undeclared = ~F.coalesce("declared", F.lit(False)) & (col("told") == 0)
    return both(found(met, undeclared, "ERROR", "reticulation flattened", col("src")), found(met, ~undeclared, "WARNING", "reticulation flattened, declared", col("src")))


@rule("hypotheses", "HYR5")
def ignored_scope(data: Ledger) -> DataFrame:
    said = data["claims"].select("file", "id", F.explode("scope.hypothesis_ids").alias("h"))
    known = data["hypotheses"].select(col("id").alias("h"), F.explode(F.array_union(_list("included_claim_ids"), F.array_union(_list("required_claim_ids"), _list("excluded_claim_ids")))).alias("id"))
    there = data["hypotheses"].select(col("id").alias("h"))
    return found(said.join(there, "h", "left_semi").join(known, ["h", "id"], "left_anti"), F.lit(True), "WARNING", "its hypothesis ignores it", col("h"))


@rule("hypotheses", "HYR6")
def mixing(data: Ledger) -> DataFrame:
    views = data["phylogenetic-views"].select("file", "id", "hypothesis_ids", "selected_claim_ids", "excluded_claim_ids").unionByName(data["classification-views"].select("file", "id", "hypothesis_ids", "selected_claim_ids", "excluded_claim_ids"))
    hyps = views.select("id", F.explode("hypothesis_ids").alias("h")).distinct()
    h = data["hypotheses"]
    alt = h.select(col("id").alias("a"), F.explode("alternative_hypothesis_ids").alias("b"))
    groups = rivals(h.select(F.explode("conflict_group_ids").alias("grp"), col("id").alias("member")))
    picks = hyps.select(col("id").alias("owner"), col("h").alias("member"))
    named = lambda df: df.withColumnRenamed("owner", "id")
    sel = views.select("file", "id", F.explode("selected_claim_ids").alias("c"))
    excl = hyps.join(h.select(col("id").alias("h"), F.explode("excluded_claim_ids").alias("c")), "h").select("id", "c").distinct()
    need = hyps.join(h.select(col("id").alias("h"), F.explode("required_claim_ids").alias("c")), "h").select("id", "c").distinct()
    scope = data["claims"].select(col("id").alias("c"), F.explode("scope.hypothesis_ids").alias("h"))
    mine = hyps.select("id", "h", F.lit(1).alias("own"))
    foreign = sel.join(scope, "c").join(mine, ["id", "h"], "left").groupBy("id", "c").agg(F.count("own").alias("n")).where("n = 0")
    return both(
        found(named(both_selected(alt, picks)), F.lit(True), "ERROR", "alternatives together", col("b")),
        found(named(both_selected(groups, picks)), F.lit(True), "ERROR", "one conflict group", col("b")),
        found(sel.join(excl, ["id", "c"]), F.lit(True), "ERROR", "selects what its hypothesis excludes", col("c")),
        found(need.join(sel.select("id", "c"), ["id", "c"], "left_anti"), F.lit(True), "WARNING", "misses a required claim", col("c")),
        found(foreign, F.lit(True), "WARNING", "claim of another hypothesis", col("c")),
        found(views, F.size(F.array_intersect(_list("selected_claim_ids"), _list("excluded_claim_ids"))) > 0, "ERROR", "selected and excluded"),
    )


@rule("hypotheses", "HYR7")
def support(data: Ledger) -> DataFrame:
    h = data["hypotheses"]
    none = lambda *cs: F.size(F.flatten(F.array(*[_list(c) for c in cs]))) == 0
    return both(
        found(h, none("supporting_evidence_ids", "supporting_source_ids"), "ERROR", "no support"),
        found(h, none("supporting_source_ids"), "WARNING", "no sources"),
        found(h, none("counterevidence_ids", "opposing_source_ids"), "WARNING", "no opposition"),
    )


@rule("hypotheses", "HYR8")
def evidence_direction(data: Ledger) -> DataFrame:
    ev = data["evidence"].select(col("id").alias("e"), _list("supports_claim_ids").alias("pro"), _list("challenges_claim_ids").alias("con"))
    parts = []
    for field, good, bad in (("supporting_evidence_ids", "pro", "con"), ("counterevidence_ids", "con", "pro")):
        each = data["hypotheses"].select("file", "id", _list("included_claim_ids").alias("inc"), F.explode(field).alias("e")).join(ev, "e")
        right, wrong = F.arrays_overlap("inc", good), F.arrays_overlap("inc", bad)
        parts += [found(each, wrong & ~right, "ERROR", f"{field} points the other way", col("e")), found(each, ~wrong & ~right, "WARNING", f"{field} is unrelated", col("e"))]
    return both(*parts)


@rule("hypotheses", "HYR9")
def alternatives(data: Ledger) -> DataFrame:
    h = data["hypotheses"]
    each = h.select("file", "id", F.explode("alternative_hypothesis_ids").alias("o"))
    back = h.select(col("id").alias("o"), F.explode("alternative_hypothesis_ids").alias("id"))
    disputed = col("epistemic_dimensions.acceptance").isin("mixed_acceptance", "minority_position")
    return both(found(h, disputed & (F.size(_list("alternative_hypothesis_ids")) == 0), "WARNING", "disputed, no alternative"), found(each.join(back, ["o", "id"], "left_anti"), F.lit(True), "WARNING", "alternative does not answer", col("o")))


@rule("hypotheses", "HYR10")
def conflict_groups(data: Ledger) -> DataFrame:
    used = data["hypotheses"].select(F.explode("conflict_group_ids").alias("id"), col("id").alias("m")).unionByName(data["claims"].select(F.explode("conflict_group_ids").alias("id"), col("id").alias("m")))
    n = used.groupBy("id").agg(F.countDistinct("m").alias("n"))
    met = data["conflict-groups"].select("id", F.lit(True).alias("there")).join(n, "id", "full_outer")
    return both(found(met, col("there").isNull(), "ERROR", "no such group"), found(met, col("there").isNotNull() & (col("n") == 1), "WARNING", "one member"), found(met, col("n").isNull(), "WARNING", "unused"))


def reticulate_nodes(data: Ledger) -> DataFrame:
    """Nodes with several parents in the selection, whatever the owner."""
    return multi_parent(selected_edges(data).where("not modal").select("src", "dst"))
