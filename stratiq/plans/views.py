"""Derived views: the chronology and the tree of a hypothesis.

Every row ends in exactly one place, selected or excluded with a reason.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators import temporal as tm
from stratiq.operators.graph import ancestors, innermost_parent
from stratiq.operators.relational import rivals
from stratiq.plans.findings import Ledger
from stratiq.sources.ledger import active

col = F.col

#: Bounds of named intervals in millions of years (ICS v2023/09).
INTERVALS = {
    "arcaico": (4031.0, 2500.0), "paleoproterozoico": (2500.0, 1600.0), "mesoproterozoico": (1600.0, 1000.0), "neoproterozoico": (1000.0, 538.8), "paleozoico": (538.8, 251.902),
    "sideriano": (2500.0, 2300.0), "riásico": (2300.0, 2050.0), "orosírico": (2050.0, 1800.0), "estatérico": (1800.0, 1600.0), "calímico": (1600.0, 1400.0), "ectásico": (1400.0, 1200.0),
    "esténico": (1200.0, 1000.0), "tónico": (1000.0, 720.0), "criogénico": (720.0, 635.0), "ediacárico": (635.0, 538.8), "cámbrico": (538.8, 485.4),
}
METHOD_PREDICATES = ("limits", "depends_on", "provides_bound", "assumes", "calibrates")
DRAWN = ("member_of", "descends_from", "sister_group_of", "contains")


def _none():
    return F.expr("cast(array() as array<string>)")


def _named(name: Column, which: int) -> Column:
    out = F.lit(None).cast("double")
    for k, bounds in INTERVALS.items():
        out = F.when(name == k, F.lit(bounds[which])).otherwise(out)
    return out


def chronology(data: Ledger) -> DataFrame:
    """One mark per active dating claim, nothing averaged or merged: ``id``,
    ``subject_id``, ``shape``, ``from_ma``, ``to_ma``, ``lane`` (clock or rock), ``kind``."""
    times = active(data["temporal-expressions"]).select(col("id").alias("tid"), "interval", "determination")
    occ = data["occurrences"].select(col("id").alias("subject_id"), col("entity_id").alias("occ_of"))
    marks = active(data["claims"]).where("predicate = 'dated_to'").select("id", "subject_id", col("object.temporal_expression_id").alias("tid")).join(times, "tid").join(occ, "subject_id", "left")
    unit, name = col("interval.unit"), F.lower(F.trim(F.coalesce("interval.geological_interval", F.lit(""))))
    shape = tm.interval_shape(col("interval.oldest_bound"), col("interval.youngest_bound"), unit)
    shape = F.when((shape == "geologic") & _named(name, 0).isNull(), "unplaced").otherwise(shape)
    lane = F.when(col("determination") == "modelled", "clock").otherwise("rock")
    kind = F.when(col("determination") == "modelled", "clock").when(F.startswith("subject_id", F.lit("OCC-")), F.when(F.startswith(F.coalesce("occ_of", F.lit("")), F.lit("MOL-")), "biomarker").otherwise("fossil")).when(F.startswith("subject_id", F.lit("SITE-")), "unit").otherwise("record")
    old = F.when(unit == "geological_interval", _named(name, 0)).otherwise(tm.to_ma(col("interval.oldest_bound"), unit))
    young = F.when(unit == "geological_interval", _named(name, 1)).otherwise(tm.to_ma(col("interval.youngest_bound"), unit))
    return marks.select("id", "subject_id", shape.alias("shape"), old.alias("from_ma"), young.alias("to_ma"), lane.alias("lane"), kind.alias("kind"))


def allocate(data: Ledger) -> DataFrame:
    """Each active claim in one bucket (``id``, ``bucket``, ``reason``): on the axis,
    on method, on a card (one step from a dated subject) or outside."""
    marks = chronology(data)
    placed = marks.where("shape <> 'unplaced'").select("id", F.lit(True).alias("placed"))
    dated = marks.where("shape <> 'unplaced'").select("subject_id").distinct()
    c = active(data["claims"]).select("id", "predicate", "subject_id", col("object.entity_id").alias("object_id"))
    met = c.join(placed, "id", "left").join(dated.withColumn("s", F.lit(True)), "subject_id", "left").join(dated.select(col("subject_id").alias("object_id"), F.lit(True).alias("o")), "object_id", "left")
    near = col("s").isNotNull() | (col("o").isNotNull() & ~F.substring_index("object_id", "-", 1).isin("CLADE", "EVENT"))
    bucket = F.when(col("placed"), "axis").when(col("predicate").isin(*METHOD_PREDICATES), "method").when(near, "card").otherwise("outside")
    reason = F.when(bucket != "outside", F.lit(None).cast("string")).when(col("predicate") == "dated_to", "its date cannot be placed").otherwise("no dated subject")
    return met.select("id", bucket.alias("bucket"), reason.alias("reason"))


def event_spread(data: Ledger) -> DataFrame:
    """(``event``, ``oldest_ma``, ``youngest_ma``, ``marks``) over all bounds of an event's marks."""
    m = chronology(data).where(F.startswith("subject_id", F.lit("EVENT-")))
    bounds = m.select(col("subject_id").alias("event"), "id", F.explode(F.array_compact(F.array("from_ma", "to_ma"))).alias("ma"))
    return bounds.groupBy("event").agg(F.max("ma").alias("oldest_ma"), F.min("ma").alias("youngest_ma"), F.countDistinct("id").alias("marks"))


def cards(data: Ledger) -> DataFrame:
    """One card per active claim: its evidence with sources, its hypotheses, its issues."""
    src = data["sources"].select(col("id").alias("source_id"), t.short_citation(F.coalesce("authors", _none()), col("year")).alias("cited"))
    ev = data["evidence"].join(src, "source_id", "left").select("id", F.struct("id", "cited", "locator").alias("e"), F.explode("supports_claim_ids").alias("claim"))
    by_claim = ev.groupBy("claim").agg(F.array_sort(F.collect_list("e")).alias("evidence"))
    hyp = data["hypotheses"].select(col("id").alias("h"), F.explode("included_claim_ids").alias("claim")).groupBy("claim").agg(F.array_sort(F.collect_set("h")).alias("hypotheses"))
    iss = data["issues"].select(col("id").alias("i"), F.explode("affects.claim_ids").alias("claim")).groupBy("claim").agg(F.array_sort(F.collect_set("i")).alias("issues"))
    c = active(data["claims"]).select(col("id").alias("claim"), "subject_id", "predicate", col("object.entity_id").alias("object_id"))
    return c.join(by_claim, "claim", "left").join(hyp, "claim", "left").join(iss, "claim", "left")


def select_claims(data: Ledger, hypotheses: list[str]) -> DataFrame:
    """(``id``, ``reason``) of the claims a tree could draw for a set of hypotheses;
    null means candidate.  Reasons, first that holds: derived, rival,
    other_hypothesis, excluded, historical, classification, not_drawn."""
    h = data["hypotheses"]
    mine = F.array(*[F.lit(x) for x in hypotheses])
    pairs = rivals(h.select(F.explode("conflict_group_ids").alias("grp"), col("id").alias("member")))
    against = [r[0] for r in pairs.select(F.when(col("a").isin(*hypotheses), col("b")).when(col("b").isin(*hypotheses), col("a")).alias("x")).where("x is not null").distinct().collect() if r[0] not in hypotheses]  # rivals of a few hypotheses
    enemies = F.array(*[F.lit(x) for x in against]) if against else _none()
    out = h.where(col("id").isin(*hypotheses)).select(F.explode("excluded_claim_ids").alias("id")).distinct().withColumn("x", F.lit(True))
    c = active(data["claims"]).join(out, "id", "left").withColumn("reach", F.coalesce("scope.hypothesis_ids", _none()))
    own = F.arrays_overlap("reach", mine)
    reason = (
        F.when(col("derivation").isNotNull(), "derived")
        .when((F.size("reach") > 0) & ~own, F.when(F.arrays_overlap("reach", enemies), "rival").otherwise("other_hypothesis"))
        .when(col("x"), "excluded")
        .when((F.size("reach") == 0) & col("epistemic_dimensions.historical_status").isin("historical", "superseded", "rejected"), "historical")
        .when((col("predicate") == "member_of") & F.startswith(F.coalesce("object.entity_id", F.lit("")), F.lit("TAXCONCEPT-")) & ~own, "classification")
        .when(~col("predicate").isin(*DRAWN), "not_drawn")
    )
    return c.select("id", "predicate", "subject_id", col("object.entity_id").alias("object_id"), reason.alias("reason"))


def containment(chosen: DataFrame) -> DataFrame:
    """(``node``, ``parent``): every node under the innermost of its parents."""
    c = chosen.where("reason is null")
    up = c.where(col("predicate").isin("member_of", "descends_from")).select(col("subject_id").alias("node"), col("object_id").alias("parent"))
    down = c.where("predicate = 'contains'").select(col("object_id").alias("node"), col("subject_id").alias("parent"))
    edges = up.unionByName(down).distinct()
    return innermost_parent(edges, ancestors(edges.select(col("node").alias("src"), col("parent").alias("dst"))))


TREE = "view string, node string, parent string, label string"


def assemble(parents: DataFrame, sisters: DataFrame) -> DataFrame:
    """Trees per ``view``: parents (``view``, ``node``, ``parent``) and sister pairs
    (``view``, ``a``, ``b``), which stand under a common unnamed node.

    A view's tree is small and its assembly runs to a fixed point, so each view
    is one group; views are independent of one another.
    """
    rows = parents.select("view", col("node").alias("x"), col("parent").alias("y"), F.lit("parent").alias("kind")).unionByName(sisters.select("view", col("a").alias("x"), col("b").alias("y"), F.lit("sister").alias("kind")))

    def build(view: pd.DataFrame) -> pd.DataFrame:
        name = view["view"].iloc[0]
        known = view.where(view["kind"] == "parent").dropna(subset=["x"])
        parent: dict[str, str | None] = {x: (y if isinstance(y, str) else None) for x, y in zip(known["x"], known["y"], strict=True)}
        for y in list(parent.values()):
            if y is not None:
                parent.setdefault(y, None)
        pairs = sorted({tuple(sorted(p)) for p in view.loc[view["kind"] == "sister", ["x", "y"]].itertuples(index=False, name=None)})
        made = 0
        moved = True
        while moved:
            moved = False
            for a, b in pairs:
                pa, pb = parent.get(a), parent.get(b)
                if a in parent and b in parent and pa is not None and pa == pb and not str(pa).startswith("+"):
                    others = [n for n, p in parent.items() if p == pa and n not in (a, b)]
                    if others:
                        made += 1
                        knot = f"+{made}"
                        parent[knot] = pa
                        parent[a] = parent[b] = knot
                        moved = True
                elif (a in parent) != (b in parent):
                    here, gone = (a, b) if a in parent else (b, a)
                    made += 1
                    knot = f"+{made}"
                    parent[knot] = parent[here]
                    parent[here] = parent[gone] = knot
                    moved = True
        return pd.DataFrame({"view": name, "node": list(parent), "parent": list(parent.values()), "label": ["" if n.startswith("+") else n for n in parent]})

    return rows.groupBy("view").applyInPandas(build, TREE)


def verify(chosen: DataFrame, tree: DataFrame) -> DataFrame:
    """Candidates held against the tree: (``id``, ``reason``), null if it shows
    them, ``contradicted`` if it shows otherwise, ``not_drawable`` if an end is not in it."""
    nodes = tree.select("node").distinct()
    up = ancestors(tree.where("parent is not null").select(col("node").alias("src"), col("parent").alias("dst"))).select(col("node").alias("lower"), col("ancestor").alias("upper"), F.lit(True).alias("above"))
    c = chosen.where("reason is null")
    flip = col("predicate") == "contains"
    ends = c.select("id", "predicate", F.when(flip, col("object_id")).otherwise(col("subject_id")).alias("lower"), F.when(flip, col("subject_id")).otherwise(col("object_id")).alias("upper"))
    both = ends.join(nodes.select(col("node").alias("lower"), F.lit(True).alias("l")), "lower", "left").join(nodes.select(col("node").alias("upper"), F.lit(True).alias("u")), "upper", "left")
    family = tree.where("parent is not null").select("node", "parent")
    sister = family.select(col("node").alias("lower"), "parent").join(family.select(col("node").alias("upper"), "parent"), "parent").where("lower <> upper").select("lower", "upper", F.lit(True).alias("sister"))
    met = both.join(up, ["lower", "upper"], "left").join(sister, ["lower", "upper"], "left")
    shown = F.when(col("predicate") == "sister_group_of", col("sister").isNotNull()).otherwise(col("above").isNotNull())
    return met.select("id", F.when(col("l").isNull() | col("u").isNull(), "not_drawable").when(~shown, "contradicted").alias("reason"))


def view_record(view: str, selected: DataFrame, excluded: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The view's record: its claims, the reasons that shape it, and a version that
    rises with its content; ``previous`` is (``view``, ``digest``, ``version``)."""
    s = selected.agg(F.array_sort(F.collect_set("id")).alias("selected_claim_ids"))
    x = excluded.agg(F.array_sort(F.collect_set("id")).alias("excluded_claim_ids"), F.array_sort(F.collect_set("reason")).alias("editorial_criteria"))
    row = s.join(x).withColumn("view", F.lit(view))
    row = row.withColumn("digest", F.sha2(F.to_json(F.struct("selected_claim_ids", "excluded_claim_ids", "editorial_criteria")).cast("binary"), 256))
    if previous is None:
        return row.withColumn("version", F.lit("1.0.0"))
    old = previous.select("view", col("digest").alias("d0"), col("version").alias("v0"))
    return row.join(old, "view", "left").withColumn("version", t.next_version(col("v0"), col("digest") != col("d0"))).drop("d0", "v0")


def retired_views(previous: DataFrame, wanted: DataFrame) -> DataFrame:
    """Views that are no longer asked for: kept, as deprecated."""
    return previous.join(wanted.select("view"), "view", "left_anti").withColumn("record_status", F.lit("deprecated"))

