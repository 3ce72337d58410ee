"""Geography: record kinds, occurrences, containment, coexistence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.functions.text import id_prefix
from stratiq.operators.graph import ancestors
from stratiq.plans.findings import Ledger, both, found, rule
from stratiq.sources.ledger import ledger

col = F.col

#: Which file holds which kind, and predicates with a direction.
CONTRACT = {"sites": ("SITE", "site"), "regions": ("REGION", "region"), "occurrences": ("OCC", "occurrence")}
UPWARD = ("member_of", "occurs_in")
COEXISTENCE = ("coexists_with", "may_have_coexisted_with")
TEMPORAL = ("temporally_overlaps_with", "dated_to")


def _none():
    return F.expr("cast(array() as array<string>)")


@rule("geography", "GEO1")
def kinds(data: Ledger) -> DataFrame:
    parts = []
    for family, (prefix, kind) in CONTRACT.items():
        df = data[family]
        parts += [found(df, id_prefix(col("id")) != prefix, "ERROR", f"not a {kind} id"), found(df, col("entity_type").isNotNull() & (col("entity_type") != kind), "ERROR", f"not of type {kind}")]
    for family in ("clades", "lineages", "populations", "specimens", "traits"):
        parts.append(found(data[family], id_prefix(col("id")).isin("SITE", "REGION", "OCC") | col("entity_type").isin("site", "region", "occurrence"), "ERROR", "place in another family's file"))
    return both(*parts)


@rule("geography", "GEO2")
def occurrences(data: Ledger) -> DataFrame:
    o = data["occurrences"]
    placed = col("site_id").isNotNull() | col("region_id").isNotNull()
    return both(
        found(o, ~placed & ~col("location_precision").eqNullSafe("unknown"), "ERROR", "no place and not unknown"),
        found(o, (col("location_precision") == "inferred") & (col("evidence_basis") == "observed"), "WARNING", "inferred place, observed basis"),
        found(o, (col("evidence_basis") == "observed") & col("temporal_expression_id").isNull(), "WARNING", "observed without time"),
    )


@rule("geography", "GEO3")
def fields(data: Ledger) -> DataFrame:
    parts = []
    for df in (data["events"].select("file", "id", "site_ids", "region_ids"), data["claims"].select("file", "id", col("scope.site_ids").alias("site_ids"), col("scope.region_ids").alias("region_ids"))):
        for field, prefix in (("site_ids", "SITE"), ("region_ids", "REGION")):
            each = df.select("file", "id", F.explode(field).alias("x"))
            parts.append(found(each, id_prefix(col("x")) != prefix, "ERROR", f"{field} holds another kind", col("x")))
    scope = data["claims"].select("file", "id", F.explode("scope.region_ids").alias("x"))
    parts.append(found(scope.join(ledger(data).select(col("id").alias("x")), "x", "left_anti"), F.lit(True), "ERROR", "scope region not there", col("x")))
    return both(*parts)


def _claims(data: Ledger) -> DataFrame:
    return data["claims"].withColumn("object_id", col("object.entity_id")).withColumn("origin", col("provenance.origin"))


@rule("geography", "GEO4")
def direction(data: Ledger) -> DataFrame:
    c, s, o = _claims(data), id_prefix(col("subject_id")), id_prefix(col("object_id"))
    up, down = col("predicate").isin(*UPWARD), col("predicate") == "contains"
    return both(
        found(c, up & (s == "REGION") & (o == "SITE"), "ERROR", "region inside a site"),
        found(c, down & (s == "SITE") & (o == "REGION"), "ERROR", "site contains a region"),
        found(c, down & s.isin("SITE", "REGION") & ~col("origin").eqNullSafe("derived"), "WARNING", "contains should be derived"),
    )


@rule("geography", "GEO5")
def marks(data: Ledger) -> DataFrame:
    c = _claims(data)
    place = (col("predicate") == "occurs_in") | F.coalesce(id_prefix(col("object_id")), F.lit("")).isin("SITE", "REGION")
    return both(
        found(c, place & col("derivation").isNotNull() & ~col("origin").eqNullSafe("derived"), "ERROR", "derivation without derived origin"),
        found(c, place & col("derivation").isNull() & (col("origin") == "derived"), "ERROR", "derived without derivation"),
        found(c, place & col("origin").isNull(), "WARNING", "location without origin"),
    )


def region_edges(data: Ledger) -> DataFrame:
    """(``src`` inner, ``dst`` outer) of sites and regions."""
    c = _claims(data)
    up = c.where(col("predicate").isin(*UPWARD)).select(col("subject_id").alias("src"), col("object_id").alias("dst"))
    down = c.where("predicate = 'contains'").select(col("object_id").alias("src"), col("subject_id").alias("dst"))
    inside = id_prefix(col("src")).isin("SITE", "REGION") & (id_prefix(col("dst")) == "REGION")
    return up.unionByName(down).where(inside).distinct()


def footprints(data: Ledger) -> DataFrame:
    """(``entity``, ``region``): the regions an entity occurs in, its sites' regions,
    and one level of what its occurrences pass on; unknown stays empty."""
    c = _claims(data)
    sites = region_edges(data).where(col("src").startswith("SITE-")).select(col("src").alias("place"), col("dst").alias("region"))
    at = c.where("predicate = 'occurs_in'").select(col("subject_id").alias("entity"), col("object_id").alias("place")).where(~id_prefix(col("entity")).isin("SITE", "REGION"))
    direct = at.where(col("place").startswith("REGION-")).select("entity", col("place").alias("region"))
    own = direct.unionByName(at.join(sites, "place").select("entity", "region")).distinct()
    passed = c.where((col("predicate") == "assigned_to") & col("subject_id").startswith("OCC-")).select(col("subject_id").alias("entity"), col("object_id").alias("to")).join(own, "entity").select(col("to").alias("entity"), "region")
    return own.unionByName(passed).distinct()


def compatible(pairs: DataFrame, prints: DataFrame, edges: DataFrame) -> DataFrame:
    """``pairs`` (``id``, ``a``, ``b``) with ``known`` (both have a footprint) and
    ``fits``: a region in common, or one inside the other; a common ancestor is
    not enough, an unknown footprint fits."""
    up = ancestors(edges)
    above = prints.select("entity", "region", col("region").alias("reach")).unionByName(prints.join(up, col("region") == col("node")).select("entity", "region", col("ancestor").alias("reach"))).distinct()
    side = lambda k: prints.select(col("entity").alias(k), col("region").alias(f"r_{k}"))
    reach = lambda k: above.select(col("entity").alias(k), col("reach").alias(f"r_{k}"))
    one = pairs.join(reach("a"), "a").join(side("b"), "b").where("r_a = r_b").select("id", "a", "b")
    two = pairs.join(side("a"), "a").join(reach("b"), "b").where("r_a = r_b").select("id", "a", "b")
    met = one.unionByName(two).distinct().withColumn("met", F.lit(True))
    has = lambda k: prints.select(col("entity").alias(k)).distinct().withColumn(f"has_{k}", F.lit(True))
    out = pairs.join(has("a"), "a", "left").join(has("b"), "b", "left").join(met, ["id", "a", "b"], "left")
    known = col("has_a").isNotNull() & col("has_b").isNotNull()
    return out.select("id", "a", "b", known.alias("known"), (~known | col("met").isNotNull()).alias("fits"))


@rule("geography", "GEO6")
def coexistence(data: Ledger) -> DataFrame:
    c = _claims(data)
    meet = c.where(col("predicate").isin(*COEXISTENCE)).select("file", "id", "origin", col("subject_id").alias("a"), col("object_id").alias("b"), F.coalesce("derivation.depends_on_claim_ids", _none()).alias("deps"))
    dep = meet.select("id", F.explode("deps").alias("d")).join(c.select(col("id").alias("d"), col("predicate").alias("p")), "d", "left")
    timed = dep.groupBy("id").agg(F.bool_and(F.coalesce(col("p").isin(*TEMPORAL), F.lit(False))).alias("time_only"))
    fit = compatible(meet.select("id", "a", "b"), footprints(data), region_edges(data))
    met = meet.join(fit, ["id", "a", "b"]).join(timed, "id", "left").withColumn("derived", (col("origin") == "derived") & F.coalesce("time_only", F.lit(False)))
    return both(
        found(met, col("derived") & ~col("fits"), "ERROR", "from time alone, places apart", col("b")),
        found(met, col("derived") & ~col("known"), "WARNING", "from time alone, places unknown", col("b")),
        found(met, ~F.coalesce("derived", F.lit(False)) & ~col("fits"), "WARNING", "stated, places apart", col("b")),
        found(met, (col("origin") == "derived") & (F.size("deps") == 0), "WARNING", "derived without dependencies"),
    )
