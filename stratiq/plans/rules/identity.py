"""Identity: aliases, homonyms, names and concepts, specimens, molecules, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.functions.text import LONG_ID_PATTERN, folded, id_prefix, ids_in
from stratiq.operators.graph import pointer_ends
from stratiq.plans.findings import Ledger, both, found, rule
from stratiq.sources.ledger import active, ledger
from stratiq.sources.schemas import ENTITY_FILES, TYPE_PREFIX

col = F.col

#: Predicates with restricted ends, and prefixes of trait bearers.
TAXONOMIC = ("TAXCONCEPT", "CLADE", "LINEAGE", "NAME")
TAXON_ONLY = ("descends_from", "diverges_from", "sister_group_of", "stem_lineage_of", "crown_group_of", "contains")
CONCEPT_TARGET = ("assigned_to", "classified_as_by", "historically_classified_as")
BEARER = {"specimen": "SPECIMEN", "population": "POP", "taxon_concept": "TAXCONCEPT", "clade": "CLADE", "biological_lineage": "LINEAGE", "analysis": "ANALYSIS"}


def entities(data: Ledger) -> DataFrame:
    out = None
    for f in ENTITY_FILES:
        part = data[f].select("file", "id", "entity_type", "preferred_label", "alias_ids", "record_status")
        out = part if out is None else out.unionByName(part)
    return out


def _mapped(value, mapping: dict[str, str]):
    out = F.lit(None).cast("string")
    for k, v in mapping.items():
        out = F.when(value == k, v).otherwise(out)
    return out


@rule("identity", "IDN1")
def aliases(data: Ledger) -> DataFrame:
    e = entities(data)
    each = e.select("file", "id", F.explode("alias_ids").alias("alias"))
    live = active(e).select(col("id").alias("alias"))
    claimed = each.groupBy("alias").agg(F.array_sort(F.collect_set("id")).alias("by")).where(F.size("by") > 1)
    return both(
        found(e, F.array_contains("alias_ids", col("id")), "ERROR", "alias of itself"),
        found(e, F.size("alias_ids") > F.size(F.array_distinct("alias_ids")), "WARNING", "repeated alias"),
        found(each.where("alias <> id").join(live, "alias"), F.lit(True), "ERROR", "alias of an active record", col("alias")),
        found(claimed.select(col("alias").alias("id"), "by"), F.lit(True), "ERROR", F.concat(F.lit("claimed by "), F.array_join("by", ", "))),
    )


@rule("identity", "IDN2")
def same_labels(data: Ledger) -> DataFrame:
    g = active(entities(data)).groupBy("entity_type", folded(col("preferred_label")).alias("label")).agg(F.array_sort(F.collect_set("id")).alias("ids")).where("label is not null and size(ids) > 1")
    return found(g.select(F.element_at("ids", 1).alias("id"), "ids"), F.lit(True), "WARNING", F.array_join("ids", ", "))


@rule("identity", "IDN3")
def homonym_names(data: Ledger) -> DataFrame:
    from stratiq.operators.relational import homonyms

    n = data["taxonomic-names"].withColumn("spelling", folded(col("canonical_spelling"))).withColumn("was_merged", F.coalesce(col("record_status") == "merged", F.lit(False)))
    g = homonyms(n, "spelling", "authorship", "rank_when_established", "was_merged")
    return found(g.withColumnRenamed("spelling", "id").withColumnRenamed("severity", "sev"), F.lit(True), col("sev"), F.concat(col("n").cast("string"), F.lit(" records of one spelling")))


@rule("identity", "IDN4")
def conceptual_homonyms(data: Ledger) -> DataFrame:
    g = data["taxon-concepts"].groupBy("name_id").agg(F.countDistinct("according_to_source_id").alias("sources"), F.bool_or(F.coalesce(col("record_status") == "merged", F.lit(False))).alias("merged")).where("name_id is not null and sources > 1")
    return found(g.withColumnRenamed("name_id", "id"), F.lit(True), F.when(col("merged"), "ERROR").otherwise("INFO"), "one name, several sources")


@rule("identity", "IDN5")
def merged_homonyms(data: Ledger) -> DataFrame:
    c = data["taxon-concepts"]
    each = c.select("file", "id", "record_status", F.explode("relation_to_other_concepts").alias("r")).where(col("r.relation").isin("homonym", "incompatible"))
    other = c.select(col("id").alias("o"), col("record_status").alias("os"))
    met = each.join(other, col("r.other_concept_id") == col("o"), "left")
    return found(met, (F.coalesce(col("record_status"), F.lit("")) == "merged") | (F.coalesce(col("os"), F.lit("")) == "merged"), "ERROR", "declared homonym was merged", col("r.other_concept_id"))


@rule("identity", "IDN6")
def concept_parts(data: Ledger) -> DataFrame:
    c = data["taxon-concepts"]
    names, sources = data["taxonomic-names"].select(col("id").alias("n")), data["sources"].select(col("id").alias("s"))
    met = c.join(names, col("name_id") == col("n"), "left").join(sources, col("according_to_source_id") == col("s"), "left")
    return both(found(met, ~F.coalesce(col("name_id"), F.lit("")).startswith("NAME-") | col("n").isNull(), "ERROR", "no name record", col("name_id")), found(met, ~F.coalesce(col("according_to_source_id"), F.lit("")).startswith("SRC-") | col("s").isNull(), "ERROR", "no source record", col("according_to_source_id")))


@rule("identity", "IDN7")
def name_as_concept(data: Ledger) -> DataFrame:
    keys = F.array_intersect(F.json_object_keys("raw"), F.array(*[F.lit(k) for k in ("circumscription", "included_entity_ids", "excluded_entity_ids", "according_to_source_id")]))
    return found(data["taxonomic-names"].withColumn("k", keys), F.size("k") > 0, "ERROR", F.array_join("k", ", "))


def _ends(data: Ledger) -> DataFrame:
    return data["claims"].select("file", "id", "predicate", "subject_id", col("object.entity_id").alias("object_id"))


@rule("identity", "IDN8")
def name_targets(data: Ledger) -> DataFrame:
    return found(_ends(data), col("predicate").isin(*CONCEPT_TARGET) & col("object_id").startswith("NAME-"), "ERROR", "a name where a concept belongs", col("object_id"))


@rule("identity", "IDN9")
def type_prefix(data: Ledger) -> DataFrame:
    want = _mapped(col("entity_type"), TYPE_PREFIX)
    return found(entities(data), want.isNotNull() & (id_prefix(col("id")) != want), "ERROR", "id prefix does not fit the type")


@rule("identity", "IDN10")
def specimen_aliases(data: Ledger) -> DataFrame:
    each = entities(data).select("file", "id", F.explode("alias_ids").alias("alias"))
    a, b = id_prefix(col("id")), id_prefix(col("alias"))
    return found(each, ((a == "SPECIMEN") & b.isin(*TAXONOMIC)) | (a.isin(*TAXONOMIC, "POP") & (b == "SPECIMEN")), "ERROR", "specimen and group as aliases", col("alias"))


@rule("identity", "IDN11")
def specimen_as_taxon(data: Ledger) -> DataFrame:
    ends = _ends(data).where(col("predicate").isin(*TAXON_ONLY)).select("file", "id", F.explode(F.array("subject_id", "object_id")).alias("end"))
    return found(ends, col("end").startswith("SPECIMEN-"), "ERROR", "specimen treated as taxon", col("end"))


@rule("identity", "IDN12")
def bearers(data: Ledger) -> DataFrame:
    want = _mapped(col("bearer_type"), BEARER)
    return found(data["trait-observations"], want.isNotNull() & (id_prefix(col("bearer_id")) != want), "ERROR", "bearer type and id differ", col("bearer_id"))


@rule("identity", "IDN13")
def molecules(data: Ledger) -> DataFrame:
    e, mol = _ends(data), lambda c: F.coalesce(col(c), F.lit("")).startswith("MOL-")
    each = entities(data).select("file", "id", F.explode("alias_ids").alias("alias"))
    targets = ("CLADE", "LINEAGE", "TAXCONCEPT", "POP", "EVENT", "TRAIT")
    return both(
        found(e, (col("predicate") == "biomarker_of") & ~mol("subject_id"), "ERROR", "biomarker is no molecule", col("subject_id")),
        found(e, (col("predicate") == "biomarker_of") & ~id_prefix(col("object_id")).isin(*targets), "ERROR", "biomarker of what cannot have one", col("object_id")),
        found(e, mol("subject_id") & col("predicate").isin(*TAXON_ONLY, "member_of"), "ERROR", "molecule treated as taxon"),
        found(e, mol("subject_id") & col("predicate").isin(*CONCEPT_TARGET) & id_prefix(col("object_id")).isin(*TAXONOMIC), "ERROR", "molecule classified in a taxon", col("object_id")),
        found(each, mol("id") != mol("alias"), "ERROR", "molecule and non-molecule as aliases", col("alias")),
    )


@rule("identity", "IDN14")
def merges(data: Ledger) -> DataFrame:
    e = entities(data)
    every = ledger(data).select(col("id").alias("target"), col("record_status").alias("target_status")).dropDuplicates(["target"])
    survivors = e.select(col("id").alias("survivor"), F.explode("alias_ids").alias("id")).groupBy("id").agg(F.min("survivor").alias("survivor"))
    noted = ledger(data).where(col("record_status") == "merged").select("file", "id", F.try_element_at(F.filter(ids_in(F.concat_ws(" ", F.get_json_object("raw", "$.merged_into"), F.get_json_object("raw", "$.notes")), LONG_ID_PATTERN), lambda x: x != col("id")), F.lit(1)).alias("noted"))
    to = noted.join(survivors, "id", "left").select("file", "id", F.coalesce("survivor", "noted").alias("target"))
    met = to.join(every, "target", "left")
    ends = pointer_ends(to.where("target is not null").select(col("id").alias("node"), "target"))
    last = ends.join(every.withColumnRenamed("target", "last"), "last", "left")
    return both(
        found(met, col("target").isNull(), "ERROR", "merged into nothing"),
        found(met, col("target").isNotNull() & col("target_status").isNull() & ~col("target").isin(""), "WARNING", "target without status or not there", col("target")),
        found(last.select(col("node").alias("id"), "circular", "target_status", "last"), col("circular"), "ERROR", "circular merge"),
        found(last.select(col("node").alias("id"), "circular", "target_status", "last"), ~col("circular") & ~F.coalesce(col("target_status"), F.lit("active")).isin("active"), "WARNING", "ends at an inactive record", col("last")),
    )
