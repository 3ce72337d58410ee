"""Declared schemas and closed vocabularies of the ledger's record families.

Schemas are never inferred: all-null fields, absent fields and column order
would differ from file to file.  Every family also keeps ``raw``, the record's
JSON text, for rules that tell an absent key from a null one or walk all keys.
"""

from __future__ import annotations

IDS = "array<string>"
AXES = "struct<acceptance:string,evidence_strength:string,evidence_strength_reason:string,resolution:string,historical_status:string>"
PROV = "struct<section_ids:array<string>,passage_ids:array<string>,source_ids:array<string>,operation_id:string,dataset_revision:string,origin:string>"
COMMON = "record_status string, superseded_by string, merged_into string, replaced_by string, successor_id string, deprecation_reason string, reason string, schema_version string, epistemic_dimensions " + AXES
SUPPORT = "array<struct<measure_type:string,value:string,unit:string,scale:string,method:string,source_id:string,locator:string,applies_to:string,conditions:string>>"
ENTITY = f"id string, entity_type string, preferred_label string, alias_ids {IDS}, description string, claim_ids {IDS}, issue_ids {IDS}, first_introduced_in string, last_modified_in string, notes {IDS}"

#: Families that share the entity shape, and the id prefix of each entity type.
ENTITY_FILES = ("clades", "lineages", "populations", "specimens", "sites", "regions", "occurrences", "traits", "methods", "molecules")
TYPE_PREFIX = {
    "biological_lineage": "LINEAGE", "clade": "CLADE", "population": "POP", "specimen": "SPECIMEN", "site": "SITE",
    "region": "REGION", "occurrence": "OCC", "trait": "TRAIT", "method": "METHOD", "molecule": "MOL",
}

FAMILIES: dict[str, str] = {
    "sections": f"id string, title string, received_at string, original_content_path string, content_hash string, source_ids {IDS}, dataset_revision string, notes {IDS}",
    "passages": "id string, section_id string, ordinal int, text string, character_offsets struct<start:int,end:int>",
    "mentions": f"id string, section_id string, passage_id string, original_text string, normalized_form string, mention_type string, character_offsets struct<start:int,end:int>, resolution struct<status:string,target_ids:array<string>,reason:string>, disposition string, issue_ids {IDS}, notes {IDS}",
    "sources": f"id string, citation_key string, authors {IDS}, year int, title string, container string, doi string, url string, source_type string, quality_notes {IDS}, consulted_at string, verification_status string, notes {IDS}",
    **{f: ENTITY for f in ENTITY_FILES if f != "occurrences"},
    "occurrences": f"id string, entity_type string, preferred_label string, alias_ids {IDS}, entity_id string, temporal_expression_id string, region_id string, site_id string, location_precision string, evidence_basis string, claim_ids {IDS}, evidence_ids {IDS}, issue_ids {IDS}, notes {IDS}",
    "taxonomic-names": f"id string, canonical_spelling string, original_spellings {IDS}, authorship string, nomenclatural_status string, rank_when_established string, source_ids {IDS}, notes {IDS}",
    "taxon-concepts": f"id string, name_id string, according_to_source_id string, circumscription struct<included_entity_ids:array<string>,excluded_entity_ids:array<string>,definition_text:string>, relation_to_other_concepts array<struct<other_concept_id:string,relation:string,claim_id:string>>, taxonomic_status string, claim_ids {IDS}, notes {IDS}",
    "trait-observations": f"id string, trait_id string, bearer_id string, bearer_type string, observation_basis string, state string, temporal_expression_ids {IDS}, evidence_ids {IDS}, claim_ids {IDS}, notes {IDS}, provenance {PROV}",
    "claims": f"id string, claim_type string, subject_id string, predicate string, object struct<entity_id:string,temporal_expression_id:string,value:string,unit:string,scale:string,category:string>, scope struct<hypothesis_ids:array<string>,classification_view_ids:array<string>,temporal_expression_ids:array<string>,region_ids:array<string>,site_ids:array<string>>, provenance {PROV}, quantitative_support {SUPPORT}, evidence_ids {IDS}, counterevidence_ids {IDS}, derivation struct<depends_on_claim_ids:array<string>,method:string>, conflict_group_ids {IDS}, issue_ids {IDS}, notes {IDS}",
    "evidence": f"id string, evidence_type string, description string, source_id string, locator string, passage_ids {IDS}, dataset_ids {IDS}, analysis_ids {IDS}, result_ids {IDS}, supports_claim_ids {IDS}, challenges_claim_ids {IDS}, limitations {IDS}, issue_ids {IDS}, notes {IDS}, provenance {PROV}",
    "datasets": f"id string, dataset_type string, title string, source_ids {IDS}, notes {IDS}",
    "analyses": f"id string, analysis_type string, method string, dataset_ids {IDS}, result_ids {IDS}, source_ids {IDS}, notes {IDS}",
    "results": f"id string, analysis_id string, result_type string, description string, value string, unit string, scale string, support struct<measure_type:string,value:string,scale:string>, source_ids {IDS}, issue_ids {IDS}, notes {IDS}",
    "events": f"id string, event_type string, label string, participants array<struct<entity_id:string,role:string,proportion:string,notes:string>>, result_entity_ids {IDS}, temporal_expression_ids {IDS}, region_ids {IDS}, site_ids {IDS}, claim_ids {IDS}, evidence_ids {IDS}, hypothesis_ids {IDS}, issue_ids {IDS}, notes {IDS}",
    "hypotheses": f"id string, name string, description string, included_claim_ids {IDS}, required_claim_ids {IDS}, excluded_claim_ids {IDS}, supporting_evidence_ids {IDS}, counterevidence_ids {IDS}, supporting_source_ids {IDS}, opposing_source_ids {IDS}, conflict_group_ids {IDS}, alternative_hypothesis_ids {IDS}, issue_ids {IDS}, notes {IDS}",
    "conflict-groups": f"id string, name string, description string, issue_ids {IDS}, notes {IDS}",
    "temporal-expressions": f"id string, temporal_type string, label string, interval struct<oldest_bound:double,youngest_bound:double,unit:string,reference_point:string,geological_interval:string>, calendar_date string, uncertainty struct<kind:string,plus_minus:double,lower:double,upper:double,level:double>, calibration struct<system:string>, method_type string, determination string, notes {IDS}",
    "issues": f"id string, issue_type string, title string, severity string, affects struct<record_ids:array<string>,claim_ids:array<string>,mention_ids:array<string>>, resolution struct<status:string,resolved_in:string>, notes {IDS}",
    "phylogenetic-views": f"id string, name string, hypothesis_ids {IDS}, selected_claim_ids {IDS}, excluded_claim_ids {IDS}, editorial_criteria {IDS}, simplifications {IDS}, topology struct<format:string,content:string,reticulation:boolean>, generated_artifacts array<struct<artifact_type:string,path:string>>, notes {IDS}",
    "classification-views": f"id string, name string, taxon_concept_ids {IDS}, hypothesis_ids {IDS}, selected_claim_ids {IDS}, excluded_claim_ids {IDS}, editorial_criteria {IDS}, simplifications {IDS}, generated_artifacts array<struct<artifact_type:string,path:string>>, notes {IDS}",
    "game-projections": f"id string, justification string, scientific_reference_ids {IDS}, simplifications {IDS}, scientific_constraints {IDS}, notes {IDS}",
}


def ddl(family: str) -> str:
    """All columns of a family, the shared ones included."""
    return f"{FAMILIES[family]}, {COMMON}"
