"""Separation of the scientific layer from the game layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.functions.text import ids_in, key_tokens
from stratiq.plans.findings import Ledger, both, found, rule
from stratiq.sources.ledger import ledger, walked

col = F.col

#: Prefixes and vocabularies of the two layers.
GAME = ("GAME", "MECH", "CAMP", "CHAPTER")
MECHANIC = (
    "cost", "costs", "upkeep", "price", "budget", "bonus", "bonuses", "malus", "buff", "debuff", "penalty", "penalties", "reward", "rewards",
    "loot", "xp", "points", "score", "scoring", "victory", "defeat", "win", "lose", "loss", "gameover", "unlock", "unlocks", "unlockable",
    "achievement", "achievements", "quest", "objective", "objectives", "difficulty", "balance", "balancing", "hp", "mana", "stamina", "energy",
    "perk", "perks", "tier", "tech", "game", "gameplay", "player", "playable", "mechanic", "mechanics",
)
MECHANIC_KEYS = "(victory_condition|win_condition|lose_condition|game_over|condicion_de_victoria|bonificacion|coste|costo|recompensa|puntuacion)"
SCIENCE_ONLY = (
    "predicate", "subject_id", "claim_type", "epistemic_dimensions", "quantitative_support", "evidence_ids", "counterevidence_ids", "derivation",
    "claim_text", "claim_override", "claim_overrides", "overrides", "restated_claim", "rewritten_claim", "corrected_claim", "selected_claim_ids",
    "excluded_claim_ids", "editorial_criteria",
)
SCIENCE_SHAPED = ("claims", "object", "claim", "hypotheses", "evidence")
NON_CONSENSUS = ("mixed_acceptance", "minority_position", "not_assessed", "abandoned")
VIEWS = ("phylogenetic-views", "classification-views")


def _prefix(c):
    return F.substring_index(c, "-", 1)


def _science(data: Ledger) -> DataFrame:
    return ledger({k: v for k, v in data.items() if k != "game-projections" and "raw" in v.columns and "record_status" in v.columns})


def _keys(data: Ledger, name: str, df: DataFrame) -> DataFrame:
    return walked(data, name, df).where("key is not null")


def _text(data: Ledger) -> DataFrame:
    """Leaf strings of the scientific records with their unquoted text."""
    return walked(data, "science", _science(data)).where(F.col("kind") == "STRING").withColumn("leaf", F.regexp_replace("value", '^"|"$', ""))


@rule("separation", "SEP1")
def mechanics(data: Ledger) -> DataFrame:
    k = _keys(data, "science", _science(data))
    hit = F.arrays_overlap(key_tokens(col("key")), F.array(*[F.lit(m) for m in MECHANIC])) | F.lower("key").rlike(MECHANIC_KEYS)
    return found(k, hit, "ERROR", "mechanic in a scientific record", col("path"))


@rule("separation", "SEP2")
def game_records(data: Ledger) -> DataFrame:
    return found(_science(data), _prefix("id").isin(*GAME), "ERROR", "game record among scientific ones")


@rule("separation", "SEP3")
def game_ids(data: Ledger) -> DataFrame:
    t = _text(data).where(col("leaf").rlike("^(GAME|MECH|CAMP|CHAPTER)-[0-9]{6}$") & (col("leaf") != col("id")))
    return found(t, F.lit(True), F.when(_prefix("leaf").isin("GAME", "MECH"), "ERROR").otherwise("WARNING"), "scientific field holds a game id", col("leaf"))


@rule("separation", "SEP4")
def game_mentions(data: Ledger) -> DataFrame:
    t = _text(data).where(~col("leaf").rlike("^[A-Z]+-[0-9]{6}$"))
    held = F.filter(ids_in(col("leaf")), lambda x: F.substring_index(x, "-", 1).isin(*GAME))
    return found(t.withColumn("held", held), F.size("held") > 0, "WARNING", "text names a game id", F.element_at("held", 1))


@rule("separation", "SEP5")
def science_records(data: Ledger) -> DataFrame:
    return found(data["game-projections"], ~_prefix("id").isin(*GAME), "ERROR", "scientific record in the game layer")


@rule("separation", "SEP6")
def rewriting(data: Ledger) -> DataFrame:
    k = _keys(data, "projections", data["game-projections"])
    shaped = col("key").isin(*SCIENCE_SHAPED) & (col("kind").startswith("OBJECT") | col("kind").startswith("ARRAY<OBJECT")) & col("value").rlike('"(id|predicate|subject_id|claim_type)"')
    return found(k, col("key").isin(*SCIENCE_ONLY) | shaped, "ERROR", "game layer restates science", col("path"))


@rule("separation", "SEP7")
def copies(data: Ledger) -> DataFrame:
    k = _keys(data, "projections", data["game-projections"]).where((col("key") == "id") & F.contains("path", F.lit(".")))
    known = _science(data).select(F.concat(F.lit('"'), "id", F.lit('"')).alias("value"))
    return found(k.join(known, "value", "left_semi"), F.lit(True), "ERROR", "copy of a scientific record", col("value"))


def _none():
    return F.expr("cast(array() as array<string>)")


def _size(c: str):
    return F.size(F.coalesce(col(c), _none()))


@rule("separation", "SEP8")
def projections(data: Ledger) -> DataFrame:
    p = data["game-projections"]
    return both(found(p, col("id").isNull(), "WARNING", "no id"), found(p, _size("scientific_reference_ids") == 0, "WARNING", "no reference"), found(p, F.trim(F.coalesce("justification", F.lit(""))) == "", "ERROR", "no justification"))


@rule("separation", "SEP9")
def contested(data: Ledger) -> DataFrame:
    p = data["game-projections"].withColumn("told", (_size("simplifications") > 0) | (_size("scientific_constraints") > 0))
    accepted = _science(data).select(col("id").alias("ref"), F.get_json_object("raw", "$.epistemic_dimensions.acceptance").alias("acceptance"))
    each = p.select("file", "id", "told", F.explode("scientific_reference_ids").alias("ref")).join(accepted, "ref", "left")
    risky = each.groupBy("file", "id", "told").agg(F.bool_or(F.startswith("ref", F.lit("HYP-")) | F.coalesce(col("acceptance").isin(*NON_CONSENSUS), F.lit(False))).alias("risky"))
    return found(risky, ~col("told"), F.when(col("risky"), "ERROR").otherwise("WARNING"), "nothing declared as simplified")


def _views(data: Ledger) -> DataFrame:
    out = None
    for v in VIEWS:
        part = data[v].select("file", "id", "raw", "simplifications", "excluded_claim_ids", "generated_artifacts", "editorial_criteria")
        out = part if out is None else out.unionByName(part)
    return out


@rule("separation", "SEP10")
def simplifications(data: Ledger) -> DataFrame:
    v = _views(data)
    said = F.get_json_object("raw", "$.simplifications")
    return both(
        found(v, said.isNull(), "ERROR", "no simplifications field"),
        found(v, said.isNotNull() & ~F.startswith(said, F.lit("[")), "ERROR", "simplifications are no list"),
        found(v, F.exists(F.coalesce("simplifications", _none()), lambda s: F.trim(F.coalesce(s, F.lit(""))) == ""), "ERROR", "blank simplification"),
    )


@rule("separation", "SEP11")
def unsimplified(data: Ledger) -> DataFrame:
    v = _views(data).where(F.startswith(F.get_json_object("raw", "$.simplifications"), F.lit("[")) & (_size("simplifications") == 0))
    drawn = F.coalesce(F.size("generated_artifacts"), F.lit(0)) > 0
    return found(v, F.lit(True), F.when(drawn, "ERROR").when(_size("excluded_claim_ids") > 0, "WARNING").otherwise("INFO"), "declares no simplification")


@rule("separation", "SEP12")
def criteria(data: Ledger) -> DataFrame:
    return found(_views(data), _size("editorial_criteria") == 0, "ERROR", "no editorial criteria")
