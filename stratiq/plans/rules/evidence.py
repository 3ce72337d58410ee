"""Evidence: quantitative support, direction of links, sources, strength."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.functions.text import blank, carries_number, measure_name, vague_measure
from stratiq.plans.findings import Ledger, both, found, rule
from stratiq.sources.schemas import FAMILIES

col = F.col

#: Measures that say what they are, and words that do not.
RECOGNISED = ("bootstrap", "posterior_probability", "jackknife", "bremer", "p_value", "confidence_interval", "credible_interval", "margin_of_error", "standard_error")
VAGUE = (
    "confidence", "confianza", "certainty", "certeza", "seguridad", "reliability", "fiabilidad", "score", "puntuacion", "likelihood",
    "verosimilitud", "probability", "probabilidad", "percent", "porcentaje", "strength", "fuerza",
)
MOLECULAR = ("molecular", "genomic", "mitochondrial", "chromosomal", "paleoproteomic")


def _none():
    return F.expr("cast(array() as array<string>)")


def _size(c: str):
    return F.size(F.coalesce(col(c), _none()))


def support_rows(data: Ledger) -> DataFrame:
    """One row per entry of quantitative support, numbered from 1."""
    each = data["claims"].select("file", "id", F.posexplode("quantitative_support").alias("i", "s"))
    return each.select("file", "id", (col("i") + 1).alias("n"), "s.*")


@rule("evidence", "EVD1")
def no_measure(data: Ledger) -> DataFrame:
    return found(support_rows(data), blank(col("measure_type")), "ERROR", "value without measure type", col("n").cast("string"))


@rule("evidence", "EVD2")
def bare_numbers(data: Ledger) -> DataFrame:
    s = support_rows(data)
    return both(found(s, carries_number(col("value")) & blank(col("source_id")), "ERROR", "number without source", col("n").cast("string")), found(s, carries_number(col("value")) & blank(col("method")), "ERROR", "number without method", col("n").cast("string")))


@rule("evidence", "EVD3")
def vague(data: Ledger) -> DataFrame:
    s = support_rows(data).where(~blank(col("measure_type")))
    chain = ~blank(col("source_id")) & ~blank(col("method")) & ~blank(col("scale"))
    return found(s, vague_measure(col("measure_type"), RECOGNISED, VAGUE), F.when(chain, "WARNING").otherwise("ERROR"), F.concat(F.lit("vague measure: "), measure_name(col("measure_type"))), col("n").cast("string"))


@rule("evidence", "EVD4")
def sourceless(data: Ledger) -> DataFrame:
    return found(support_rows(data), ~blank(col("value")) & ~carries_number(col("value")) & blank(col("source_id")), "WARNING", "value without source", col("n").cast("string"))


@rule("evidence", "EVD5")
def incomplete(data: Ledger) -> DataFrame:
    missing = F.array_compact(F.array(*[F.when(blank(col(f)), f) for f in ("scale", "applies_to", "conditions")]))
    s = support_rows(data).withColumn("missing", missing)
    return found(s, carries_number(col("value")) & (F.size("missing") > 0), "WARNING", F.array_join("missing", ", "), col("n").cast("string"))


@rule("evidence", "EVD6")
def no_locator(data: Ledger) -> DataFrame:
    return found(support_rows(data), ~blank(col("source_id")) & blank(col("locator")), "WARNING", "source without locator", col("n").cast("string"))


@rule("evidence", "EVD7")
def quantitative_claims(data: Ledger) -> DataFrame:
    c = data["claims"].where(col("claim_type") == "quantitative")
    number = carries_number(col("object.value"))
    return both(found(c, number & (F.coalesce(F.size("quantitative_support"), F.lit(0)) <= 0), "ERROR", "number without support"), found(c, number & blank(col("object.unit")) & blank(col("object.scale")), "WARNING", "neither unit nor scale"))


@rule("evidence", "EVD8")
def result_sources(data: Ledger) -> DataFrame:
    a = data["analyses"].select(col("id").alias("analysis_id"), F.coalesce("source_ids", _none()).alias("inherited"))
    r = data["results"].join(a, "analysis_id", "left")
    has = F.size(F.concat(F.coalesce("source_ids", _none()), F.coalesce("inherited", _none()))) > 0
    return found(r, (col("support").isNotNull() | ~blank(col("value"))) & ~has, "ERROR", "no source of its own or of its analysis")


@rule("evidence", "EVD9")
def result_support(data: Ledger) -> DataFrame:
    r = data["results"]
    return both(found(r, carries_number(col("support.value")) & blank(col("support.scale")), "WARNING", "support without scale"), found(r, (col("support.measure_type") == "other") & blank(col("description")), "WARNING", "other measure, not described"))


@rule("evidence", "EVD10")
def proportions(data: Ledger) -> DataFrame:
    e = data["events"]
    each = e.select("file", "id", "claim_ids", "evidence_ids", F.explode("participants").alias("p")).where(carries_number(col("p.proportion")))
    claims = data["claims"].select(col("id").alias("c"), (F.coalesce(F.size("quantitative_support"), F.lit(0)) > 0).alias("q"))
    backed = e.select("id", F.explode("claim_ids").alias("c")).join(claims, "c").groupBy("id").agg(F.bool_or("q").alias("backed"))
    met = each.join(backed, "id", "left")
    return found(met, (_size("evidence_ids") == 0) & ~F.coalesce("backed", F.lit(False)), "ERROR", "proportion without evidence", col("p.entity_id"))


@rule("evidence", "EVD11")
def sides(data: Ledger) -> DataFrame:
    e, pro, con = data["evidence"], F.coalesce("supports_claim_ids", _none()), F.coalesce("challenges_claim_ids", _none())
    return both(found(e, F.size(F.array_intersect(pro, con)) > 0, "ERROR", "supports and challenges one claim"), found(e, (F.size(pro) == 0) & (F.size(con) == 0), "WARNING", "bears on nothing"))


def _links(data: Ledger) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    e, c = data["evidence"], data["claims"]
    pro = e.select(col("id").alias("e"), F.explode("supports_claim_ids").alias("c")).distinct()
    con = e.select(col("id").alias("e"), F.explode("challenges_claim_ids").alias("c")).distinct()
    by = c.select(F.explode("evidence_ids").alias("e"), col("id").alias("c")).distinct()
    against = c.select(F.explode("counterevidence_ids").alias("e"), col("id").alias("c")).distinct()
    return pro, con, by, against


@rule("evidence", "EVD12")
def one_way(data: Ledger) -> DataFrame:
    pro, con, by, against = _links(data)
    there = data["claims"].select(col("id").alias("c"))
    lone = lambda a, b: a.join(there, "c", "left_semi").join(b, ["e", "c"], "left_anti").withColumnRenamed("e", "id")
    return both(found(lone(pro, by), F.lit(True), "WARNING", "claim does not list its support", col("c")), found(lone(con, against), F.lit(True), "WARNING", "claim does not list its challenge", col("c")))


def _leaning(data: Ledger, listed: DataFrame, right: DataFrame, wrong: DataFrame, words: tuple[str, str]) -> DataFrame:
    there = data["evidence"].select(col("id").alias("e"))
    known = listed.join(there, "e", "left_semi")
    bad = known.join(wrong, ["e", "c"]).withColumnRenamed("c", "id")
    mute = known.join(wrong, ["e", "c"], "left_anti").join(right, ["e", "c"], "left_anti").withColumnRenamed("c", "id")
    return both(found(bad, F.lit(True), "ERROR", words[0], col("e")), found(mute, F.lit(True), "ERROR", words[1], col("e")))


@rule("evidence", "EVD13")
def leaning(data: Ledger) -> DataFrame:
    pro, con, by, _ = _links(data)
    return _leaning(data, by, pro, con, ("leans on what challenges it", "leans on what does not support it"))


@rule("evidence", "EVD14")
def counter(data: Ledger) -> DataFrame:
    pro, con, _, against = _links(data)
    return _leaning(data, against, con, pro, ("counterevidence supports it", "counterevidence does not challenge it"))


@rule("evidence", "EVD15")
def evidence_source(data: Ledger) -> DataFrame:
    return found(data["evidence"], blank(col("source_id")), F.when(_size("issue_ids") > 0, "WARNING").otherwise("ERROR"), "no source")


@rule("evidence", "EVD16")
def locators(data: Ledger) -> DataFrame:
    s = data["sources"].select(col("id").alias("source_id"), "source_type")
    e = data["evidence"].join(s, "source_id")
    return both(found(e, (col("source_type") == "section_provided") & (_size("passage_ids") == 0), "WARNING", "section source without passage"), found(e, (col("source_type") != "section_provided") & blank(col("locator")), "WARNING", "external source without locator"))


@rule("evidence", "EVD17")
def kinds(data: Ledger) -> DataFrame:
    e = data["evidence"]
    return both(
        found(e, (col("evidence_type") == "statistical") & (_size("result_ids") == 0), "WARNING", "statistical without result"),
        found(e, col("evidence_type").isin(*MOLECULAR) & (_size("dataset_ids") == 0) & (_size("analysis_ids") == 0), "INFO", "molecular without dataset or analysis"),
        found(e, _size("limitations") == 0, "INFO", "no limitations"),
    )


@rule("evidence", "EVD18")
def strength(data: Ledger) -> DataFrame:
    s = col("epistemic_dimensions.evidence_strength")
    parts = [found(data[f], s.isin("high", "medium", "low") & blank(col("epistemic_dimensions.evidence_strength_reason")), "ERROR", "strength without reason") for f in FAMILIES]
    parts.append(found(data["claims"], (s == "high") & (_size("evidence_ids") == 0), "WARNING", "high strength without evidence"))
    return both(*parts)


@rule("evidence", "EVD19")
def nothing(data: Ledger) -> DataFrame:
    n = support_rows(data).select("id").unionByName(data["evidence"].select("id")).unionByName(data["results"].select("id")).agg(F.count(F.lit(1)).alias("n"))
    return found(n.withColumn("id", F.lit(None).cast("string")), col("n") == 0, "INFO", "nothing to check")
