"""Rules of the validation families over ledgers derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.plans.findings import both
from stratiq.plans.rules import evidence, hypotheses, time
from stratiq.queries.registry import query

col = F.col

TYPES = ("occurrence_date", "observed_taxon_range", "inferred_lineage_range", "divergence_estimate", "event_date", "trait_evidence_date", "publication_date", "classification_validity_period", "nonsense")
UNITS = ("years", "million_years", "generations", "geological_interval", None, "furlongs")
REFS = ("before_present", "calendar", None)
KINDS = (None, "symmetric", "credible_interval", "unknown", "unknown", "unknown", "unknown", "unknown")
FOUND = (None, "observed", "inferred", "modelled", "reported_without_basis", "unknown", "guess")


def _pick(key, values):
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(key % len(values) == i, F.lit(v).cast("string")).otherwise(out)
    return out


def _sql(values, key="k"):
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)) + " END"


TIMES = f"""t AS (SELECT 'TIME-' || lpad(CAST(k AS VARCHAR), 6, '0') AS id, {_sql(TYPES)} AS type, k % 10 <> 0 AS iv, {_sql(UNITS)} AS unit, CASE WHEN k % 4 <> 0 THEN k % 50 END AS old, CASE WHEN k % 5 <> 0 THEN k % 40 - 3 END AS young,
coalesce({_sql(REFS)}, 'not_stated') AS ref, k % 7 = 0 AS named, {_sql(KINDS)} AS kind, k % 16 = 1 AS size, k % 16 = 2 AS level, CASE k % 11 WHEN 0 THEN NULL WHEN 1 THEN 'molecular_clock' ELSE 'ics' END AS cal, {_sql(FOUND)} AS det, k % 13 = 0 AS clock, k % 12 = 0 AS dated FROM (SELECT o_orderkey AS k FROM orders)),
u AS (SELECT * FROM t WHERE iv AND unit IN ('years', 'million_years', 'generations', 'geological_interval'))"""


@query(f"""WITH {TIMES}
SELECT 'ERROR' AS severity, id AS record_id, 'unknown temporal type' AS detail FROM t WHERE type = 'nonsense'
UNION ALL SELECT 'ERROR', id, 'publication without calendar date' FROM t WHERE type = 'publication_date' AND NOT dated
UNION ALL SELECT 'ERROR', id, 'deep time without interval' FROM t WHERE NOT iv AND type IN ('occurrence_date', 'observed_taxon_range', 'inferred_lineage_range', 'divergence_estimate', 'event_date', 'trait_evidence_date')
UNION ALL SELECT 'ERROR', id, 'neither interval nor date' FROM t WHERE NOT iv AND type IN ('classification_validity_period', 'nonsense') AND NOT dated
UNION ALL SELECT 'ERROR', id, 'no unit' FROM t WHERE iv AND unit IS NULL
UNION ALL SELECT 'ERROR', id, 'unknown unit' FROM t WHERE iv AND unit = 'furlongs'
UNION ALL SELECT 'WARNING', id, 'no bound' FROM u WHERE old IS NULL AND young IS NULL AND unit <> 'geological_interval'
UNION ALL SELECT 'ERROR', id, 'inverted interval' FROM u WHERE CASE WHEN ref = 'calendar' THEN old > young ELSE old < young END
UNION ALL SELECT 'ERROR', id, 'negative oldest_bound' FROM u WHERE ref <> 'calendar' AND old < 0
UNION ALL SELECT 'ERROR', id, 'negative youngest_bound' FROM u WHERE ref <> 'calendar' AND young < 0
UNION ALL SELECT 'ERROR', id, 'geological unit without name' FROM u WHERE unit = 'geological_interval' AND NOT named
UNION ALL SELECT 'WARNING', id, 'geological unit with numbers' FROM u WHERE unit = 'geological_interval' AND (old IS NOT NULL OR young IS NOT NULL)
UNION ALL SELECT 'ERROR', id, 'no uncertainty' FROM u WHERE kind IS NULL
UNION ALL SELECT 'WARNING', id, 'uncertainty without magnitude' FROM u WHERE kind = 'symmetric' AND NOT size
UNION ALL SELECT 'WARNING', id, 'interval without level' FROM u WHERE kind = 'credible_interval' AND NOT level
UNION ALL SELECT 'ERROR', id, 'no calibration' FROM u WHERE cal IS NULL
UNION ALL SELECT 'ERROR', id, 'no determination' FROM t WHERE det IS NULL
UNION ALL SELECT 'ERROR', id, 'unknown determination' FROM t WHERE det = 'guess'
UNION ALL SELECT 'ERROR', id, 'observed range by inference' FROM t WHERE type = 'observed_taxon_range' AND det IN ('inferred', 'modelled')
UNION ALL SELECT 'ERROR', id, 'estimate as observation' FROM t WHERE type IN ('inferred_lineage_range', 'divergence_estimate') AND det = 'observed'
UNION ALL SELECT 'ERROR', id, 'molecular clock as observation' FROM t WHERE clock AND det = 'observed'
UNION ALL SELECT 'WARNING', id, 'reported without basis' FROM t WHERE det = 'reported_without_basis'
UNION ALL SELECT 'ERROR', id, 'clock calibration as observation' FROM t WHERE cal = 'molecular_clock' AND det = 'observed'""")
def time_rules(d):
    """TIM1 to TIM6 and TIM8 to TIM10 over temporal expressions derived from orders."""
    k = col("o_orderkey")
    interval = F.struct(F.when(k % 4 != 0, (k % 50).cast("double")).alias("oldest_bound"), F.when(k % 5 != 0, (k % 40 - 3).cast("double")).alias("youngest_bound"), _pick(k, UNITS).alias("unit"), _pick(k, REFS).alias("reference_point"), F.when(k % 7 == 0, "x").alias("geological_interval"))
    kind = F.struct(_pick(k, KINDS).alias("kind"), F.when(k % 16 == 1, 1.0).alias("plus_minus"), F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"), F.when(k % 16 == 2, 0.95).alias("level"))
    t = d.orders.select(
        F.concat(F.lit("TIME-"), F.lpad(k.cast("string"), 6, "0")).alias("id"), _pick(k, TYPES).alias("temporal_type"), F.when(k % 10 != 0, interval).alias("interval"), F.when(k % 12 == 0, "2024-01-01").alias("calendar_date"), kind.alias("uncertainty"),
        F.struct(F.when(k % 11 == 1, "molecular_clock").when(k % 11 != 0, "ics").alias("system")).alias("calibration"), F.when(k % 13 == 0, "molecular_clock").alias("method_type"), _pick(k, FOUND).alias("determination"), F.lit("temporal-expressions.jsonl").alias("file"),
    )
    data = {"temporal-expressions": t}
    rules = (time.types, time.units, time.unbounded, time.inverted, time.negative, time.geologic, time.uncertainty, time.calibration, time.determination)
    return both(*[f(data) for f in rules]).select("severity", "record_id", "detail")


@query("""WITH s AS (SELECT 'CLAIM-' || lpad(CAST(l_orderkey AS VARCHAR), 6, '0') AS id, l_linenumber AS n, CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'bootstrap' WHEN 2 THEN 'Índice de Confianza' ELSE 'support' END AS m, CASE WHEN l_partkey % 3 = 0 THEN 'strong' ELSE CAST(l_partkey AS VARCHAR) END AS v,
CASE WHEN l_suppkey % 2 = 0 THEN 'SRC-1' END AS src, CASE WHEN l_suppkey % 3 = 0 THEN 'ml' END AS method, CASE WHEN l_suppkey % 5 = 0 THEN 'ratio' END AS scale, CASE WHEN l_suppkey % 7 = 0 THEN 'p. 1' END AS loc, l_partkey % 3 <> 0 AS num FROM lineitem)
SELECT 'ERROR' AS severity, id AS record_id, 'value without measure type' AS detail FROM s WHERE m IS NULL
UNION ALL SELECT 'ERROR', id, 'number without source' FROM s WHERE num AND src IS NULL
UNION ALL SELECT 'ERROR', id, 'number without method' FROM s WHERE num AND method IS NULL
UNION ALL SELECT CASE WHEN src IS NOT NULL AND method IS NOT NULL AND scale IS NOT NULL THEN 'WARNING' ELSE 'ERROR' END, id, 'vague measure: indice_de_confianza' FROM s WHERE m LIKE '%Confianza'
UNION ALL SELECT 'WARNING', id, 'value without source' FROM s WHERE NOT num AND src IS NULL
UNION ALL SELECT 'WARNING', id, CASE WHEN scale IS NULL THEN 'scale, applies_to, conditions' ELSE 'applies_to, conditions' END FROM s WHERE num
UNION ALL SELECT 'WARNING', id, 'source without locator' FROM s WHERE src IS NOT NULL AND loc IS NULL""")
def evidence_rules(d):
    """EVD1 to EVD6 over quantitative support derived from line items."""
    n, p, s = col("l_linenumber"), col("l_partkey"), col("l_suppkey")
    measure = F.when(n % 4 == 1, "bootstrap").when(n % 4 == 2, "Índice de Confianza").when(n % 4 == 3, "support")
    none = F.lit(None).cast("string")
    entry = F.struct(measure.alias("measure_type"), F.when(p % 3 == 0, "strong").otherwise(p.cast("string")).alias("value"), none.alias("unit"), F.when(s % 5 == 0, "ratio").alias("scale"), F.when(s % 3 == 0, "ml").alias("method"), F.when(s % 2 == 0, "SRC-1").alias("source_id"), F.when(s % 7 == 0, "p. 1").alias("locator"), none.alias("applies_to"), none.alias("conditions"))
    claims = d.lineitem.select(F.concat(F.lit("CLAIM-"), F.lpad(col("l_orderkey").cast("string"), 6, "0")).alias("id"), F.array(entry).alias("quantitative_support"), F.lit("claims.jsonl").alias("file"))
    data = {"claims": claims}
    rules = (evidence.no_measure, evidence.bare_numbers, evidence.vague, evidence.sourceless, evidence.incomplete, evidence.no_locator)
    return both(*[f(data) for f in rules]).select("severity", "record_id", "detail")


@query("""WITH h AS (SELECT o_custkey AS c, list('CLAIM-' || o_orderkey ORDER BY o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS inc, list('CLAIM-' || o_orderkey) FILTER (WHERE o_orderkey % 3 = 0) AS req, list('CLAIM-' || o_orderkey) FILTER (WHERE o_orderkey % 5 = 0) AS exc FROM orders GROUP BY 1),
x AS (SELECT 'HYP-' || c AS id, coalesce(inc, []) AS inc, coalesce(req, []) AS req, coalesce(exc, []) AS exc FROM h),
s AS (SELECT 'CLAIM-' || o_orderkey AS c FROM orders WHERE o_orderstatus = 'F')
SELECT 'ERROR' AS severity, id AS record_id, 'required but not included' AS detail FROM x WHERE len(list_filter(req, lambda r: NOT list_contains(inc, r))) > 0
UNION ALL SELECT 'ERROR', id, 'required and excluded' FROM x WHERE list_has_any(req, exc)
UNION ALL SELECT 'ERROR', id, 'included and excluded' FROM x WHERE list_has_any(inc, exc)
UNION ALL SELECT 'WARNING', id, 'inactive requirement' FROM (SELECT id, unnest(req) AS c FROM x) JOIN s USING (c)
UNION ALL SELECT 'WARNING', id, 'inactive inclusion' FROM (SELECT id, unnest(list_filter(inc, lambda i: NOT list_contains(req, i))) AS c FROM x) JOIN s USING (c)""")
def hypothesis_rules(d):
    """HYR1 over hypotheses derived from customers' orders."""
    k = col("o_orderkey")
    name = F.concat(F.lit("CLAIM-"), k.cast("string"))
    h = d.orders.groupBy("o_custkey").agg(*[F.collect_list(F.when(k % m == 0, name)).alias(f"{n}_claim_ids") for n, m in (("included", 2), ("required", 3), ("excluded", 5))])
    h = h.select(F.concat(F.lit("HYP-"), col("o_custkey").cast("string")).alias("id"), "included_claim_ids", "required_claim_ids", "excluded_claim_ids", F.lit("hypotheses.jsonl").alias("file"))
    claims = d.orders.select(name.alias("id"), F.when(col("o_orderstatus") == "F", "deprecated").otherwise("active").alias("record_status"))
    return hypotheses.requirements({"hypotheses": h, "claims": claims}).select("severity", "record_id", "detail")
