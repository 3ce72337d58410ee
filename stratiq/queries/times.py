"""Deep time: spans, overlaps, precedence."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.operators import temporal as tm
from stratiq.queries.registry import query

col = F.col

UNIT_SQL = "CASE p_partkey % 5 WHEN 0 THEN 'years' WHEN 1 THEN 'thousand_years' WHEN 2 THEN 'million_years' WHEN 3 THEN 'generations' ELSE 'calibrated_years' END"
YEARS_SQL = "CASE p_partkey % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 1e3 WHEN 2 THEN 1e6 WHEN 4 THEN 1.0 END"


def _unit():
    m = col("p_partkey") % 5
    return F.when(m == 0, "years").when(m == 1, "thousand_years").when(m == 2, "million_years").when(m == 3, "generations").otherwise("calibrated_years")


@query(f"""SELECT p_partkey, y IS NOT NULL AND (o IS NOT NULL OR n IS NOT NULL) AS comparable, CAST(CASE WHEN o IS NOT NULL OR n IS NOT NULL THEN o * y END AS DOUBLE) AS old, CAST(CASE WHEN o IS NOT NULL OR n IS NOT NULL THEN n * y END AS DOUBLE) AS young
FROM (SELECT p_partkey, CAST({YEARS_SQL} AS DOUBLE) AS y, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size + 10 AS DOUBLE) END AS o, CASE WHEN p_size % 6 <> 0 THEN CAST(p_size AS DOUBLE) END AS n FROM part)""")
def unit_normalise(d):
    """bounds in years before present; open bounds stay null."""
    p = d.part.withColumn("o", F.when(col("p_size") % 4 != 0, (col("p_size") + 10).cast("double"))).withColumn("n", F.when(col("p_size") % 6 != 0, col("p_size").cast("double")))
    ok, old, young = tm.span(col("o"), col("n"), _unit(), F.lit("before_present"))
    return p.select("p_partkey", ok.alias("comparable"), old.alias("old"), young.alias("young"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 3 THEN 'unplaced' WHEN o IS NULL AND n IS NULL THEN 'unplaced' WHEN o IS NULL THEN 'minimum' WHEN n IS NULL THEN 'from' WHEN o = n THEN 'point' ELSE 'interval' END AS shape
FROM (SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size // 7 * 7 AS DOUBLE) END AS o, CASE WHEN p_size % 6 <> 0 THEN CAST(p_size AS DOUBLE) END AS n FROM part)""")
def interval_shapes(d):
    """shapes of marks."""
    p = d.part.withColumn("o", F.when(col("p_size") % 4 != 0, F.expr("p_size div 7 * 7").cast("double"))).withColumn("n", F.when(col("p_size") % 6 != 0, col("p_size").cast("double")))
    return p.select("p_partkey", tm.interval_shape(col("o"), col("n"), _unit()).alias("shape"))


@query("""WITH e AS (SELECT user_id, event_type, min(epoch_ms(ts)) // 1000 AS young, max(epoch_ms(ts)) // 1000 AS old FROM events GROUP BY ALL)
SELECT a.user_id, a.event_type AS a, b.event_type AS b, (a.old >= b.young AND b.old >= a.young) AS overlap FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type < b.event_type""")
def envelope_overlap(d):
    """J07, J09, TIM12: whether two envelopes of one subject share a moment."""
    s = F.expr("unix_millis(cast(ts as timestamp)) div 1000")
    e = d.events.withColumn("s", s).groupBy("user_id", "event_type").agg(F.min("s").cast("double").alias("young"), F.max("s").cast("double").alias("old"))
    a, b = e.select("user_id", col("event_type").alias("a"), col("young").alias("a_young"), col("old").alias("a_old")), e.select("user_id", col("event_type").alias("b"), col("young").alias("b_young"), col("old").alias("b_old"))
    return tm.any_overlap(a.join(b, "user_id").where("a < b"), ("user_id", "a", "b"))


@query("""WITH n AS (SELECT c_nationkey AS id, min(epoch_ms(o_orderdate)) / 86400000.0 AS young, max(epoch_ms(o_orderdate)) / 86400000.0 AS old FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
s AS (SELECT p.p_partkey AS id, 9000.0 + p.p_partkey % 3000 AS young, 9000.0 + p.p_partkey % 3000 + p.p_size AS old FROM part p)
SELECT n.id AS left_id, s.id AS right_id FROM n JOIN s ON n.old >= s.young AND s.old >= n.young""")
def interval_overlap_pairs(d):
    """Overlap join by buckets, each pair once."""
    day = F.expr("unix_millis(cast(o_orderdate as timestamp))") / F.lit(86400000.0)
    n = d.orders.join(d.customer, col("c_custkey") == col("o_custkey")).groupBy(col("c_nationkey").alias("id")).agg(F.min(day).alias("young"), F.max(day).alias("old"))
    young = F.lit(9000.0) + col("p_partkey") % 3000
    s = d.part.select(col("p_partkey").alias("id"), young.alias("young"), (young + col("p_size")).alias("old"))
    return tm.overlap_join(n, s, 64.0)


@query("""WITH a AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 <> 0 THEN 1000 + s_suppkey * 7 % 3000 END AS young, CASE WHEN s_suppkey % 7 <> 0 THEN 1000 + s_suppkey * 7 % 3000 + s_suppkey % 40 END AS old FROM supplier),
b AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey * 150 END AS young, CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey * 150 + 90 END AS old FROM nation)
SELECT a.id AS left_id, b.id AS right_id FROM a JOIN b ON (a.old IS NULL OR b.young IS NULL OR a.old >= b.young) AND (b.old IS NULL OR a.young IS NULL OR b.old >= a.young)""")
def open_overlap_pairs(d):
    """Overlap join of intervals with open bounds."""
    k, n = col("s_suppkey"), col("n_nationkey")
    young = 1000 + k * 7 % 3000
    a = d.supplier.select(k.alias("id"), F.when(k % 5 != 0, young).alias("young"), F.when(k % 7 != 0, young + k % 40).alias("old"))
    b = d.nation.select(n.alias("id"), F.when(n % 3 != 0, n * 150).alias("young"), F.when(n % 4 != 0, n * 150 + 90).alias("old"))
    return tm.overlap_join(a, b)


@query("SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING bool_and(l_shipdate < o_orderdate)")
def strictly_precedes(d):
    """J10, TIM14: all of one side's dates lie before the other's."""
    met = d.orders.join(d.lineitem, col("l_orderkey") == col("o_orderkey"))
    return met.groupBy("o_orderkey").agg(F.bool_and(tm.strictly_younger(col("l_shipdate"), col("o_orderdate"))).alias("every")).where("every").select("o_orderkey")


@query("SELECT o_custkey, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, count(*) AS n FROM orders GROUP BY 1")
def envelope_spread(d):
    """Range over all marks."""
    return d.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, bool_and(l_returnflag = 'A') AS every, bool_or(l_returnflag = 'R') AS some FROM lineitem GROUP BY 1")
def any_all(d):
    """Any and all over a group."""
    return d.lineitem.groupBy("l_orderkey").agg(F.bool_and(col("l_returnflag") == "A").alias("every"), F.bool_or(col("l_returnflag") == "R").alias("some"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'no unit' WHEN o_orderkey % 11 = 0 THEN 'unknown unit' END AS unit_problem, (o_orderkey % 3 = 0) <> (o_orderkey % 5 = 0) AS half_open,
CASE WHEN o_totalprice < 100000 THEN 'ERROR' WHEN o_totalprice < 200000 THEN 'WARNING' ELSE 'INFO' END AS severity FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_totalprice < 200000""")
def ordered_checks(d):
    """TIM1, TIM2: ordered conditions of which the first decides."""
    k = col("o_orderkey")
    unit = F.when(k % 7 == 0, "no unit").when(k % 11 == 0, "unknown unit")
    sev = F.when(col("o_totalprice") < 100000, "ERROR").when(col("o_totalprice") < 200000, "WARNING").otherwise("INFO")
    return d.orders.where((k % 7 == 0) | (k % 11 == 0) | (col("o_totalprice") < 200000)).select("o_orderkey", unit.alias("unit_problem"), ((k % 3 == 0) != (k % 5 == 0)).alias("half_open"), sev.alias("severity"))


@query("SELECT p_partkey, round((p_size - 1.0) / 49.0 * 1000.0, 6) AS x FROM part")
def linear_scale(d):
    """values on an axis."""
    return d.part.select("p_partkey", F.round(tm.scale_linear(col("p_size").cast("double"), 1.0, 50.0, 0.0, 1000.0), 6).alias("x"))
