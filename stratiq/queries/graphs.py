"""Closure, cycles, components, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.operators import graph as g
from stratiq.plans.rules.geography import compatible
from stratiq.queries.registry import query

col = F.col


def _tree(d):
    return d.customer.where("c_custkey > 0").select(col("c_custkey").alias("src"), F.expr("c_custkey div 2").alias("dst"))


@query("""WITH RECURSIVE e AS (SELECT c_custkey AS s, c_custkey // 2 AS t FROM customer WHERE c_custkey > 0), r AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s)
SELECT s AS node, t AS ancestor FROM r""")
def tree_closure(d):
    """All ancestors, by path doubling."""
    return g.ancestors(_tree(d))


@query("""WITH RECURSIVE e AS (SELECT 'C' || c_custkey AS s, 'N' || c_nationkey AS t FROM customer UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation), r AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s)
SELECT s AS src, t AS dst FROM r""")
def containment_closure(d):
    """Containment over several families."""
    name = lambda p, c: F.concat(F.lit(p), col(c).cast("string"))
    e = d.customer.select(name("C", "c_custkey").alias("src"), name("N", "c_nationkey").alias("dst")).unionByName(d.nation.select(name("N", "n_nationkey").alias("src"), name("R", "n_regionkey").alias("dst")))
    return g.closure(e)


@query("""WITH RECURSIVE r AS (SELECT CAST(0 AS BIGINT) AS node, CAST(0 AS BIGINT) AS depth UNION ALL SELECT c_custkey, r.depth + 1 FROM customer JOIN r ON c_custkey // 2 = r.node AND c_custkey > 0)
SELECT depth, count(*) AS n FROM r GROUP BY 1""")
def tree_levels(d):
    """Depth of every node, by pointer doubling."""
    parents = d.customer.select(col("c_custkey").alias("node"), F.when(col("c_custkey") > 0, F.expr("c_custkey div 2")).alias("parent"))
    return g.depths(parents).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


CYCLE_SQL = """WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS s, p_partkey // 8 * 8 + (p_partkey * 5 + p_size) % 8 AS t FROM part), r AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s),
c AS (SELECT s FROM r WHERE s = t) SELECT a.s AS node, min(a.t) AS cycle FROM r a JOIN r b ON a.s = b.t AND a.t = b.s WHERE a.s IN (SELECT s FROM c) GROUP BY 1"""


def _functional(d):
    """An edge from every part to one of the same eight."""
    return d.part.select(col("p_partkey").alias("src"), (F.expr("p_partkey div 8 * 8") + (col("p_partkey") * 5 + col("p_size")) % 8).alias("dst")).distinct()


@query(CYCLE_SQL)
def cycle_members(d):
    """G04, G05, TIM17: nodes on a cycle, with the cycle's name."""
    return g.cycle_members(_functional(d)).select("node", "cycle")


@query("SELECT DISTINCT p_partkey AS src FROM part WHERE p_partkey % 8 = (p_partkey * 5 + p_size) % 8")
def self_loops(d):
    """TIM16."""
    return g.self_loops(_functional(d)).select("src")


@query("SELECT l_partkey AS src, count(DISTINCT l_suppkey) AS n_parents FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def multi_parent(d):
    """A14, HYR4: children of several parents."""
    return g.multi_parent(d.lineitem.select(col("l_partkey").alias("src"), col("l_suppkey").alias("dst")))


@query()
def components(d):
    """Connected components over all links."""
    return g.components(d.part.where("p_size % 4 <> 0").select(col("p_partkey").alias("u"), (col("p_partkey") + 7 + col("p_size") % 3).alias("v")))


@query("""WITH RECURSIVE p AS (SELECT p_partkey AS n, p_partkey - 1 - p_size % 5 AS t FROM part WHERE p_partkey - 1 - p_size % 5 > 0), r AS (SELECT n, t FROM p UNION ALL SELECT r.n, p.t FROM r JOIN p ON r.t = p.n)
SELECT n AS node, min(t) AS last, FALSE AS circular FROM r GROUP BY 1""")
def pointer_chase(d):
    """G09, IDN14: where chains of redirects end."""
    p = d.part.select(col("p_partkey").alias("node"), (col("p_partkey") - 1 - col("p_size") % 5).alias("target")).where("target > 0")
    return g.pointer_ends(p)


@query("""WITH RECURSIVE e AS (SELECT c_custkey AS s, c_custkey // 2 AS t FROM customer WHERE c_custkey > 0), r AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s), u AS (SELECT s, t FROM r UNION SELECT c_custkey, c_custkey FROM customer),
g AS (SELECT DISTINCT c_nationkey AS grp, c_custkey AS n FROM customer), c AS (SELECT grp, t, count(DISTINCT n) AS k FROM g JOIN u ON u.s = g.n GROUP BY ALL)
SELECT c.grp, max(t) AS lca FROM c JOIN (SELECT grp, count(*) AS k FROM g GROUP BY 1) z ON c.grp = z.grp AND c.k = z.k GROUP BY 1""")
def lowest_common_ancestor(d):
    """The deepest node above all customers of a nation."""
    parents = d.customer.select(col("c_custkey").alias("node"), F.when(col("c_custkey") > 0, F.expr("c_custkey div 2")).alias("parent"))
    return g.lowest_common_ancestor(parents, d.customer.select(col("c_nationkey").alias("grp"), col("c_custkey").alias("node")))


@query("""SELECT a.s_suppkey AS a, b.s_suppkey AS b, bool_or(na.n_regionkey = nb.n_regionkey) AS fits FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1 JOIN nation na ON na.n_nationkey = a.s_nationkey JOIN nation nb ON nb.n_nationkey = b.s_nationkey GROUP BY ALL""")
def footprint_compatible(d):
    """Footprints that share a region."""
    region = d.supplier.join(d.nation, col("s_nationkey") == col("n_nationkey")).select(col("s_suppkey").alias("entity"), F.concat(F.lit("R"), col("n_regionkey").cast("string")).alias("region"))
    pairs = d.supplier.select(F.lit("x").alias("id"), col("s_suppkey").alias("a"), (col("s_suppkey") + 1).alias("b")).join(d.supplier.select(col("s_suppkey").alias("b")), "b")
    top = d.region.select(F.concat(F.lit("R"), col("r_regionkey").cast("string")).alias("src"), F.lit("WORLD").alias("dst"))
    return compatible(pairs.select("id", "a", "b"), region, top).select("a", "b", "fits")


@query("""WITH RECURSIVE leaf AS (SELECT 0 AS x) SELECT 'WORLD' AS root, '(' || string_agg('(' || kids || ')' || r_name, ',' ORDER BY first, r_name) || ')WORLD;' AS newick
FROM (SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS kids, min(n_name) AS first FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1)""")
def newick_tree(d):
    """A tree as text, children in a fixed order."""
    r, n = d.region, d.nation.join(d.region, col("n_regionkey") == col("r_regionkey"))
    parents = r.select(col("r_name").alias("node"), F.lit("WORLD").alias("parent")).unionByName(n.select(col("n_name").alias("node"), col("r_name").alias("parent")))
    parents = parents.unionByName(d.region.limit(1).select(F.lit("WORLD").alias("node"), F.lit(None).cast("string").alias("parent")))
    return g.newick(parents, parents.select("node", col("node").alias("label")))


@query("""WITH RECURSIVE e AS (SELECT p_type AS scope, p_partkey % 13 AS s, (p_partkey * 3 + p_size) % 13 AS t FROM part), r AS (SELECT scope, s, t FROM e UNION SELECT r.scope, r.s, e.t FROM r JOIN e ON r.scope = e.scope AND r.t = e.s)
SELECT DISTINCT scope, s AS node FROM r WHERE s = t""")
def scoped_cycles(d):
    """G07, HYR3, TIM17: cycles within each scope, over all rows."""
    e = d.part.select(col("p_type").alias("scope"), (col("p_partkey") % 13).alias("src"), ((col("p_partkey") * 3 + col("p_size")) % 13).alias("dst"))
    return g.cycle_members(e, ("scope",)).select("scope", "node")
