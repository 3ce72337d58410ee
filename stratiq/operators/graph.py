"""Graph operators over edge DataFrames: closure, cycles, components, pointers.

Iterations double path lengths or contract stars, so their number grows with
the logarithm of the depth; each round is settled in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiq.session import settled


def closure(edges: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """All pairs (``src``, ``dst``) with a path of one edge or more, within each
    scope.  A node reaches itself only over a cycle.  Null ends are no edges."""
    cols = (*scope, "src", "dst")
    reach = settled(edges.where("src is not null and dst is not null").select(*cols).distinct())
    n = reach.count()
    while n:
        left, right = reach.withColumnRenamed("dst", "via"), reach.withColumnRenamed("src", "via")
        longer = left.join(right, [*scope, "via"]).select(*cols)
        reach = settled(reach.unionByName(longer).distinct())
        now = reach.count()
        if now == n:  # pairs are only ever added
            break
        n = now
    return reach


def ancestors(edges: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """(``node``, ``ancestor``) of edges from child ``src`` to parent ``dst``."""
    return closure(edges, scope).withColumnRenamed("src", "node").withColumnRenamed("dst", "ancestor")


def _peeled(edges: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """Edges without those that start where none ends, or end where none starts,
    round by round while at least a tenth of them go."""
    cols = (*scope, "src", "dst")
    left = settled(edges.where("src is not null and dst is not null").select(*cols).distinct())
    n = left.count()
    while n:
        starts = left.select(*scope, F.col("src").alias("dst")).distinct()
        ends = left.select(*scope, F.col("dst").alias("src")).distinct()
        left = settled(left.join(starts, [*scope, "dst"], "left_semi").join(ends, [*scope, "src"], "left_semi").select(*cols))
        now = left.count()
        if now > 0.9 * n:
            break
        n = now
    return left


def cycle_members(edges: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Nodes on a directed cycle, with ``cycle``: the least node of their cycle's
    strongly connected part, its name.  Nodes without an edge in or out are
    peeled off first, so that paths are only followed where cycles may be."""
    reach = closure(_peeled(edges, scope), scope)
    on = reach.where("src = dst").select(*scope, F.col("src").alias("node"))
    back = reach.withColumnRenamed("src", "y").withColumnRenamed("dst", "x")
    mutual = reach.withColumnRenamed("src", "x").withColumnRenamed("dst", "y").join(back, [*scope, "x", "y"])
    least = mutual.groupBy(*scope, F.col("x").alias("node")).agg(F.min("y").alias("cycle"))
    return on.join(least, [*scope, "node"])


def self_loops(edges: DataFrame) -> DataFrame:
    return edges.where("src = dst")


def acyclicity(edges: DataFrame) -> DataFrame:
    """Cycles of ``scope, src, dst, modal`` by severity, per scope: ERROR if strict
    edges alone close one, WARNING if it takes modal edges, and INFO (scope
    "*") for nodes that lie on a cycle of the union of scopes only."""
    strict = cycle_members(edges.where(~F.col("modal")), ("scope",)).select("scope", "node", "cycle", F.lit("ERROR").alias("severity"))
    loose = cycle_members(edges, ("scope",)).join(strict.select("scope").distinct(), "scope", "left_anti").select("scope", "node", "cycle", F.lit("WARNING").alias("severity"))
    inside = strict.unionByName(loose)
    union = cycle_members(edges).join(inside.select("node").distinct(), "node", "left_anti").select(F.lit("*").alias("scope"), "node", "cycle", F.lit("INFO").alias("severity"))
    return inside.unionByName(union)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links, ascending, and the least node that each can reach."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    to = np.arange(len(nodes))
    while (to[a] != to[b]).any():
        one, other = to[a], to[b]
        np.minimum.at(to, np.maximum(one, other), np.minimum(one, other))
        while (to[to] != to).any():
            to = to[to]
    return nodes, nodes[to]


def components(links: DataFrame, *, few: int = 0) -> DataFrame:
    """(``node``, ``component``) of undirected links ``u``, ``v``; a component is
    named by its least node.  Alternating large-star and small-star steps.  Up
    to ``few`` distinct links (of long integers) are followed on the driver in
    one go: what the driver keeps of every job of the steps is far more."""
    links = settled(links.where("u <> v").select("u", "v").distinct())
    n = links.count()
    if few and n <= few:
        found = links.select(F.col("u").cast("long"), F.col("v").cast("long")).toArrow()  # few rows at most
        nodes, least = least_reachable(found["u"].to_numpy(), found["v"].to_numpy())
        return links.sparkSession.createDataFrame(pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array(least, pa.int64())}))
    while n:
        made = settled(_small_star(_large_star(links)))
        now = made.count()
        same = now == n and made.join(links, ["u", "v"], "left_anti").isEmpty()
        links, n = made, now
        if same:
            break
    own = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def depths(parents: DataFrame) -> DataFrame:
    """(``node``, ``root``, ``depth``) of a forest of (``node``, ``parent``), roots
    with a null parent.  Pointer doubling; nodes below a cycle have no root and
    are left out."""
    state = settled(parents.select("node", F.coalesce("parent", "node").alias("to"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    for _ in range(state.count().bit_length() + 1):  # pointers double; more rounds would only turn in cycles
        up = state.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("depth").alias("d2"))
        state = settled(state.join(up, "to").select("node", F.col("to2").alias("to"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("to") != F.col("to2")).alias("moved")))
        if state.where("moved").isEmpty():
            break
    roots = parents.where("parent is null").select(F.col("node").alias("to"))
    return state.join(roots, "to").select("node", F.col("to").alias("root"), "depth")


def pointer_ends(pointers: DataFrame) -> DataFrame:
    """Where chains of (``node``, ``target``) end: (``node``, ``last``, ``circular``).
    The last target is one that points nowhere; a chain that comes back to a
    node it has passed is circular and has no last target."""
    onward = pointers.select(F.col("node").alias("last")).distinct()
    if pointers.groupBy("node").count().where("count > 1").isEmpty():  # one target each: pointers double
        state = settled(pointers.select("node", F.col("target").alias("last")))
        for _ in range(state.count().bit_length() + 1):
            up = state.select(F.col("node").alias("last"), F.col("last").alias("next"))
            state = settled(state.join(up, "last", "left").select("node", F.coalesce("next", "last").alias("last"), F.col("next").isNotNull().alias("moved")))
            if state.where("moved").isEmpty():
                break
        ends = state.select("node", "last").join(onward, "last", "left_anti")
    else:
        reach = closure(pointers.select(F.col("node").alias("src"), F.col("target").alias("dst")))
        ends = reach.withColumnRenamed("dst", "last").join(onward, "last", "left_anti").groupBy(F.col("src").alias("node")).agg(F.min("last").alias("last"))
    return pointers.select("node").distinct().join(ends, "node", "left").withColumn("circular", F.col("last").isNull())


def multi_parent(edges: DataFrame) -> DataFrame:
    """Children (``src``) with more than one parent (``dst``)."""
    return edges.groupBy("src").agg(F.countDistinct("dst").alias("n_parents")).where("n_parents > 1")


def lowest_common_ancestor(parents: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each ``grp`` of (``grp``, ``node``): the deepest node that is, or is
    above, all its nodes."""
    up = ancestors(parents.where("parent is not null").select(F.col("node").alias("src"), F.col("parent").alias("dst")))
    above = up.unionByName(parents.select("node", F.col("node").alias("ancestor")).distinct())
    size = nodes.groupBy("grp").agg(F.countDistinct("node").alias("size"))
    common = nodes.distinct().join(above, "node").groupBy("grp", "ancestor").agg(F.countDistinct("node").alias("n"))
    common = common.join(size, "grp").where("n = size")
    deep = depths(parents).select(F.col("node").alias("ancestor"), "depth")
    best = Window.partitionBy("grp").orderBy(F.desc("depth"), "ancestor")
    return common.join(deep, "ancestor").withColumn("r", F.row_number().over(best)).where("r = 1").select("grp", F.col("ancestor").alias("lca"))


def innermost_parent(candidates: DataFrame, up: DataFrame) -> DataFrame:
    """Of each node's candidate parents (``node``, ``parent``) the one below all
    the others; ``up`` is (``node``, ``ancestor``).  Null if none is."""
    a, b = candidates.alias("a"), candidates.withColumnRenamed("parent", "other").alias("b")
    pairs = a.join(b, "node").where("parent <> other")
    bad = pairs.join(up.select(F.col("node").alias("parent"), F.col("ancestor").alias("other")), ["parent", "other"], "left_anti").select("node", "parent").distinct()
    good = candidates.distinct().join(bad, ["node", "parent"], "left_anti").groupBy("node").agg(F.min("parent").alias("parent"))
    return candidates.select("node").distinct().join(good, "node", "left")


def newick(parents: DataFrame, labels: DataFrame) -> DataFrame:
    """(``root``, ``newick``) of forests (``node``, ``parent``) with (``node``,
    ``label``).  Children stand inner nodes first, then by their first leaf's
    label, then by id.  Built level by level from the deepest upward."""
    spark = parents.sparkSession
    deep = settled(depths(parents).join(parents, "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", F.col("node").cast("string"))))
    most = deep.agg(F.max("depth")).head()[0]
    if most is None:
        return spark.createDataFrame([], f"root {parents.schema['node'].dataType.simpleString()}, newick string")
    empty = deep.select("node", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("first")).where("false")
    below = empty.withColumnRenamed("node", "parent")
    for level in range(most, -1, -1):
        here = deep.where(F.col("depth") == level).join(below.withColumnRenamed("parent", "node"), "node", "left")
        made = here.select(
            "node", "parent", "root",
            F.when(F.col("text").isNull(), F.col("label")).otherwise(F.concat(F.lit("("), "text", F.lit(")"), "label")).alias("own"),
            F.coalesce("first", "label").alias("leaf"),
            F.col("text").isNull().cast("int").alias("is_leaf"),
        )
        made = settled(made) if level % 8 == 0 else made
        ordered = F.array_sort(F.collect_list(F.struct("is_leaf", "leaf", "node", "own")))
        below = made.where("parent is not null").groupBy("parent").agg(F.array_join(F.transform(ordered, lambda x: x["own"]), ",").alias("text"), F.min("leaf").alias("first"))
    return made.select("root", F.concat("own", F.lit(";")).alias("newick"))
