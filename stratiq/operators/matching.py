"""Assisted identity resolution: blocking, candidate pairs with reasons, homonym
signals, review decisions.  Nothing is merged by similarity alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators.graph import components


def block_keys(labels: DataFrame, *, edits: int = 1, prefix: int = 5) -> DataFrame:
    """``labels`` (``label``, ``key``, ``core``) exploded to block keys: neighbours
    by up to ``edits`` deletions, words of three letters or more, prefix and core."""
    near = t.deletions(F.col("key"), edits)
    words = F.filter(F.split("key", " "), lambda w: F.length(w) >= 3)
    head = F.array(F.substr("key", F.lit(1), F.lit(prefix)))
    tagged = lambda kind, arr: F.transform(arr, lambda x: F.concat(F.lit(kind), x))
    keys = F.array_distinct(F.concat(tagged("d:", near), tagged("w:", words), tagged("p:", head), tagged("c:", F.array("core"))))
    return labels.select("label", "key", "core", F.explode(keys).alias("block"))


def candidate_pairs(labels: DataFrame, *, edits: int = 1, root: int = 0, synonyms: DataFrame | None = None, qualifiers: str = r"\([^)]*\)|s\. ?l\.|s\. ?s\.|sp\.") -> DataFrame:
    """Pairs of ``label``s that may name the same thing, with ``reasons``.

    Reasons: qualifier (same core), synonym_declared, containment,
    edit_distance (``edits`` at most), shared_root (``root`` letters or more;
    off at 0).  Equal keys are identical groups, no pairs.  Pairs whose one
    reason is that a species stands under its genus, or that differ in digits
    only, are kept with ``suppressed`` set.
    """
    key = t.comparison_key(F.col("label"))
    core, _ = t.core_and_qualifier(key, qualifiers)
    base = labels.select("label").distinct().withColumn("key", key).withColumn("core", core)
    blocks = block_keys(base, edits=edits)
    a = blocks.select("block", *[F.col(c).alias(f"{c}_a") for c in ("label", "key", "core")])
    b = blocks.select("block", *[F.col(c).alias(f"{c}_b") for c in ("label", "key", "core")])
    pairs = a.join(b, "block").where("label_a < label_b and key_a <> key_b").drop("block").distinct()
    if synonyms is not None:
        said = synonyms.select(F.least("a", "b").alias("label_a"), F.greatest("a", "b").alias("label_b")).distinct().withColumn("declared", F.lit(True))
        named = base.select(*[F.col(c).alias(f"{c}_a") for c in ("label", "key", "core")]), base.select(*[F.col(c).alias(f"{c}_b") for c in ("label", "key", "core")])
        more = said.drop("declared").join(named[0], "label_a").join(named[1], "label_b").select(*pairs.columns)
        pairs = pairs.unionByName(more).distinct().join(said, ["label_a", "label_b"], "left").withColumn("declared", F.coalesce("declared", F.lit(False)))
    else:
        pairs = pairs.withColumn("declared", F.lit(False))
    ka, kb = F.col("key_a"), F.col("key_b")
    short, long = F.when(F.length(ka) <= F.length(kb), ka).otherwise(kb), F.when(F.length(ka) <= F.length(kb), kb).otherwise(ka)
    reasons = F.array_compact(F.array(
        F.when(F.col("core_a") == F.col("core_b"), "qualifier"),
        F.when(F.col("declared"), "synonym_declared"),
        F.when(t.meaningfully_contained(short, long), "containment"),
        F.when(t.near(ka, kb, edits), "edit_distance"),
        F.when((F.lit(root) > 0) & (t.common_prefix_length(ka, kb) >= root), "shared_root"),
    ))
    made = pairs.withColumn("reasons", reasons).where(F.size("reasons") > 0)
    alone = (F.size("reasons") == 1) & ~F.col("declared")
    hidden = F.when(alone & t.extends_binomially(short, long), "genus_species").when(alone & t.differ_in_digits_only(ka, kb), "digits")
    return made.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"), "reasons", hidden.alias("suppressed"))


def identical_groups(labels: DataFrame, label: str = "label") -> DataFrame:
    """Groups of spellings with one comparison key: ``key``, ``n`` and their members."""
    g = labels.select(label).distinct().groupBy(t.comparison_key(F.col(label)).alias("key")).agg(F.array_sort(F.collect_set(label)).alias("members"))
    return g.where(F.size("members") > 1).select("key", F.size("members").cast("long").alias("n"), "members")


def homonym_signals(labels: DataFrame) -> DataFrame:
    """Labels with signals of several meanings.

    ``labels`` has booleans: strong ``several_rows, approx_mark, several_types,
    several_sisters, several_crowns, member_and_sister, unnested`` and
    supporting ``warning_mark, historical_mark, in_synonymy, mixed_vigency``.
    A decision is due with any strong one or two supporting ones.
    """
    strong = ("several_rows", "approx_mark", "several_types", "several_sisters", "several_crowns", "member_and_sister", "unnested")
    weak = ("warning_mark", "historical_mark", "in_synonymy", "mixed_vigency")
    listed = lambda names: F.array_compact(F.array(*[F.when(F.coalesce(F.col(n), F.lit(False)), n) for n in names]))
    out = labels.withColumn("strong", listed(strong)).withColumn("supporting", listed(weak))
    return out.where((F.size("strong") > 0) | (F.size("supporting") >= 2)).select("label", "strong", "supporting")


def number_decisions(decisions: DataFrame) -> DataFrame:
    """Decisions in order of falling risk, subrank and weight, then labels, as D-0001…"""
    from stratiq.operators.relational import number_rows

    numbered = number_rows(decisions.withColumn("__o", -F.col("risk")).withColumn("__s", -F.col("subrank")).withColumn("__w", -F.col("weight")), ["__o", "__s", "__w", "labels"])
    return numbered.withColumn("decision", F.concat(F.lit("D-"), F.lpad(F.col("row_number").cast("string"), 4, "0"))).drop("row_number", "__o", "__s", "__w")


def apply_review(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Joins what a review says of pairs (``a``, ``b``, ``mark``: yes, no, pending).

    Returns (groups, contradictions, implicit): *groups* of labels by their
    yes-pairs; a group that holds a no-pair is a *contradiction* and dissolves
    whole; *implicit* merges are pairs in a group that nobody was asked about.
    """
    ids = pairs.select(F.col("a").alias("x")).unionByName(pairs.select(F.col("b").alias("x"))).distinct()
    yes = pairs.where("mark = 'yes'").select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = components(yes)
    no = pairs.where("mark = 'no'")
    inside = no.join(found.select(F.col("node").alias("a"), F.col("component").alias("ga")), "a").join(found.select(F.col("node").alias("b"), F.col("component").alias("gb")), "b").where("ga = gb")
    wrong = inside.select(F.col("ga").alias("component"), "a", "b")
    good = found.join(wrong.select("component").distinct(), "component", "left_anti")
    groups = ids.join(good.select(F.col("node").alias("x"), "component"), "x", "left").select(F.col("x").alias("label"), F.coalesce("component", "x").alias("group"))
    one, two = good.select("component", F.col("node").alias("a")), good.select("component", F.col("node").alias("b"))
    asked = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    implicit = one.join(two, "component").where("a < b").select("a", "b").join(asked, ["a", "b"], "left_anti")
    return groups, wrong, implicit


def context_lines(labels: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows (``row_id``, ``label``, ``line``) that mention each label."""
    w = Window.partitionBy("label").orderBy("row_id")
    kept = rows.join(labels.select("label").distinct(), "label", "left_semi").withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)
    return kept.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "line"))), lambda x: x["line"]).alias("lines"))


def review_token(document_hash: str, decisions: DataFrame) -> DataFrame:
    """Sixteen hexadecimal digits that change with the document and its decisions."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("decision", "labels"))), lambda d: F.concat_ws("\t", d["decision"], d["labels"])), "\n")
    return decisions.agg(F.substr(F.sha2(F.concat(F.lit(document_hash + "\n"), listed).cast("binary"), 256), F.lit(1), F.lit(16)).alias("token"))
