"""Labels: identical groups, near labels, homonyms."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators import matching as m
from stratiq.queries.registry import query

col = F.col


@query("""SELECT key, count(*) AS n, string_agg(label, ',' ORDER BY label) AS members FROM (SELECT DISTINCT label, trim(lower(regexp_replace(label, '\\s+', ' ', 'g'))) AS key FROM (SELECT p_name AS label FROM part UNION ALL SELECT upper(p_name) FROM part UNION ALL SELECT replace(p_name, ' ', '  ') FROM part WHERE p_size > 25)) GROUP BY 1 HAVING count(*) > 1""")
def identical_groups(d):
    """Spellings of one comparison key."""
    labels = d.part.select(col("p_name").alias("label")).union(d.part.select(F.upper("p_name"))).union(d.part.where("p_size > 25").select(F.replace("p_name", F.lit(" "), F.lit("  "))))
    return m.identical_groups(labels).select("key", "n", F.array_join("members", ",").alias("members"))


@query("""WITH w AS (SELECT DISTINCT trim(lower(regexp_replace(p_name || ' ' || p_type, '\\s+', ' ', 'g'))) AS k FROM part) SELECT a.k AS a, b.k AS b FROM w a JOIN w b ON a.k < b.k AND levenshtein(a.k, b.k) <= 1""")
def edit_pairs(d):
    """Labels one edit apart, found through shared deletions."""
    w = d.part.select(t.folded(F.concat_ws(" ", "p_name", "p_type")).alias("k")).distinct()
    blocks = w.select("k", F.explode(t.deletions(col("k"))).alias("block"))
    a, b = blocks.select("block", col("k").alias("a")), blocks.select("block", col("k").alias("b"))
    return a.join(b, "block").where("a < b").select("a", "b").distinct().where(t.near(col("a"), col("b"), 1))


@query("""WITH l AS (SELECT DISTINCT c_name AS label, regexp_replace(c_name, '[0-9]+', '#', 'g') AS mask FROM customer WHERE regexp_matches(c_name, '[0-9]'))
SELECT label, representative, n, label <> representative AS differs FROM l JOIN (SELECT mask, min(label) AS representative, count(*) AS n FROM l GROUP BY 1) USING (mask)""")
def digits_only_classes(d):
    """every label with digits, its class of labels that differ in digits only (least member and size)."""
    labels = d.customer.where(col("c_name").rlike("[0-9]")).select(col("c_name").alias("label"), F.regexp_replace("c_name", "[0-9]+", "#").alias("mask")).distinct()
    classes = labels.groupBy("mask").agg(F.min("label").alias("representative"), F.count(F.lit(1)).alias("n"))
    return labels.join(classes, "mask").select("label", "representative", "n", t.differ_in_digits_only(col("label"), col("representative")).alias("differs"))


@query("""WITH w AS (SELECT DISTINCT p_name AS a, p_name || ' ' || lower(p_type) AS b FROM part) SELECT a, b, contains(' ' || b || ' ', ' ' || a || ' ') AS contained, length(a) AS prefix FROM w""")
def containment(d):
    """a label within another, and their common prefix."""
    w = d.part.select(col("p_name").alias("a"), F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("b")).distinct()
    return w.select("a", "b", t.meaningfully_contained(col("a"), col("b")).alias("contained"), t.common_prefix_length(col("a"), col("b")).cast("long").alias("prefix"))


@query("""SELECT p_name AS label FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1 OR (CASE WHEN count(DISTINCT p_brand) > 3 THEN 1 ELSE 0 END + CASE WHEN max(p_size) > 45 THEN 1 ELSE 0 END) >= 2""")
def homonym_signals(d):
    """Labels with one strong or two supporting signals."""
    g = d.part.groupBy(col("p_name").alias("label")).agg((F.countDistinct("p_type") > 1).alias("several_types"), (F.countDistinct("p_brand") > 3).alias("warning_mark"), (F.max("p_size") > 45).alias("historical_mark"))
    for c in ("several_rows", "approx_mark", "several_sisters", "several_crowns", "member_and_sister", "unnested", "in_synonymy", "mixed_vigency"):
        g = g.withColumn(c, F.lit(False))
    return m.homonym_signals(g).select("label")


@query("""SELECT label, list_aggregate(list(k ORDER BY k)[1:3], 'string_agg', ',') AS lines FROM (SELECT p_name AS label, CAST(p_partkey AS VARCHAR) AS k FROM part) GROUP BY 1""")
def context_lines(d):
    """The first rows that mention a label."""
    rows = d.part.select(col("p_partkey").cast("string").alias("row_id"), col("p_name").alias("label"), col("p_partkey").cast("string").alias("line"))
    return m.context_lines(rows.select("label"), rows, 3).select("label", F.array_join("lines", ",").alias("lines"))


@query("""SELECT trim(lower(regexp_replace(s, '\\s+', ' ', 'g'))) AS part, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(p_name || ' ; ' || p_type || ', ' || p_brand, '[;,/]|\\s\\|\\s')) AS s FROM part) GROUP BY 1""")
def synonym_split(d):
    """Cells split at ``; , /`` and a lone bar."""
    cell = F.concat("p_name", F.lit(" ; "), "p_type", F.lit(", "), "p_brand")
    return d.part.select(F.explode(F.split(cell, r"[;,/]|\s\|\s")).alias("s")).groupBy(t.folded(col("s")).alias("part")).agg(F.count(F.lit(1)).alias("n"))
