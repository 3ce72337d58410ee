"""References, links, diffs and grouped findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators import relational as r
from stratiq.queries.registry import query

col = F.col


@query("SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey")
def dangling_refs(d):
    """Orders that no line item names."""
    return r.dangling(d.orders.select("o_orderkey"), "o_orderkey", d.lineitem, "l_orderkey")


@query("""SELECT DISTINCT l_suppkey AS record_id, other_id FROM (SELECT l_suppkey, unnest(list_distinct(list(l_partkey * 3))) AS other_id FROM lineitem GROUP BY l_suppkey)
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = other_id)""")
def dangling_list_refs(d):
    """List references without a target."""
    lists = d.lineitem.groupBy("l_suppkey").agg(F.collect_set(col("l_partkey") * 3).alias("refs"))
    return r.dangling_lists(lists, "l_suppkey", "refs", d.part, "p_partkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(d):
    """A02."""
    return r.duplicates(d.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def first_wins_index(d):
    """The first record of each key."""
    return r.first_wins(d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate")
def inverted_interval(d):
    """TIM4."""
    return d.lineitem.join(d.orders, col("l_orderkey") == col("o_orderkey")).where("l_shipdate < o_orderdate").select("l_orderkey", "l_linenumber", "l_partkey")


FINDINGS_SQL = """SELECT 'REF3' AS rule, 'ERROR' AS severity, count(*) AS n FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT 'REF2', 'ERROR', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'TIM4', 'ERROR', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate"""


@query(FINDINGS_SQL)
def findings_rollup(d):
    """Counts of findings by rule."""
    one = lambda df, rule: df.select(F.lit(rule).alias("rule"), F.lit("ERROR").alias("severity"))
    both = one(dangling_refs(d), "REF3").unionByName(one(duplicate_keys(d), "REF2")).unionByName(one(inverted_interval(d), "TIM4"))
    return both.groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT regexp_replace(regexp_replace(m, '\b[A-Z]+-[0-9]{6}\b', '<ID>', 'g'), ':[0-9]+', ':N', 'g') AS template, count(*) AS n, min(k) AS first_seen
FROM (SELECT c_custkey AS k, 'file:' || c_custkey || ' CLAIM-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || ' in ' || c_mktsegment AS m FROM customer) GROUP BY 1""")
def message_template(d):
    """Findings by message template."""
    m = F.concat(F.lit("file:"), col("c_custkey").cast("string"), F.lit(" CLAIM-"), F.lpad(col("c_custkey").cast("string"), 6, "0"), F.lit(" in "), col("c_mktsegment"))
    return r.roll_up(d.customer.select(m.alias("message"), col("c_custkey").alias("seq"))).select("template", "n", "first_seen")


@query("""SELECT coalesce(a.k, b.k) AS o_orderkey, coalesce(a.s, b.s) AS suppkey, CASE WHEN b.k IS NULL THEN 'a' ELSE 'b' END AS side
FROM (SELECT DISTINCT l_orderkey AS k, l_suppkey AS s FROM lineitem) a FULL JOIN (SELECT DISTINCT o_orderkey AS k, o_custkey % 100 AS s FROM orders) b ON a.k = b.k AND a.s = b.s
WHERE a.k IS NULL OR b.k IS NULL""")
def one_way_links(d):
    """Links that only one side has."""
    a = d.lineitem.select(col("l_orderkey").alias("o_orderkey"), col("l_suppkey").alias("suppkey"))
    b = d.orders.select("o_orderkey", (col("o_custkey") % 100).alias("suppkey"))
    return r.one_way_links(a, b, ["o_orderkey", "suppkey"])


@query("SELECT l_suppkey, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS sources FROM lineitem GROUP BY 1")
def back_links(d):
    """What points to each target."""
    links = d.lineitem.select("l_suppkey", col("l_partkey").cast("string").alias("p"))
    return r.back_links(links, "l_suppkey", "p").select("l_suppkey", F.array_join("sources", ",").alias("sources"))


@query("""SELECT c_custkey, CASE WHEN s_name IS NOT NULL THEN s_name WHEN n_name IS NOT NULL THEN n_name ELSE CAST(c_custkey AS VARCHAR) END AS label
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN nation ON n_nationkey = c_custkey""")
def label_chain(d):
    """Label by a chain of fallbacks."""
    names = d.supplier.join(d.nation, col("s_suppkey") == col("n_nationkey"), "full_outer").select(F.coalesce(col("s_suppkey").cast("long"), col("n_nationkey").cast("long")).alias("id"), "s_name", "n_name")
    return r.with_label(d.customer.select("c_custkey"), "c_custkey", names, "id", ["s_name", "n_name"], "label").select("c_custkey", "label")


@query("""WITH sel AS (SELECT DISTINCT l_orderkey AS owner, l_suppkey AS m FROM lineitem)
SELECT a.owner, a.m AS a, b.m AS b FROM sel a JOIN sel b ON a.owner = b.owner AND b.m = a.m + 1 WHERE a.m IN (SELECT s_suppkey FROM supplier)""")
def set_conflicts(d):
    """J16, HYR2: all neighbouring suppliers that one owner selects both of."""
    sel = d.lineitem.select(col("l_orderkey").alias("owner"), col("l_suppkey").alias("member")).distinct()
    pairs = d.supplier.select(col("s_suppkey").alias("a"), (col("s_suppkey") + 1).alias("b"))
    return r.both_selected(pairs, sel).select("owner", "a", "b")


@query("SELECT DISTINCT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey")
def rival_pairs(d):
    """Pairs within a conflict group."""
    g = d.customer.select(F.concat(col("c_nationkey").cast("string"), F.lit("/"), "c_mktsegment").alias("grp"), col("c_custkey").alias("member"))
    return r.rivals(g)


@query("""WITH o AS (SELECT l_orderkey AS id, list(l_partkey ORDER BY l_partkey, l_linenumber) AS xs FROM lineitem GROUP BY 1),
e AS (SELECT id, unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM o)
SELECT e.id, e.x AS a, f.x AS b FROM e JOIN e f ON e.id = f.id AND e.i < f.i AND e.x <> f.x""")
def participant_pairs(d):
    """Unordered pairs of one event's participants."""
    lists = d.lineitem.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", "l_linenumber"))), lambda x: x["l_partkey"]).alias("xs"))
    return r.unordered_pairs(lists, "l_orderkey", "xs")


@query("""SELECT o_orderkey, coalesce(p, s, -1) AS anchor, CASE WHEN p IS NOT NULL THEN 0 WHEN s IS NOT NULL THEN 1 ELSE 2 END AS tier FROM orders
LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS p FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a ON a.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) b ON b.l_orderkey = o_orderkey""")
def tiered_anchor(d):
    """The first tier that knows a row."""
    rows = d.orders.select("o_orderkey")
    cited = d.lineitem.where("l_returnflag = 'A'").groupBy(col("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("anchor"))
    table = d.lineitem.groupBy(col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("anchor"))
    return r.tiered(rows, [cited, table, rows.withColumn("anchor", F.lit(-1).cast("long"))], "o_orderkey", "anchor")


@query("""WITH o AS (SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey % 7 <> 0), n AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 11 <> 0)
SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, CASE WHEN o.p_partkey IS NULL THEN 'new' WHEN n.p_partkey IS NULL THEN 'retired' WHEN o.p_size = n.p_size THEN 'unchanged' ELSE 'modified' END AS change
FROM o FULL JOIN n ON o.p_partkey = n.p_partkey""")
def keyed_diff(d):
    """How keyed rows changed."""
    cols = ["p_partkey", "p_name", "p_size"]
    old = d.part.where("p_partkey % 7 <> 0").select(*cols)
    new = d.part.where("p_partkey % 11 <> 0").withColumn("p_size", F.when(col("p_partkey") % 5 == 0, col("p_size") + 1).otherwise(col("p_size"))).select(*cols)
    return r.keyed_diff(old, new, "p_partkey")


@query("SELECT l_returnflag, l_linestatus, l_quantity FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_orderkey % 2 = 0 EXCEPT ALL SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_orderkey % 2 = 1)")
def multiset_diff(d):
    """What one side has more copies of."""
    rows = d.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    return r.multiset_difference(rows.where("l_orderkey % 2 = 0").drop("l_orderkey"), rows.where("l_orderkey % 2 = 1").drop("l_orderkey"))


@query("SELECT l_returnflag, l_quantity FROM (SELECT l_returnflag, l_quantity FROM lineitem WHERE l_orderkey % 2 = 0 INTERSECT ALL SELECT l_returnflag, l_quantity FROM lineitem WHERE l_orderkey % 2 = 1)")
def multiset_common(d):
    """Copies that both sides have."""
    rows = d.lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    return r.multiset_intersection(rows.where("l_orderkey % 2 = 0").drop("l_orderkey"), rows.where("l_orderkey % 2 = 1").drop("l_orderkey"))


@query("SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def set_difference(d):
    """Uncovered keys."""
    return d.orders.select("o_custkey").subtract(d.customer.where("c_acctbal > 0").select(col("c_custkey").alias("o_custkey")))


@query("SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 1000")
def set_intersection(d):
    """U03."""
    return d.supplier.select("s_nationkey").intersect(d.customer.where("c_acctbal < 1000").select(col("c_nationkey").alias("s_nationkey")))


@query("SELECT id, label FROM (SELECT c_custkey AS id, c_name AS label FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer))")
def union_first_wins(d):
    """Union of families, the first wins on a clash."""
    c, s = d.customer.select(col("c_custkey").alias("id"), col("c_name").alias("label"), F.lit(0).alias("rank")), d.supplier.select(col("s_suppkey").alias("id"), col("s_name").alias("label"), F.lit(1).alias("rank"))
    return r.first_wins(c.unionByName(s), ["id"], ["rank"]).select("id", "label")


@query("""SELECT doc_id, CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 0 THEN 'poor' WHEN n_chars < 200 THEN 'short' WHEN lang = 'en' THEN 'axis' ELSE 'card' END AS bucket
FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id)""")
def exclusive_buckets(d):
    """Every row in exactly one bucket, by priority."""
    marks = d.labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    bucket = F.when(col("toxic") == 1, "toxic").when(col("quality") == 0, "poor").when(col("n_chars") < 200, "short").when(col("lang") == "en", "axis").otherwise("card")
    return d.documents.join(marks, "doc_id", "left").select("doc_id", bucket.alias("bucket"))


@query("SELECT count(*) AS n FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) <> 1)")
def bucket_completeness(d):
    """Keys that are not in exactly one bucket."""
    return r.not_in_one_bucket(exclusive_buckets(d), "doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT coalesce(a.k, b.k) AS grp, coalesce(b.n, 0) AS declared, coalesce(a.n, 0) AS actual FROM (SELECT l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY 1) a
FULL JOIN (SELECT l_returnflag AS k, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1) b ON a.k = b.k WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def control_totals(d):
    """Declared and actual counts that differ."""
    actual = d.lineitem.groupBy(col("l_returnflag").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    declared = d.lineitem.groupBy(col("l_returnflag").alias("grp")).agg(F.countDistinct("l_orderkey").alias("n"))
    return r.control_totals(actual, declared, "grp")


@query("SELECT source, round(avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END), 6) AS share FROM documents GROUP BY 1 HAVING avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) < 0.6")
def ratio_threshold(d):
    """Groups below a ratio."""
    share = F.avg(F.when(col("lang") == "en", 1.0).otherwise(0.0))
    return d.documents.groupBy("source").agg(share.alias("s")).where("s < 0.6").select("source", F.round("s", 6).alias("share"))


@query("SELECT p_name AS label, count(DISTINCT p_brand) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def ambiguous_labels(d):
    """A07, A08, IDN1, IDN2: labels claimed by several owners."""
    return r.ambiguous(d.part.withColumnRenamed("p_name", "label"), "label", "p_brand").select("label", F.size("owners").cast("long").alias("n"))


@query("""SELECT p_name, n, CASE WHEN m AND (a > 1 OR r > 1) THEN 'ERROR' WHEN m THEN 'WARNING' WHEN a > 1 OR r > 1 THEN 'INFO' ELSE 'WARNING' END AS severity FROM
(SELECT p_name, count(*) AS n, count(DISTINCT p_brand) AS a, count(DISTINCT p_size) AS r, bool_or(p_partkey % 50 = 0) AS m FROM part GROUP BY 1 HAVING count(*) > 1)""")
def homonym_groups(d):
    """A09, A10, IDN3: spellings of several records, with severity."""
    return r.homonyms(d.part.withColumn("merged", col("p_partkey") % 50 == 0), "p_name", "p_brand", "p_size", "merged")


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(*) FILTER (WHERE o_totalprice > 250000) AS large FROM orders GROUP BY ALL")
def grouped_counts(d):
    """Counts and conditional counts."""
    return d.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(col("o_totalprice") > 250000).alias("large"))


@query("SELECT l_suppkey, min(l_orderkey) AS first_id, max(l_orderkey) AS last_id, count(*) AS n FROM lineitem GROUP BY 1")
def delta_summary(d):
    """Count, first and last id per group."""
    return d.lineitem.groupBy("l_suppkey").agg(F.min("l_orderkey").alias("first_id"), F.max("l_orderkey").alias("last_id"), F.count(F.lit(1)).alias("n"))


@query("""SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS r, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
WHERE r % greatest(1, n // 3) = 0 AND r < 3 * greatest(1, n // 3)""")
def spread_sample(d):
    """Examples spread evenly over a group."""
    return r.spread_sample(d.part.select("p_brand", "p_partkey"), ["p_brand"], ["p_partkey"], 3)


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_name LIMIT 20")
def top_texts(d):
    """The most frequent texts."""
    return r.top_texts(d.part, "p_name", 20)


@query("SELECT s_suppkey, suffix, row_number() OVER (ORDER BY suffix DESC NULLS LAST, s_suppkey) AS position FROM (SELECT s_suppkey, CAST(regexp_extract(s_name, '([0-9]+)$', 1) AS BIGINT) AS suffix FROM supplier)")
def numeric_suffix_order(d):
    """The place of every label in the order by its last number."""
    rows = d.supplier.select("s_suppkey", F.regexp_extract("s_name", "([0-9]+)$", 1).cast("long").alias("suffix"))
    return r.number_rows(rows.withColumn("down", -col("suffix")).withColumn("none", col("suffix").isNull()), ["none", "down", "s_suppkey"]).select("s_suppkey", "suffix", col("row_number").alias("position"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_acctbal IS NOT NULL")
def closed_vocabulary(d):
    """Values outside a vocabulary."""
    return d.customer.where(~col("c_mktsegment").isin("BUILDING", "MACHINERY") & col("c_acctbal").isNotNull()).select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || '!' ELSE o_orderpriority END AS o_orderpriority, coalesce(nullif(o_orderstatus, 'P'), 'open') AS o_orderstatus FROM orders")
def patch_projection(d):
    """Patches over rows, defaults where a value is missing."""
    patch = d.orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.concat("o_orderpriority", F.lit("!")).alias("new"))
    return d.orders.join(patch, "o_orderkey", "left").select("o_orderkey", F.coalesce("new", "o_orderpriority").alias("o_orderpriority"), F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("open")).alias("o_orderstatus"))


@query("SELECT l_suppkey, list_aggregate(list_sort(list_distinct(list(l_returnflag || l_linestatus))), 'string_agg', ',') AS flags FROM lineitem GROUP BY 1")
def distinct_lists(d):
    """Distinct values of a group as a list."""
    return d.lineitem.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), ",").alias("flags"))


@query("""SELECT n_name, p_brand, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def reference_join_chain(d):
    """Chained equi-joins of references."""
    j = d.lineitem.join(d.supplier, col("s_suppkey") == col("l_suppkey")).join(d.nation, col("n_nationkey") == col("s_nationkey")).join(d.part, col("p_partkey") == col("l_partkey"))
    return j.groupBy("n_name", "p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey FROM customer SEMI JOIN orders ON o_custkey = c_custkey AND o_totalprice > 400000")
def claimed_members(d):
    """Members that some owner claims."""
    owners = d.orders.groupBy(col("o_orderkey").alias("owner")).agg(F.collect_set("o_custkey").alias("included"), F.collect_set(F.when(col("o_totalprice") <= 400000, col("o_custkey"))).alias("excluded"))
    claimed = r.claimed_by(owners, "included", "excluded").select(col("member").alias("c_custkey"))
    return d.customer.select("c_custkey").join(claimed, "c_custkey", "left_semi")


@query("""SELECT a.p_partkey AS old, b.p_partkey AS new FROM part a JOIN part b ON a.p_partkey < b.p_partkey AND (a.p_name = b.p_name AND a.p_brand = b.p_brand OR a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_type = b.p_type)""")
def either_key_pairs(d):
    """Pairs that agree on one of two keys, as a union of equi-joins."""
    a = d.part.select(col("p_partkey").alias("old"), "p_name", "p_brand", "p_size", "p_type")
    b = d.part.select(col("p_partkey").alias("new"), "p_name", "p_brand", "p_size", "p_type")
    met = a.join(b, ["p_name", "p_brand"]).select("old", "new").union(a.join(b, ["p_name", "p_size", "p_type"]).select("old", "new"))
    return met.where("old < new").distinct()


@query("SELECT message FROM (SELECT DISTINCT 'line:N ' || l_returnflag || l_linestatus AS message FROM lineitem WHERE l_orderkey % 2 = 1 AND l_quantity > 49.5 EXCEPT SELECT DISTINCT 'line:N ' || l_returnflag || l_linestatus FROM lineitem WHERE l_orderkey % 2 = 0 AND l_quantity > 49.9 AND l_returnflag = 'A')")
def new_errors_only(d):
    """Messages that were not there before."""
    m = lambda odd, q: d.lineitem.where((col("l_orderkey") % 2 == odd) & (col("l_quantity") > q)).select(F.concat(F.lit("line:"), col("l_orderkey").cast("string"), F.lit(" "), "l_returnflag", "l_linestatus").alias("message"))
    return r.new_errors(m(0, 49.9).where(F.contains("message", F.lit(" A"))), m(1, 49.5))


@query("SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS blank FROM conversations GROUP BY 1")
def blank_fields(d):
    """P06, COV1: blank fields per group."""
    return d.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(t.blank(col("text"))).alias("blank"))
