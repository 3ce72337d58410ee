"""Texts: segments, ids, citations, keys."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators.versioning import fingerprint
from stratiq.queries.registry import query

col = F.col


@query("""SELECT doc_id, i - 1 AS ordinal, start, start + length(p) AS "end", length(p) AS n FROM (
SELECT doc_id, p, i, CAST(coalesce(list_sum(list_transform(ps[1:i-1], lambda x: length(x) + 1)), 0) AS BIGINT) AS start FROM (
SELECT doc_id, ps, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ps FROM documents))) WHERE trim(regexp_replace(p, '\\s+', ' ', 'g')) <> ''""")
def segments(d):
    """Lines with their offsets."""
    lines = d.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ordinal", "p"))
    upto = Window.partitionBy("doc_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    each = lines.withColumn("start", F.coalesce(F.sum(F.length("p") + 1).over(upto), F.lit(0))).where(~t.blank(col("p")))
    return each.select("doc_id", col("ordinal").cast("long").alias("ordinal"), "start", (col("start") + F.length("p")).alias("end"), F.length("p").cast("long").alias("n"))


@query(r"""SELECT doc_id, len(m) AS n, m[1] AS first FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._]+@[a-z0-9.]+', 0) AS m FROM documents) WHERE len(m) > 0""")
def extracted_ids(d):
    """matches in texts."""
    found = d.documents.select("doc_id", t.mentions(col("text"), r"[A-Za-z0-9._]+@[a-z0-9.]+").alias("m")).where(F.size("m") > 0)
    return found.select("doc_id", F.size("m").cast("long").alias("n"), F.element_at("m", 1)["text"].alias("first"))


@query("SELECT source, 'sha256:' || sha256(string_agg(lpad(CAST(doc_id AS VARCHAR), 12, '0') || chr(9) || sha256(text) || chr(10), '' ORDER BY doc_id)) AS fingerprint FROM documents GROUP BY 1")
def layer_fingerprint(d):
    """One hash over all rows of a layer, whatever their order."""
    files = d.documents.select("source", F.lpad(col("doc_id").cast("string"), 12, "0").alias("path"), F.sha2(col("text").cast("binary"), 256).alias("sha256"))
    return fingerprint(files, ("source",)).select("source", "fingerprint")


@query("""SELECT a.doc_id AS old, b.doc_id AS new FROM documents a JOIN documents b ON sha256(a.text) = sha256(b.text) AND a.doc_id % 2 = 0 AND b.doc_id % 2 = 1""")
def content_match(d):
    """Rows of two versions with equal content."""
    h = F.sha2(col("text").cast("binary"), 256)
    a, b = d.documents.where("doc_id % 2 = 0").select(col("doc_id").alias("old"), h.alias("h")), d.documents.where("doc_id % 2 = 1").select(col("doc_id").alias("new"), h.alias("h"))
    return a.join(b, "h").select("old", "new")


CITED = "'see C-' || lpad(CAST(p_partkey % 90 AS VARCHAR), 3, '0') || '–C-' || lpad(CAST(p_partkey % 90 + p_size % 7 AS VARCHAR), 3, '0') || ' and C-' || p_size"


@query(f"""WITH c AS (SELECT p_partkey, p_partkey % 90 AS a, p_partkey % 90 + p_size % 7 AS b, 'C-' || p_size AS z FROM part)
SELECT p_partkey, list_aggregate(list_sort(list_distinct(list_append(list_transform(generate_series(a, b), lambda x: 'C-' || lpad(CAST(x AS VARCHAR), 3, '0')), z))), 'string_agg', ' ') AS cited FROM c""")
def citation_ranges(d):
    """Citations with their ranges expanded."""
    three = lambda c: F.lpad(c.cast("string"), 3, "0")
    text = F.concat(F.lit("see C-"), three(col("p_partkey") % 90), F.lit("–C-"), three(col("p_partkey") % 90 + col("p_size") % 7), F.lit(" and C-"), col("p_size").cast("string"))
    return d.part.select("p_partkey", F.array_join(F.array_sort(t.citations(text)), " ").alias("cited"))


@query(r"SELECT p_partkey, regexp_replace('as in C-' || p_partkey || ', C-' || p_size || '.', '\bC-[0-9]+', 'C-#', 'g') AS masked FROM part")
def masked_citations(d):
    """F16, V08."""
    text = F.concat(F.lit("as in C-"), col("p_partkey").cast("string"), F.lit(", C-"), col("p_size").cast("string"), F.lit("."))
    return d.part.select("p_partkey", t.mask_citations(text).alias("masked"))


@query("SELECT p_partkey, replace(replace(lower(trim(p_name || ' ' || p_type)), '-', '_'), ' ', '_') AS name FROM part")
def measure_names(d):
    """F04."""
    return d.part.select("p_partkey", t.measure_name(F.concat_ws(" ", "p_name", "p_type")).alias("name"))


@query()
def comparison_keys(d):
    """keys of all documents, whatever their language."""
    return d.documents.select("doc_id", F.sha2(t.comparison_key(col("text")).cast("binary"), 256).alias("key"))


@query("""SELECT c_custkey, CASE WHEN t = '' THEN 'empty' WHEN lower(t) IN ('-', '—', '–', 'n/a', '?') THEN 'gap' WHEN regexp_matches(t, '^[A-Z]{1,3}-?[0-9]+$') THEN 'key' WHEN NOT regexp_matches(t, '[A-Za-z]') THEN 'no letters' END AS reason
FROM (SELECT c_custkey, trim(CASE c_custkey % 6 WHEN 0 THEN ' ' WHEN 1 THEN '-' WHEN 2 THEN 'AB-' || c_custkey WHEN 3 THEN CAST(c_acctbal AS VARCHAR) WHEN 4 THEN c_name ELSE c_mktsegment END) AS t FROM customer)""")
def discard_reasons(d):
    """Why a cell is no label."""
    m = col("c_custkey") % 6
    cell = F.when(m == 0, " ").when(m == 1, "-").when(m == 2, F.concat(F.lit("AB-"), col("c_custkey").cast("string"))).when(m == 3, col("c_acctbal").cast("string")).when(m == 4, col("c_name")).otherwise(col("c_mktsegment"))
    return d.customer.select("c_custkey", t.discard_reason(cell).alias("reason"))


@query("""SELECT k AS token, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(c_name || '_' || c_mktsegment), '[^a-z0-9]+'), lambda x: x <> '')) AS k FROM customer) GROUP BY 1""")
def key_tokens(d):
    """Pieces of snake-case keys."""
    return d.customer.select(F.explode(t.key_tokens(F.concat_ws("_", "c_name", "c_mktsegment"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(r"SELECT p_partkey, regexp_matches(i, '^(CLAIM|SRC|TIME)-[0-9]{6}$') AS good, split_part(i, '-', 1) AS prefix FROM (SELECT p_partkey, (CASE p_partkey % 3 WHEN 0 THEN 'CLAIM-' WHEN 1 THEN 'SRC-' ELSE 'XYZ-' END) || lpad(CAST(p_partkey AS VARCHAR), 5 + p_size % 3, '0') AS i FROM part)")
def id_formats(d):
    """P05, REF1: well-formed ids and their prefixes."""
    m = col("p_partkey") % 3
    i = F.concat(F.when(m == 0, "CLAIM-").when(m == 1, "SRC-").otherwise("XYZ-"), F.lpad(col("p_partkey").cast("string"), 12, "0").substr(F.lit(8) - col("p_size") % 3, F.lit(5) + col("p_size") % 3))
    return d.part.select("p_partkey", t.well_formed_id(i).alias("good"), t.id_prefix(i).alias("prefix"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '1.0.0' WHEN o_orderkey % 4 = 1 THEN '1.' || (o_orderkey % 10 + 1) || '.0' ELSE '1.' || (o_orderkey % 10) || '.3' END AS version FROM orders")
def version_bumps(d):
    """A version rises only with its content."""
    k = col("o_orderkey")
    before = F.when(k % 4 != 0, F.concat(F.lit("1."), (k % 10).cast("string"), F.lit(".3")))
    return d.orders.select("o_orderkey", t.next_version(before, k % 4 == 1).alias("version"))


@query("SELECT page_id, length(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')) AS escaped, length(replace(html, '</', '<\\/')) AS embedded FROM pages")
def escapes(d):
    """F35."""
    return d.pages.select("page_id", F.length(t.html_escape(col("html"))).cast("long").alias("escaped"), F.length(t.safe_embed(col("html"))).cast("long").alias("embedded"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE trim(regexp_replace(line, '\\s+', ' ', 'g')) <> '') AS lines FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)")
def nonblank_lines(d):
    """X01."""
    lines = d.documents.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(~t.blank(col("line"))).alias("lines"))
