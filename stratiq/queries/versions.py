"""Change sets and version diffs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.operators import versioning as v
from stratiq.queries.registry import query

col = F.col


def _ledger(d):
    body = F.concat(F.lit('{"id":"'), col("p_partkey").cast("string"), F.lit('","size":'), col("p_size").cast("string"), F.lit("}"))
    return d.part.select(F.lit("parts.jsonl").alias("file"), col("p_partkey").cast("string").alias("record_id"), body.alias("body"))


def _ops(d):
    base = _ledger(d).where("cast(record_id as bigint) % 10 = 3")
    changed = base.select(col("record_id").cast("long").alias("seq"), "file", "record_id", col("body").alias("before"), F.replace("body", F.lit("}"), F.lit(',"new":1}')).alias("after"))
    added = base.select((col("record_id").cast("long") + 1_000_000).alias("seq"), "file", F.concat(F.lit("9"), F.lpad("record_id", 8, "0")).alias("record_id"), F.lit(None).cast("string").alias("before"), F.concat(F.lit('{"id":"9'), F.lpad("record_id", 8, "0"), F.lit('"}')).alias("after"))
    return changed.unionByName(added)


BODY = "'{\"id\":\"' || p_partkey || '\",\"size\":' || p_size || "


@query(f"""SELECT CAST(p_partkey AS VARCHAR) AS record_id, {BODY} CASE WHEN p_partkey % 10 = 3 THEN ',\"new\":1}}' ELSE '}}' END AS body FROM part
UNION ALL SELECT '9' || lpad(CAST(p_partkey AS VARCHAR), 8, '0'), '{{\"id\":\"9' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || '\"}}' FROM part WHERE p_partkey % 10 = 3""")
def delta_apply(d):
    """A ledger after a change set, all or nothing."""
    return v.apply_delta(_ledger(d), _ops(d)).select("record_id", "body")


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS record_id, {BODY} '}}' AS body FROM part")
def delta_round_trip(d):
    """Applying and reverting restores every record."""
    return v.apply_delta(v.apply_delta(_ledger(d), _ops(d)), _ops(d), reverse=True).select("record_id", "body")


@query("SELECT count(*) AS n, 'already there' AS problem FROM part WHERE p_partkey % 10 = 3")
def delta_conflicts(d):
    """What keeps a change set from being applied twice."""
    after = v.apply_delta(_ledger(d), _ops(d))
    wrong = v.check_delta(after, _ops(d).where("before is null"))
    return wrong.groupBy("problem").agg(F.count(F.lit(1)).alias("n")).select("n", "problem")


@query("SELECT CASE WHEN a.doc_id IS NULL THEN b.doc_id ELSE a.doc_id END AS path, CASE WHEN a.doc_id IS NULL THEN 'new' WHEN b.doc_id IS NULL THEN 'retired' ELSE 'changed' END AS change FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS h FROM documents WHERE doc_id % 5 <> 1) a FULL JOIN (SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN text || 'x' ELSE text END) AS h FROM documents WHERE doc_id % 7 <> 1) b ON a.doc_id = b.doc_id WHERE a.h IS DISTINCT FROM b.h")
def file_changes(d):
    """Changed, new and retired files."""
    path = col("doc_id").cast("string").alias("path")
    old = d.documents.where("doc_id % 5 <> 1").select(path, F.md5("text").alias("sha256"))
    new = d.documents.where("doc_id % 7 <> 1").select(path, F.md5(F.when(col("doc_id") % 3 == 0, F.concat("text", F.lit("x"))).otherwise(col("text"))).alias("sha256"))
    return v.file_changes(old, new)


@query("SELECT p_partkey, 'see C-' || (p_partkey * 2) || ' or C-' || CASE WHEN p_size IN (SELECT p_partkey FROM part) THEN p_size * 2 ELSE p_size END || '!' AS text FROM part")
def citation_translation(d):
    """renumbering all citations of all rows at once."""
    rows = d.part.select("p_partkey", F.concat(F.lit("see C-"), col("p_partkey").cast("string"), F.lit(" or C-"), col("p_size").cast("string"), F.lit("!")).alias("text"))
    mapping = d.part.select(F.concat(F.lit("C-"), col("p_partkey").cast("string")).alias("old"), F.concat(F.lit("C-"), (col("p_partkey") * 2).cast("string")).alias("new"))
    return v.translate_citations(rows, "p_partkey", "text", mapping)


@query("""SELECT change, count(*) AS n FROM (SELECT CASE WHEN k % 10 = 1 THEN 'retired' WHEN k % 10 = 2 THEN 'modified' WHEN k % 10 = 3 THEN 'renumbered' ELSE 'unchanged' END AS change FROM (SELECT p_partkey AS k FROM part)
UNION ALL SELECT 'new' FROM part WHERE p_partkey % 10 = 4) GROUP BY 1""")
def version_diff(d):
    """Rows of two versions matched in four passes."""
    k = col("p_partkey")
    text = F.concat(F.lit("row "), F.md5(k.cast("string")), F.lit(" cites C-"), k.cast("string"))
    old = d.part.select(F.concat(F.lit("C-"), k.cast("string")).alias("id"), (k % 4).cast("string").alias("section"), (k * 2).alias("pos"), text.alias("content"))
    kept = d.part.where("p_partkey % 10 <> 1")
    changed = F.when(k % 10 == 2, F.concat(text, F.lit(" more"))).when(k % 10 == 3, F.replace(text, F.lit("cites C-"), F.lit("cites C-9"))).otherwise(text)
    new = kept.select(F.concat(F.lit("C-"), k.cast("string")).alias("id"), (k % 4).cast("string").alias("section"), (k * 2).alias("pos"), changed.alias("content"))
    extra = d.part.where("p_partkey % 10 = 4").select(F.concat(F.lit("N-"), k.cast("string")).alias("id"), F.lit("9").alias("section"), (k * 2 + 1).alias("pos"), F.concat(F.lit("fresh "), F.md5(F.concat(F.lit("n"), k.cast("string")))).alias("content"))
    diff = v.version_diff(old, new.unionByName(extra))
    return diff.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS record_id, CASE WHEN p_partkey % 4 = 0 THEN 'r2' WHEN p_partkey % 2 = 0 THEN 'r1' ELSE 'r0' END AS body FROM part")
def pending_overlay(d):
    """A ledger with pending change sets laid over it."""
    rid = col("p_partkey").cast("string").alias("record_id")
    base = d.part.select(F.lit("f").alias("file"), rid, F.lit("r0").alias("body"))
    p1 = d.part.where("p_partkey % 2 = 0").select(F.lit("f").alias("file"), rid, F.lit("r1").alias("after"), F.lit(1).alias("revision"))
    p2 = d.part.where("p_partkey % 4 = 0").select(F.lit("f").alias("file"), rid, F.lit("r2").alias("after"), F.lit(2).alias("revision"))
    return v.pending_overlay(base, p1.unionByName(p2)).select("record_id", "body")
