"""Freezes, snapshots and their chains over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiq.plans import findings, freezing
from stratiq.plans.rules import state
from stratiq.queries.registry import query
from stratiq.sources.ledger import dataset

col = F.col


def _files(d, changed=False):
    """The customers as files of a layer; of a later state if ``changed``."""
    k = col("c_custkey")
    body = F.concat_ws("|", "c_name", "c_mktsegment", F.when((k % 9 == 4) & F.lit(changed), "x"))
    kept = d.customer.where(k % 11 != 3) if changed else d.customer.where(k % 7 != 2)
    return kept.select(F.concat(F.lit("data/"), F.lpad(k.cast("string"), 8, "0")).alias("path"), F.sha2(body.cast("binary"), 256).alias("sha256"))


PATH = "'data/' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')"


@query(f"""SELECT 'sha256:' || sha256(string_agg({PATH} || chr(9) || sha256(c_name || '|' || c_mktsegment) || chr(10), '' ORDER BY c_custkey)) AS fingerprint, count(*) AS file_count, 'already frozen' AS again, 'refused' AS other FROM customer WHERE c_custkey % 7 <> 2""")
def freeze_record(d):
    """A layer frozen under one fingerprint, never rewritten with another."""
    record = freezing.freeze(_files(d), version="1.0.0")
    again = freezing.refreeze(record, freezing.freeze(_files(d))).withColumnRenamed("outcome", "again")
    other = freezing.refreeze(record, freezing.freeze(_files(d, True))).withColumnRenamed("outcome", "other")
    return record.select("fingerprint", "file_count").join(again, F.lit(True)).join(other, F.lit(True))


@query(f"""SELECT {PATH} AS path, CASE WHEN c_custkey % 7 = 2 THEN 'new' WHEN c_custkey % 11 = 3 THEN 'retired' ELSE 'changed' END AS change FROM customer
WHERE (c_custkey % 7 = 2 AND c_custkey % 11 <> 3) OR (c_custkey % 7 <> 2 AND c_custkey % 11 = 3) OR (c_custkey % 7 <> 2 AND c_custkey % 11 <> 3 AND c_custkey % 9 = 4)""")
def freeze_verify(d):
    """A layer against its freeze."""
    return freezing.verify_freeze(freezing.freeze(_files(d)), _files(d, True))


@query("SELECT NULL AS path, 'incoherent' AS change")
def freeze_incoherent(d):
    """A freeze whose fingerprint is not that of its own files."""
    record = freezing.freeze(_files(d)).withColumn("files", F.slice("files", 1, 3))
    return freezing.verify_freeze(record, _files(d, True))


@query(f"""WITH a AS (SELECT o_orderpriority AS g, count(*) AS n FROM orders WHERE o_orderkey % 5 <> 1 GROUP BY 1), b AS (SELECT o_orderpriority AS g, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '2-HIGH' GROUP BY 1)
SELECT coalesce(a.g, b.g) AS subject, 'count ' || coalesce(a.n, 0) || ' -> ' || coalesce(b.n, 0) AS problem FROM a FULL JOIN b ON a.g = b.g WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
UNION ALL SELECT {PATH}, 'file ' || CASE WHEN c_custkey % 7 = 2 THEN 'new' WHEN c_custkey % 11 = 3 THEN 'retired' ELSE 'changed' END FROM customer
WHERE (c_custkey % 7 = 2 AND c_custkey % 11 <> 3) OR (c_custkey % 7 <> 2 AND c_custkey % 11 = 3) OR (c_custkey % 7 <> 2 AND c_custkey % 11 <> 3 AND c_custkey % 9 = 4)""")
def snapshot_verify(d):
    """A ledger against its snapshot."""
    counted = lambda df: df.groupBy(col("o_orderpriority").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    record = freezing.snapshot(counted(d.orders.where("o_orderkey % 5 <> 1")), _files(d))
    return freezing.verify_snapshot(record, counted(d.orders.where("o_orderstatus <> 'P' and o_orderpriority <> '2-HIGH'")), _files(d, True))


@query("SELECT n_nationkey + 1 AS n, sha256((SELECT string_agg(m.n_name || chr(10), '' ORDER BY m.n_nationkey) FROM nation m WHERE m.n_nationkey <= nation.n_nationkey)) AS sha256 FROM nation UNION ALL SELECT 0, sha256('')")
def log_prefixes(d):
    """The hash of every start of a log."""
    return freezing.prefix_hashes(d.nation.select(col("n_nationkey").alias("seq"), col("n_name").alias("line")))


@query("SELECT 'SNAP-' || lpad(CAST(max(s_suppkey) + 1 AS VARCHAR), 6, '0') AS id, max(s_suppkey) AS revision, -1 AS malformed FROM supplier")
def snapshot_numbers(d):
    """The next snapshot id; revision numbers, -1 where malformed."""
    names = d.supplier.select(F.concat(F.lit("SNAP-"), F.lpad(col("s_suppkey").cast("string"), 6, "0")).alias("id"))
    revisions = d.supplier.agg(F.max(freezing.revision_number(F.concat(F.lit("REV-"), F.lpad(col("s_suppkey").cast("string"), 6, "0")))).alias("revision"), F.min(freezing.revision_number(col("s_name"))).alias("malformed"))
    return freezing.snapshot_id(names).join(revisions, F.lit(True))


def _log(d):
    """A change set for every supplier; every fifth is taken back, some of these made again."""
    k = col("s_suppkey").cast("long")
    delta = F.concat(F.lit("D"), k.cast("string"))
    sha = F.when(k % 13 != 5, F.sha2(delta.cast("binary"), 256))
    step = lambda rows, at, action: rows.select((k * 10 + at).alias("seq"), delta.alias("delta"), F.lit(action).alias("action"), sha.alias("sha256"))
    return step(d.supplier, 0, "apply").unionByName(step(d.supplier.where(k % 5 == 3), 1, "revert")).unionByName(step(d.supplier.where(k % 10 == 3), 2, "apply"))


@query("SELECT 'D' || s_suppkey AS delta, s_suppkey * 10 + CASE WHEN s_suppkey % 10 = 3 THEN 2 ELSE 0 END AS seq FROM supplier WHERE s_suppkey % 5 <> 3 OR s_suppkey % 10 = 3")
def standing_deltas(d):
    """Change sets that stand, and since when."""
    return freezing.standing(_log(d))


@query("""SELECT 'D' || s_suppkey AS delta, CASE WHEN s_suppkey % 17 = 4 THEN 'applied, but gone' WHEN s_suppkey % 13 = 5 THEN 'applied without a hash' ELSE 'not what was applied' END AS problem
FROM supplier WHERE s_suppkey % 17 = 4 OR s_suppkey % 13 = 5 OR s_suppkey % 19 = 6""")
def altered_deltas(d):
    """Change sets that are not what was applied."""
    k = col("s_suppkey")
    delta = F.concat(F.lit("D"), k.cast("string"))
    files = d.supplier.where(k % 17 != 4).select(delta.alias("path"), F.sha2(F.concat(delta, F.when(k % 19 == 6, "!").otherwise("")).cast("binary"), 256).alias("sha256"))
    return freezing.altered_deltas(_log(d), files)


@query("""WITH c AS (SELECT s_suppkey AS k, s_suppkey * 10 + CASE WHEN s_suppkey % 10 = 3 THEN 2 ELSE 0 END AS seq FROM supplier WHERE s_suppkey % 5 <> 3 OR s_suppkey % 10 = 3),
x AS (SELECT k, seq, k % 10 = 0 AS moves, CASE WHEN k % 10 = 0 THEN 'F' || ((k // 10) - 1 + CASE WHEN k % 30 = 20 THEN 5 ELSE 0 END) END AS src, CASE WHEN k % 10 = 0 THEN 'F' || (k // 10) END AS dst, CASE WHEN k % 10 <> 0 AND k % 3 = 0 THEN 'F' || (k // 10) || CASE WHEN k % 7 = 0 THEN 'X' ELSE '' END END AS declared FROM c),
w AS (SELECT *, coalesce(last_value(dst IGNORE NULLS) OVER b, first_value(declared IGNORE NULLS) OVER b) AS cur FROM x WINDOW b AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT 'D' || k AS delta, CASE WHEN moves THEN 'moves from ' || src ELSE 'starts from ' || declared END || ', stood on ' || cur AS problem FROM w WHERE cur IS NOT NULL AND CASE WHEN moves THEN src <> cur ELSE declared <> cur END
UNION ALL SELECT NULL, 'active is F0, change sets leave ' || arg_max(dst, seq) FROM x WHERE dst IS NOT NULL HAVING arg_max(dst, seq) <> 'F0'""")
def freeze_chain(d):
    """The freezes that change sets start from, walked in the order of the log."""
    k, block = col("s_suppkey"), F.expr("s_suppkey div 10")
    named = lambda n: F.concat(F.lit("F"), n.cast("string"))
    deltas = d.supplier.select(
        F.concat(F.lit("D"), k.cast("string")).alias("delta"), F.when(k % 10 == 0, named(block - 1 + F.when(k % 30 == 20, 5).otherwise(0))).alias("from"), F.when(k % 10 == 0, named(block)).alias("to"),
        F.when((k % 10 != 0) & (k % 3 == 0), F.concat(named(block), F.when(k % 7 == 0, "X").otherwise(""))).alias("declared"),
    )
    return freezing.freeze_chain(_log(d), deltas, "F0")


@query("""SELECT 'PRV4' AS rule, CASE WHEN n_nationkey % 4 = 0 OR n_nationkey % 2 = 0 THEN 'ERROR' ELSE 'WARNING' END AS severity, n_name AS record_id, CASE WHEN n_nationkey % 4 = 0 THEN 'guide is gone' ELSE 'guide differs from its recorded hash' END AS detail FROM nation WHERE n_nationkey % 4 = 0 OR n_nationkey % 3 = 0""")
def guide_hashes(d):
    """PRV4: archived and active guides against their recorded hashes."""
    k, sha = col("n_nationkey"), F.sha2(col("n_comment" if "n_comment" in d.nation.columns else "n_name").cast("binary"), 256)
    data = dataset(d.spark, {})
    data["guides"] = d.nation.select(col("n_name").alias("path"), sha.alias("sha256"), (k % 2 == 0).alias("archived"))
    data["guide-files"] = d.nation.where(k % 4 != 0).select(col("n_name").alias("path"), F.when(k % 3 == 0, "other").otherwise(sha).alias("sha256"))
    return findings.run(data, ("provenance",)).select("rule", "severity", "record_id", "detail")


@query("SELECT 'STA1' AS rule, 'claims' AS record_id, 'ERROR' AS severity")
def conservation(d):
    """STA1: fewer records than the snapshot had, less what was taken back since."""
    data = dataset(d.spark, {"claims": [{"id": "CLAIM-000001"}], "events": [{"id": "EVENT-000001"}]})
    regions = d.region.agg(F.count(F.lit(1)).alias("n"))
    data["snapshot-counts"] = regions.select(F.lit("claims").alias("grp"), col("n").alias("was"), F.lit(1).alias("undone")).unionByName(regions.select(F.lit("events").alias("grp"), col("n").alias("was"), (col("n") - 1).alias("undone")))
    return findings.shaped(state.conservation(data), "state", "STA1").select("rule", "record_id", "severity")
