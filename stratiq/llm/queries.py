"""Driver-facing queries of the training-data operators, and their SQL.

Each query applies its operator, with production parameters, to the whole of
its table and derives the columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiq.llm import tokencounts, tokenfiles, toxicity
from stratiq.llm.chat import rotate_perspectives
from stratiq.llm.common import scratch_path, table
from stratiq.llm.decontam import contaminated
from stratiq.llm.ngramjoin import link_documents
from stratiq.llm.packing import pack_documents
from stratiq.llm.secrets import RULES, count_kind, scan_versions, span_text
from stratiq.llm.sharding import shard_rows
from stratiq.llm.topk import top_k

N_SHARDS = 40


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = scan_versions(table(spark, sf_dir, "documents"))
    joined = span_text(F.col("spans"))
    counts = [count_kind(F.col("spans"), r.kind).alias(f"n_{r.kind}") for r in RULES]
    return findings.select("doc_id", *counts, F.sha2(joined.cast("binary"), 256).alias("base_sha256"), joined.alias("spans"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), out, tokenizer_path())
    return tokenfiles.read_tokens(spark, out)


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = rotate_perspectives(table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return made.select("conv_id", "speaker", "part", "section", "n_turns", F.length("rendered").cast("long").alias("n_chars"), F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"), mask.alias("mask"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencounts.count_tokens(docs, ranks).withColumn("n_tokens_before", F.col("n_tokens"))
    after = tokencounts.recount(counted.withColumn("edits", tokencounts.sample_edits(F.col("text"), F.col("doc_id"))), ranks)
    return after.select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), F.length("text").cast("long").alias("n_chars_after"), "n_reread", "n_edits")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_secret_scan": op2_secret_scan,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_token_files": op7_token_files,
    "op8_chat_rotation": op8_chat_rotation,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
}


def _spans_sql(kind: str, pattern: str, group: int, least: int) -> str:
    """All kept matches of a rule with their offsets: positions come from the pieces between matches."""
    return f"""SELECT doc_id, '{kind}' AS kind, s AS s, s + length(m) AS e FROM (
SELECT doc_id, ms[i] AS m, gs[i] AS g, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s FROM (
SELECT doc_id, ms, gs, ps, unnest(generate_series(1, len(ms))) AS i FROM (
SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS ms, regexp_extract_all(t, '{pattern}', {group}) AS gs, string_split_regex(t, '{pattern}') AS ps FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)) WHERE len(ms) > 0))
WHERE length(g) >= {least}"""


_ASSIGN = r'''((?i:password|passwd|secret|token|api_?key))["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)'''.replace("\\'", "''")

SQL: dict[str, str] = {
    "op2_secret_scan": f"""WITH spans AS ({_spans_sql("assign", _ASSIGN, 2, 8)} UNION ALL {_spans_sql("access", "AKIA[A-Z0-9]+", 0, 16)} UNION ALL {_spans_sql("hex", "[0-9a-f]+", 0, 32)}),
j AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END) AS spans FROM spans GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id""",
    "op3_exact_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5""",
    "op6_ngram_jaccard": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [md5(array_to_string(ws, ' '))] ELSE list_transform(generate_series(1, len(ws) - 2), lambda i: md5(ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
e AS (SELECT a AS u, b AS v FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
q AS (SELECT doc_id, array_to_string(ws, ' ') AS k FROM w WHERE len(ws) > 0), k AS (SELECT k, min(doc_id) AS class_id FROM q GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, coalesce(k.class_id, d.doc_id) AS class_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT u, min(v) AS component_id FROM r GROUP BY 1) m ON m.u = d.doc_id
LEFT JOIN q ON q.doc_id = d.doc_id LEFT JOIN k ON k.k = q.k""",
    "op8_chat_rotation": """WITH d AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, count(*) AS n FROM conversations GROUP BY ALL),
c AS (SELECT conv_id, turn, role, text, unnest(generate_series(1, CASE WHEN turn IS NULL THEN n ELSE 1 END)) AS copy,
CASE WHEN turn IS NULL THEN 144115188075855855 + instr('0123456789abcdef', substr(md5(role || ' ' || text), 1, 1)) - 1 ELSE (turn - (turn % 64 + 64) % 64) // 64 END AS part FROM d),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) AS k FROM c),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role NOT IN ('', 'system')),
b AS (SELECT t.conv_id, speaker, CAST(part AS BIGINT) AS part, CAST((k - 1) // 256 AS BIGINT) AS section, k, role,
'<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role WHEN role = '' THEN 'user' ELSE 'user name=' || role END || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body FROM t JOIN s ON s.conv_id IS NOT DISTINCT FROM t.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part, section ORDER BY k) AS upto FROM b)
SELECT conv_id, speaker, part, section, count(*) AS n_turns, CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars, sha256(string_agg(head || body, '' ORDER BY k)) AS rendered_sha256,
coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || ':' || CAST(upto AS BIGINT), ',' ORDER BY k) FILTER (WHERE role = speaker), '') AS mask FROM o GROUP BY conv_id, speaker, part, section""",
}
