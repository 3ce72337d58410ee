"""From corpus tables and prose to records: parse, check, anchor, convert, absorb.

Everything is a DataFrame transformation; human decisions come in as tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators import relational as r
from stratiq.operators import versioning as v
from stratiq.plans.findings import both, found

col = F.col

#: Columns of the claims registry, and what its Spanish terms stand for.
COLUMNS = ("#", "Afirmación", "Sujeto", "Predicado", "Objeto", "Atribución", "Fuente", "Aceptación", "Fuerza", "Motivo", "Resolución", "Vigencia")
ACCEPTANCE = {
    "consenso amplio": "broad_consensus", "aceptación mayoritaria": "majority_acceptance", "aceptación mixta": "mixed_acceptance",
    "posición minoritaria": "minority_position", "no evaluado": "not_assessed",
}
STRENGTH = {"alta": "high", "media": "medium", "baja": "low", "desconocida": "unknown"}
RESOLUTION = {"resuelta": "resolved", "parcialmente resuelta": "partially_resolved", "sin resolver": "unresolved", "información insuficiente": "insufficient_information"}
VIGENCY = {"vigente": "current", "histórica": "historical", "superada": "superseded", "rechazada": "rejected"}
ATTRIBUTION = ("expresa", "sintesis", "síntesis", "glosa")
LEAST_EXPLICIT = 0.6


def mapped(value: Column, table: dict[str, str]) -> Column:
    """The term that a cell stands for; null if none does."""
    cell = F.lower(t.squeeze(F.coalesce(value, F.lit(""))))
    return reduce(lambda out, kv: F.when(cell == kv[0], kv[1]).otherwise(out), table.items(), F.lit(None).cast("string"))


def classify_table(header: Column) -> Column:
    """What a table is, by the shape of its header: ``claims``, ``sources``,
    ``entities``, ``events``, ``hypotheses``, ``dates``, ``magnitudes``, ``control``,
    ``unfiled``; null if it is none of these."""
    low = F.transform(header, lambda c: F.lower(t.squeeze(c)))
    first = F.coalesce(F.try_element_at(low, F.lit(1)), F.lit(""))
    has = lambda word: F.exists(low, lambda c: F.contains(c, F.lit(word)))
    key = first == "clave"
    return (
        F.when((F.size(header) >= 6) & (first == "#"), "claims")
        .when(key & F.array_contains(low, "tipo") & (has("autor") | has("título")), "sources")
        .when(F.startswith(first, F.lit("etiqueta")), "entities")
        .when(key & has("participante"), "events")
        .when(key & has("sostiene"), "hypotheses")
        .when(F.startswith(first, F.lit("a qué se aplica")), "dates")
        .when((first == "magnitud") & (F.size(header) > 3), "magnitudes")
        .when(first.isin("magnitud", "control"), "control")
        .when(first == "material", "unfiled")
    )


def orphan_lines(texts: DataFrame, tables: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, ``n``): lines with bars that belong to no table, as after a table was cut in two."""
    piped = texts.select(key, F.explode(F.split(text, "\n")).alias("line")).where(col("line").rlike(r"^\s*\|")).groupBy(key).agg(F.count(F.lit(1)).alias("piped"))
    inside = tables.groupBy(key, "table_no").agg((F.count(F.lit(1)) + 2).alias("n")).groupBy(key).agg(F.sum("n").alias("inside"))
    return piped.join(inside, key, "left").select(key, (col("piped") - F.coalesce("inside", F.lit(0))).alias("n")).where("n > 0")


def registry(rows: DataFrame) -> DataFrame:
    """Registry rows of :func:`stratiq.sources.ledger.markdown_tables` as named columns
    (``id``, ``statement``, …), with ``width`` and the header's width ``due``."""
    names = ("id", "statement", "subject", "predicate", "object", "attribution", "source", "acceptance", "strength", "reason", "resolution", "vigency")
    at = lambda name: F.try_element_at("cells", F.array_position("header", name).cast("int"))
    cells = [F.when(F.array_contains("header", c), at(c)).alias(n) for c, n in zip(COLUMNS, names, strict=True)]
    claims = rows.where(classify_table(col("header")) == "claims")
    return claims.select(*cells, F.size("cells").alias("width"), F.size("header").alias("due"), (col("header") == F.array(*[F.lit(c) for c in COLUMNS])).alias("canonical"))


def conformity(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """Findings on a registry: ragged rows, vocabularies, sources, reasons,
    citations, repeated rows and the share of explicit attributions."""
    c = claims.withColumn("file", F.lit("registry"))
    cell = lambda n: F.lower(t.squeeze(F.coalesce(col(n), F.lit(""))))
    parts = [
        found(c, col("width") < col("due"), "ERROR", "fewer cells than columns"),
        found(c, ~col("canonical"), "ERROR", "columns differ from the contract"),
        found(c, ~cell("attribution").isin(*ATTRIBUTION), "ERROR", "unknown attribution"),
        found(c, (cell("attribution") == "expresa") & (cell("source") == ""), "ERROR", "explicit without source"),
        found(c, cell("strength").isin("alta", "media", "baja") & (cell("reason") == ""), "ERROR", "strength without reason"),
    ]
    for name, table in (("acceptance", ACCEPTANCE), ("strength", STRENGTH), ("resolution", RESOLUTION), ("vigency", VIGENCY)):
        parts.append(found(c, mapped(col(name), table).isNull(), "ERROR", f"unknown {name}"))
    parts.append(found(r.duplicates(claims, ["id"]), F.lit(True), "ERROR", "repeated row"))
    cited = claims.select("id", F.explode(t.citations(F.concat_ws(" ", "statement", "source", "reason"))).alias("other"))
    parts.append(found(r.dangling(cited, "other", claims.select("id"), "id"), F.lit(True), "ERROR", "cites a row that is not there", col("other")))
    keys = claims.select("id", F.explode(F.regexp_extract_all("source", F.lit(r"\bS[0-9]+\b"), F.lit(0))).alias("other"))
    parts.append(found(r.dangling(keys, "other", sources, "citation_key"), F.lit(True), "ERROR", "cites a source that is not there", col("other")))
    share = claims.agg(F.avg(F.when(cell("attribution") == "expresa", 1.0).otherwise(0.0)).alias("share")).withColumn("id", F.lit(None).cast("string"))
    parts.append(found(share, col("share") < LEAST_EXPLICIT, "WARNING", "few explicit attributions"))
    return both(*parts)


def sources_of(rows: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Bibliography rows (``clave``, ``autores``, ``año``, ``título``, ``tipo``, ``enlace``) as source records."""
    link = t.squeeze(F.coalesce("enlace", F.lit("")))
    doi = F.startswith(link, F.lit("https://doi.org/"))
    people = F.filter(F.transform(F.split("autores", ";"), t.squeeze), lambda a: a != "")
    year = t.squeeze(F.coalesce("año", F.lit("")))
    return rows.select(
        t.squeeze(col("clave")).alias("citation_key"), people.alias("authors"), F.when(year.rlike("^[0-9]+$"), year.cast("int")).alias("year"), t.squeeze(col("título")).alias("title"),
        F.when(doi, link).alias("doi"), F.when(F.startswith(link, F.lit("http")) & ~doi, link).alias("url"), F.coalesce(mapped(col("tipo"), types or {}), F.lit("other")).alias("source_type"), F.lit("pending_verification").alias("verification_status"), F.lit("active").alias("record_status"),
    )


def merge_sources(known: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sources to add, mismatches): a known citation key is reused; one whose
    title, year or DOI differs is a mismatch."""
    k = known.select("citation_key", col("title").alias("t0"), col("year").alias("y0"), col("doi").alias("d0"), F.lit(True).alias("known"))
    met = new.join(k, "citation_key", "left")
    differs = ~(col("title").eqNullSafe(col("t0")) & col("year").eqNullSafe(col("y0")) & col("doi").eqNullSafe(col("d0")))
    return met.where("known is null").select(*new.columns), met.where(col("known") & differs).select("citation_key", "title", "t0")


def passages_of(sections: DataFrame) -> DataFrame:
    """(``section_id``, ``ordinal``, ``start``, ``end``, ``text``) of sections (``id``, ``text``)."""
    each = sections.select(col("id").alias("section_id"), F.posexplode(t.paragraphs(col("text"))).alias("i", "p"))
    return each.select("section_id", (col("i") + 1).alias("ordinal"), "p.start", "p.end", "p.text")


def mentions_of(passages: DataFrame, patterns: dict[str, str], noise: tuple[str, ...] = ()) -> DataFrame:
    """Mentions by pattern with offsets in the section; a span is kept once, for the first pattern."""
    parts = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        m = passages.select("section_id", "ordinal", "start", F.explode(t.mentions(col("text"), pattern)).alias("m"))
        parts.append(m.select("section_id", "ordinal", (col("start") + col("m.start")).alias("from"), (col("start") + col("m.end")).alias("to"), col("m.text").alias("label"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank")))
    every = reduce(DataFrame.unionByName, parts).where(~F.lower("label").isin(*noise) if noise else F.lit(True))
    return r.first_wins(every, ["section_id", "from", "to"], ["rank"]).drop("rank")


def anchor_rows(rows: DataFrame, passages: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """(``id``, ``ordinal``, ``tier``): the passage of each registry row.  Prose that
    cites it comes first, then its table's marker (``id``, ``ordinal``), then the
    section's first passage."""
    cites = passages.select("ordinal", F.explode(t.citations(col("text"))).alias("id")).groupBy("id").agg(F.min("ordinal").alias("ordinal"))
    first = rows.select("id", F.lit(1).alias("ordinal"))
    tiers = [cites, *( [tables.select("id", "ordinal")] if tables is not None else []), first]
    return r.tiered(rows.select("id"), tiers, "id", "ordinal")


def claims_of(claims: DataFrame, anchors: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, problems): registry rows as claims.

    ``labels`` maps a label to an entity id.  A row whose axis terms are
    unknown, or whose ends have no entity, is a problem and gives no record.
    """
    ends = labels.select(t.comparison_key(col("label")).alias("k"), "entity_id")
    axes = F.struct(
        mapped(col("acceptance"), ACCEPTANCE).alias("acceptance"), mapped(col("strength"), STRENGTH).alias("evidence_strength"), F.nullif(t.squeeze(F.coalesce("reason", F.lit(""))), F.lit("")).alias("evidence_strength_reason"),
        mapped(col("resolution"), RESOLUTION).alias("resolution"), mapped(col("vigency"), VIGENCY).alias("historical_status"),
    )
    met = claims.withColumn("ks", t.comparison_key(col("subject"))).withColumn("ko", t.comparison_key(col("object")))
    met = met.join(ends.select(col("k").alias("ks"), col("entity_id").alias("subject_id")), "ks", "left").join(ends.select(col("k").alias("ko"), col("entity_id").alias("object_id")), "ko", "left").join(anchors.select("id", "ordinal"), "id", "left")
    made = met.select("id", "subject_id", t.measure_name(col("predicate")).alias("predicate"), "object_id", "ordinal", axes.alias("epistemic_dimensions"))
    unknown = F.array_compact(F.array(*[F.when(col(f"epistemic_dimensions.{a}").isNull(), a) for a in ("acceptance", "evidence_strength", "resolution", "historical_status")], F.when(col("subject_id").isNull(), "subject"), F.when(col("object_id").isNull(), "object")))
    made = made.withColumn("unknown", unknown)
    return made.where(F.size("unknown") == 0).drop("unknown"), made.where(F.size("unknown") > 0).select("id", F.array_join("unknown", ", ").alias("unknown"))


def coverage(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows (``id``) that no decision covers, decisions on rows that are not there,
    and rows decided twice: (``id``, ``problem``)."""
    left = rows.select("id").subtract(decided.select("id")).withColumn("problem", F.lit("not covered"))
    foreign = decided.select("id").subtract(rows.select("id")).withColumn("problem", F.lit("no such row"))
    twice = r.duplicates(decided, ["id"]).select("id", F.lit("decided twice").alias("problem"))
    return left.unionByName(foreign).unionByName(twice)


def elect_dates(datings: DataFrame, choices: DataFrame) -> DataFrame:
    """The date of each occurrence from datings (``id``, ``time_id``, ``retired``):
    the one date, or the chosen one (``id``, ``time_id``); else null with a problem.
    Retired claims do not compete."""
    live = datings.where(~F.coalesce(col("retired"), F.lit(False))).groupBy("id").agg(F.collect_set("time_id").alias("dates"))
    met = live.join(choices.select("id", col("time_id").alias("chosen")), "id", "left")
    ok = F.when(col("chosen").isNotNull(), F.array_contains("dates", col("chosen"))).otherwise(F.size("dates") == 1)
    picked = F.when(ok, F.coalesce("chosen", F.element_at("dates", 1)))
    return met.select("id", picked.alias("time_id"), F.when(~ok, F.when(col("chosen").isNotNull(), "choice is no dating").otherwise("several dates, no choice")).alias("problem"))


def already_done(log: DataFrame, origin: str) -> DataFrame:
    """Change sets (``seq``, ``delta``, ``action``, ``origin``) of one origin that still stand."""
    return v.applied(log.where(col("origin") == origin))


def evidence_chain(evidence: DataFrame, results: DataFrame, analyses: DataFrame) -> DataFrame:
    """(``id``, ``other_id``, ``problem``): results of analyses that an evidence does
    not list, and datasets that none of its analyses used."""
    e = evidence.select("id", "analysis_ids", "dataset_ids", "result_ids")
    own = e.select("id", "analysis_ids", F.explode("result_ids").alias("other_id")).join(results.select(col("id").alias("other_id"), "analysis_id"), "other_id")
    stray = own.where(~F.array_contains("analysis_ids", col("analysis_id"))).select("id", "other_id", F.lit("result of another analysis").alias("problem"))
    used = e.select("id", F.explode("analysis_ids").alias("a")).join(analyses.select(col("id").alias("a"), F.explode("dataset_ids").alias("other_id")), "a").select("id", "other_id")
    loose = e.select("id", F.explode("dataset_ids").alias("other_id")).join(used, ["id", "other_id"], "left_anti").withColumn("problem", F.lit("dataset of no analysis"))
    return stray.unionByName(loose)


def absorption_report(old: DataFrame, new: DataFrame, successions: DataFrame, touched: DataFrame) -> DataFrame:
    """What a new corpus version asks of the records: per row (``id``, ``change``,
    ``successors``, ``records``); ``touched`` maps rows to records."""
    diff = v.version_diff(old, new)
    return diff.join(successions.select(col("retired").alias("id"), "successors"), "id", "left").join(touched.groupBy("id").agg(F.array_sort(F.collect_set("record_id")).alias("records")), "id", "left")


def decision_skeleton(report: DataFrame) -> DataFrame:
    """One open decision per changed row; ``options`` are what may be decided."""
    options = F.when(col("change") == "retired", F.array(F.lit("retire"), F.lit("replace"), F.lit("split"))).when(col("change") == "modified", F.array(F.lit("patch"), F.lit("replace"))).when(col("change") == "new", F.array(F.lit("add"))).when(col("change") == "renumbered", F.array(F.lit("re-anchor")))
    return report.where(col("change") != "unchanged").select("id", "change", "records", options.alias("options"), F.lit(None).cast("string").alias("decision"))


def review_decisions(skeleton: DataFrame, filled: DataFrame) -> DataFrame:
    """Why filled-in decisions are no good: coverage, fixed fields and options."""
    met = skeleton.select("id", "change", "options").join(filled.select("id", col("change").alias("change2"), "decision"), "id")
    touched = met.where(~col("change").eqNullSafe(col("change2"))).select("id", F.lit("a fixed field was changed").alias("problem"))
    other = met.where(~F.array_contains("options", F.coalesce("decision", F.lit("")))).select("id", F.lit("no such option").alias("problem"))
    return coverage(skeleton, filled).unionByName(touched).unionByName(other)


IMMUTABLE = ("id", "subject_id", "predicate", "provenance")


def editorial_changes(ledger: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(operations, problems) of patches (``record_id``, ``field``, ``mode``, ``value``;
    ``value`` is JSON).  ``set`` overwrites a field, ``add`` appends to a list what
    is not in it.  Immutable fields and unknown records are problems."""
    locked = patches.where(col("field").isin(*IMMUTABLE)).select("record_id", F.concat(F.lit("immutable: "), "field").alias("problem"))
    lost = r.dangling(patches, "record_id", ledger, "record_id").select("record_id", F.lit("no such record").alias("problem"))
    ok = patches.where(~col("field").isin(*IMMUTABLE)).join(ledger.select("file", "record_id", "body"), "record_id")
    fields = F.from_json("body", "map<string,string>")
    asked = ok.groupBy("file", "record_id", "body").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("mode", "value")))).alias("p"))
    wide = asked.withColumn("f", fields)
    strings = lambda x: F.coalesce(F.from_json(x, "array<string>"), F.expr("cast(array() as array<string>)"))
    added = lambda old, new: F.to_json(F.array_distinct(F.concat(strings(old), strings(new))))
    merged = F.transform_values("p", lambda k, x: F.when(x["mode"] == "add", added(F.col("f")[k], x["value"])).otherwise(x["value"]))
    changed = wide.withColumn("new", merged)
    keys = F.array_union(F.map_keys("f"), F.map_keys("new"))
    quoted = lambda x: F.when(x.rlike(r'^\s*([\[{"]|-?[0-9]|true$|false$|null$)') & F.try_parse_json(x).isNotNull(), x).otherwise(F.to_json(F.array(x)).substr(F.lit(2), F.length(F.to_json(F.array(x))) - 2))
    value = lambda k: F.when(F.array_contains(F.map_keys("new"), k), F.col("new")[k]).otherwise(quoted(F.col("f")[k]))
    body = F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(F.lit('"'), k, F.lit('":'), F.coalesce(value(k), F.lit("null")))), ","), F.lit("}"))
    ops = changed.select(F.xxhash64("record_id").alias("seq"), "file", "record_id", col("body").alias("before"), body.alias("after"))
    return ops, locked.unionByName(lost)


def retire_ops(ledger: DataFrame, retired: DataFrame) -> DataFrame:
    """Operations that deprecate records (``record_id``, ``successor``): nothing is deleted."""
    met = ledger.join(retired, "record_id")
    told = F.when(col("successor").isNotNull(), F.concat(F.lit(',"record_status":"replaced","superseded_by":"'), "successor", F.lit('"}'))).otherwise(F.lit(',"record_status":"deprecated"}'))
    bare = F.regexp_replace("body", r',?"(record_status|superseded_by)":"[^"]*"', "")
    return met.select(F.xxhash64("record_id").alias("seq"), "file", "record_id", col("body").alias("before"), F.concat(F.regexp_replace(bare, r"\}$", ""), told).alias("after"))


def entity_moves(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entities (``label``, ``section``, ``first_row``) whose first row moved to another section."""
    a, b = old.select("label", col("section").alias("was"), col("first_row").alias("row_was")), new.select("label", col("section").alias("now"), col("first_row").alias("row_now"))
    return a.join(b, "label").where("was <> now")


def rows_to_records(log: DataFrame) -> DataFrame:
    """Row to records by the change sets that stand (``seq``, ``delta``, ``action``,
    ``row``, ``record_id``); the last one wins."""
    stands = v.applied(log.select("seq", "delta", "action").distinct())
    live = log.where("action = 'apply'").join(stands.select("delta"), "delta", "left_semi")
    last = live.withColumn("top", F.max("seq").over(Window.partitionBy("row"))).where("seq = top")
    return last.groupBy("row").agg(F.array_sort(F.collect_set("record_id")).alias("records"))
