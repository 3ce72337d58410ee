"""Corpus ingestion, derived views and the streamed history on small tables."""

import json

from pyspark.sql import functions as F

from stratiq.operators import versioning
from stratiq.plans import ingest, views
from stratiq.sources.ledger import dataset, markdown_tables
from stratiq.streaming import history

col = F.col
DOC = """Intro cites C-1 here.

Second paragraph cites C-2–C-3.

| # | Afirmación | Sujeto | Predicado | Objeto | Atribución | Fuente | Aceptación | Fuerza | Motivo | Resolución | Vigencia |
|---|---|---|---|---|---|---|---|---|---|---|---|
| C-1 | x | Alfa | desciende de | Beta | expresa | S1 | consenso amplio | alta | fossil | resuelta | vigente |
| C-2 | see C-9 | Alfa | desciende de | Gamma | glosa | S7 | dudosa | media | | sin resolver | vigente |
| C-2 | short | Alfa |

| a | b |
|---|---|
| 1 | 2 |
| lone |"""


def rows(df):
    return sorted(tuple(x) for x in df.collect())


def test_registry(spark):
    docs = spark.createDataFrame([(1, DOC)], "k long, t string")
    tables = markdown_tables(docs, "k", "t")
    kinds = {(x["table_no"], x["kind"]) for x in tables.select("table_no", ingest.classify_table(col("header")).alias("kind")).distinct().collect()}
    assert kinds == {(1, "claims"), (2, None)}
    claims = ingest.registry(tables)
    sources = spark.createDataFrame([("S1",)], "citation_key string")
    got = {(x["record_id"], x["severity"], x["detail"]) for x in ingest.conformity(claims, sources).collect()}
    assert {("C-2", "ERROR", "fewer cells than columns"), ("C-2", "ERROR", "unknown acceptance"), ("C-2", "ERROR", "strength without reason"), ("C-2", "ERROR", "repeated row"), ("C-2", "ERROR", "cites a row that is not there"), ("C-2", "ERROR", "cites a source that is not there"), (None, "WARNING", "few explicit attributions")} <= got
    assert not any(i == "C-1" for i, _, _ in got)
    passages = ingest.passages_of(spark.createDataFrame([("SEC-1", DOC)], "id string, text string"))
    assert all(DOC[x["start"] : x["end"]] == x["text"] for x in passages.collect())
    anchors = ingest.anchor_rows(claims.select("id").distinct(), passages)
    assert {(x["id"], x["ordinal"], x["tier"]) for x in anchors.collect()} == {("C-1", 1, 0), ("C-2", 2, 0)}
    labels = spark.createDataFrame([("alfa", "CLADE-000001"), ("Beta", "CLADE-000002")], "label string, entity_id string")
    records, problems = ingest.claims_of(claims.where("width = due"), anchors, labels)
    one = records.collect()
    assert [(x["id"], x["subject_id"], x["object_id"], x["predicate"], x["epistemic_dimensions"]["acceptance"]) for x in one] == [("C-1", "CLADE-000001", "CLADE-000002", "desciende_de", "broad_consensus")]
    assert rows(problems) == [("C-2", "acceptance, object")]


def test_sources(spark):
    raw = spark.createDataFrame([("S1", "Aa, B.; Cc", "2004", " Title ", "libro", "https://doi.org/10.1/x"), ("S2", "", "s. f.", "T2", "?", "http://x.y")], "clave string, autores string, `año` string, `título` string, tipo string, enlace string")
    made = ingest.sources_of(raw, {"libro": "book"})
    got = {x["citation_key"]: x for x in made.collect()}
    assert got["S1"]["authors"] == ["Aa, B.", "Cc"] and got["S1"]["year"] == 2004 and got["S1"]["doi"] and not got["S1"]["url"] and got["S1"]["source_type"] == "book"
    assert got["S2"]["year"] is None and got["S2"]["url"] == "http://x.y" and got["S2"]["source_type"] == "other"
    known = made.where("citation_key = 'S1'").withColumn("title", F.lit("Other"))
    new, wrong = ingest.merge_sources(known, made)
    assert [x["citation_key"] for x in new.collect()] == ["S2"] and [x["citation_key"] for x in wrong.collect()] == ["S1"]


def test_decisions(spark):
    one = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    two = spark.createDataFrame([("a",), ("a",), ("z",)], "id string")
    assert rows(ingest.coverage(one, two)) == [("a", "decided twice"), ("b", "not covered"), ("c", "not covered"), ("z", "no such row")]
    dated = spark.createDataFrame([("o1", "t1", False), ("o2", "t1", False), ("o2", "t2", False), ("o3", "t1", True), ("o3", "t2", False), ("o4", "t1", False), ("o4", "t2", False)], "id string, time_id string, retired boolean")
    chosen = spark.createDataFrame([("o4", "t2")], "id string, time_id string")
    assert {x["id"]: (x["time_id"], x["problem"]) for x in ingest.elect_dates(dated, chosen).collect()} == {"o1": ("t1", None), "o2": (None, "several dates, no choice"), "o3": ("t2", None), "o4": ("t2", None)}
    s = "id string, section string, pos long, content string"
    old = spark.createDataFrame([("C-1", "a", 1, "x"), ("C-2", "a", 2, "y"), ("C-3", "a", 3, "z")], s)
    new = spark.createDataFrame([("C-1", "a", 1, "x"), ("C-2", "a", 2, "y more"), ("C-3", "a", 3, "z")], s)
    succ, touched = spark.createDataFrame([], "retired string, successors array<string>"), spark.createDataFrame([("C-2", "CLAIM-000001")], "id string, record_id string")
    skeleton = ingest.decision_skeleton(ingest.absorption_report(old, new, succ, touched))
    assert [(x["id"], x["change"], x["records"], x["options"]) for x in skeleton.collect()] == [("C-2", "modified", ["CLAIM-000001"], ["patch", "replace"])]
    assert rows(ingest.review_decisions(skeleton, skeleton.withColumn("decision", F.lit("retire")))) == [("C-2", "no such option")]
    assert rows(ingest.review_decisions(skeleton, skeleton.withColumn("decision", F.lit("patch")))) == []


def test_editorial_round_trip(spark):
    led = spark.createDataFrame([("f", "A", '{"id":"A","label":"old","notes":["n1"],"n":3}'), ("f", "B", '{"id":"B"}')], "file string, record_id string, body string")
    patches = spark.createDataFrame([("A", "label", "set", '"new"'), ("A", "notes", "add", '["n1","n2"]'), ("A", "id", "set", '"Z"'), ("Q", "label", "set", '"x"')], "record_id string, field string, mode string, value string")
    ops, wrong = ingest.editorial_changes(led, patches)
    assert rows(wrong) == [("A", "immutable: id"), ("Q", "no such record")]
    after = versioning.apply_delta(led, ops)
    assert json.loads({x["record_id"]: x["body"] for x in after.collect()}["A"]) == {"id": "A", "label": "new", "notes": ["n1", "n2"], "n": 3}
    assert rows(versioning.apply_delta(after, ops, reverse=True)) == rows(led)
    gone = ingest.retire_ops(led, spark.createDataFrame([("A", "B"), ("B", None)], "record_id string, successor string"))
    kept = {x["record_id"]: json.loads(x["body"]) for x in versioning.apply_delta(led, gone).collect()}
    assert kept["A"]["record_status"] == "replaced" and kept["A"]["superseded_by"] == "B" and kept["B"]["record_status"] == "deprecated"


def test_chronology(spark):
    iv = lambda a, b, unit="million_years", name=None: {"oldest_bound": a, "youngest_bound": b, "unit": unit, "geological_interval": name}
    claim = lambda n, s, p, o=None, tid=None: {"id": f"CLAIM-{n}", "subject_id": s, "predicate": p, "object": {"entity_id": o, "temporal_expression_id": tid}, "record_status": "active"}
    data = dataset(spark, {
        "temporal-expressions": [{"id": "T1", "interval": iv(10, 5)}, {"id": "T2", "interval": iv(None, None, "geological_interval", "Cámbrico"), "determination": "modelled"}, {"id": "T3", "interval": iv(1, 1, "generations")}, {"id": "T4", "interval": iv(None, 2000, "thousand_years")}],
        "occurrences": [{"id": "OCC-1", "entity_id": "MOL-1"}],
        "claims": [claim(1, "OCC-1", "dated_to", tid="T1"), claim(2, "EVENT-1", "dated_to", tid="T2"), claim(3, "X", "dated_to", tid="T3"), claim(4, "EVENT-1", "dated_to", tid="T4"), claim(5, "OCC-1", "member_of", "CLADE-1"), claim(6, "M", "calibrates", "OCC-1"), claim(7, "Y", "member_of", "Z")],
    })
    got = {x["id"]: tuple(x)[2:] for x in views.chronology(data).collect()}
    assert got == {"CLAIM-1": ("interval", 10.0, 5.0, "rock", "biomarker"), "CLAIM-2": ("geologic", 538.8, 485.4, "clock", "clock"), "CLAIM-3": ("unplaced", None, None, "rock", "record"), "CLAIM-4": ("minimum", None, 2.0, "rock", "record")}
    buckets = {x["id"]: (x["bucket"], x["reason"]) for x in views.allocate(data).collect()}
    assert buckets == {"CLAIM-1": ("axis", None), "CLAIM-2": ("axis", None), "CLAIM-3": ("outside", "its date cannot be placed"), "CLAIM-4": ("axis", None), "CLAIM-5": ("card", None), "CLAIM-6": ("method", None), "CLAIM-7": ("outside", "no dated subject")}
    assert rows(views.event_spread(data)) == [("EVENT-1", 538.8, 2.0, 2)]
    assert views.cards(data).count() == 7


def test_tree_view(spark):
    claim = lambda n, s, p, o, **m: {"id": f"CLAIM-{n}", "subject_id": s, "predicate": p, "object": {"entity_id": o}, "record_status": "active"} | m
    data = dataset(spark, {
        "hypotheses": [{"id": "HYP-1", "conflict_group_ids": ["G"], "excluded_claim_ids": ["CLAIM-6"]}, {"id": "HYP-2", "conflict_group_ids": ["G"]}, {"id": "HYP-3"}],
        "claims": [
            claim(1, "a", "member_of", "m"), claim(2, "m", "member_of", "r"), claim(3, "a", "member_of", "r"), claim(4, "b", "member_of", "m"), claim(5, "c", "member_of", "m"), claim(6, "x", "member_of", "r"), claim(7, "a", "sister_group_of", "b"),
            claim(8, "q", "member_of", "r", scope={"hypothesis_ids": ["HYP-2"]}), claim(9, "q", "member_of", "r", scope={"hypothesis_ids": ["HYP-3"]}), claim(10, "q", "member_of", "r", derivation={"method": "d"}), claim(11, "q", "member_of", "TAXCONCEPT-1"), claim(12, "q", "eats", "r"),
            claim(13, "q", "member_of", "r", epistemic_dimensions={"historical_status": "superseded"}), claim(14, "r", "member_of", "a"), claim(15, "zz", "sister_group_of", "yy"),
        ],
    })
    chosen = views.select_claims(data, ["HYP-1"])
    reasons = {x["id"]: x["reason"] for x in chosen.collect()}
    assert {k: r for k, r in reasons.items() if r} == {"CLAIM-6": "excluded", "CLAIM-8": "rival", "CLAIM-9": "other_hypothesis", "CLAIM-10": "derived", "CLAIM-11": "classification", "CLAIM-12": "not_drawn", "CLAIM-13": "historical"}
    acyclic = chosen.where("id <> 'CLAIM-14'")
    parents = views.containment(acyclic)
    assert rows(parents) == [("a", "m"), ("b", "m"), ("c", "m"), ("m", "r")]
    sisters = acyclic.where("reason is null and predicate = 'sister_group_of'").select(F.lit("v").alias("view"), col("subject_id").alias("a"), col("object_id").alias("b"))
    tree = views.assemble(parents.select(F.lit("v").alias("view"), "node", "parent"), sisters)
    shape = {x["node"]: x["parent"] for x in tree.collect()}
    assert shape == {"a": "+1", "b": "+1", "+1": "m", "c": "m", "m": "r", "r": None}
    checked = {x["id"]: x["reason"] for x in views.verify(chosen, tree).collect()}
    assert checked["CLAIM-14"] == "contradicted" and checked["CLAIM-15"] == "not_drawable" and checked["CLAIM-7"] is None and checked["CLAIM-3"] is None
    record = views.view_record("v", chosen.where("reason is null"), chosen.where("reason is not null"))
    again = views.view_record("v", chosen.where("reason is null"), chosen.where("reason is not null"), record.select("view", "digest", "version"))
    changed = views.view_record("v", chosen.where("reason is null").limit(1), chosen.where("reason is not null"), record.select("view", "digest", "version"))
    assert (again.head()["version"], changed.head()["version"]) == ("1.0.0", "1.1.0")


def test_streamed_history(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    lines = [("d1", "apply", "2024-01-01T00:10:00"), ("d2", "apply", "2024-01-01T00:20:00"), ("d2", "revert", "2024-01-01T01:20:00")]
    (src / "a.json").write_text("\n".join(json.dumps({"delta": d, "action": a, "at": t}) for d, a, t in lines), encoding="utf-8")
    stream = history.standing(history.read_history(spark, f"file://{src}"))
    q = stream.writeStream.format("memory").queryName("standing").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("standing")) == [("d1", 1), ("d2", 0)]
    counts = history.windowed_counts(history.read_history(spark, f"file://{src}"))
    q = counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(x["n"] for x in spark.table("windows").collect()) == [1, 2]
