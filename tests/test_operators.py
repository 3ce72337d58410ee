"""Operators on small tables: invariants and planted cases."""

import time

import pytest
from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators import graph, matching, temporal, versioning
from stratiq.operators import relational as r
from stratiq.queries import QUERIES
from stratiq.sources import ledger, sinks

col = F.col


def rows(df):
    return sorted(tuple(x) for x in df.collect())


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).head()["x"]


def lit(x):
    return F.lit(x)


def test_text_functions(spark):
    v = lambda e: one(spark, e)
    assert v(t.squeeze(lit(" a \t b\n"))) == "a b"
    assert v(t.comparison_key(lit(" “Ñandú”  *Gigante* – x"))) == '"nandu" gigante - x'
    assert v(t.measure_name(lit(" Valor P-é "))) == "valor_p_e"
    assert v(t.citations(lit("C-008–C-011, C-3 and C-5–C-2"))) == ["C-008", "C-009", "C-010", "C-011", "C-3", "C-5", "C-2"]
    assert v(t.mask_citations(lit("C-1 and C-22"))) == "C-# and C-#"
    assert v(t.message_template(lit("claims.jsonl:12: CLAIM-000001 lost SRC-000002"))) == "claims.jsonl:N: <ID> lost <ID>"
    assert [tuple(p) for p in v(t.paragraphs(lit("one\ntwo\n\n  \nthree")))] == [(0, 7, "one\ntwo"), (12, 17, "three")]
    assert [tuple(m) for m in v(t.mentions(lit("ab é12 x7"), "[0-9]+"))] == [(4, 6, "12"), (8, 9, "7")]
    assert tuple(v(t.locate(lit("Homo"), lit("xHomo y Homo z")))) == (8, 12, None)
    assert tuple(v(t.locate(lit("homo"), lit("a Homo")))) == (2, 6, "case differs")
    assert tuple(v(t.locate(lit("zzz"), lit("abc"))))[:2] == (0, 3)
    assert v(t.extends_binomially(lit("Homo"), lit("Homo sapiens"))) and not v(t.extends_binomially(lit("Homo"), lit("Homo Sapiens")))
    assert v(t.common_prefix_length(lit("abcx"), lit("abd"))) == 2
    assert set(v(t.deletions(lit("abc")))) == {"abc", "bc", "ac", "ab"}
    assert v(t.short_citation(F.array(lit("Aa, B."), lit("Cc, D.")), lit(2004))) == "Aa y Cc 2004"
    assert v(t.short_citation(F.array(lit("Aa, B."), lit("C"), lit("D")), lit(None).cast("int"))) == "Aa et al. s. f."
    assert tuple(v(t.review_mark(lit("- [X] D-0012 merge ;; sure")))) == ("x", "D-0012", "sure")
    assert v(t.next_version(lit("1.4.2"), lit(True))) == "1.5.0" and v(t.next_version(lit("1.4.2"), lit(False))) == "1.4.2"
    assert v(t.version_order(lit("1.10.2"))) == [1, 10, 2]
    assert v(t.iso_date(lit("2024-02-30"))) is False and v(t.iso_date(lit("2024-02-29"))) is True
    assert v(t.clipped(lit("abcdef"), 4)) == "abc…" and v(t.safe_embed(lit("</s>"))) == "<\\/s>"
    assert v(t.note_reason(lit("de los montes"), ("de",))) == "opener" and v(t.note_reason(lit("a b c d e f"), ())) == "long"
    core, cut = t.core_and_qualifier(lit("homo erectus (s. l.)"), r"\([^)]*\)")
    assert (v(core), v(cut)) == ("homo erectus", "(s. l.)")


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 6)], "src long, dst long")
    assert (1, 1) in rows(graph.closure(e)) and (1, 4) in rows(graph.closure(e)) and (4, 1) not in rows(graph.closure(e))
    assert rows(graph.cycle_members(e).select("node", "cycle")) == [(1, 1), (2, 1), (3, 1)]
    p = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (8, 7)], "node long, target long")
    assert rows(graph.pointer_ends(p)) == [(1, 3, False), (2, 3, False), (7, None, True), (8, None, True)]
    f = spark.createDataFrame([("r", None), ("a", "r"), ("b", "r"), ("x", "a"), ("y", "a")], "node string, parent string")
    assert rows(graph.depths(f)) == [("a", "r", 1), ("b", "r", 1), ("r", "r", 0), ("x", "r", 2), ("y", "r", 2)]
    assert rows(graph.newick(f, f.select("node", col("node").alias("label")))) == [("r", "((x,y)a,b)r;")]
    g = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "b")], "grp long, node string")
    assert rows(graph.lowest_common_ancestor(f, g)) == [(1, "a"), (2, "r")]
    up = graph.ancestors(f.where("parent is not null").select(col("node").alias("src"), col("parent").alias("dst")))
    c = spark.createDataFrame([("x", "a"), ("x", "r"), ("y", "b"), ("y", "a")], "node string, parent string")
    assert rows(graph.innermost_parent(c, up)) == [("x", "a"), ("y", None)]
    links = spark.createDataFrame([(1, 2), (3, 2), (9, 8), (8, 7), (5, 5)], "u long, v long")
    assert rows(graph.components(links)) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7)]
    scoped = spark.createDataFrame([("h1", 1, 2, False), ("h2", 2, 1, False), ("h3", 4, 5, False), ("h3", 5, 4, True)], "scope string, src long, dst long, modal boolean")
    assert rows(graph.acyclicity(scoped).select("scope", "node", "severity")) == [("*", 1, "INFO"), ("*", 2, "INFO"), ("h3", 4, "WARNING"), ("h3", 5, "WARNING")]


def test_overlap_join(spark):
    a = spark.createDataFrame([(1, 0.0, 10.0), (2, 20.0, 25.0), (3, 5.0, 4.0)], "id long, young double, old double")
    b = spark.createDataFrame([(7, 10.0, 12.0), (8, -5.0, 40.0), (9, 26.0, 30.0)], "id long, young double, old double")
    for width in (1.0, 7.0, 100.0):
        assert rows(temporal.overlap_join(a, b, width)) == [(1, 7), (1, 8), (2, 8)]


def test_overlap_join_sends_no_large_side(spark, monkeypatch):
    few = spark.range(3_000_000).groupBy((col("id") % 25).alias("id")).agg(F.lit(0.0).alias("young"), F.max("id").cast("double").alias("old"))
    many = spark.range(200_000).select("id", col("id").cast("double").alias("young"), (col("id") + 1).cast("double").alias("old"))
    met = temporal.overlap_join(few, many, 64.0)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" in plan and "BuildRight" not in plan and met.count() == 25 * 200_000
    monkeypatch.setattr(temporal, "SENT", 0)
    met = temporal.overlap_join(many.where("id < 500"), many.where("id >= 400 and id < 900"), 7.0)
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString() and met.count() == 100 + 99 + 101


def test_rivals_of_large_and_shared_groups(spark, monkeypatch):
    members = [("g", k) for k in range(90)] + [("h", k) for k in range(60, 120)] + [("g", 5), ("one", 7), (None, 1), (None, 2), ("h", None)]
    want = {(a, b) for g in ("g", "h") for a in range(120) for b in range(a + 1, 120) if (g, a) in members and (g, b) in members}
    met = spark.createDataFrame(members, "grp string, member long")
    monkeypatch.setattr(r, "BLOCK", 16)
    monkeypatch.setattr(r, "PAIRS_A_TASK", 500)
    pairs = r.rivals(met)
    assert rows(pairs) == sorted(want)  # each once, though 60 to 89 share two groups
    per_task = [x["count"] for x in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per_task) > 6 and max(per_task) < len(want) / 2


def test_rivals_of_unknown_groups(spark, tmp_path):
    spark.createDataFrame([(1, None, "A"), (2, None, "A"), (3, 1, None), (4, 1, None), (5, 1, "A"), (6, 1, "A")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    assert rows(QUERIES["rival_pairs"](spark, str(tmp_path))) == [(5, 6)]


def test_open_bounds(spark):
    hit = lambda *x: one(spark, temporal.overlaps(*[lit(v).cast("double") for v in x]))
    assert hit(10, None, 3, 1) and hit(None, 5, 6, None) and not hit(4, 2, 9, 5) and hit(None, None, 1, 0)
    ok, old, young = temporal.span(lit(None).cast("double"), lit(2.0), lit("million_years"), lit(None).cast("string"))
    assert (one(spark, ok), one(spark, old), one(spark, young)) == (True, None, 2e6)


def test_deltas(spark):
    led = spark.createDataFrame([("f", "A", '{"id":"A"}'), ("f", "B", '{"id":"B"}')], "file string, record_id string, body string")
    ops = spark.createDataFrame([(1, "f", "A", '{"id":"A"}', '{"id":"A","v":1}'), (2, "f", "A", '{"id":"A","v":1}', '{"id":"A","v":2}'), (3, "f", "C", None, '{"id":"C"}')], "seq long, file string, record_id string, before string, after string")
    after = versioning.apply_delta(led, ops)
    assert rows(after.select("record_id", "body")) == [("A", '{"id":"A","v":2}'), ("B", '{"id":"B"}'), ("C", '{"id":"C"}')]
    assert rows(versioning.apply_delta(after, ops, reverse=True)) == rows(led)
    with pytest.raises(ValueError, match="already there"):
        versioning.apply_delta(after, ops.where("seq = 3"))
    with pytest.raises(ValueError, match="differs"):
        versioning.apply_delta(after, ops.where("seq = 1"))
    log = spark.createDataFrame([(1, "d1", "apply", "REV-000001"), (2, "d2", "apply", "REV-000002"), (3, "d2", "revert", "REV-000001"), (4, "d3", "apply", "REV-000005"), (5, "d1", "revert", "REV-000004")], "seq long, delta string, action string, revision string")
    assert rows(versioning.applied(log).select("delta")) == [("d3",)]
    assert rows(versioning.log_problems(log).select("seq", "problem")) == [(4, "revision does not follow"), (5, "not the last one applied")]


def test_version_matching(spark):
    s = "id string, section string, pos long, content string"
    old = spark.createDataFrame([("C-1", "a", 1, "alpha"), ("C-2", "a", 2, "beta cites C-1"), ("C-3", "a", 3, "gamma"), ("C-4", "a", 4, "delta"), ("C-5", "a", 5, "end")], s)
    new = spark.createDataFrame([("C-1", "a", 1, "alpha"), ("C-12", "a", 2, "beta cites C-7"), ("C-3", "a", 3, "gamma changed"), ("C-5", "a", 5, "end"), ("C-9", "b", 1, "fresh")], s)
    assert rows(versioning.version_diff(old, new)) == sorted([("C-1", "unchanged"), ("C-12", "renumbered"), ("C-3", "retired"), ("C-3", "new"), ("C-4", "retired"), ("C-5", "unchanged"), ("C-9", "new")])
    same = new.where("id <> 'C-9'").unionByName(spark.createDataFrame([("C-4", "a", 4, "delta")], s))
    assert dict(rows(versioning.version_diff(old, same)))["C-3"] == "modified"
    p = "section string, pos long, text string"
    a = spark.createDataFrame([("s", i, x) for i, x in enumerate(["A", "B", "C", "D"])], p)
    b = spark.createDataFrame([("s", i, x) for i, x in enumerate(["A", "X", "C", "N", "D"])], p)
    assert rows(versioning.align_paragraphs(a, b).select("change", "old_pos", "new_pos").na.fill(-1)) == [("changed", 1, 1), ("equal", 0, 0), ("equal", 2, 2), ("equal", 3, 4), ("new", -1, 3)]


def test_version_matching_of_a_long_section(spark):
    k = F.col("id")
    row = lambda df, text: df.select(F.concat(F.lit("C-"), k.cast("string")).alias("id"), F.lit("a").alias("section"), F.floor(k / 2).alias("pos"), text.alias("content"))
    words = F.md5(k.cast("string"))
    old, new = row(spark.range(100_000), words), row(spark.range(100_000), F.when(k % 10 == 2, F.reverse(words)).otherwise(words))
    began = time.time()
    got = rows(versioning.version_diff(old, new).groupBy("change").count())
    assert got == [("modified", 10_000), ("unchanged", 90_000)] and time.time() - began < 60  # two rows to a place; a minute is many times what a linear pass takes


def test_matching(spark):
    labels = spark.createDataFrame([(x,) for x in ["Homo", "Homo sapiens", "Homo sapien", "Gigantopitecus", "Gigantopithecus", "Clade 1", "Clade 2", "Ardi", "ardi "]], "label string")
    got = {(x["a"], x["b"]): (x["reasons"], x["suppressed"]) for x in matching.candidate_pairs(labels, synonyms=spark.createDataFrame([("Ardi", "Homo")], "a string, b string")).collect()}
    assert got["Homo sapien", "Homo sapiens"] == (["edit_distance"], None)
    assert got["Gigantopitecus", "Gigantopithecus"] == (["edit_distance"], None)
    assert got["Homo", "Homo sapiens"][1] == "genus_species" and got["Clade 1", "Clade 2"][1] == "digits"
    assert "synonym_declared" in got["Ardi", "Homo"][0]
    assert rows(matching.identical_groups(labels).select("key", "n")) == [("ardi", 2)]
    marks = spark.createDataFrame([("a", "b", "yes"), ("b", "c", "yes"), ("x", "y", "yes"), ("y", "z", "yes"), ("x", "z", "no"), ("p", "q", "pending")], "a string, b string, mark string")
    groups, wrong, implicit = matching.apply_review(marks)
    named = dict(rows(groups))
    assert named["a"] == named["b"] == named["c"] == "a" and named["x"] == "x" and named["z"] == "z"
    assert rows(wrong) == [("x", "x", "z")] and rows(implicit) == [("a", "c")]


def test_relational(spark):
    df = spark.createDataFrame([(3, "m:3 CLAIM-000001"), (1, "m:1 CLAIM-000002"), (2, "other")], "seq long, message string")
    assert {(x["template"], x["n"], tuple(x["examples"])) for x in r.roll_up(df).collect()} == {("m:N <ID>", 2, ("m:1 CLAIM-000002", "m:3 CLAIM-000001")), ("other", 1, ("other",))}
    n = r.number_rows(spark.range(1000).repartition(7), ["id"])
    assert n.where("row_number <> id + 1").count() == 0
    assert one(spark, r.merged_links(F.array(lit("b"), lit("a")), F.array(lit("d"), lit("a"), lit("c")))) == ["b", "a", "c", "d"]


def test_sources(spark, tmp_path):
    (tmp_path / "clades.jsonl").write_text('{"id":"CLADE-000001","preferred_label":"x"}\n\n{broken\n{"id":"CLADE-000002"}\n', encoding="utf-8")
    records, wrong = ledger.read_family(spark, f"file://{tmp_path}/clades.jsonl", "clades")
    assert rows(records.select("id")) == [("CLADE-000001",), ("CLADE-000002",)] and wrong.count() == 1
    none, missing = ledger.read_family(spark, f"file://{tmp_path}/sites.jsonl", "sites")
    assert none.count() == 0 and rows(missing.select("severity", "detail")) == [("ERROR", "missing file")]
    md = spark.createDataFrame([(1, "text\n| a | b |\n|---|---|\n| 1 \\| x | 2 |\n| 3 | 4 |\nmore\n| lone | row |\n")], "k long, t string")
    assert [(x["table_no"], x["row_no"], x["header"], x["cells"]) for x in ledger.markdown_tables(md, "k", "t").orderBy("row_no").collect()] == [(1, 1, ["a", "b"], ["1 | x", "2"]), (1, 2, ["a", "b"], ["3", "4"])]
    (tmp_path / "t.csv").write_text("a,b\n1,2\n3\n4,5,6\n", encoding="utf-8")
    tolerant = ledger.read_csv_tolerant(spark, f"file://{tmp_path}/t.csv", ["a", "b"])
    assert [(x["a"], x["b"], x["_ragged"] is not None) for x in tolerant.collect()] == [("1", "2", False), ("3", None, True), ("4", "5", True)]
    with pytest.raises(Exception):  # noqa: B017
        ledger.read_csv_strict(spark, f"file://{tmp_path}/t.csv", ["a", "b"]).collect()
    path = f"file://{tmp_path}/doc.json"
    assert sinks.write_document(spark, path, {"b": 1, "a": 2}) == sinks.write_document(spark, path, {"a": 2, "b": 1})
    with pytest.raises(FileExistsError):
        sinks.write_document(spark, path, {"a": 3})
    files = ledger.layer_files(spark, f"file://{tmp_path}")
    assert versioning.fingerprint(files.select("path", "sha256")).head()["files"] >= 3
    keys = {(x["path"], x["key"]) for x in ledger.walk(spark.createDataFrame([("1", '{"a":{"b":[{"c":1}]},"d":"x"}')], "id string, raw string")).collect()}
    assert {("a", "a"), ("a.b", "b"), ("a.b[0].c", "c"), ("d", "d")} <= keys


def test_keys_at_any_depth(spark):
    text = "".join(f'{{"k{i}": ' for i in range(40)) + '[1, {"last": "x"}]' + "}" * 40
    got = ledger.walk(spark.createDataFrame([("a", text), ("b", "{}"), ("c", None), ("d", "no json")], "id string, raw string")).where("key is not null")
    assert sorted(x["key"] for x in got.collect()) == sorted([f"k{i}" for i in range(40)] + ["last"])
    assert got.where("key = 'last'").head()["value"] == '"x"'


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_candidates_at_any_number_of_edits(spark, edits):
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = following(row, i, x, b)
        return row[-1]

    def following(row, i, x, b):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
        return out

    rng = random.Random(edits)
    words = {"xabcdefgh", "yabcdefgz", "abcdefghij"}
    while len(words) < 60:
        w = list(rng.choice(sorted(words)))
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], [rng.choice("abcxyz")], [w[at], rng.choice("abcxyz")]])
        if len(w) > 4:
            words.add("".join(w))
    got = matching.candidate_pairs(spark.createDataFrame([(w,) for w in words], "label string"), edits=edits)
    near = {(x["a"], x["b"]) for x in got.collect() if "edit_distance" in x["reasons"]}
    assert near == {(a, b) for a in words for b in words if a < b and distance(a, b) <= edits}


def test_overlaps_of_open_and_long_intervals(spark):
    import random

    rng = random.Random(3)
    bound = lambda: rng.choice([None, rng.randint(-20, 20), rng.randint(-2000, 2000)])
    a, b = [(i, bound(), bound(), rng.choice("pq")) for i in range(120)], [(i, bound(), bound(), rng.choice("pq")) for i in range(120)]
    left, right = (spark.createDataFrame(x, "id int, young int, old int, k string") for x in (a, b))
    sound = lambda x: x[1] is None or x[2] is None or x[1] <= x[2]
    meets = lambda x, y: sound(x) and sound(y) and (x[2] is None or y[1] is None or x[2] >= y[1]) and (y[2] is None or x[1] is None or y[2] >= x[1])
    for key in (None, "k"):
        want = sorted((x[0], y[0]) for x in a for y in b if meets(x, y) and (key is None or x[3] == y[3]))
        for width in (None, 7.0, 1000.0):
            assert rows(temporal.overlap_join(left, right, width, key=key)) == want
    nothing = left.where("false")
    assert rows(temporal.overlap_join(nothing, nothing)) == [] and rows(temporal.overlap_join(left, nothing)) == []


def test_paragraphs_that_moved(spark):
    def made(texts):
        return spark.createDataFrame([("s", i, x) for i, x in enumerate(texts)], "section string, pos int, text string")

    got = lambda o, n: {(x["old_pos"], x["new_pos"]): x["change"] for x in versioning.align_paragraphs(made(o), made(n)).collect()}
    assert got("ABCDE", "EABCD") == {(0, 1): "equal", (1, 2): "equal", (2, 3): "equal", (3, 4): "equal", (4, 0): "moved"}
    assert got("ABC", "AXC") == {(0, 0): "equal", (1, 1): "changed", (2, 2): "equal"}
    assert got("AB", "ABC") == {(0, 0): "equal", (1, 1): "equal", (None, 2): "new"}


def test_components_and_chains_against_plain_code(spark):
    import random

    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(300)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    df = spark.createDataFrame(links, "u long, v long")
    assert rows(graph.components(df)) == sorted({(x, root(x)) for u, v in links if u != v for x in (u, v)})
    assert rows(graph.components(df, few=1000)) == rows(graph.components(df, few=100)) == rows(graph.components(df))
    none = graph.components(df.where("false"), few=1000)
    assert none.count() == 0 and none.dtypes == graph.components(df).dtypes
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (201, 202), (202, 201)], "node long, target long")
    ends = {x["node"]: (x["last"], x["circular"]) for x in graph.pointer_ends(chain).collect()}
    assert all(ends[i] == (100, False) for i in range(100)) and ends[200] == ends[201] == ends[202] == (None, True)
    cycles = graph.cycle_members(chain.select(col("node").alias("src"), col("target").alias("dst")))
    assert rows(cycles.select("node", "cycle")) == [(201, 201), (202, 201)]


def test_files_of_json_in_every_shape(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\nno json\n[3]\n')
    (tmp_path / "sub" / "b.json").write_text('[{"id": 4}, 5, {"id": {"x": [1]}}]')
    (tmp_path / "c.json").write_text('{\n "id": 6\n}')
    (tmp_path / "d.json").write_text("{")
    (tmp_path / "e.txt").write_text("{}")
    records, wrong = ledger.read_json_tree(spark, str(tmp_path))
    assert rows(records) == [("a.jsonl", '{"id":1}'), ("a.jsonl", '{"id":2}'), ("b.json", '{"id":4}'), ("b.json", '{"id":{"x":[1]}}'), ("c.json", '{"id":6}')]
    assert sorted((x["file"], x["detail"]) for x in wrong.collect()) == [("a.jsonl", "invalid JSON in line 4"), ("d.json", "invalid JSON")]


def test_metadata_of_a_layer(spark, tmp_path):
    assert ledger.read_metadata(spark, str(tmp_path)) == {"corpus": None, "version": None, "cutoff": None, "declared_state": None, "counts": None}
    (tmp_path / "VERSION").write_text("1.2.0\n")
    (tmp_path / "manifest.json").write_text('{"corpus": "c", "fecha_de_corte_bibliografico": "2024", "counts": {"a": 1}}')
    assert ledger.read_metadata(spark, str(tmp_path)) == {"corpus": "c", "version": "1.2.0", "cutoff": "2024", "declared_state": None, "counts": {"a": 1}}


def test_unknown_ledger_files_are_reported(spark, tmp_path):
    (tmp_path / "claims.jsonl").write_text('{"id": "CLAIM-000001"}\n')
    (tmp_path / "strange.jsonl").write_text('{"id": "X-000001"}\n')
    data, found = ledger.read_ledger(spark, str(tmp_path))
    assert data["claims"].count() == 1 and [(x["rule"], x["file"]) for x in found.collect()] == [("SCH4", "strange.jsonl")]


def test_composed_forms_and_codes(spark):
    df = spark.createDataFrame([(" é  x ",), ("plain  text",), (None,), ("(H24 del corredor) more",)], "s string")
    got = df.select(t.proposal_form(col("s")).alias("form"), t.hypothesis_code(col("s")).alias("code")).collect()
    assert [tuple(x) for x in got] == [("é x", None), ("plain text", None), (None, None), ("(H24 del corredor) more", "H24")]


def test_the_start_of_a_log_by_its_hash(spark):
    import hashlib

    from stratiq.plans import freezing

    lines = [f"entry {i} ü" for i in range(40)]
    log = spark.createDataFrame(list(enumerate(lines)), "seq long, line string").repartition(5)
    sha = hashlib.sha256("".join(x + "\n" for x in lines[:17]).encode()).hexdigest()
    assert rows(freezing.known_prefix(log, sha)) == [(17,)] and rows(freezing.known_prefix(log, "none")) == []


def test_inputs_of_change_sets(spark):
    from stratiq.plans import freezing

    log = spark.createDataFrame([(1, "d1", "apply"), (2, "d1", "revert"), (3, "d2", "apply")], "seq long, delta string, action string")
    deltas = spark.createDataFrame([("d1", "p", "old"), ("d2", "p", "new"), ("d3", "q", "h"), ("d4", "r", "h")], "delta string, path string, sha256 string")
    files = spark.createDataFrame([("p", "new"), ("q", "other")], "path string, sha256 string")
    assert rows(freezing.altered_inputs(deltas, log, files)) == [("d3", "q", "not what was recorded"), ("d4", "r", "gone")]
