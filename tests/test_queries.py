"""Every registered query with SQL agrees with DuckDB on the small tables."""

import hashlib
import math

import duckdb
import pytest

from stratiq.functions.text import ACCENTED, PLAIN
from stratiq.operators import relational
from stratiq.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if name in SQL:
        want = duck.sql(SQL[name])
        assert cols == sorted(want.columns)
        order = [want.columns.index(c) for c in cols]
        assert got == sorted(tuple(norm(r[i]) for i in order) for r in want.fetchall())


def test_components_of_all_links(spark):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in spark.read.parquet(f"{SF}/../sf0.01/part.parquet").where("p_size % 4 <> 0").collect():
        a, b = sorted((root(r["p_partkey"]), root(r["p_partkey"] + 7 + r["p_size"] % 3)))
        parent[b] = a
    got = {tuple(r) for r in QUERIES["components"](spark, f"{SF}/../sf0.01").select("node", "component").collect()}
    assert got == {(x, root(x)) for x in parent} and max(got)[0] > 300


def test_scoped_cycles_of_all_rows(spark, tmp_path):
    rows = [(1, "a", 10), (2, "a", 7), (1001, "b", -3003), (1002, "b", 6)]  # a: 1 -> 0, 2 -> 0; b, beyond key 60: 0 -> 0, 1 -> 9
    spark.createDataFrame(rows, "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    assert [tuple(r) for r in QUERIES["scoped_cycles"](spark, str(tmp_path)).collect()] == [("b", 0)]


def test_digit_classes_of_all_labels(spark):
    got = {r["label"]: (r["representative"], r["n"]) for r in QUERIES["digits_only_classes"](spark, SF).collect()}
    names = {r["c_name"] for r in spark.read.parquet(f"{SF}/customer.parquet").collect()}
    assert len(names) > 40 and got == {x: (min(names), len(names)) for x in names}  # all are Customer#digits


def test_citations_of_all_rows(spark):
    path = f"{SF}/../sf0.01"
    assert QUERIES["citation_translation"](spark, path).where("p_partkey >= 1000").count() == spark.read.parquet(f"{path}/part.parquet").where("p_partkey >= 1000").count() > 0


def test_comparison_keys_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r["key"] for r in QUERIES["comparison_keys"](spark, SF).collect()}
    bare = str.maketrans(dict(zip(ACCENTED, PLAIN + "\0" * len(ACCENTED))) | dict.fromkeys("*_`"))
    assert len(got) == len({r["doc_id"] for r in docs}) and {r["lang"] for r in docs} > {"es", "fr"}
    for r in docs:
        key = None if r["text"] is None else hashlib.sha256(" ".join(r["text"].translate(bare).replace("\0", "").split()).lower().encode()).hexdigest()
        assert got[r["doc_id"]] == key


def test_orders_and_conflicts_of_all_suppliers(spark):
    suppliers = {r["s_suppkey"] for r in spark.read.parquet(f"{SF}/../sf0.01/supplier.parquet").collect()}
    placed = QUERIES["numeric_suffix_order"](spark, f"{SF}/../sf0.01").orderBy("position").collect()
    assert [r["position"] for r in placed] == list(range(1, len(suppliers) + 1)) and {r["s_suppkey"] for r in placed} == suppliers and len(suppliers) > 25
    assert [r["suffix"] for r in placed] == sorted((r["suffix"] for r in placed), reverse=True)
    owned = {}
    for r in spark.read.parquet(f"{SF}/lineitem.parquet").collect():
        owned.setdefault(r["l_orderkey"], set()).add(r["l_suppkey"])
    small = {r["s_suppkey"] for r in spark.read.parquet(f"{SF}/supplier.parquet").collect()}
    want = {(o, a, a + 1) for o, members in owned.items() for a in members & small if a + 1 in members}
    assert {tuple(r) for r in QUERIES["set_conflicts"](spark, SF).collect()} == want and any(a % 10 for _, a, _ in want)


def test_common_ancestors_of_all_customers(spark, tmp_path):
    spark.createDataFrame([(k, 1) for k in (0, 1, 2, 3, 4, 5, 13)] + [(k, 2) for k in (12, 6)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    assert sorted(tuple(r) for r in QUERIES["lowest_common_ancestor"](spark, str(tmp_path)).collect()) == [(1, 0), (2, 6)]


def against(sql, path):
    """The rows of a statement over the tables of a folder that Spark wrote."""
    con = duckdb.connect()
    for t in sorted(p.stem for p in path.glob("*.parquet")):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    return con.sql(sql).fetchall()


def test_ids_beyond_six_digits(spark, duck, tmp_path):
    spark.createDataFrame([(999_997,), (1_200_000,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(25).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = sorted(tuple(r) for r in QUERIES["id_allocation"](spark, str(tmp_path)).collect())
    assert got == sorted(against(SQL["id_allocation"], tmp_path)) and got[0] == (0, "CLAIM-120000")
    part, taken = spark.read.parquet(f"{tmp_path}/part.parquet"), spark.createDataFrame([("CLAIM-999997",), ("CLAIM-1200000",)], "id string")
    ids = {r["new_id"] for r in relational.allocate_ids(part, "CLAIM", taken, ["p_partkey"]).collect()}
    assert ids == {f"CLAIM-{1_200_001 + i}" for i in range(25)}  # the operator's own ids stay apart


@pytest.mark.parametrize("name", ["state_family", "identity_family", "basic_families"])
def test_families_beyond_a_million(spark, name, tmp_path):
    shifted = {"part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey"], "customer": [], "supplier": [], "nation": []}
    for table, keys in shifted.items():
        df = spark.read.parquet(f"{SF}/{table}.parquet")
        more = df.withColumns({k: df[k] + 999_900 for k in keys})  # 999,999 and the millionth among them
        (df.unionByName(more) if keys else df).write.parquet(f"{tmp_path}/{table}.parquet")
    got = QUERIES[name](spark, str(tmp_path)).select("rule", "severity", "n", "first_id", "last_id").collect()
    assert sorted(tuple(r) for r in got) == sorted(against(SQL[name], tmp_path))
