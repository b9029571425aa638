from __future__ import annotations

import datetime

import pytest

from riskweave import schemas
from riskweave.operators import integrate, sequence, sketches
from riskweave.plans import catalog, tables as T

SF = "/root/testdata/sf0.001"


def test_values_behind_the_last_asked_column_do_not_travel(spark):
    rows = [("a", 2, 1.0, "z", 5), ("a", 1, 3.0, "y", 7), ("a", 1, 3.0, "x", 9), (None, 1, None, "n", 1), (None, 1, 2.0, "m", 1), ("b", 4, 1.0, None, 2)]
    df = spark.createDataFrame(rows, "key string, seq int, w double, tag string, n int")
    whole = integrate.first_wins(df, ["key"], ["seq"])
    for columns in (["w"], ["tag"], ["n"], ["w", "tag"]):
        some = integrate.first_wins(df, ["key"], ["seq"], columns)
        assert "seq" not in some.columns and ("n" in some.columns) == ("n" in columns)
        assert sorted(map(str, some.select("key", *columns).collect())) == sorted(map(str, whole.select("key", *columns).collect()))
    keys = integrate.first_wins(df, ["key"], ["seq"], ["key"])
    assert sorted(map(str, keys.collect())) == sorted(map(str, whole.select("key").collect()))
    assert "min(" not in keys._jdf.queryExecution().optimizedPlan().toString()


def test_lines_keep_only_asked_values(spark):
    rows = [(1, 2, "b", 7), (1, 1, "a", 8), (2, 1, "c", 9), (1, 2, "a", 6)]
    df = spark.createDataFrame(rows, "o int, n int, t string, v int")
    whole = sequence.following(df, ["o"], ["n", "t", "v"])
    some = sequence.following(df, ["o"], ["n", "t", "v"], ahead=["v"], kept=["t"])
    assert some.schema["f"].dataType.names == ["t"] and some.schema["g"].dataType.names == ["v"]
    assert sorted(some.select("o", "seq", "f.t", "g.v").collect()) == sorted(whole.select("o", "seq", "f.t", "g.v").collect())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Lines with nulls and repeated keys; a bank and a stock share a key."""
    path = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2020, 1, 2)
    lines = [(o, n, 1 + (o * 7 + n) % 4, 50 * (1 + (o + n * n) % 5), 100.0 * n + o, float(n), [None, 0.01, 0.07][n % 3], ["A", "R", "N", None][(o + n) % 4], day)
             for o in range(1, 9) for n in (1, 2, 2, 3, 4)]
    lines += [lines[3], (None, 1, 1, 50, 1.0, 1.0, 0.1, "A", day), (3, 9, None, 50, 5.0, 1.0, 0.1, "A", day), (3, 10, 2, None, 5.0, 1.0, 0.1, "A", None)]
    made = {
        "lineitem": (lines, "l_orderkey long, l_linenumber long, l_suppkey long, l_partkey long, l_extendedprice double, l_quantity double, l_discount double, l_returnflag string, l_shipdate timestamp"),
        "orders": ([(o, o % 3, day, 9.0) for o in range(1, 9)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double"),
        "supplier": ([(i, f"s{i}", 0, float(i)) for i in range(1, 5)], "s_suppkey long, s_name string, s_nationkey long, s_acctbal double"),
        "part": ([(50 * i, f"p{i}", "t", "b", 3, 1.0) for i in range(1, 6)], "p_partkey long, p_name string, p_type string, p_brand string, p_size long, p_retailprice double"),
        "nation": ([(0, "NN", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "RR")], "r_regionkey long, r_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_edges_with_asked_columns_are_those_of_all_edges(spark, folder):
    whole = T.edges(spark, folder).cache()
    assert whole.columns == [f.name for f in schemas.EDGES] and whole.select("network_layer").distinct().count() == 4
    assert {r["currency"] for r in whole.where("network_layer = 'banking'").collect()} == {"USD"}
    for columns in (("source_id", "target_id"), ("source_id", "target_id", "weight"), T.LINKS, ("interest_rate", "source_id"), ("shares_held", "network_layer"), ("transaction_date", "currency")):
        some = T.edges(spark, folder, *columns)
        assert some.columns == list(columns)
        assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(*columns).collect()))


def test_edges_of_asked_kinds_move_no_loans(spark, folder):
    kinds = ("PUBLICLY_TRADED_AS", "equity_ownership")
    whole = T.edges(spark, folder).select(*T.LINKS)
    got = T.graph(spark, folder, kinds=kinds)[1]
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.where(whole.relationship_type.isin(*kinds)).collect())) != []
    market = T.edges(spark, folder, *T.LINKS).where("relationship_type in ('PUBLICLY_TRADED_AS', 'equity_ownership')")
    assert "market_correlation" not in market._jdf.queryExecution().optimizedPlan().toString()


class Seen(Exception):
    """Ends a query once it has asked for its edges."""


@pytest.mark.parametrize("name", ["clustering", "pagerank", "bfs_tree", "betweenness_sampled", "similar_entities", "bloom_parts"])
def test_queries_of_the_links_alone_move_only_their_ends(spark, monkeypatch, name):
    def asked(spark, sf, *columns, **_):
        raise Seen(columns)

    monkeypatch.setattr(T, "edges", asked)
    with pytest.raises(Seen) as seen:
        catalog.QUERIES[name](spark, SF)
    assert sorted(seen.value.args[0]) == ["source_id", "target_id"]


def test_edges_without_values_lie_in_the_order_of_their_keys(spark):
    rows = spark.range(500).selectExpr("id * 7 % 50 a", "id % 3 b", "id v")
    out = integrate.first_wins(rows, ["a", "b"], ["v"], [])
    parts = out.rdd.glom().collect()
    assert all(p == sorted(p) for p in parts) and sum(map(len, parts)) == rows.select("a", "b").distinct().count()


def test_a_counted_filter_reads_its_rows_once(spark, tmp_path):
    spark.range(400).selectExpr("if(id % 4 = 0, null, concat('k', id % 90)) key").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    filled, parts, k = sketches.counted_filter(rows, "key", 0.01)
    assert not [f for f in filled.inputFiles() if str(tmp_path) in f]
    n = rows.select("key").where("key is not null").distinct().count()
    assert (parts, k) == sketches.part_plan(n, 0.01)
    plain = sketches.part_filter(rows, "key", parts, k)
    assert sorted(map(str, filled.collect())) == sorted(map(str, plain.collect()))
    assert sketches.part_contains(rows, "key", filled, parts, k).where("not maybe_present").count() == 0


def test_followed_import_files_are_packed(spark, monkeypatch):
    packed = []

    def noted(df, path, compression=None):
        packed.append(compression)
        if len(packed) == 2:
            raise Seen

    monkeypatch.setattr(catalog.writers, "write_graph", noted)
    with pytest.raises(Seen):
        catalog.graph_upsert_files(spark, SF)
    assert packed == ["gzip", "gzip"]
