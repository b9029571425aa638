from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators import cascade, privacy

NODES = [
    ("BANK_A", "bank", "A", "A Corp", None, None, None, 10.0), ("BANK_B", "bank", "B", "B Corp", None, None, None, 5.0),
    ("STOCK_A", "stock", None, "A", "A", "Fin", 100.0, None), ("STOCK_X", "stock", None, "X", "X", "Tech", 50.0, None),
    ("STOCK_Y", "stock", None, "Y", "Y", "Tech", 60.0, None), ("STOCK_B", "stock", None, "B", "B", "Fin", 70.0, None),
    ("INST_1", "institutional_investor", None, "I1", None, None, None, None),
    ("INST_2", "institutional_investor", None, "I2", None, None, None, None),
]
EDGES = [
    ("BANK_A", "STOCK_A", "PUBLICLY_TRADED_AS", 1.0), ("STOCK_A", "BANK_A", "REPRESENTS_BANK", 1.0),
    ("BANK_B", "STOCK_B", "PUBLICLY_TRADED_AS", 1.0),
    ("INST_1", "STOCK_A", "equity_ownership", 3.0), ("INST_1", "STOCK_A", "equity_ownership", 4.0),
    ("INST_2", "STOCK_A", "equity_ownership", 5.0), ("INST_1", "STOCK_X", "equity_ownership", 7.0),
    ("INST_2", "STOCK_X", "equity_ownership", 11.0), ("INST_2", "STOCK_Y", "equity_ownership", 13.0),
    ("INST_1", "INST_2", "cross_institutional_holding", 1.0),
]


@pytest.fixture(scope="module")
def network(spark):
    nodes = spark.createDataFrame(NODES, "node_id string, node_type string, institution_id string, name string, "
                                         "ticker string, sector string, market_cap double, total_assets double")
    return nodes, spark.createDataFrame(EDGES, "source_id string, target_id string, relationship_type string, weight double")


@pytest.mark.parametrize("size", [1, 1_000_000])
def test_three_hops(network, size):
    rows = cascade.cascade_impact(*network, rows_per_split=size, pairs_per_cell=size).where("bank = 'A'").collect()
    got = sorted((r["hop"], r["entity_id"], r["impact_value"]) for r in rows)
    # The two parallel first edges repeat the path through the first holder.
    assert got == [(1, "A", 100.0), (2, "INST_1", 3.0), (2, "INST_1", 4.0), (2, "INST_2", 5.0),
                   (3, "X", 25.0), (3, "Y", 13.0)]


def test_chosen_and_complete_banks(spark, network):
    asked = spark.createDataFrame([("B",)], "institution_id string")
    rows = cascade.cascade_impact(*network, banks=asked).collect()
    assert [(r["bank"], r["hop"]) for r in rows] == [("B", 1)]
    whole = cascade.cascade_impact(*network, require_all_hops=True)
    assert [r["bank"] for r in whole.select("bank").distinct().collect()] == ["A"]


def test_summary_score_and_ranking(spark, network):
    rows = {r["bank"]: r for r in cascade.systemic_score(cascade.cascade_summary(*network)).collect()}
    assert (rows["A"]["direct_stocks"], rows["A"]["affected_investors"], rows["A"]["cascade_stocks"]) == (1, 2, 2)
    assert (rows["B"]["direct_stocks"], rows["B"]["affected_investors"], rows["B"]["cascade_stocks"]) == (1, 0, 0)
    assert rows["A"]["systemic_score"] == 0.625 and rows["A"]["assessment"] == "MODERATE"
    counts = spark.createDataFrame([(20, 30, 50), (1, 31, 1), (1, 16, 1)],
                                   "direct_stocks long, affected_investors long, cascade_stocks long")
    assert [r["assessment"] for r in cascade.systemic_score(counts).collect()] == ["HIGH", "CRITICAL", "HIGH"]
    assert cascade.systemic_score(counts).first()["systemic_score"] == 10.0
    asked = spark.createDataFrame([("B", 1), ("A", 2)], "institution_id string, position int")
    ranking = cascade.systemic_ranking(*network, asked).collect()
    assert [(r["bank_group"], r["total_impact"]) for r in ranking] == [("Bank_Group_2", 5), ("Bank_Group_1", 1)]


def test_sectors_below_k_are_left_out(network):
    assert [tuple(r) for r in cascade.sector_breakdown(*network, k=2).collect()] == [("A", "Tech", 2)]
    assert cascade.sector_breakdown(*network, k=3).count() == 0


def test_subgraph(network):
    rows = cascade.cascade_subgraph(*network, bank="A", limit=None)
    assert rows.count() == 9
    assert cascade.cascade_subgraph(*network, bank="A", limit=4).count() == 4
    assert cascade.cascade_subgraph(*network, bank="B").count() == 0


MORE_NODES = [
    ("BANK_C", "bank", "C", "C Corp", None, None, None, 1.0), ("STOCK_C", "stock", None, "C", "C", "Fin", 1.0, None),
    ("INST_3", "institutional_investor", None, "I3", None, None, None, None), ("BANK_N", "bank", None, "N Corp", None, None, None, 1.0)]
MORE_EDGES = [
    ("BANK_C", "STOCK_C", "PUBLICLY_TRADED_AS", 1.0), ("BANK_N", "STOCK_A", "PUBLICLY_TRADED_AS", 1.0), ("INST_3", "STOCK_C", "equity_ownership", 2.0),
    ("INST_3", "STOCK_X", "equity_ownership", 6.0), ("STOCK_X", "STOCK_C", "market_correlation", 0.5), ("STOCK_X", "STOCK_Y", "market_correlation", 0.5),
    ("INST_3", "BANK_A", "equity_ownership", 1.0), ("BANK_A", "STOCK_X", "equity_ownership", 1.0), ("INST_1", None, "equity_ownership", 1.0)]


@pytest.mark.parametrize("sizes", [{}, dict(rows_per_split=1, pairs_per_cell=1, banks_per_row=1)])
def test_subgraphs_of_all_banks(spark, network, sizes):
    nodes, edges = network
    nodes = nodes.union(spark.createDataFrame(MORE_NODES, nodes.schema))
    edges = edges.union(spark.createDataFrame(MORE_EDGES, edges.schema))
    rows = [*EDGES, *MORE_EDGES]
    kinds = {n[0]: n[1] for n in [*NODES, *MORE_NODES]}
    want = []
    for b in "ABC":
        first = {t for s, t, k, _ in rows if s == f"BANK_{b}" and k == cascade.LISTED and kinds.get(t) == "stock"}
        holders = {s for s, t, k, _ in rows if t in first and k == cascade.OWNED and kinds.get(s) == "institutional_investor"}
        second = {t for s, t, k, _ in rows if s in holders and k == cascade.OWNED and kinds.get(t) == "stock"}
        inside = {f"BANK_{b}"} | first | holders | second if holders else set()
        want += [(b, *r) for r in rows if r[0] in inside and r[1] in inside]
    got = cascade.cascade_subgraph(nodes, edges, **sizes)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r[0] for r in want} == {"A", "C"}
    one = cascade.cascade_subgraph(nodes, edges, bank="C", **sizes)
    assert sorted(map(tuple, one.collect())) == sorted(r for r in want if r[0] == "C")


def test_the_query_gives_the_subgraph_of_every_bank(spark):
    from riskweave.plans import catalog
    sf = "/root/testdata/sf0.001"
    impact = cascade.cascade_impact(*catalog._cascade_graph(spark, sf, "weight")).where("hop = 2")
    banks = {r["bank"] for r in impact.select("bank").distinct().collect()}
    got = {r["bank"] for r in catalog.cascade_subgraph(spark, sf).select("bank").distinct().collect()}
    assert len(banks) > 1 and got == banks


PEOPLE = [("a", "n1", "x", "s", 1.0, 1), ("b", "n2", "x", "s", 2.0, 1), ("c", "n3", "x", "s", 3.0, 1),
          ("d", "n4", "y", "s", 4.0, 1), ("e", "n5", None, "s", 5.0, 1), ("f", "n6", None, "s", 6.0, 1), ("g", "n7", None, "s", 7.0, 1)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "entity_id string, entity_name string, kind string, sector string, impact_value double, hop int")


def test_no_small_group_and_no_identifier(people):
    out = privacy.k_anonymize(people, ["kind", "sector"], ["entity_id", "entity_name"], 3)
    assert not {"entity_id", "entity_name"} & set(out.columns)
    rows = out.collect()
    assert len(rows) == 6 and all(r["group_size"] == 3 for r in rows)
    text = " ".join(str(tuple(r)) for r in rows)
    assert not any(name in text for name in ("n1", "n2", "n3", "n5"))
    assert {r["entity_id_anonymized"] for r in rows} == {"Group[kind=x, sector=s]", "Group[kind=null, sector=s]"}


def test_report_and_summary(people):
    report = privacy.anonymization_report(people, ["kind", "sector"], 3).first()
    assert tuple(report) == (3, 2, 1, 6, 7)
    totals = {r["kind"]: (r["entity_count"], r["total_impact"]) for r in privacy.k_anon_summary(people, ["kind"], 3).collect()}
    assert totals == {"x": (3, 6.0), None: (3, 18.0)}


def test_fallback_and_both_outputs(spark, people, tmp_path):
    small = privacy.anonymized_or_summary(people.where("kind = 'y'"), ["kind", "sector"], ["entity_id", "entity_name"], 2)
    assert "entity_count" in small.columns and small.count() == 0
    privacy.write_impact(people, f"{tmp_path}/anon", f"{tmp_path}/internal", ["kind", "sector"], ["entity_id", "entity_name"], 3)
    assert "entity_id" not in spark.read.option("header", True).csv(f"{tmp_path}/anon").columns
    assert spark.read.option("header", True).csv(f"{tmp_path}/internal").count() == 7


def test_group_size_of_a_large_group(spark):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise("x"))
    sizes = {r["g"]: r["group_size"] for r in privacy.with_group_size(df, ["g"]).select("g", "group_size").distinct().collect()}
    assert sizes == {None: 1000, "x": 2000}
