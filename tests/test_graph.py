from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskweave.operators import graph
from riskweave.operators.skew import heavy_keys, sized_join, split_join


def make(spark, seed=1, n=24, m=150):
    """Random digraph with parallel edges, loops, a hub and isolated nodes."""
    rng = random.Random(seed)
    pairs = [(f"n{rng.randrange(n):02d}", f"n{rng.randrange(n):02d}") for _ in range(m)]
    pairs += [("n00", f"n{i:02d}") for i in range(1, n)] + [("x1", "x1"), ("n03", "x1")]
    rows = [(a, b, float(i % 7 + 1), i) for i, (a, b) in enumerate(pairs)]
    edges = spark.createDataFrame(rows, "source_id string, target_id string, weight double, seq long")
    nodes = spark.createDataFrame([(f"n{i:02d}",) for i in range(n)] + [("alone",)], "node_id string")
    return nodes, edges, rows


def universe(rows, nodes):
    return sorted({a for a, *_ in rows} | {r[1] for r in rows} | {r["node_id"] for r in nodes.collect()})


def got(df, col):
    return {r["node_id"]: r[col] for r in df.collect()}


def brute_pagerank(rows, names, iters=20, d=0.85):
    out, into = defaultdict(list), defaultdict(list)
    for a, b, *_ in rows:
        out[a].append(b)
        into[b].append(a)
    pr = dict.fromkeys(names, 1 / len(names))
    for _ in range(iters):
        pr = {v: (1 - d) / len(names) + d * sum(pr[u] / len(out[u]) for u in into[v]) for v in names}
    return pr


@pytest.mark.parametrize("rows_per_split", [1_000_000, 4])
def test_pagerank_matches_brute_force_also_with_split_hubs(spark, rows_per_split):
    nodes, edges, rows = make(spark)
    want = brute_pagerank(rows, universe(rows, nodes))
    ranks = got(graph.pagerank(nodes, edges, rows_per_split=rows_per_split), "pagerank_score")
    assert ranks.keys() == want.keys()
    assert all(math.isclose(ranks[v], want[v], rel_tol=1e-12) for v in want)


def test_pagerank_of_a_cycle_and_of_the_uniform_variant(spark):
    edges = spark.createDataFrame([(f"{i}", f"{(i + 1) % 5}") for i in range(5)], "source_id string, target_id string")
    nodes = edges.selectExpr("source_id as node_id")
    assert all(math.isclose(r, 0.2) for r in got(graph.pagerank(nodes, edges, 7), "pagerank_score").values())
    loose = spark.createDataFrame([("a", "b"), ("a", "c")], "source_id string, target_id string")
    total = sum(got(graph.pagerank(loose.selectExpr("source_id as node_id"), loose, 6, dangling="uniform"), "pagerank_score").values())
    assert math.isclose(total, 1.0)


def brute_bfs(rows, source):
    out = defaultdict(set)
    for a, b, *_ in rows:
        out[a].add(b)
    depth, parent, level = {source: 0}, {source: None}, [source]
    while level:
        reached = defaultdict(set)
        for u in level:
            for v in out[u] - depth.keys():
                reached[v].add(u)
        for v, us in reached.items():
            depth[v], parent[v] = depth[level[0]] + 1, min(us)
        level = list(reached)
    return depth, parent


@pytest.mark.parametrize("rows_per_split", [1_000_000, 4])
def test_bfs_tree_matches_brute_force(spark, rows_per_split):
    nodes, edges, rows = make(spark)
    sources = spark.createDataFrame([("n00",), ("n05",), ("alone",)], "node_id string")
    tree = graph.bfs_tree(nodes, edges, sources, rows_per_split=rows_per_split).collect()
    for s in ("n00", "n05", "alone"):
        depth, parent = brute_bfs(rows, s)
        mine = {r["node_id"]: (r["depth"], r["parent"]) for r in tree if r["source"] == s}
        assert mine == {v: (depth[v], parent[v]) for v in depth}
    shallow = graph.bfs_tree(nodes, edges, sources, max_depth=1)
    assert shallow.agg({"depth": "max"}).first()[0] == 1


@pytest.mark.parametrize("sent_nodes", [1_000_000, 0])
def test_a_node_meets_its_links_once_for_all_sources(spark, monkeypatch, sent_nodes):
    met = []
    expand = graph.frontier_expand

    def counted(frontier, *rest):
        met.append(frontier.count())
        return expand(frontier, *rest)

    monkeypatch.setattr(graph, "frontier_expand", counted)
    pairs = [(f"s{i:02d}", "hub") for i in range(70)] + [("hub", f"t{i}") for i in range(5)] + [("t4", "z"), ("t1", "z")]
    edges = spark.createDataFrame(pairs, "source_id string, target_id string")
    nodes = edges.selectExpr("source_id as node_id").distinct()
    g = graph.index_graph(nodes, edges)
    tree, numbered = graph._bfs(g, nodes.where("node_id like 's%'"), rows_per_split=3, sent_nodes=sent_nodes)
    assert met[0] == 70 and len(met) == 4
    # a heavy node that is not sent is repeated per part
    assert met[1:] == ([1, 5, 1] if sent_nodes else [2, 5, 1])
    rows = g.named(tree, id="node_id", parent="parent_id").groupBy("node_id", "parent_id", "depth").count().collect()
    got = {(r["node_id"], r["parent_id"], r["depth"]): r["count"] for r in rows if r["depth"] and r["node_id"] != "hub"}
    assert got == {**{(f"t{i}", "hub", 2): 70 for i in range(5)}, ("z", "t1", 3): 70}
    assert sum(r["count"] for r in rows if r["node_id"] == "hub" and r["depth"] == 1) == 70


def test_betweenness_counts_interior_nodes_of_tree_paths(spark):
    nodes, edges, rows = make(spark)
    names = universe(rows, nodes)
    visits = dict.fromkeys(names, 0)
    for s in names:
        depth, parent = brute_bfs(rows, s)
        for v in depth:
            u = parent[v]
            while u is not None and u != s:
                visits[u] += 1
                u = parent[u]
    norm = (len(names) - 1) * (len(names) - 2)
    mine = got(graph.betweenness_sampled(nodes, edges, sources=1000), "betweenness_centrality")
    assert mine == {v: visits[v] / norm for v in names}
    some = graph.seeded_sources(graph.node_universe(nodes, edges), 5, seed=3)
    assert some.count() == 5 and some.collect() == graph.seeded_sources(graph.node_universe(nodes, edges), 5, seed=3).collect()


def test_clustering_matches_brute_force(spark):
    nodes, edges, rows = make(spark, m=90)
    links = {(a, b) for a, b, *_ in rows}
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for v in universe(rows, nodes):
        k = len(near[v])
        hits = sum((p, q) in links for p in near[v] for q in near[v] if p != q)
        want[v] = hits / (k * (k - 1)) if k >= 2 else 0.0
    assert got(graph.clustering(nodes, edges), "clustering_coefficient") == want


def test_corners_of_a_batch_are_added_up():
    """Links 1-2 and 1-3 share 4 and 5, the second also 9; 4 is linked with 2 both ways, 5 with 1."""
    rows = [dict(v=1, x=2, m_vx=2, ids_v=[4, 5], both_v=[5], ids=[4, 5, 7], both=[4]), dict(v=1, x=3, m_vx=1, ids_v=[4, 5, 9], both_v=[5], ids=[4, 5, 9], both=[]),
            dict(v=6, x=8, m_vx=1, ids_v=[9], both_v=[], ids=[], both=[])]
    schema = pa.schema([("v", pa.int32()), ("x", pa.int32()), ("m_vx", pa.int64()), *[(c, pa.list_(pa.int32())) for c in ("ids_v", "both_v", "ids", "both")]])
    out = list(graph._corners(iter([pa.RecordBatch.from_pylist(rows, schema), pa.RecordBatch.from_pylist(rows[2:], schema), pa.RecordBatch.from_pylist([], schema)])))
    assert {r["rank"]: r["opposite"] for r in out[0].to_pylist()} == {1: 3 + 3, 2: 3, 3: 4, 4: 3, 5: 3, 9: 1}
    assert [b.num_rows for b in out] == [6, 0, 0]


def test_degree_and_exposure_modes(spark):
    nodes, edges, rows = make(spark)
    deg = {r["node_id"]: r for r in graph.degree(nodes, edges).collect()}
    names = universe(rows, nodes)
    assert sorted(deg) == names
    for v in names:
        assert deg[v]["in_degree"] == sum(r[1] == v for r in rows)
        assert deg[v]["out_degree"] == sum(r[0] == v for r in rows)
    last = {}
    for a, b, w, _ in rows:
        last[a, b] = w
    plain = got(graph.exposure(nodes, edges), "incoming_exposure")
    legacy = got(graph.exposure(nodes, edges, "last", "seq"), "outgoing_exposure")
    for v in names:
        assert plain[v] == sum(r[2] for r in rows if r[1] == v)
        assert legacy[v] == sum(last[r[0], r[1]] for r in rows if r[0] == v)


def test_dense_ids_follow_the_id_order(spark):
    names = spark.range(500).selectExpr("concat('k', id) as node_id")
    rows = graph.dense_ids(names.repartition(5)).orderBy("node_id").collect()
    assert [r["id"] for r in rows] == list(range(500))


def test_features_have_no_missing_cell(spark):
    nodes, edges, _ = make(spark)
    tiers = nodes.selectExpr("node_id", "cast(null as string) as tier", "cast(null as double) as equity")
    out = graph.node_features(tiers, edges, sources=3).collect()
    assert len(out) == nodes.count()
    assert all(v is not None for r in out for v in r) and out[0]["tier"] == "0"


def test_split_joins_keep_every_row(spark):
    heavy = spark.createDataFrame([("hot", i) for i in range(200)] + [("cold", 1), ("none", 2)], "k string, v int")
    other = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("cold", "c")], "k string, w string")
    assert {r["k"]: r["_parts"] for r in heavy_keys(heavy, ["k"], 30).collect()} == {"hot": 7}
    for how in ("inner", "left"):
        want = sorted(map(str, heavy.join(other, "k", how).collect()))
        assert sorted(map(str, split_join(heavy, other, ["k"], 30, how).select("k", "v", "w").collect())) == want
        for size in (30, 1000):
            assert sorted(map(str, sized_join(heavy, other, ["k"], size, how).select("k", "v", "w").collect())) == want
    with pytest.raises(ValueError):
        split_join(heavy, other, ["k"], how="full")


def test_exposure_keeps_small_weights(spark):
    edges = spark.createDataFrame([("a", "b", 0.004)] * 3 + [("b", "a", 1e-9)], "source_id string, target_id string, weight double")
    nodes = spark.createDataFrame([("a",), ("b",)], "node_id string")
    got = {r.node_id: (r.incoming_exposure, r.outgoing_exposure) for r in graph.exposure(nodes, edges).collect()}
    assert got == {"a": (1e-9, 0.012), "b": (0.012, 1e-9)}


def test_clustering_with_neighbour_lists_in_pieces(spark):
    """Dense and two-way links; every piece meets every other."""
    rng = np.random.default_rng(8)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 25, (260, 2))}
    edges = spark.createDataFrame([(f"n{a}", f"n{b}", "x", 1.0) for a, b in pairs], "source_id string, target_id string, relationship_type string, weight double")
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(26)], "node_id string")
    around = {i: {b for a, b in pairs if a == i} | {a for a, b in pairs if b == i} for i in range(26)}
    want = {}
    for i, near in around.items():
        k = len(near)
        inside = sum((a, b) in pairs for a in near for b in near if a != b)
        want[f"n{i}"] = inside / (k * (k - 1)) if k > 1 else 0.0
    for piece in (1, 3, 10_000):
        got = {r["node_id"]: r["clustering_coefficient"] for r in graph.clustering(nodes, edges, piece=piece).collect()}
        assert got == pytest.approx(want)


def test_clustering_takes_only_later_neighbours_along(spark):
    """Pieces of two neighbours give the values of whole lists, and lists are cut before they move."""
    pairs = [(f"n{i}", f"n{j}") for i in range(9) for j in range(9) if i != j and (i * 5 + j * 3) % 4]
    edges = spark.createDataFrame(pairs, "source_id string, target_id string")
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(10)], "node_id string")
    cut, whole = graph.clustering(nodes, edges, piece=2), graph.clustering(nodes, edges)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert "slice(" in whole._jdf.queryExecution().optimizedPlan().toString()
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {n: sum(a in near[n] and b in near[n] for a, b in pairs) / (len(s) * (len(s) - 1)) for n, s in near.items()}
    assert {r.node_id: r.clustering_coefficient for r in cut.collect()} == pytest.approx(want | {"n9": 0.0})
