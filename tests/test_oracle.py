"""Every query with a SQL twin gives the same rows in both engines."""

from __future__ import annotations

import os

import pytest

from compare import compare, connect
from riskweave.operators import graph
from riskweave.plans import tables
from riskweave.plans.catalog import QUERIES
from riskweave.plans.oracle import BFS_LEVELS, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], SQL[name]) is None


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_written_out_bfs_levels_are_enough(spark):
    nodes, edges = tables.graph(spark, SF)
    sources = graph.seeded_sources(graph.node_universe(nodes, edges))
    depth = graph.bfs_tree(nodes, edges, sources).agg({"depth": "max"}).first()[0]
    assert depth < BFS_LEVELS
