"""What the edges move and write: whole-number keys, lines with a next one, packed import files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as types

from riskweave import schemas
from riskweave.operators import integrate, sequence
from riskweave.plans import catalog, tables as T
from riskweave.sources import readers, writers
from test_edge_columns import folder  # noqa: F401


def text(df):
    return sorted(map(str, df.collect()))


def test_the_first_row_is_chosen_by_natural_keys(spark, folder, monkeypatch):  # noqa: F811
    seen, choose = [], integrate.first_wins

    def noted(df, keys, *rest):
        if keys == integrate.EDGE_KEY:
            seen.extend(df.schema[c].dataType for c in ("source_id", "target_id"))
        return choose(df, keys, *rest)

    monkeypatch.setattr(integrate, "first_wins", noted)
    assert T.edges(spark, folder).schema["source_id"].dataType == types.StringType()
    assert seen == [types.LongType()] * 6


def test_whole_and_text_keys_give_the_same_edges(spark):
    def edges(kind):
        lending = spark.createDataFrame([(2, 1, 7, "x", 5.0), (1, 1, 7, "x", 9.0), (3, None, 7, "x", 1.0), (4, -3, 1, None, None)],
                                        "seq long, a long, b long, relationship_type string, amount_usd double")
        corr = spark.createDataFrame([(1, 2, -0.5), (1, 2, -0.25), (2, None, 1.0)], "a long, b long, correlation double")
        own = spark.createDataFrame([(7, 1, 3.0), (7, 1, 2.0), (7, 12, 2.0)], "a long, b long, ownership_value double")
        named = [df.withColumns({"a": df.a.cast(kind), "b": df.b.cast(kind)}).withColumnsRenamed({"a": a, "b": b}) for df, a, b in (
            (lending, "from_institution", "to_institution"), (corr, "symbol1", "symbol2"), (own, "owner_cik", "owned_ticker"))]
        return integrate.unified_edges(*named)

    whole = edges("long")
    assert text(whole) == text(edges("string")) and whole.count() == 5
    assert {(r.source_id, r.target_id) for r in whole.collect()} == {
        ("BANK_1", "BANK_7"), ("BANK_-3", "BANK_1"), ("STOCK_1", "STOCK_2"), ("INST_7", "STOCK_1"), ("INST_7", "STOCK_12")}


@pytest.fixture
def written(monkeypatch):
    """Plans and rows of what the pairing of rows writes."""
    found, write = [], sequence.materialize

    def noted(df, *rest):
        table = write(df, *rest)
        found.append((df._jdf.queryExecution().optimizedPlan().toString(), table))
        return table

    monkeypatch.setattr(sequence, "materialize", noted)
    return found


def test_rows_without_a_next_one_are_not_written(spark, written):
    rows = [(i // 2 if i < 100 else i, i, i) for i in range(400)]  # 50 pairs, 300 rows alone
    got = sequence.following(spark.createDataFrame(rows, "k int, n int, v int").repartition(3), ["k"], ["n"]).collect()
    assert sorted((r.seq, r.f.v, r.g.v) for r in got) == [(i, i, i + 1) for i in range(0, 100, 2)]
    table = written[0][1]
    assert "_next_k" not in table.columns
    ranges = table.selectExpr("shiftright(_id, 33)").distinct().count()
    assert table.count() <= 50 + 2 * ranges


def test_order_columns_behind_the_used_ones_do_not_move(spark, written):
    rows = [(i % 9, i % 3, i % 4, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, n int, v int, tail string").repartition(3)
    whole = sequence.following(df, ["k"], ["n", "v", "tail"])
    some = sequence.following(df, ["k"], ["n", "v", "tail"], ahead=["n"], kept=["v"])
    assert text(some.select("k", "seq", "f.v", "g.n")) == text(whole.select("k", "seq", "f.v", "g.n"))
    # a used column outside the order: ties keep the whole order
    part = sequence.following(df.withColumnRenamed("tail", "t").withColumn("w", df.v), ["k"], ["n", "v", "t"], ahead=["n"], kept=["w"])
    assert text(part.selectExpr("k", "seq", "f.w as v", "g.n")) == text(whole.select("k", "seq", "f.v", "g.n"))
    moved = [next(line for line in plan.splitlines() if "RepartitionByExpression" in line) for plan, _ in written]
    assert ["tail#" in line or "t#" in line for line in moved] == [True, False, True]


def test_round_trip_writes_packed_files(spark, folder, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    back = catalog.graph_round_trip(spark, folder)
    files = [n for n in os.listdir(f"{tmp_path}/import") if n.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
    assert text(back) == text(T.edges(spark, folder)) and back.schema == schemas.EDGES


def test_packed_files_end_after_some_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_PACKED_FILE", 10)
    df = spark.range(95, numPartitions=1).selectExpr("cast(id as string) as source_id", "'b,\"c' as target_id", "'t' as relationship_type")
    writers.write_graph(integrate.to_import_edges(df), f"{tmp_path}/e", compression="gzip")
    assert sum(n.startswith("part-") for n in os.listdir(f"{tmp_path}/e")) == 10
    back = readers.read_graph_csv(spark, f"{tmp_path}/e", schemas.EDGES).select(*df.columns)
    assert text(back) == text(df)
