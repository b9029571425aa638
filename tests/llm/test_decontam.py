from __future__ import annotations

import random

import pytest
from compare import compare, connect

import corpus_pipeline
from riskweave.llm import decontam
from riskweave.llm.queries import QUERIES, SQL

ITEM = "In the morning Anna buys 12 apples and 3 kg of flour at the market, then Anna sells 5 apples to Bob for 2 dollars each."
OTHER = "A quiet harbour keeps many small boats that sail every spring towards the distant northern islands without any hurry."
SHORT = "which planet is the largest one"


@pytest.fixture(scope="module")
def tables(spark):
    changed = ITEM.replace("Anna", "Clara").replace("12", "47").replace("Bob", "Dan").replace("kg", "pounds")
    mixed = ITEM.replace("Anna sells", "Zoe sells")
    draw = random.Random(1)
    noise = " ".join(draw.choice(["river", "stone", "cloud", "tree", "field"]) + str(i) for i in range(60))
    docs = [
        (1, f"{noise}. {ITEM} {noise}"), (2, f"{noise}.\n{changed}\n{noise}"), (15, f"{noise} {ITEM}"), (3, mixed), (4, noise), (5, None), (6, ""), (7, OTHER.upper()), (7, OTHER.upper()),
        (8, " ".join(OTHER.split()[:9])), (9, "so which planet is the largest one then"), (10, "In the morning of a day"), (None, ITEM), (11, "x " * 50_000 + ITEM), (12, OTHER.lower()),
        (13, f"{ITEM} {changed}"), (14, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16")]
    items = [(100, ITEM), (101, OTHER), (102, None), (103, ""), (104, "one two"), (105, SHORT), (106, "1 2 3 4 5 6 7 8 9 10 11 12")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("text", "doc_id", "1 as item", "2 as hash", "3 as at"),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as width"))


def test_templates(spark, tables):
    row = decontam.templates(spark.createDataFrame([(1, "Then Anna pays 3,50 euros (to Bob!). He waits 5 minutes, not minutes: OK ½ $9")], "i long, t string"), "i", "t").first()
    assert row.tokens == ["then", "<name>", "pays", "<num>", "<unit>", "to", "<name>", "he", "waits", "<num>", "<unit>", "not", "minutes", "ok", "½", "<num>"]


def test_leaks_and_re_parameterised_questions(tables):
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(*tables).collect()}
    # an inconsistent name (3) is chance; nine words of OTHER (8) are two of its windows, too few
    assert set(got) == {(1, 100), (2, 100), (None, 100), (11, 100), (13, 100), (15, 100), (12, 101), (9, 105)}
    assert got[1, 100].n_changed == 0 and got[1, 100].n_matched == got[1, 100].n_windows
    # without a stop before it, "In" is taken for a name: the first window differs
    assert got[15, 100].n_matched == got[15, 100].n_windows - 1
    assert got[2, 100].n_changed == 4 and got[2, 100].n_matched == got[2, 100].n_windows


def test_empty_tables(tables):
    docs, items = tables
    assert decontam.contaminated(docs.where("false"), items).collect() == []
    assert decontam.contaminated(docs, items.where("false")).collect() == []


def test_sql_gives_the_same(spark, tables, tmp_path):
    docs, items = tables
    docs.select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    items.where("item_id <> 105").select("item_id", "text").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = connect("/nowhere")
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert compare(spark, con, str(tmp_path), QUERIES["op2_decontaminate"], SQL["op2_decontaminate"]) is None
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), sf, QUERIES["op2_decontaminate"], SQL["op2_decontaminate"]) is None
    assert QUERIES["op2_decontaminate"](spark, sf).count() > 10


def test_an_altered_value_costs_its_own_windows_only(spark, tables, tmp_path):
    docs, items = tables
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, items, veto="window").collect()}
    whole = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, items).collect()}
    assert set(got) == {*whole, (3, 100)} and all(got[k] == r for k, r in whole.items())
    # only the windows over the altered name go
    zoe = ITEM.split().index("then") + 1
    assert got[3, 100].n_windows - got[3, 100].n_matched == sum(at <= zoe < at + decontam.WINDOW for at in range(got[3, 100].n_windows))
    items.select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()}
    assert not left & {1, 2, 3, 15} and {4, 5, 6, 8} <= left


def test_rows_that_share_an_id_are_judged_alone(spark, tables, tmp_path):
    items = tables[1].where("item_id = 100")
    other = ITEM.replace("Anna", "Clara").replace("12", "47").replace("Bob", "Dan")
    words = ITEM.split()
    # each of the parts holds two of 19 windows, under SHARE, together they are over it
    parts = [(None, " ".join(words[at:at + 9])) for at in (8, 11, 14)]
    docs = [(None, ITEM), (None, other), (None, None), (None, "a clean text without an id"), *parts, (1, ITEM), (1, other), (1, "a clean text with the id of a leak"), (2, parts[0][1]), (2, parts[1][1]), (2, parts[2][1])]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in decontam.contaminated(docs, items).collect()}
    assert set(got) == {None, 1}
    assert all(r.n_matched == r.n_windows == 19 and r.n_changed == 3 for r in got.values())
    rows = decontam.contaminated_rows(docs, items).collect()
    assert sorted((r.id is None, r.n_changed) for r in rows) == [(False, 0), (False, 3), (True, 0), (True, 3)]
    items.select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [tuple(r) for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted((tuple(r) for r in docs.collect() if r.text not in (ITEM, other)), key=str)
