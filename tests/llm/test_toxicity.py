from __future__ import annotations

import zlib

import numpy as np
import pytest

from riskweave.llm import toxicity
from riskweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def rank_area(score, y):
    """Chance that a positive outranks a negative, ties half."""
    pos, neg = score[y == 1], np.sort(score[y == 0])
    return float(np.mean((np.searchsorted(neg, pos, "left") + np.searchsorted(neg, pos, "right")) / 2 / len(neg)))


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SF).collect()}
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    # toxic words are planted in English alone here: 7 % of its toxic labels, and all others, show nothing in the text
    english = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id").collect()}
    unseen = [i for i in labels if rows[i].held_out and i in english]
    score, y = np.array([rows[i].score for i in unseen]), np.array([labels[i] for i in unseen])
    assert rank_area(score, y) > 0.92
    assert np.mean((score >= 0.5) == y) > 0.97


@pytest.fixture(scope="module")
def small(spark):
    clean = [(i, f"the quiet river number {i % 7} runs past green fields and old towns " * 3) for i in range(200)]
    foul = [(1000 + i, f"the quiet river runs you vilefool past green {i % 5} fields and zorkbrained towns " * 2) for i in range(60)]
    docs = spark.createDataFrame(clean + foul, "doc_id long, text string").selectExpr("text", "doc_id", "1 as score", "2 as gains", "3 as toxic")
    labels = spark.createDataFrame([(i, 0) for i, _ in clean] + [(i, 1) for i, _ in foul] + [(1000, 0), (1001, None), (None, 1)], "doc_id long, toxic int")
    return docs, labels


def test_learns_and_scores_odd_rows(spark, small):
    docs, labels = small
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "you vilefool and zorkbrained you vilefool"), (3, "x" * 300_000), (3, "x" * 300_000), (4, "green fields and old towns")], "doc_id long, text string")
    got = [(r.doc_id, r.score) for r in toxicity.score(odd, model).collect()]
    assert len(got) == 6 and all(0 <= s <= 1 for _, s in got)
    by_id = dict(got)
    assert by_id[1] == by_id[2] and by_id[None] > 0.5 > by_id[4]
    assert toxicity.fit(docs.select("doc_id", "text"), labels) == model


def test_one_kind_of_label(spark, small):
    docs, labels = small
    docs = docs.select("doc_id", "text")
    for kept, want in ((labels.where("false"), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = toxicity.fit(docs, kept)
        assert {r.score for r in toxicity.score(docs, model).collect()} == {want}
    assert toxicity.score(docs.where("false"), model).collect() == []
