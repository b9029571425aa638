"""Exact duplicates against a plain re-computation."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskweave.llm import exactdup
from riskweave.llm.queries import QUERIES
from riskweave.session import scratch_path

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (None, "a"), (3, "a"), (3, "a"), (4, "A"), (5, "a "), (None, "b"), (None, "b"), (6, "é"), (7, "é"), (8, "x" * 300_000), (9, "x" * 300_000), (10, "x" * 299_999 + "y")]


def write(spark, rows, files=1):
    path = scratch_path(spark, "docs")
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "1 as n", "doc_id", "2 as digest", "3 as file", "'k' as keep", "4 as row", "5 as part")
    frame.repartition(files).write.parquet(path)
    return path


def plain(rows):
    """``(doc_id, keep_id, group_size, sha)`` of every row."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def found(frame):
    rows = frame.collect()
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)


@pytest.mark.parametrize("files", [1, 5])
def test_odd_rows(spark, files):
    path = write(spark, ODD * 2 + [(20 + i, "hot") for i in range(700)], files)
    frame = exactdup.exact_groups(spark, path, files_per_batch=2)
    assert found(frame) == plain(ODD * 2 + [(20 + i, "hot") for i in range(700)])


def test_equal_digests_of_other_texts_are_told_apart(spark):
    rows = [(i, f"text {i % 9}") for i in range(120)] + [(500, None), (501, "")]

    def weak(text):
        return F.length(text).cast("string")

    assert found(exactdup.exact_groups(spark, write(spark, rows), digest=weak)) == plain(rows)


def test_empty_table(spark):
    assert exactdup.exact_groups(spark, write(spark, [])).collect() == []


def test_state_goes_on_where_it_stopped(spark):
    """A second run on the checkpoint reads the new files only and knows all earlier digests."""
    path, checkpoint = write(spark, [(1, "a"), (2, "b")]), scratch_path(spark, "state")
    first = {r.n for r in exactdup.follow(spark, path, checkpoint).collect()}
    spark.createDataFrame([(7, "a"), (0, "b"), (3, "c")], "doc_id long, text string").write.mode("append").parquet(path)
    state = {r.digest: (r.keep.doc_id, r.n) for r in exactdup.follow(spark, path, checkpoint).collect()}
    assert first == {1}
    assert state == {hashlib.sha256(t).hexdigest(): v for t, v in ((b"a", (7, 2)), (b"b", (2, 2)), (b"c", (3, 1)))}


def test_no_python_meets_a_row(spark):
    plan = exactdup.exact_groups(spark, f"{SF}/documents.parquet")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op12_exact_dedup"](spark, SF)) == plain(docs)


def test_a_store_reserves_no_disk(spark, tmp_path, monkeypatch):
    """Each of many small stores would take 4 MB of disk for a log of a few rows."""
    seen, settings = [], exactdup._settings

    def spied(session, wanted):
        seen.append(wanted.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate"))
        return settings(session, wanted)

    monkeypatch.setattr(exactdup, "_settings", spied)
    texts = {text or "" for _, text in ODD}
    assert exactdup.follow(spark, write(spark, ODD), f"{tmp_path}/state").count() == len(texts)
    assert seen == ["false"]
