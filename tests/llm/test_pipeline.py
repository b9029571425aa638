"""The pipeline against a plain version of every stage."""

from __future__ import annotations

import pandas as pd
import pytest
import sentencepiece
from compare import connect
from test_jaccard import plain as plain_components
from test_text_scans import base_secrets

import corpus_pipeline
from riskweave.llm import decontam, quality, secrets, tokens

SF = "/root/testdata/sf0.01"


def blank(text):
    spans = sorted(tuple(map(int, s.split(":")[1:])) for s in base_secrets(text))
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def stages(rows: pd.DataFrame, con):
    con.register("rows_now", rows)
    verdict = dict(con.execute("SELECT doc_id, kept FROM (" + quality.VERDICT_SQL.format(documents="rows_now") + ")").fetchall())
    rows = rows[rows.doc_id.map(verdict)]
    yield rows
    alone = {i for i, _, c in plain_components(list(zip(rows.doc_id, rows.text))) if i == c}
    rows = rows[rows.doc_id.isin(alone)]
    yield rows
    con.register("rows_now", rows)
    leaked = {r[0] for r in con.execute("SELECT doc_id FROM (" + decontam.CONTAMINATED_SQL.replace("DOCUMENTS_TABLE", "rows_now") + ")").fetchall()}
    rows = rows[~rows.doc_id.isin(leaked)]
    yield rows
    rows = rows.assign(text=rows.text.map(blank))
    rows["n_chars"] = rows.text.str.len()
    yield rows


def test_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = stages(docs.toPandas(), connect(SF))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{tmp_path}/{k}"
        before = docs.count()
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        if k < 4:
            want = next(plain)
            assert sorted(docs.columns) == sorted(want.columns), name
            got = docs.toPandas()[want.columns].sort_values("doc_id").reset_index(drop=True)
            pd.testing.assert_frame_equal(got, want.sort_values("doc_id").reset_index(drop=True), check_dtype=False)
            if k < 3:
                assert len(got) < before, name
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    assert {r.doc_id: r.ids for r in docs.collect()} == {i: library.encode(t) for i, t in zip(want.doc_id, want.text)}
    run = {r.doc_id: (r.n_ids, r.restored) for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {r.doc_id: (r.n_ids, r.restored) for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, good, "en", "s", 5), (3, good + " x", "en", "s", 5), (4, good + " y", "en", "s", 5), (4, good + " y", "en", "s", 5),
            (5, good.replace("word", "term") + " token = abcdef123456 password: hunter2hunter2", "en", "s", 1), (6, "long " + " ".join(f"l{i}" for i in range(6_000)), "en", "s", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "7 as words", "8 as row", "9 as leaked")


def test_odd_rows(spark, odd, tmp_path):
    docs = odd
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(sorted(-1 if r.doc_id is None else r.doc_id for r in docs.collect()))
        if k < 4:
            assert docs.columns == odd.columns
        if k == 3:
            assert "[secret] [secret]" in docs.where("doc_id = 5").first().text
    assert kept == [[-1, 3, 4, 4, 5, 6], [-1, 3, 5, 6], [-1, 3, 5, 6], [-1, 3, 5, 6], [-1, 3, 5, 6]]


def test_empty_table(spark, odd, tmp_path):
    docs = odd.where("false")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0


def test_redaction_equals_found_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    spans = {r.doc_id: sorted((s.start, s.end) for s in r.spans) for r in secrets.find_secrets(docs).collect()}
    for r in secrets.redacted(docs).collect():
        assert r.text == secrets.blanked(texts[r.doc_id], spans[r.doc_id], "[secret]")
