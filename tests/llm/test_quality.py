from __future__ import annotations

import re
from collections import Counter

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from riskweave.llm import quality
from riskweave.llm.queries import QUERIES, SQL

ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a b c a b c"), (5, "a b c"), (6, "x y " * 40), (7, "same\nsame\n\nsame\x0b \n other"),
    (8, "#tag * $5 <b> | " * 30), (None, "word " * 60), (9, "naïve café " * 30 + "end\x0cfeed\rback"), (9, "naïve café " * 30 + "end\x0cfeed\rback"),
    (10, " ".join(f"w{i}" for i in range(20_000))), (11, "... \n" * 60), (12, "\n".join(f"- item {i} of a list" for i in range(40))),
    (13, " ".join(str(i) for i in range(100))), (14, "a b  c " * 30), (15, "�" * 5 + " " + " ".join(f"w{i}" for i in range(80))),
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    places = {p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("text", "doc_id", "1 as words", "2 as lines", "3 as n_words")


def test_measures_equal_plain_ones(docs):
    got = sorted((tuple(r[m] for m in quality.MEASURES), r.base_failed) for r in quality.judge(docs).collect())
    want = []
    for _, text in ROWS:
        m = plain(text)
        want.append((m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert got == sorted(want)


def test_order_never_changes_the_verdict(docs):
    rows = quality.measured(docs)
    kept = [
        sorted(str(r) for r in rows.select("doc_id", "text", quality.cascade(list(rules)).isNull().alias("kept")).collect())
        for rules in (quality.RULES, quality.RULES[::-1])]
    assert kept[0] == kept[1]
    judged = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert judged[10].kept and judged[10].first_failed is None
    assert not judged[12].kept and not judged[13].kept and not judged[15].kept


def test_rules_are_ordered_by_rejections_per_second(docs):
    order = quality.ordered_rules(quality.measured(docs))
    assert {rule.name for rule, _, _ in order} == {rule.name for rule in quality.RULES}
    ranks = [share / seconds for _, seconds, share in order]
    assert ranks == sorted(ranks, reverse=True)


def test_sql_gives_the_same(spark, tmp_path, docs):
    (docs.select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "documents.parquet")))
    con = connect("/nowhere")
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, str(tmp_path), QUERIES["op4_quality_rules"], SQL["op4_quality_rules"]) is None
    assert compare(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", QUERIES["op4_quality_rules"], SQL["op4_quality_rules"]) is None


def test_empty_table(docs):
    assert quality.judge(docs.where(F.lit(False))).collect() == []
