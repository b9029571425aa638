from __future__ import annotations

import hashlib
import random

import pytest

from riskweave.llm import substrings
from riskweave.llm.queries import QUERIES


def plain(texts, length):
    """Covered bytes of each text, from every string of the table."""
    seen: dict[bytes, int] = {}
    for data in texts:
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for data in texts:
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i:i + length]] > 1:
                covered[i:i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, length, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id", "1 as k1", "2 as data", "3 as start")
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.removal_report(docs, length=length, **settings).collect()]
    want = [(i, *w) for (i, _), w in zip(rows, plain([(t or "").encode() for _, t in rows], length))]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)


def invented(draw, n):
    return "".join(draw.choice("abcdé ") for _ in range(n))


@pytest.mark.parametrize("settings", [{"group": 2_000}, {"group": 1}, {"segment": 64}])
def test_small_strings_equal_plain_search(spark, settings):
    draw = random.Random(7)
    passage = [invented(draw, 60) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [invented(draw, draw.randint(0, 80))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passage)
            a = draw.randint(0, 30)
            parts += [p[a:a + draw.randint(5, 60)], invented(draw, draw.randint(0, 30))]
        rows.append((i, "".join(parts)))
    rows += [(200, "a" * 100), (201, "ab" * 80), (202, rows[3][1]), (203, rows[3][1]), (203, rows[3][1]), (None, rows[5][1]), (204, None), (205, ""), (206, "x")]
    check(spark, rows, 24, trigger=8, **settings)


def test_near_copies_and_a_hot_passage(spark):
    draw = random.Random(9)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(300)]
    base = [draw.choice(words) for _ in range(200)]
    passage = " ".join(draw.choice(words) for _ in range(80))
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(3):
            copy[draw.randrange(200)] = draw.choice(words) + "x"
        rows.append((i, " ".join(copy)))
    for i in range(60, 120):
        rows.append((i, " ".join(draw.choice(words) + str(i) for _ in range(40)) + " " + passage + " " + " ".join(draw.choice(words) + str(i) for _ in range(40))))
    check(spark, rows, 200)
    check(spark, rows, 200, group=10)


def test_crowded_trigger_is_halved_not_written_out(spark):
    """One passage in 300 documents, each cut elsewhere and with its own surroundings."""
    draw = random.Random(21)
    passage = invented(draw, 90)
    rows = [(i, invented(draw, 30) + passage[draw.randint(0, 40):draw.randint(60, 90)] + invented(draw, 30)) for i in range(300)]
    rows += [(400 + i, rows[i][1][:70] + invented(draw, 10)) for i in range(40)]
    for group in (1, 5, 60):
        check(spark, rows, 24, trigger=8, group=group)
    parser_of = substrings._ParserOf(24, 8, substrings.SEGMENT)
    data = [bytes(draw.randrange(256) for _ in range(16)) + passage.encode()[:8] + bytes(draw.randrange(256) for _ in range(16)) for _ in range(500)]
    keyed = [(i, i, 0, n, t, False, True, bytearray(d)) for i, d in enumerate(data)
             for s, n, t in zip(*(x.tolist() for x in (next(parser_of().phrases(d))[:3]))) if s == 0]
    gathered = spark.createDataFrame(keyed, substrings.GATHERED)
    first = substrings._halved(gathered.selectExpr("*", "int(null) low", "int(null) high", "int(null) lead"), parser_of)
    assert first.count() <= 2 * len(keyed)


def test_equal_rows_without_id_share_one_list(spark):
    text = invented(random.Random(3), 400)
    docs = spark.createDataFrame([(None, text)] * 50, "doc_id long, text string")
    spans = substrings.repeated_spans(docs)
    rows = substrings._with_spans(docs, spans, "doc_id", "text").selectExpr("size(spans) n").collect()
    assert len(rows) == 50 and max(r.n for r in rows) <= 400
    assert {(r.n_removed, r.n_spans) for r in substrings.removal_report(docs).collect()} == {(len(text.encode()), 1)}


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_substring_dedup"](spark, sf).collect()}
    assert got == {r.doc_id: w for r, w in zip(texts, plain([r.text.encode() for r in texts], 200))}


def test_ranges_and_empty_tables(spark):
    passage = " ".join(str(i * 7919) for i in range(60))
    docs = spark.createDataFrame([(1, "head " + passage), (2, passage + " tail"), (3, "other")], "doc_id long, text string")
    n = len(passage)
    got = {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in substrings.removed_ranges(docs).collect()}
    assert got == {1: [(5, 5 + n)], 2: [(0, n)]}
    assert substrings.removal_report(docs.where("false")).collect() == []
