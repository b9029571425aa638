"""Periodic runs against a search of every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm import periodic
from riskweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(6, 4 * q) and not any(words[at:at + length - p] == words[at + p:at + length] for p in range(1, q)):
                out.append((at, length, q))
            at = end + 1 if end > at else at + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_transform_gives_exact_cyclic_products():
    rng = np.random.default_rng(5)
    for size in (1, 2, 4, 16, 64):
        a, b = rng.integers(0, periodic.PRIME, (2, 3, 2 * size))
        want = [[sum(int(x[i]) * int(y[(k - i) % len(x)]) for i in range(len(x))) % periodic.PRIME for k in range(len(x))] for x, y in zip(a, b, strict=True)]
        assert periodic._cyclic(a, b).tolist() == want


def test_mismatches_are_sums_of_squared_differences():
    ids = np.random.default_rng(6).integers(0, 7, 300)
    for size in (1, 2, 8, 32):
        starts = np.arange(0, 300 - 3 * size, size)
        got = periodic.mismatches(ids, starts, size)
        for row, s in zip(got, starts, strict=True):
            assert row.tolist() == [int(((ids[s:s + size] - ids[s + d:s + d + size]) ** 2).sum()) for d in range(size, 2 * size)]


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 60)), max_size=8))
@settings(max_examples=300, deadline=None)
def test_every_run_is_found(pieces):
    words = [w for root, length in pieces for w in (root * 60)[:length]]
    assert periodic.find_runs(np.array(words, np.int64)) == plain_runs(words)


def test_fibonacci_words_and_long_periods():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    rng = random.Random(2)
    root = [rng.randrange(9) for _ in range(400)]
    for words in (b[:900], root * 5, root + root[:7] * 99, [0] * 700 + [1] + [0] * 800):
        assert periodic.find_runs(np.array(words, np.int64)) == plain_runs(words)


def test_runs_do_not_cross_texts():
    texts = [[b"a"] * 5, [b"a"] * 5, [], [b"b", b"c"] * 4]
    got = [(n, [tuple(r.values()) for r in runs], text) for n, runs, text in periodic._described(texts)]
    assert got == [(5, [], "a a a a a"), (5, [], "a a a a a"), (0, [], ""), (8, [(0, 8, 2)], "b c")]


ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "x x x x x x x"), (4, "a b a b a b a b"), (4, "a b a b a b a b"), (5, "very " * 50_000),
       (6, "ä ä  ä ä ä ä ä"), (7, "k l m " * 20_000 + "end"), (8, "same same same same same")]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("1 as runs", "doc_id", "text", "2 as collapsed", "'n' as n_words", "3 as start")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs).collect()), key=str)
    want = []
    for i, text in ODD:
        words = WORD.findall(text or "")
        runs = plain_runs(words) if len(words) < 1000 else [(0, 50_000, 1)] if i == 5 else [(0, 60_000, 3)]
        want.append((i, len(words), runs, plain_collapsed(words, runs)))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_table(spark):
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = WORD.findall(r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((r.doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()))
    got = QUERIES["op13_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(w[1] for w in want) > 10
