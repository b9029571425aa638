"""Source divergence against a plain re-computation over every kept term."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from riskweave.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in docs[lang].items() if n >= 3), key=lambda t: t.encode())
        sources = sorted(s for g, s in groups if g == lang)

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 1) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("1 as term", "*", "2 as count", "3 as p", "4 as item", "'v' as value")
    return sorted(map(tuple, divergence.audit(docs).collect()))


ODD = [(None, None, None), ("", "en", ""), ("A a É é _ a-b", "en", "x"), ("a É b9c", "en", "y"), ("É a B", "en", "x"), ("É a B", "en", "x"), (None, "en", "z"),
       ("only here", "de", "x"), ("Only here", "de", None), ("1 2 3", "de", "y"), ("here only 日本語", None, "x"), ("w" * 70_000 + " here", "de", "x")]


def test_odd_rows(spark):
    assert found(spark, ODD) == plain(ODD)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_ties_and_more_terms_than_ranks(spark):
    rng = random.Random(4)
    rows = [(" ".join(f"t{''.join(chr(97 + int(c)) for c in str(rng.randrange(900)))}" for _ in range(rng.randrange(200))), "en", f"s{rng.choice('0001234567')}") for _ in range(150)]
    want = plain(rows)
    assert max(r[5] for r in want) == 200
    assert found(spark, rows) == want


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_runs_do_not_depend_on_the_block_size(spark, monkeypatch, block):
    """Each run is sorted, and the merged shard is the same however often memory was full."""
    batch = pa.RecordBatch.from_pydict({"lang": [l or "" for _, l, _ in ODD], "source": [s or "" for _, _, s in ODD], "text": [t or "" for t, _, _ in ODD]})
    whole = sorted(_table(divergence._runs(iter([batch]))))
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "PIECE", 5)
    runs = list(divergence._runs(iter([batch.slice(i, 1) for i in range(len(ODD))])))
    for run in runs:
        keys = [(r["lang"], r["term"].encode(), r["source"]) for r in run.to_pylist()]
        assert keys == sorted(keys)
    rows = sorted((r for run in runs for r in run.to_pylist()), key=lambda r: (r["lang"], r["term"].encode()))
    sums = Counter()
    for r in rows:
        sums[r["lang"], r["term"], r["source"], "count"] += r["count"]
        sums[r["lang"], r["term"], r["source"], "docs"] += r["docs"]
    assert sorted((*k, sums[(*k, "count")], sums[(*k, "docs")]) for k in {x[:3] for x in sums}) == whole
    merged = [sorted(_table(divergence._merged(iter([pa.RecordBatch.from_pylist(rows[i:i + n], divergence.RUNS) for i in range(0, len(rows), n)])))) for n in (1, 3, 1000)]
    assert merged[0] == merged[1] == merged[2] and merged[0]


def _table(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]
