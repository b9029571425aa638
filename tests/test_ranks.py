"""Exact order statistics of many groups and ranks at once."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from riskweave.operators import ranking

HARD = {
    "spread": [s * 10.0 ** e for e in range(-300, 301, 40) for s in (-1, 1)] + [0.0, 5e-324, -5e-324],
    "ends": [math.inf, -math.inf, 1.7e308, -1.7e308, 0.0, 1.0, math.inf],
    "same": [3.5] * 40,
    "close": [1.0, 1.0000000000000002, 1.0000000000000004, 0.9999999999999999] * 5,
}


@pytest.mark.parametrize("name", HARD)
def test_every_rank_of_hard_values(spark, name):
    values = HARD[name]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ks = sorted(random.Random(1).sample(range(len(values)), min(len(values), 25)))
    assert ranking.kth_values(df, "v", ks) == [sorted(values)[k] for k in ks]


def test_whole_numbers_up_to_the_limits(spark):
    big = 2 ** 63 - 1
    values = [-big - 1, big, 0, *range(big - 50, big), *range(2 ** 60, 2 ** 60 + 300)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ks = [0, 1, 2, 150, 151, len(values) - 30, len(values) - 1]
    assert ranking.kth_values(df, "v", ks) == [sorted(values)[k] for k in ks]
    with pytest.raises(ValueError):
        ranking.kth_values(df, "v", [len(values)])


def test_groups_with_their_own_ranks(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(40)) for i in range(900)] + [("c", 900, 7)]
    df = spark.createDataFrame(rows, "g string, id long, v long")
    groups = {g: sorted(v for x, _, v in rows if x == g) for g in ("a", "b", "c", None)}
    wanted = [(g, k) for g, values in groups.items() for k in {0, len(values) // 3, len(values) - 1, len(values)}] + [("none", 0)]
    found = ranking.values_at(df, ["g"], "v", spark.createDataFrame(wanted, "g string, k long"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((g, k, groups[g][k]) for g, k in wanted if g in groups and k < len(groups[g])), key=str)

    takes = {"a": 100, "b": 5000, "c": 0, None: 7}
    got = ranking.smallest_by(df, ["g"], "v", ["id"], spark.createDataFrame(list(takes.items()), "g string, n long")).collect()
    want = []
    for g, n in takes.items():
        own = sorted((v, i) for x, i, v in rows if x == g)
        want += [(g, i, v) for v, i in own[:n]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_several_quantiles_at_once(spark):
    df = spark.createDataFrame([(float(i % 1000),) for i in range(5000)], "v double")
    got = ranking.quantiles(df, "v", [0.85, 0.9, 0.5])
    assert got == pytest.approx(np.percentile([i % 1000 for i in range(5000)], [85, 90, 50]).tolist(), abs=1e-9)
