"""Ids of texts are handed over as flat arrays, and remembered as bytes."""

from __future__ import annotations

import gc
from array import array

import pyarrow as pa

from riskweave.llm import tokens
from riskweave.llm.common import _column
from riskweave.llm.pieces import Pieces


def test_typed_arrays_become_one_list_column():
    kind = pa.list_(pa.field("element", pa.int32()))
    for values in ([array("H", [1, 65535]), array("H"), array("H", [7])], [array("H")], [array("i", [-1, 70000])], [], [None, array("H", [1])], [[1], [2, 3]]):
        made = _column(values, kind)
        assert made.type == kind and made.to_pylist() == [None if v is None else list(v) for v in values]
    assert _column(["a", None], pa.string()).to_pylist() == ["a", None]


def test_remembered_segments_are_not_walked_for_cycles():
    with open(tokens.MODEL, "rb") as file:
        pieces = Pieces(file.read())
    ids = pieces.encode("two words, zweimal zweimal qqqzzzq")
    assert list(ids) and pieces.decode(ids) == "two words, zweimal zweimal qqqzzzq"
    assert pieces._known and not any(gc.is_tracked(found[0]) for found in pieces._known.values())
    assert pieces.count("two words, zweimal zweimal qqqzzzq")[0] == len(ids)
