"""Toxicity by compression distance to two zstandard dictionaries.

One dictionary is trained on toxic text, one on ordinary text. A window that shares strings with a
dictionary gets shorter under it than under a neutral one of the same size. Every window starts with
a marker that all dictionaries hold, so the fixed cost of a compressed block is the same and a
single shared word shows. A document is described by its window gains; a logistic model puts the
thresholds on them.

Labels stand for whole documents, and most of a toxic document is ordinary text. What is toxic in
it is found first: byte strings of ``GRAM`` bytes that occur in far more toxic than ordinary
documents mark the spans the toxic dictionary is trained on.

Fitting uses a bounded sample of labelled rows (``TOXIC_ROWS`` and ``ORDINARY_ROWS``, the rows with
the smallest hashes); scoring covers all rows and whole texts. Null and empty texts are one empty
window and get the score the model gives to no gain. Without labels of both kinds every score is
the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import id_text, map_texts

WINDOW, STRIDE = 32, 16
GRAM = 5
#: Bounds of the labelled sample that fits the model.
TOXIC_ROWS, ORDINARY_ROWS = 2_000, 4_000
DICTIONARY_BYTES = 1024
#: A marking string occurs in this share of toxic documents and this many times more often there.
LEAST_SHARE, LEAST_LIFT = 0.02, 8
MARKER = bytes(range(24))
LEVEL, MIN_MATCH = 3, 5
STEPS = (3, 4, 5, 6, 8)


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    constant: float | None


def _grams(text: bytes) -> np.ndarray:
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    if len(a) < GRAM:
        return np.empty(0, np.uint64)
    g = a[:len(a) - GRAM + 1].copy()
    for k in range(1, GRAM):
        g = g << np.uint64(8) | a[k:len(a) - GRAM + 1 + k]
    return g


def _documents_with(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.unique(_grams(t)) for t in texts]
    return np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint64), return_counts=True)


def marking_grams(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    grams, found = _documents_with(toxic)
    others, elsewhere = _documents_with(ordinary)
    at = np.minimum(np.searchsorted(others, grams), max(len(others) - 1, 0))
    there = np.where(others[at] == grams, elsewhere[at], 0) if len(others) else np.zeros(len(grams), int)
    lift = (found / len(toxic)) / ((there + 1) / len(ordinary))
    return grams[(found >= max(4, LEAST_SHARE * len(toxic))) & (lift > LEAST_LIFT)]


def marked_spans(text: bytes, marks: np.ndarray) -> bytes:
    """Words, or parts of words, that marking strings cover, each after a space."""
    hits = np.flatnonzero(np.isin(_grams(text), marks))
    out, i = [], 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] <= hits[j] + GRAM:
            j += 1
        out += [b" " + word for word in text[hits[i]:hits[j] + GRAM].split() if len(word) >= GRAM - 1]
        i = j + 1
    return b"".join(out)


def _trained(samples: list[bytes]) -> bytes:
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=16, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the samples themselves
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_checksum=0, write_content_size=0, write_dict_id=0, min_match=MIN_MATCH)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(MARKER + content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings)


class Describer:
    """Window gains of texts, summed up per text."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        neutral = bytes(range(128, 256)) * (DICTIONARY_BYTES // 128)
        self.neutral, self.toxic, self.ordinary = (_compressor(x).compress for x in (neutral, toxic, ordinary))

    def describe(self, text: str) -> list[float]:
        data = text.encode().lower()
        neutral, toxic, ordinary = self.neutral, self.toxic, self.ordinary
        windows = [MARKER + data[i:i + WINDOW] for i in range(0, max(1, len(data) - WINDOW + STRIDE), STRIDE)]
        plain = np.array([len(neutral(w)) for w in windows])
        gain = plain - np.array([len(toxic(w)) for w in windows])
        apart = gain - (plain - np.array([len(ordinary(w)) for w in windows]))
        top = np.sort(gain)[-3:]
        return [float(x) for x in (gain.max(), top.mean(), gain.mean(), apart.max(), apart.mean(), *(math.log1p((gain >= s).sum()) for s in STEPS), *((gain >= s).mean() for s in STEPS))]


def _logistic(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (sample_weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (sample_weight * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> Model:
    """Fit on labelled rows. ``docs`` has ``doc_id, text``, ``labels`` has ``doc_id, toxic``.

    Of several labels of a document the highest counts; null labels do not. The driver holds
    at most ``toxic_rows + ordinary_rows`` texts.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    sizes = dict(known.groupBy("toxic").count().collect())
    n_toxic, n_ordinary = sizes.get(True, 0), sizes.get(False, 0)
    empty = Model(b"", b"", (), (), (), n_toxic / max(1, n_toxic + n_ordinary))
    if not n_toxic or not n_ordinary:
        return empty
    picked = [row for kind, limit in ((True, toxic_rows), (False, ordinary_rows)) for row in known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()]
    chosen = docs.sparkSession.createDataFrame(picked, known.schema)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    toxic = [r.text.encode().lower() for r in sample if r.toxic]
    ordinary = [r.text.encode().lower() for r in sample if not r.toxic]
    if not toxic or not ordinary:
        return empty
    marks = marking_grams(toxic, ordinary)
    toxic_dictionary = _trained([marked_spans(t, marks) for t in toxic])
    ordinary_dictionary = _trained([t[i:i + 4 * WINDOW] for t in ordinary[:1000] for i in range(0, len(t), 16 * WINDOW)])

    rows = docs.sparkSession.createDataFrame([(r.doc_id, r.text) for r in sample], "doc_id long, text string").repartition(16)
    described = dict(describe(rows, toxic_dictionary, ordinary_dictionary).collect())
    x = np.array([described[r.doc_id] for r in sample])
    y = np.array([float(r.toxic) for r in sample])
    centre, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1
    share = n_toxic / (n_toxic + n_ordinary)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = _logistic((x - centre) / scale, y, weight)
    return Model(toxic_dictionary, ordinary_dictionary, tuple(centre), tuple(scale), tuple(w), None)


def describe(docs: DataFrame, toxic: bytes, ordinary: bytes) -> DataFrame:
    """``doc_id, gains``: what the model sees of a text."""

    def start():
        describer = Describer(toxic, ordinary)
        return lambda text: (describer.describe(text),)

    return map_texts(id_text(docs), start, "doc_id long, gains array<double>")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: probability that a text is toxic, for every row."""

    def start():
        if model.constant is not None:
            return lambda text: (model.constant,)
        describer = Describer(model.toxic, model.ordinary)
        centre, scale, weights = np.array(model.centre), np.array(model.scale), np.array(model.weights)

        def work(text):
            z = weights[0] + ((np.array(describer.describe(text)) - centre) / scale) @ weights[1:]
            return (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))),)

        return work

    return map_texts(id_text(docs, id_col, text_col), start, "doc_id long, score double")
