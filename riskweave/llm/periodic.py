"""Runs of repeated words, found by block convolutions.

A run is a maximal stretch of words that repeats with its smallest period ``q`` and is at least
``EXPONENT`` periods and ``SHORTEST`` words long. At the scale ``L``, a power of two, the words are
cut into blocks of ``L``. The sum of squared differences between a block and what lies ``d`` words
after it, for all ``d`` in ``[L, 2L)`` at once, is an exact integer convolution modulo a prime
(number-theoretic transforms of all blocks together); where it is zero the block occurs again, and
``d`` is the seed of a run that is then extended word by word to both sides.

Why no run is missed: a run of period ``q`` in ``[L, 2L)`` starts less than ``L`` words before some
block, and that block and its copy ``q`` words on end within ``L - 1 + L + q < 4q`` words. All words
of such a block return within ``q`` words, so blocks with a word that does not return within ``2L``
are left out before the transform. Blocks whose whole window lies inside a run already found
at a smaller scale are left out too: by the periodicity lemma they can only show multiples of its
period. A zero modulo the prime that is no true zero fails the extension.

Odd rows: null and empty texts have no words and no runs. A text of any length is one unit of work;
short ones are handled many at a time. Repeated rows stay repeated, null ids stay, and only the id
and the text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.common import arrow_schema, id_text

#: Least number of periods and of words in a run.
EXPONENT, SHORTEST = 4, 6
#: Words handled together, unless one text has more.
TOGETHER = 1 << 18
#: Entries of one transform; more blocks are taken in turns.
TRANSFORM = 1 << 20

# A prime of the form k * 2**27 + 1 and a generator of its multiplicative group. Products fit 63
# bits, and transforms of 2**27 entries serve texts of half a billion words, more than one Arrow value holds.
PRIME, GENERATOR, TWOS = 2_013_265_921, 31, 27

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers of a primitive root of unity of order ``size``, the first half of them."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(max(1, size // 2), np.int64)
    have, step = 1, root
    while have < len(out):  # doubling: out[have:2 * have] = out[:have] * root ** have
        out[have:2 * have] = out[:have] * step % PRIME
        have, step = 2 * have, step * step % PRIME
    return out


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row; lengths are powers of two up to ``2**TWOS``."""
    count, size = rows.shape
    if size > 1 << TWOS:
        raise ValueError("too long for this prime")
    # the length halves while the number of interleaved sub-transforms doubles, so no reordering is needed
    x = rows.reshape(count, size, 1) % PRIME
    length, roots = size, _roots(size, inverse)
    while length > 1:
        half = length // 2
        low, high = x[:, :half], x[:, half:]
        turned = (low - high) % PRIME * roots[:: size // length][:half, None] % PRIME
        x = np.concatenate([(low + high) % PRIME, turned], axis=2)
        length = half
    out = x.reshape(count, size)
    return out * pow(size, PRIME - 2, PRIME) % PRIME if inverse else out


def _places(size: int) -> np.ndarray:
    """Index of each frequency in the result of ``transform``."""
    order = np.zeros(1, np.int64)
    step = 1
    while len(order) < size:
        order = np.concatenate([order, order + step])
        step *= 2
    return order


def mismatches(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Sums of squared differences modulo the prime, a row for each block start, a column for each distance ``size .. 2 size - 1``."""
    at = starts[:, None] + np.arange(size)
    block = ids[at] % PRIME
    there = starts[:, None] + size + np.arange(2 * size)
    window = np.where(there < len(ids), ids[np.minimum(there, len(ids) - 1)], 0) % PRIME
    padded = np.zeros((len(starts), 2 * size), np.int64)
    padded[:, 0] = block[:, 0]
    padded[:, size + 1:] = block[:, :0:-1]  # reversed: the cyclic product then is a correlation
    product = _cyclic(padded, window)[:, :size]
    squares = np.zeros((len(starts), 2 * size + 1), np.int64)
    np.cumsum(window * window % PRIME, axis=1, out=squares[:, 1:])
    return ((block * block % PRIME).sum(1)[:, None] + squares[:, size:2 * size] - squares[:, :size] - 2 * product) % PRIME


def _cyclic(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cyclic convolution of the rows."""
    size = a.shape[1]
    spectrum = transform(a) * transform(b) % PRIME
    ordered = np.empty_like(spectrum)
    ordered[:, _places(size)] = spectrum
    result = transform(ordered, inverse=True)
    out = np.empty_like(result)
    out[:, _places(size)] = result
    return out


def _agree(ids: np.ndarray, at: int, d: int, step: int) -> int:
    """How many words from ``at`` on, to the right or the left, equal the word ``d`` places later."""
    done, chunk = 0, 64
    while True:
        if step > 0:
            low, high = at + done, min(at + done + chunk, len(ids) - d)
        else:
            low, high = max(at - done - chunk + 1, 0), at - done + 1
        if high <= low:
            return done
        same = ids[low:high] == ids[low + d:high + d]
        if not same.all():
            return done + int(np.argmin(same) if step > 0 else np.argmin(same[::-1]))
        done, chunk = done + high - low, min(2 * chunk, 1 << 16)


def _factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] * (n > 1)


def _is_smallest(ids: np.ndarray, start: int, d: int) -> bool:
    """Whether the word sequence of a run's period is no power of a shorter one."""
    return all(not np.array_equal(ids[start:start + d], ids[start + d // f:start + d // f + d]) for f in _factors(d))


def _seeds(ids: np.ndarray, blocks: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Block starts and distances at which blocks occur again, checked a little ahead."""
    turn = max(1, TRANSFORM // (2 * size))
    for i in range(0, len(blocks), turn):
        part = blocks[i:i + turn]
        row, lag = np.nonzero(mismatches(ids, part, size) == 0)
        at, d = part[row], lag + size
        whole = at + d + size <= len(ids)
        at, d = at[whole], d[whole]
        # from the first block of a run on, at least 3 d - size + 1 words return after d: a few of them sort out most chance
        for ahead in range(min(2 * size, 64)):
            there = at + ahead + d
            fine = there < len(ids)
            fine[fine] = ids[at[fine] + ahead] == ids[there[fine]]
            at, d = at[fine], d[fine]
        yield at, d


def _inside(known: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether one of the known stretches, sorted by start, holds each ``[start, end)``."""
    if not len(known):
        return np.zeros(len(starts), bool)
    furthest = np.maximum.accumulate(known[:, 1])
    k = np.searchsorted(known[:, 0], starts, side="right") - 1
    return (k >= 0) & (furthest[np.maximum(k, 0)] >= ends)


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in a sequence of word numbers, by start and period.

    Numbers are non-negative; equal words have equal numbers.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    back = np.full(n, n, np.int64)  # distance to the next equal word
    same = ids[order[1:]] == ids[order[:-1]]
    back[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found: set[tuple[int, int, int]] = set()  # also those below SHORTEST, which hide no other run
    size, worst = 1, back
    while len(worst) and EXPONENT * size <= n:
        blocks = np.flatnonzero(worst < 2 * size) * size
        known = np.array(sorted((s, s + length) for s, length, _ in found), np.int64).reshape(-1, 2)
        blocks = blocks[~_inside(known, blocks, blocks + 3 * size)]  # they could only show multiples of the run's period
        if len(blocks):
            pairs = []
            for at, d in _seeds(ids, blocks, size):
                fresh = ~_inside(known, at, at + d + size)
                pairs += [(at[fresh], d[fresh])] if fresh.any() else []
            at = np.concatenate([a for a, _ in pairs]) if pairs else np.zeros(0, np.int64)
            d = np.concatenate([b for _, b in pairs]) if pairs else at
            by_distance = np.lexsort((at, d))
            at, d = at[by_distance], d[by_distance]
            cuts = np.flatnonzero(np.diff(d, prepend=-1, append=-1))
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                places, period, i = at[low:high], int(d[low]), 0
                while i < len(places):
                    here = int(places[i])
                    left, right = _agree(ids, here - 1, period, -1), _agree(ids, here, period, 1)
                    start, length = here - left, left + right + period
                    if length >= EXPONENT * period and _is_smallest(ids, start, period):
                        found.add((start, length, period))
                    i = int(np.searchsorted(places, here + max(right, 1)))
        size *= 2
        whole = len(worst) // 2 * 2
        worst = worst[:whole].reshape(-1, 2).max(1)
    return sorted((s, length, q) for s, length, q in found if length >= SHORTEST)


def _described(texts: list[list[bytes]]) -> Iterator[tuple[int, list[dict], str]]:
    """Number of words, runs and collapsed text of each list of words; all are searched as one sequence."""
    words = [w for text in texts for w in text]
    codes = pd.factorize(np.array(words, object))[0].astype(np.int64) if words else np.zeros(0, np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(sizes + 1) - sizes - 1  # a number of its own after each text: no run crosses it
    ids = np.empty(len(words) + len(texts), np.int64)
    own = firsts + sizes
    is_word = np.ones(len(ids), bool)
    is_word[own] = False
    ids[is_word] = codes
    ids[own] = len(words) + np.arange(len(texts))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = find_runs(ids)
    for (start, length, period), k in zip(found, np.searchsorted(firsts, [r[0] for r in found], side="right") - 1 if found else (), strict=True):
        runs[k].append((start - int(firsts[k]), length, period))
    for text, own_runs in zip(texts, runs, strict=True):
        kept = text
        if own_runs:
            change = np.zeros(len(text) + 1, np.int64)
            for start, length, period in own_runs:
                change[start + period] += 1
                change[start + length] -= 1
            kept = [w for w, covered in zip(text, np.cumsum(change[:-1]).tolist(), strict=True) if not covered]
        yield len(text), [{"start": s, "length": n, "period": q} for s, n, q in own_runs], b" ".join(kept).decode()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    Words are what stands between ASCII white space, numbered from 0. ``runs`` lists ``start, length,
    period`` by start, then period. ``collapsed`` holds the words, joined by one space, that no run
    covers after its first period.
    """
    schema = arrow_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            counts, runs, collapsed = zip(*_described(texts), strict=True)
            columns = [pa.array(v, f.type) for v, f in zip((ids, counts, runs, collapsed), schema, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            ids: list = []
            texts: list[list[bytes]] = []
            held = 0
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                # bytes.split() cuts at ASCII white space only
                words = (text.as_py() or "").encode().split()
                if texts and held + len(words) > TOGETHER:
                    yield made(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(key.as_py())
                texts.append(words)
                held += len(words)
            if texts:
                yield made(ids, texts)

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
