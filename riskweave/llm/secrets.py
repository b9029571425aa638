"""Secrets: fixed forms, and tokens that look drawn at random.

A token of at least ``MIN_LENGTH`` characters with letters and digits is put under the narrowest
encoding that covers it (hexadecimal, base 32, base 62, base 64). Three tests ask whether it
fits a uniform draw from that alphabet: chi-squared on symbol counts, runs above and below the
middle symbol, and lag-one serial correlation. A token that fails one is not random.

The other question, whether ordinary text could look like that, has a probability too. Text is taken
as a walk over kinds of symbols (lower and upper case, digits, others), its letters by the letter
before. Under that law a token is R times as likely from a uniform draw with probability 1/R at most,
whatever its length (Markov's bound, times the number of alphabets). Beside it, the number of equal
symbol pairs under letter frequencies of prose has a known mean and variance; the smaller one counts,
doubled. These probabilities shrink with length, so tokens are judged within bands of encoding and length, and in
each band the Benjamini-Hochberg step over *all* tokens of the corpus sets the cut. Only counts per
band and bin reach the driver: a fixed number of cells at any corpus size.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SLICE, id_text, map_texts
from riskweave.session import materialize

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
RANK = {kind: i for i, kind in enumerate(KINDS)}
MIN_LENGTH = 20
#: A uniform draw fails a test of the battery this rarely.
REJECT = 0.001
#: Expected share of ordinary tokens among those reported.
FALSE_SHARE = 0.01
#: -log10 of the text probability is kept in steps of a quarter, to 40.
BINS, STEPS = 160, 4

ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
# An equals sign cuts (name=value), except as padding at the end.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:=+(?![A-Za-z0-9+/_=-]))?" % (MIN_LENGTH - 2))

# Letter frequencies of English prose in per mille, a to z.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
# How often a letter (column) follows a letter (row) in words of mixed languages, in halvings of one.
FOLLOWS = (
    "67565996499682599442387999", "99991999999199499999999949", "99999991299999499999999999", "45991995399695299554696999",
    "37744996499582589235688997", "46793975697697179253778997", "35791974597595489644776997", "26891985498695489654886998",
    "68493997799771398743989999", "09999999999999999999999999", "99990999999999999999999999", "39891999499399699989999929",
    "89990999299999899999999999", "45633935598585488552776998", "79898399599961899358299999", "19999199799999499999999999",
    "99999999999999999999099999", "45791975598685489454776998", "57374972589676597661697999", "57994991299796499565997995",
    "56792786598672567565877398", "99991999199999399999999999", "39999990399999899999999999", "39492999599549354393949999",
    "45992994499594399543995999", "55574967676669877755179997")
# Share of pairs of letters that follow no such rule (names, abbreviations, other languages).
UNRULED = 0.1
# Kinds of symbols that follow a kind in ordinary tokens: lower, upper, digit, other.
STEP = {"start": (0.55, 0.25, 0.15, 0.05), "lower": (0.84, 0.07, 0.03, 0.06), "upper": (0.45, 0.45, 0.04, 0.06), "digit": (0.10, 0.08, 0.70, 0.12), "other": (0.55, 0.22, 0.20, 0.03)}
# Share of digits that the text law grants to a token of letters and digits.
DIGIT_SHARE = 0.2

LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Narrowest first.
ALPHABETS = {"hex": DIGIT + LOWER[:6], "HEX": DIGIT + UPPER[:6], "base32": UPPER + DIGIT[2:8], "base36": DIGIT + LOWER, "base62": DIGIT + LOWER + UPPER, "base64": DIGIT + LOWER + UPPER + "+/-_"}


def _text_law(alphabet: str) -> tuple[float, float]:
    """Chance that two (three) symbols of ordinary text agree in this alphabet."""
    weight = []
    for c in alphabet:
        if c in DIGIT:
            weight.append(DIGIT_SHARE / 10)
        elif c.lower() in LOWER:
            both = LOWER[0] in alphabet and UPPER[0] in alphabet
            weight.append((1 - DIGIT_SHARE) * LETTERS[LOWER.index(c.lower())] / 1000 * ((0.95 if c in LOWER else 0.05) if both else 1))
        else:
            weight.append(0.01)
    total = sum(weight)
    return sum((w / total) ** 2 for w in weight), sum((w / total) ** 3 for w in weight)


LAWS = {name: _text_law(alphabet) for name, alphabet in ALPHABETS.items()}


def _kind(c: str) -> str:
    return "lower" if c in LOWER else "upper" if c in UPPER else "digit" if c in DIGIT else "other"


def _walk_law() -> dict[str, float]:
    """log10 of the chance of a symbol after a symbol (keys of two) or at the start (of one)."""
    symbols = ALPHABETS["base64"]
    kinds = list(STEP)[1:]
    first = [x / sum(LETTERS) for x in LETTERS]
    law = {}
    for a in ["", *symbols]:
        after = first
        if a and a.lower() in LOWER:
            row = [2.0 ** -int(x) for x in FOLLOWS[LOWER.index(a.lower())]]
            after = [UNRULED / 26 + (1 - UNRULED) * x / sum(row) for x in row]
        step = STEP[_kind(a) if a else "start"]
        for b in symbols:
            kind = _kind(b)
            within = after[LOWER.index(b.lower())] if kind in ("lower", "upper") else 1 / 10 if kind == "digit" else 1 / 4
            law[a + b] = math.log10(step[kinds.index(kind)] * within)
    return law


WALK = _walk_law()


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_upper(x: float, df: int) -> float:
    """Upper tail of chi-squared by the Wilson-Hilferty cube root."""
    z = ((x / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df))
    return _upper_normal(z)


def infer_encoding(token: str) -> str | None:
    """Narrowest alphabet of a token with a letter and a digit, else None."""
    symbols = set(token.rstrip("="))
    if not any(c in symbols for c in DIGIT) or not any(c in symbols for c in LOWER + UPPER):
        return None
    return next((name for name, alphabet in ALPHABETS.items() if symbols <= set(alphabet)), None)


def randomness(token: str, encoding: str) -> tuple[float, float]:
    """(probability under a uniform draw, -log10 of the probability under ordinary text)."""
    alphabet = ALPHABETS[encoding]
    token = token.rstrip("=")
    n, k = len(token), len(alphabet)
    counts = Counter(token).values()
    squares = sum(c * c for c in counts)
    uniform = _chi_upper(max(k / n * squares - n, 1e-9), k - 1)
    codes = [alphabet.index(c) for c in token]
    # runs above and below the middle symbol
    high = [2 * c >= k for c in codes]
    a = sum(high)
    b = n - a
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    if a and b:
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        run = 2 * _upper_normal(abs(runs - mean) / math.sqrt(var))
    else:
        run = 0.0
    # lag-one correlation
    middle = sum(codes) / n
    spread = sum((c - middle) ** 2 for c in codes)
    r = sum((x - middle) * (y - middle) for x, y in zip(codes, codes[1:])) / spread if spread else 1.0
    serial = 2 * _upper_normal(abs(r + 1 / n) * math.sqrt(n))
    fits = min(1.0, 3 * min(uniform, run, serial))
    # pairs of equal symbols under the text law
    s2, s3 = LAWS[encoding]
    pairs = n * (n - 1) / 2
    var = pairs * (s2 - s2 * s2 + 2 * (n - 2) * (s3 - s2 * s2))
    z = ((squares - n) / 2 - pairs * s2) / math.sqrt(var)
    text = _upper_normal(-z)
    return fits, min(BINS / STEPS, max(0.0, max(-math.log10(max(text, 1e-300)), walk_odds(token, k)) - math.log10(2)))


def walk_odds(token: str, symbols: int) -> float:
    """-log10 of a bound on the probability that text is as likely a uniform draw as this token."""
    text = WALK[token[0]] + sum(WALK[a + b] for a, b in zip(token, token[1:]))
    return -len(token) * math.log10(symbols) - text - math.log10(len(ALPHABETS))


def length_band(n: int) -> int:
    """Bands by half powers of two, the last one open."""
    return min(15, int(2 * math.log2(n / MIN_LENGTH)))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], RANK[s[2]]))


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[dict]:
    """Tokens under test: outside base spans, judged by the battery."""
    out, i = [], 0
    by_end = sorted(base, key=lambda s: s[1])
    for m in TOKEN.finditer(text):
        if m.end() - m.start() < MIN_LENGTH:
            continue
        encoding = infer_encoding(m[0])
        if encoding is None:
            continue
        while i < len(by_end) and by_end[i][1] <= m.start():
            i += 1
        if any(s < m.end() for s, _, _ in by_end[i:i + 8]):
            continue  # a base span holds or touches it already
        fits, odds = randomness(m[0], encoding)
        out.append({"start": m.start(), "end": m.end(), "band": f"{encoding}/{length_band(m.end() - m.start())}", "fits": fits, "bin": int(odds * STEPS)})
    return out


def battery(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, tokens``: base spans and the tokens under test with their probabilities."""

    def start():
        def work(text):
            base = base_spans(text)
            return [{"start": a, "end": b, "kind": k} for a, b, k in base], candidates(text, base)

        return work

    return map_texts(id_text(docs, id_col, text_col), start, "doc_id long, base array<struct<start:int,end:int,kind:string>>, tokens array<struct<start:int,end:int,band:string,fits:double,bin:int>>")


def discovery_cuts(tested: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, int]:
    """Lowest bin accepted in each band, by the Benjamini-Hochberg step over all tokens."""
    cells = tested.select(F.explode("tokens").alias("t")).groupBy("t.band", "t.bin").count().collect()  # at most 96 bands x 161 bins
    by_band: dict[str, list[tuple[int, int]]] = {}
    for band, at, count in cells:
        by_band.setdefault(band, []).append((at, count))
    cuts = {}
    for band, found in by_band.items():
        total, upto = sum(c for _, c in found), 0
        for at, count in sorted(found, reverse=True):
            upto += count
            if total * 10 ** (-at / STEPS) <= false_share * upto:  # the weakest probability in the bin
                cuts[band] = at
    return cuts


def accepted(text: str, cuts: dict[str, int]) -> list[tuple[int, int]]:
    """Ranges of all secrets of a text, under cuts that are known."""
    base = base_spans(text)
    found = [(a, b) for a, b, _ in base]
    found += [(t["start"], t["end"]) for t in candidates(text, base) if t["fits"] >= REJECT and t["bin"] >= cuts.get(t["band"], BINS + 1)]
    return sorted(found)


def redacted(docs: DataFrame, mark: str = "[secret]", false_share: float = FALSE_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with every secret in the text replaced by ``mark``; null texts stay null.

    Two passes over the texts, the first for the cuts; no text is shuffled. Overlapping secrets
    become one mark.
    """
    cuts = discovery_cuts(materialize(battery(docs, id_col, text_col).select("tokens"), "battery"), false_share)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts = [None if t is None else blanked(t, accepted(t, cuts), mark) for t in part.column(at).to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array(texts, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def blanked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, false_share: float = FALSE_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: ``(kind, start, end)`` by start and kind, in code points, ends exclusive.

    Null and empty texts have no spans; every input row gives one row. The texts are read once: base
    spans and tested tokens are written to the shared scratch area, the cuts come from there.
    """
    tested = materialize(battery(docs, id_col, text_col), "battery")
    cuts = discovery_cuts(tested, false_share)
    accepted = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    if cuts:
        cut = F.create_map(*[F.lit(x) for pair in sorted(cuts.items()) for x in pair])
        passed = F.filter("tokens", lambda t: (t.fits >= REJECT) & F.coalesce(t.bin >= cut[t.band], F.lit(False)))
        accepted = F.transform(passed, lambda t: F.struct(t.start.alias("start"), t.end.alias("end"), F.lit("random").alias("kind")))
    rank = {kind: F.lit(i) for kind, i in RANK.items()}
    order = F.create_map(*[x for kind, i in rank.items() for x in (F.lit(kind), i)])
    keyed = F.transform(F.concat("base", accepted), lambda s: F.struct(s.start.alias("start"), order[s.kind].alias("rank"), s.end.alias("end"), s.kind.alias("kind")))
    return tested.select("doc_id", F.transform(F.array_sort(keyed), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"))).alias("spans"))
