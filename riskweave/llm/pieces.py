"""SentencePiece vocabularies: segmentation by dynamic programming over Aho-Corasick matches.

A text is normalised as the model file says (identity: a dummy prefix, spaces as U+2581) and cut
where no vocabulary piece can cross (a U+2581 after another character). There every path meets, so
a segment is solved alone and its solution may be remembered. Inside a segment a best entry is kept
per position, and the open window reaches back one longest piece only.

Two selection rules share the same matches:

* ``unigram``: highest sum of scores; among equal sums the earliest start of the last piece (the
  first one reached) stays, as in the public library. A character that no single piece covers costs
  the lowest score less 10 as unknown.
* ``bpe``: exactly one piece that ends at a position continues the merge result of the text before
  it: the one whose pair with the preceding piece no merge would ever join. The merge order is
  score, then leftmost.

Scores are summed as doubles; the public library keeps 32-bit sums, so beyond 2^24 its unigram ties
may fall differently on long texts.
"""

from __future__ import annotations

import gc
import re
from array import array

import ahocorasick

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the public library
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
REMEMBERED = 300_000
LONG_SEGMENT = 64
#: Objects that a Python worker makes before they are searched for cycles; remembered segments hold none.
COLLECT_EVERY = 200_000


class Pieces:
    """A vocabulary read from the bytes of a model file."""

    def __init__(self, model: bytes, rule: str | None = None):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only identity normalisation with spaces as prefixes is supported")
        self.rule = rule or {1: "unigram", 2: "bpe"}[kind]
        self.prefix = norm.add_dummy_prefix
        self.text = [p.piece for p in proto.pieces]
        self.kind = [p.type for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self._code = "H" if len(self.text) < 1 << 16 else "i"
        self.unknown = self.kind.index(UNKNOWN)
        self.byte_id = {int(self.text[i][3:5], 16): i for i, k in enumerate(self.kind) if k == BYTE}
        self.fallback = len(self.byte_id) == 256
        if USER in self.kind:
            raise ValueError("user-defined pieces are not supported")
        self.by_text = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind)) if k == NORMAL}
        if any(SPACE in t.lstrip(SPACE) for t in self.by_text):
            raise ValueError("a piece crosses word starts: texts of this vocabulary can't be cut")
        self.longest = max(map(len, self.by_text))
        self.lowest = min((self.score[i] for i in self.by_text.values()), default=0.0)
        self._plain = [t.replace(SPACE, " ").encode() if k == NORMAL else bytes([int(t[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else b"" for t, k in zip(self.text, self.kind)]
        if self.rule == "bpe":
            self._grow_spines()
        self._matches = ahocorasick.Automaton()
        for t, i in self.by_text.items():
            if self.rule == "unigram" or i in self._right:
                self._matches.add_word(t, (len(t), i, self.score[i]))
        self._matches.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._known: dict[str, tuple] = {}
        self._older: dict[str, tuple] = {}
        self._alphabet = frozenset(t for t in self.by_text if len(t) == 1)
        self._inside = frozenset(t[i:i + 2] for t in self.by_text for i in range(len(t) - 1))

    # ---- merge order -------------------------------------------------------------------------

    def _merge(self, text: str) -> list[tuple]:
        """Merge result of a short string as nested ``(string, left, right)`` nodes."""
        parts = [(c, None, None) for c in text]
        while True:
            best = None
            for i in range(len(parts) - 1):
                at = self.by_text.get(parts[i][0] + parts[i + 1][0])
                if at is not None and (best is None or self.score[at] > best[0]):
                    best = (self.score[at], i)
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [(parts[i][0] + parts[i + 1][0], parts[i], parts[i + 1])]

    def _grow_spines(self) -> None:
        """For each reachable piece, the symbols seen at its two ends as merges build it.

        Each entry is (symbol, score of the merge that takes it up, infinitely low at the top).
        """
        self._right, self._left = {}, {}
        never = float("-inf")
        for t, i in self.by_text.items():
            parts = self._merge(t)
            if len(parts) != 1:
                continue  # no merge sequence ends in this piece
            for side, spines in ((1, self._left), (2, self._right)):
                node, spine, taken = parts[0], [], never
                while node is not None:
                    spine.append((node[0], taken))
                    taken = self.score[self.by_text[node[0]]] if node[1] is not None else never
                    node = node[side]
                spines[i] = spine[::-1]

    def _stays(self, one: int, two: int) -> bool:
        """Whether no merge ever joins the last symbol of ``one`` with the first of ``two``."""
        right, left = self._right[one], self._left[two]
        i = j = 0
        while True:
            (a, a_up), (b, b_up) = right[i], left[j]
            joined = self.by_text.get(a + b)
            if joined is not None:
                s = self.score[joined]
                if s > a_up and s >= b_up:  # equal scores: the leftmost merge goes first
                    return False
            if i == len(right) - 1 and j == len(left) - 1:
                return True
            if j == len(left) - 1 or (i < len(right) - 1 and a_up >= b_up):
                i += 1
            else:
                j += 1

    def _fits(self, one: int, two: int) -> bool:
        # an unknown character (-1) meets no merge on either side
        if one < 0 or two < 0:
            return True
        found = self._pairs.get(one << 20 | two)
        return self._follows(one, two) if found is None else found

    def _follows(self, one: int, two: int) -> bool:
        if len(self._pairs) > 4 * REMEMBERED:
            self._pairs.clear()
        found = self._pairs[one << 20 | two] = self._stays(one, two)
        return found

    # ---- dynamic programming -----------------------------------------------------------------

    def _steps(self, segment: str):
        """Yield ``(end, matches)`` for every position; matches are (length, id, score)."""
        at, found = 1, []
        for end, value in self._matches.iter(segment):
            while at <= end:
                yield at, found
                at, found = at + 1, []
            found.append(value)
        while at <= len(segment):
            yield at, found
            at, found = at + 1, []

    def _solve_word(self, segment: str) -> tuple[tuple[int, ...], float]:
        """``solve`` for a short segment of known characters under merge order: one open window."""
        # the piece that ends at each place; -1 none, -2 the start
        last = [-1] * (len(segment) + 1)
        last[0] = -2
        pairs, follows = self._pairs.get, self._follows
        for end, (length, i, _) in self._matches.iter(segment):
            end += 1
            if last[end] == -1:
                one = last[end - length]
                if one >= 0:
                    fits = pairs(one << 20 | i)
                    if fits or fits is None and follows(one, i):
                        last[end] = i
                elif one == -2:
                    last[end] = i
        ids, end, text, score = [], len(segment), self.text, self.score
        while end:
            i = last[end]
            ids.append(i)
            end -= len(text[i])
        return tuple(reversed(ids)), sum([score[i] for i in ids])

    def solve(self, segment: str) -> tuple[tuple[int, ...], float]:
        """Ids of a segment and their score sum, by a window that commits where all paths meet."""
        if self.rule == "bpe" and len(segment) <= LONG_SEGMENT and self._alphabet.issuperset(segment):
            return self._solve_word(segment)
        ids: list[int] = []
        # position -> (start of the last piece, its id, score so far); -1 marks an unknown character
        entries: dict[int, tuple[int, int, float]] = {0: (0, -2, 0.0)}
        committed = 0
        unigram = self.rule == "unigram"
        for end, matches in self._steps(segment):
            best = None
            single = False
            if unigram:
                for length, i, score in sorted(matches, reverse=True):  # earliest start first
                    single |= length == 1
                    total = entries[end - length][2] + score if end - length >= committed else None
                    if total is not None and (best is None or total > best[2]):
                        best = (end - length, i, total)
                if not single:
                    total = entries[end - 1][2] + self.lowest - UNKNOWN_PENALTY
                    if best is None or total > best[2]:
                        best = (end - 1, -1, total)
            else:
                for length, i, score in matches:
                    before = entries.get(end - length)
                    if before is not None and (before[1] == -2 or self._fits(before[1], i)):
                        best = (end - length, i, before[2] + score)
                        break
                if best is None and segment[end - 1] not in self.by_text:
                    best = (end - 1, -1, entries[end - 1][2] + self.lowest - UNKNOWN_PENALTY)
            if best is not None:
                entries[end] = best
            if end - committed >= LONG_SEGMENT and end % self.longest == 0:
                committed = self._commit(entries, end, committed, ids)
        self._emit(entries, len(segment), committed, ids, segment)
        return tuple(ids), entries[len(segment)][2]

    def _commit(self, entries: dict, end: int, committed: int, ids: list[int]) -> int:
        """Give out the ids before the last boundary that every open path shares."""
        heads = {p for p in range(max(committed, end - self.longest + 1), end + 1) if p in entries}
        while len(heads) > 1:
            last = max(heads)
            heads.remove(last)
            heads.add(entries[last][0] if last > committed else committed)
        meet = heads.pop()
        if meet <= committed:
            return committed
        self._emit(entries, meet, committed, ids, None)
        for p in [p for p in entries if p < meet]:
            del entries[p]
        return meet

    def _emit(self, entries: dict, end: int, start: int, ids: list[int], segment: str | None) -> None:
        path = []
        while end > start:
            before, i, _ = entries[end]
            path.append(i if i >= 0 else -1 - end)  # unknown characters keep their place for now
            end = before
        ids.extend(reversed(path))

    def _spell(self, segment: str, found: tuple[int, ...]) -> tuple[int, ...]:
        """Replace unknown characters by their bytes, or runs of them by one unknown id."""
        if min(found, default=0) >= 0:
            return found
        out: list[int] = []
        for i in found:
            if i >= 0:
                out.append(i)
            elif self.fallback:
                out.extend(self.byte_id[b] for b in segment[-2 - i].encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return tuple(out)

    def _segment(self, segment: str) -> tuple[bytes, int, float]:
        """Solution of a segment; short ones are remembered, the least used are forgotten.

        Ids are kept as bytes, which the garbage collector need not walk.
        """
        known = self._older.get(segment)
        if known is None:
            inside, start, parts = self._inside, 0, []
            for at in range(1, len(segment)):
                if segment[at - 1:at + 1] not in inside:  # no piece holds these two characters side by side
                    parts.append(segment[start:at])
                    start = at
            if start and (self.fallback or self._alphabet.issuperset(segment)):
                parts.append(segment[start:])
                each = [self._known.get(part) or self._segment(part) for part in parts]
                score = 0.0
                for one in each:
                    score += one[2]
                known = (b"".join([one[0] for one in each]), sum([one[1] for one in each]), score)
            else:
                found, score = self.solve(segment)
                ids = array(self._code, self._spell(segment, found))
                known = (ids.tobytes(), len(ids), score)
        if len(segment) <= LONG_SEGMENT:
            if len(self._known) >= REMEMBERED:
                self._older, self._known = self._known, {}
            self._known[segment] = known
        return known

    def _segments(self, text: str) -> list[tuple[bytes, int, float]]:
        text = text.replace(" ", SPACE)
        known, solve = self._known.get, self._segment
        return [known(segment) or solve(segment) for segment in SEGMENT.findall(SPACE + text if self.prefix else text)]

    # ---- what callers use --------------------------------------------------------------------

    def encode(self, text: str) -> array:
        """Ids of a whole text; empty for an empty one."""
        out = array(self._code)
        if text:
            out.frombytes(b"".join([found[0] for found in self._segments(text)]))
        return out

    def count(self, text: str) -> tuple[int, float]:
        """Number of ids and the score sum, without keeping any path over the whole text."""
        n, score = 0, 0.0
        if text:
            for found in self._segments(text):
                n += found[1]
                score += found[2]
        return n, score

    def decode(self, ids) -> str:
        """Text of a sequence of ids."""
        plain = self._plain
        text = b"".join([plain[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_loaded: dict[tuple[bytes, str | None], Pieces] = {}


def loaded(model: bytes, rule: str | None = None) -> Pieces:
    """The vocabulary, built once per Python worker. It stays for good, so the garbage collector leaves it out."""
    if (model, rule) not in _loaded:
        _loaded[model, rule] = Pieces(model, rule)
        gc.freeze()
        gc.set_threshold(COLLECT_EVERY)
    return _loaded[model, rule]
