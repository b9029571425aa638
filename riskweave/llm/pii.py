"""Personal data found by anchors and local parsers.

One Aho-Corasick pass over a text gives the anchors: at-signs, plus signs, digits, schemes and
identifier cues. At each one a small deterministic parser expands to both sides and validates what
it found. Every parser works left to right and remembers where its last match ended, so matches of
a kind never overlap and the whole pass is linear in the text.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame

from riskweave.llm.common import id_text, map_texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "account", "login", "street")
KINDS = BASE_KINDS + ADDED_KINDS
RANK = {kind: i for i, kind in enumerate(KINDS)}

# Cues before identifiers and after street names.
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account", "acct", "a/c", "konto", "cuenta", "compte", "ssn", "social security", "passport", "tax id")
STREET_CUES = ("street", "avenue", "road", "lane", "drive", "boulevard")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AFTER_CUE = re.compile(r"(?: ?(?:no|nr|number|nummer|num|code|id)\b\.?)?[ \t]{0,3}[.:#=]?[ \t]{0,3}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,19}(?![A-Za-z0-9])")
LOGIN = re.compile(r"[^\s/@:<>\"']+(?::[^\s/@<>\"']*)?@[A-Za-z0-9.-]+")
HOUSE = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,5}[A-Za-z]?(?: [A-Z][^\W\d_]*){1,4} $")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def iban_holds(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    found.add_word("+", ("+", 1))
    found.add_word("://", ("login", 3))
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    for kind, cues in (("iban", IBAN_CUES), ("account", ACCOUNT_CUES), ("street", STREET_CUES)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


class Finder:
    """Finds the spans of one text after another."""

    def __init__(self):
        self.anchors = anchors()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """``(start, end, kind)`` by start, then kind; ends are exclusive, in code points."""
        out: list[tuple[int, int, str]] = []
        free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
        tried_ip = 0
        for last, (kind, length) in self.anchors.iter(text):
            at = last + 1 - length
            if kind == "digit":
                if at >= free["card"]:
                    m = CARD.match(text, at)
                    free["card"] = m.end() if m else at + 1
                    if m:
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            out.append((at, m.end(), "card"))
                if at >= tried_ip:
                    m = QUAD.match(text, at)
                    tried_ip = m.end() if m else DIGITS.match(text, at).end()
                    if m and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                        out.append((at, m.end(), "ip"))
            elif kind == "@":
                start = at
                while start > free["email"] and text[start - 1] in LOCAL:
                    start -= 1
                m = DOMAIN.match(text, at + 1) if start < at else None
                if m:
                    free["email"] = m.end()
                    out.append((start, m.end(), "email"))
            elif kind == "+":
                m = PHONE.match(text, at) if at >= free["phone"] else None
                if m:
                    free["phone"] = m.end()
                    if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                        out.append((at, m.end(), "phone"))
            elif at >= free[kind]:
                found = getattr(self, f"_{kind}")(text, at, last + 1, free[kind])
                if found:
                    free[kind] = found[1]
                    out.append((*found, kind))
        return sorted(out, key=lambda s: (s[0], RANK[s[2]]))

    @staticmethod
    def _value(text: str, cue: int, end: int) -> int | None:
        """Where the value after a whole-word cue starts."""
        if cue and text[cue - 1].isalnum() or text[end:end + 1].isalnum():
            return None
        return AFTER_CUE.match(text, end).end()

    def _iban(self, text: str, at: int, end: int, free: int):
        value = self._value(text, at, end)
        m = IBAN.match(text, value) if value is not None else None
        while m and not iban_holds(m[0].replace(" ", "")):  # a following word may look like part of it
            cut = m[0].rfind(" ")
            m = IBAN.match(text[:m.start() + cut], m.start()) if cut > 0 else None
        return (m.start(), m.end()) if m else None

    def _account(self, text: str, at: int, end: int, free: int):
        value = self._value(text, at, end)
        m = ACCOUNT.match(text, value) if value is not None else None
        return (m.start(), m.end()) if m else None

    def _login(self, text: str, at: int, end: int, free: int):
        start = at
        while start > free and text[start - 1] in SCHEME:
            start -= 1
        m = LOGIN.match(text, end) if start < at and text[start].isalpha() else None
        return (start, m.end()) if m else None

    def _street(self, text: str, at: int, end: int, free: int):
        if not text[at].isupper() or text[end:end + 1].isalnum():
            return None
        floor = max(free, at - 120)  # a house number and four names
        m = HOUSE.search(text[floor:at])
        return (floor + m.start(), end) if m else None


def digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: every span as ``(kind, start, end, value)``, in order of start and kind.

    Null and empty texts have no spans. Each row of the input gives one row, repeated rows too.
    Texts are read whole whatever their length.
    """

    def start():
        finder = Finder()
        return lambda text: ([{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, b, k in finder.spans(text)],)

    return map_texts(id_text(docs, id_col, text_col), start, "doc_id long, spans array<struct<kind:string,start:int,end:int,value:string>>")
