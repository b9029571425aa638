"""Removal of long repeated byte strings by prefix-free parsing.

*Parsing.* A rolling hash over ``trigger`` bytes runs along a text. The string of ``length`` bytes
that starts at a position belongs to the trigger at the smallest hash inside it (the first among
equals). Consecutive positions with the same trigger make a phrase; phrases overlap by ``length``-1
bytes, so each string of ``length`` bytes lies whole in exactly one phrase, at the same distance
from the same trigger wherever it occurs. Highly repetitive text is few distinct phrases.

*Dictionary and parse.* Distinct phrases are the dictionary, their occurrences the parse. A phrase
that occurs twice makes all its strings repeats. A phrase that occurs once can share strings only
with phrases of the same trigger. Those are gathered by trigger, and the suffixes of the dictionary
phrases are put in order there. Only equality over ``length`` bytes matters, so suffixes are ordered
by 128-bit fingerprints of that many bytes instead of letter by letter; together with the number of
occurrences in the parse, neighbours in this order tell which strings start in two places.

*Hot keys.* Occurrences are counted with map-side sums. Phrases that hold a large share of the parse
(few can, see ``skewed``) are joined by broadcast. A trigger with more than
``GROUP`` distinct phrases is not gathered at once: its phrases are halved around the trigger, and the
halves meet only where they share a core, which grows with every halving.

Null texts are empty and lose nothing; texts under ``length`` bytes neither. Equal rows are separate
documents that repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SLICE, arrow_schema, id_text
from riskweave.llm.keybits import key_bits, may_hold
from riskweave.llm.skewed import share_join
from riskweave.session import materialize

LENGTH, TRIGGER = 200, 64
#: Positions of a text that are parsed at a time.
SEGMENT = 1 << 19
#: Distinct phrases of one trigger that a task compares by itself.
GROUP = 2_000

PLACE = 20  # bits of a position inside a segment; SEGMENT + LENGTH must fit


class Parser:
    """Rolling hashes and phrases of byte strings."""

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER, segment: int = SEGMENT):
        if not 0 < trigger <= length or segment + length >= 1 << PLACE:
            raise ValueError("need trigger <= length and a segment that fits")
        self.length, self.trigger, self.segment = length, trigger, segment
        draw = np.random.default_rng(20_031)
        size = segment + length + 1
        self.hashes = []
        for base in (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4B):
            symbol = draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            powers = []
            for b in (base, pow(base, -1, 1 << 64)):
                factors = np.full(size, b, np.uint64)
                factors[0] = 1
                powers.append(np.cumprod(factors, dtype=np.uint64))
            self.hashes.append((symbol, *powers))

    def sums(self, data: np.ndarray) -> list[np.ndarray]:
        return [np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbol[data] * up[:len(data)], dtype=np.uint64)]) for symbol, up, _ in self.hashes]

    def between(self, which: int, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``data[start:end]`` for each pair of places."""
        return (sums[end] - sums[start]) * self.hashes[which][2][start]

    def strings(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of every string of ``length`` bytes."""
        at = np.arange(len(data) - self.length + 1)
        return tuple(self.between(i, s, at, at + self.length) for i, s in enumerate(self.sums(data)))

    def windows(self, sums: list[np.ndarray], size: int) -> np.ndarray:
        """Rolling hash of the ``trigger`` bytes that start at each place."""
        at = np.arange(size - self.trigger + 1)
        rolling = self.between(0, sums[0], at, at + self.trigger)
        rolling ^= rolling >> np.uint64(31)
        rolling *= np.uint64(0xD6E8FEB86659FD93)
        return rolling ^ rolling >> np.uint64(29)

    def phrases(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Per segment: start, number of strings, trigger hash and the two hashes of each phrase."""
        whole = np.frombuffer(text, np.uint8)
        for base in range(0, len(whole) - self.length + 1, self.segment):
            data = whole[base:base + self.segment + self.length - 1]
            sums = self.sums(data)
            rolling = self.windows(sums, len(data))
            low = rolling >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(rolling), dtype=np.uint64)
            width, have = self.length - self.trigger + 1, 1
            while have * 2 <= width:
                low = np.minimum(low[:-have], low[have:])
                have *= 2
            if width > have:
                low = np.minimum(low[:-(width - have)], low[width - have:])
            place = (low & np.uint64((1 << PLACE) - 1)).astype(np.int64)
            cut = np.flatnonzero(np.diff(place)) + 1
            start = np.concatenate([[0], cut])
            end = np.concatenate([cut, [len(place)]])
            stop = end - 1 + self.length
            yield start + base, end - start, rolling[place[start]].view(np.int64), self.between(0, sums[0], start, stop).view(np.int64), self.between(1, sums[1], start, stop).view(np.int64)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``k1, k2, data, doc_id``: rows with the same key are equal, so they lose the same bytes."""
    return id_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(0)).alias("k1"),
        F.xxhash64(F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))).alias("k2"),
        F.coalesce("text", F.lit("")).cast("binary").alias("data"), "doc_id")


PHRASE = "k1 long, k2 long, start int, n int, trigger long, h1 long, h2 long"


def _parse(keyed: DataFrame, parser_of, keep=None) -> DataFrame:
    """Occurrences of phrases; with ``keep``, only those whose trigger may be in that bit filter."""
    schema = arrow_schema(PHRASE)

    def run(batches):
        parser = parser_of()
        words = keep.value if keep is not None else None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = []
                for k1, k2, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    for start, n, trigger, h1, h2 in parser.phrases(data):
                        if words is not None:
                            ok = may_hold(words, trigger)
                            start, n, trigger, h1, h2 = start[ok], n[ok], trigger[ok], h1[ok], h2[ok]
                        found.append((np.full(len(start), k1), np.full(len(start), k2), start.astype(np.int32), n.astype(np.int32), trigger, h1, h2))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)

    return keyed.select("k1", "k2", "data").mapInArrow(run, PHRASE)


def _triggers(keyed: DataFrame, parser_of) -> DataFrame:
    schema = arrow_schema("trigger long")

    def run(batches):
        parser = parser_of()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                found = [p[2] for data in batch.slice(at, SLICE).column(0).to_pylist() for p in parser.phrases(data)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], schema=schema)

    return keyed.select("data").mapInArrow(run, "trigger long")


def _texts_of(keyed: DataFrame, keys: DataFrame, columns: str, empty: str | None = None) -> DataFrame:
    """Rows of ``keyed`` that may have a row in ``keys``; with ``empty`` the others stay, without data.

    ``empty`` names what the others carry instead: their length and digest.
    """
    spark = keyed.sparkSession
    bits = spark.sparkContext.broadcast(key_bits(keys, F.col("k2")))
    schema = arrow_schema(columns)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                wanted = may_hold(bits.value, part.column(1).to_numpy())
                if empty is None:
                    yield pa.RecordBatch.from_arrays(part.filter(pa.array(wanted)).columns[:3], schema=schema)
                else:
                    data = part.column(2).to_pylist()
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), part.column(1), pa.array([d if w else None for d, w in zip(data, wanted)], pa.binary()), part.column(3),
                        pa.array([len(d) for d in data], pa.int64()), pa.array([None if w else hashlib.sha256(d).hexdigest() for d, w in zip(data, wanted)], pa.string())], schema=schema)

    return keyed.mapInArrow(run, columns)


GATHERED = "k1 long, k2 long, start int, n int, trigger long, twice boolean, hot boolean, data binary"


def _cut_out(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of dictionary phrases, from the text of one occurrence each."""
    schema = arrow_schema(GATHERED)
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "trigger", "twice", "hot")).alias("phrases"))
    rows = texts.dropDuplicates(["k1", "k2"]).join(lists, ["k1", "k2"]).select("k1", "k2", "data", "phrases")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = []
                for row in batch.slice(at, SLICE).to_pylist():
                    data = row["data"]
                    out += [(row["k1"], row["k2"], p["start"], p["n"], p["trigger"], p["twice"], p["hot"], data[p["start"]:p["start"] + p["n"] + length - 1]) for p in row["phrases"]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, GATHERED)


SPAN = "k1 long, k2 long, start int, stop int"


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return places[np.concatenate([[0], cut])], places[np.concatenate([cut, [len(places)]]) - 1]


def _ordered(gathered: DataFrame, parser_of) -> DataFrame:
    """Repeated strings of phrases that occur once, found among those with the same ``trigger``."""
    schema = arrow_schema(SPAN)

    def judge(rows: list[tuple], parser: Parser):
        spans = []
        h1, h2, owner, place = [], [], [], []
        for i, row in enumerate(rows):
            a, b = parser.strings(np.frombuffer(row[5], np.uint8))
            h1.append(a)
            h2.append(b)
            owner.append(np.full(len(a), i))
            place.append(np.arange(len(a)))
        h1, h2, owner, place = map(np.concatenate, (h1, h2, owner, place))
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        which = np.cumsum(new) - 1
        twice = np.array([r[4] for r in rows])
        weight = np.bincount(which, 1 + twice[owner[order]])
        repeated = np.empty(len(order), bool)
        repeated[order] = weight[which] >= 2
        repeated &= ~twice[owner]
        bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
        for i in np.unique(owner[repeated]):
            mine = slice(bounds[i], bounds[i + 1])
            first, last = _runs(place[mine][repeated[mine]])
            k1, k2, start = rows[i][:3]
            spans += [(k1, k2, start + int(f), start + int(x) + parser.length) for f, x in zip(first, last)]
        return spans

    def run(batches):
        parser = parser_of()
        held: list[tuple] = []

        def flush():
            spans = judge(held, parser) if held else []
            held.clear()
            if spans:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*spans), schema)], schema=schema)

        for batch in batches:
            for k1, k2, start, trigger, twice, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and held[-1][3] != trigger and len(held) >= 64:
                    yield from flush()
                held.append((k1, k2, start, trigger, twice, data))
        yield from flush()

    return (
        gathered.select("k1", "k2", "start", "trigger", "twice", "data")
        .repartition("trigger").sortWithinPartitions("trigger").mapInArrow(run, SPAN)
    )


PIECE = "k1 long, k2 long, start int, n int, low int, high int, lead int, g1 long, g2 long, e1 long, e2 long, twice boolean, data binary"


def _halved(pieces: DataFrame, parser_of) -> DataFrame:
    """Two pieces for each: its strings that reach far to the left of the trigger, and the others.

    A piece holds the strings with ``low`` to ``high`` - 1 bytes before the trigger. All of them share
    a core: ``low`` bytes before the trigger and what the one that starts first has behind it. So
    pieces can only share strings if their cores (``g1, g2``) are equal; ``e1, e2`` stand for the
    whole piece, ``lead`` for the place of the trigger in it.
    """
    schema = arrow_schema(PIECE)

    def run(batches):
        parser = parser_of()
        length, reach = parser.length, parser.length - parser.trigger
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = []
                for k1, k2, start, n, trigger, low, high, lead, twice, data in zip(*(batch.slice(at, SLICE).column(i).to_pylist() for i in range(10))):
                    symbols = np.frombuffer(data, np.uint8)
                    sums = parser.sums(symbols)
                    if lead is None:  # a whole phrase; its trigger is the first window of that hash
                        lead, low, high = int(np.flatnonzero(parser.windows(sums, len(symbols)).view(np.int64) == trigger)[0]), 0, reach + 1
                    middle = (low + high) // 2
                    for a, b in ((low, middle), (middle, high)):
                        first, last = max(0, lead - b + 1), min(n - 1, lead - a)
                        if a < b and first <= last:
                            core = np.array([lead - a]), np.array([lead - b + 1 + length])
                            ends = np.array([first]), np.array([last + length])
                            marks = [int(parser.between(i, sums[i], *part).view(np.int64)[0]) for part in (core, ends) for i in (0, 1)]
                            out.append((k1, k2, start + first, last - first + 1, a, b, lead - first, *marks, twice, data[first:last + length]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return pieces.select("k1", "k2", "start", "n", "trigger", "low", "high", "lead", "twice", "data").mapInArrow(run, PIECE)


def _halving(gathered: DataFrame, parser_of, group: int) -> DataFrame:
    """The same for triggers with too many phrases for a task: halves, until few have the same core.

    Equal pieces are one piece that repeats whole. Different ones with the same core are compared in
    a task, or halved again where they are too many. A piece of one string is its own core, so there
    are no more rounds than halvings of ``length`` - ``trigger`` + 1.
    """
    core, whole = ["low", "high", "g1", "g2"], ["low", "high", "g1", "g2", "lead", "n", "e1", "e2"]
    spans = []
    crowd = gathered.where("hot").select("k1", "k2", "start", "n", "trigger", "twice", "data").withColumns(
        {c: F.lit(None).cast("int") for c in ("low", "high", "lead")})
    while True:
        pieces = materialize(_halved(crowd, parser_of), "pieces")
        if pieces.isEmpty():
            return reduce(DataFrame.unionByName, spans) if spans else None
        kinds = materialize(pieces.groupBy(*whole).agg(
            F.count("*").alias("c"), F.max("twice").alias("twice"), F.min(F.struct("k1", "k2", "start", "data")).alias("one")), "piece-kinds")
        again = kinds.where("c > 1 or twice").select(*whole, "c")
        spans.append(share_join(pieces.where("not twice"), again, whole).selectExpr("k1", "k2", "start", f"start + n + {parser_of.length - 1} as stop"))
        sizes = materialize(kinds.groupBy(*core).agg(F.count("*").alias("c")).where("c > 1"), "piece-groups")
        others = materialize(share_join(kinds.withColumnRenamed("c", "copies"), sizes.withColumn("crowded", F.col("c") > group), core).select(
            "one.*", "n", "low", "high", "lead", "g1", "g2", F.expr("twice or copies > 1").alias("twice"), "crowded"), "piece-variants")
        few = others.where("not crowded").select("k1", "k2", "start", F.xxhash64(*core).alias("trigger"), "twice", "data")
        spans.append(_ordered(few, parser_of))
        crowd = others.where("crowded").withColumn("trigger", F.lit(None).cast("long"))


class _ParserOf:
    """Builds the parser in a task; its settings travel with the function."""

    def __init__(self, length: int, trigger: int, segment: int):
        self.length, self.trigger, self.segment = length, trigger, segment

    def __call__(self) -> Parser:
        return Parser(self.length, self.trigger, self.segment)


def repeated_spans(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, segment: int = SEGMENT, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k1, k2, start, stop``: bytes of the keyed rows that repeated strings cover; spans may overlap."""
    spark = docs.sparkSession
    keyed, parser_of = _keyed(docs, id_col, text_col), _ParserOf(length, trigger, segment)
    again = _triggers(keyed, parser_of).groupBy("trigger").count().where("count > 1")
    keep = spark.sparkContext.broadcast(key_bits(again, F.col("trigger")))
    parse = materialize(_parse(keyed, parser_of, keep), "parse")
    dictionary = materialize(
        parse.groupBy("trigger", "h1", "h2").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "start", "n")).alias("first")), "dictionary")
    whole = share_join(parse, dictionary.where("c > 1").select("h1", "h2", "c"), ["h1", "h2"]).selectExpr("k1", "k2", "start", f"start + n + {length - 1} as stop")

    # phrases that occur once, with those that may share strings with them
    variants = materialize(dictionary.groupBy("trigger").agg(F.count("*").alias("phrases"), F.min("c").alias("least")).where("phrases > 1 and least = 1"), "variants")
    # a trigger with many phrases holds a large share: the same split as for any heavy key
    crowded = materialize(variants.where(F.col("phrases") > group).select("trigger"), "crowded")
    n_crowded = crowded.count()
    sized = variants.select("trigger", F.col("phrases").alias("c"))
    wanted = share_join(dictionary.select("trigger", "first.*", (F.col("c") > 1).alias("twice")), sized, ["trigger"])
    if n_crowded:
        wanted = _mark_crowded(wanted, crowded, n_crowded)
    else:
        wanted = wanted.withColumn("hot", F.lit(False))
    wanted = materialize(wanted.select("k1", "k2", "start", "n", "trigger", "twice", "hot"), "wanted")
    texts = _texts_of(keyed, wanted, "k1 long, k2 long, data binary")
    gathered = materialize(_cut_out(texts, wanted, length), "phrases")
    spans = whole.unionByName(_ordered(gathered.where("not hot"), parser_of))
    halves = _halving(gathered, parser_of, group) if n_crowded else None
    return spans if halves is None else spans.unionByName(halves)


def _mark_crowded(wanted: DataFrame, crowded: DataFrame, n: int) -> DataFrame:
    # each stands for more than GROUP phrases; beyond a million of them the join is left to the planner
    side = crowded.withColumn("hot", F.lit(True))
    return wanted.join(F.broadcast(side) if n <= 1_000_000 else side, ["trigger"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with what they lose; rows that lose nothing travel without their text."""
    # equal rows share their keys and their spans: a set, or each would carry those of all
    spans = materialize(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    rows = _texts_of(_keyed(docs, id_col, text_col), spans, "k1 long, k2 long, data binary, doc_id long, n_bytes long, whole_sha256 string", "digest")
    return rows.join(spans, ["k1", "k2"], "left")


def _map_spans(rows: DataFrame, columns: list[str], work, ddl: str) -> DataFrame:
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = [work(*row) for row in zip(*(batch.slice(at, SLICE).column(i).to_pylist() for i in range(len(columns))))]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.select(*columns).mapInArrow(run, ddl)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""

    def work(doc_id, data, n_bytes, digest, spans):
        if data is None or not spans:
            return doc_id, n_bytes, 0, 0, digest or hashlib.sha256(data).hexdigest()
        cut = merge([(s["start"], s["stop"]) for s in spans])
        kept, at = hashlib.sha256(), 0
        for a, b in cut:
            kept.update(data[at:a])
            at = b
        kept.update(data[at:])
        return doc_id, n_bytes, sum(b - a for a, b in cut), len(cut), kept.hexdigest()

    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, **settings)
    return _map_spans(_with_spans(docs, spans, id_col, text_col), ["doc_id", "data", "n_bytes", "whole_sha256", "spans"], work, RESULT)


def removed_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, spans``: maximal removed byte ranges of the rows that lose something."""

    def work(doc_id, spans):
        return doc_id, [{"start": a, "stop": b} for a, b in merge([(s["start"], s["stop"]) for s in spans])]

    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, **settings)
    rows = _with_spans(docs, spans, id_col, text_col).where("spans is not null")
    return _map_spans(rows, ["doc_id", "spans"], work, "doc_id long, spans array<struct<start:int,stop:int>>")
