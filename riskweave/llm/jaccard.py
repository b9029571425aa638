r"""Documents joined by the Jaccard similarity of their word n-gram sets, by prefix trees.

Words are runs of ``[^\x20\x09-\x0D]`` with A-Z lowered. A set holds the distinct shingles of
``words`` words, as sorted 64-bit hashes; a shorter text has its whole sequence as its only shingle;
a text without words has none and is linked with nothing. Two documents link when
``100 * intersection >= percent * union``.

1. Equal sets are one class, told by a 128-bit fingerprint; one document stands for it.
2. Shingles get one global order: those that few documents hold come first, then by hash. Linked sets
   share a shingle in their prefixes (size - ceil(t * size) + 1 first ones). Only shingles that two
   classes hold are kept as postings.
3. *Home groups.* Each class goes with its text to the groups of its first shared shingles. A group
   keeps its ordered sets as a prefix tree (sorted sets with their common prefixes); a probe walks the
   tree, shares the overlap of common prefixes, leaves a branch when the remaining lengths can't reach
   the threshold any more or when all of it is linked already. Links give components.
4. *Completion.* In the posting groups that still hold several components, every pair from different
   components is judged by size, prefix places and a parity sketch (the number of differing sketch
   bits never exceeds the number of differing shingles). What survives is checked in prefix trees on
   whole texts. So no link between different texts is lost, and pairs inside a component are spared.

A group with more than ``block`` members is split: home groups by a hash (step 4 makes up for it),
posting groups into all pairs of blocks. A document is its id: rows that repeat an id are the same
document. Rows with a null id are linked with nothing and have no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import SLICE, arrow_schema, id_text
from riskweave.llm.keybits import key_bits, may_hold
from riskweave.llm.skewed import components, share_join
from riskweave.session import materialize

WORDS, PERCENT = 4, 85
#: Shingles whose hash lies in this share of the range are counted to order them by frequency.
COUNTED = 0.25
#: Held by so many classes, a shingle comes late in the order.
COMMON = 64
#: The late shingles travel to the tasks: 8 MB at most, the most frequent ones if there are more.
MOST_COMMON = 1 << 20
HOMES = 3
BLOCK = 2_000
SKETCH_BITS = 512

U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> U(30)) * U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> U(27)) * U(0x94D049BB133111EB)
    return x ^ x >> U(31)


class Shingler:
    """Sorted shingle hashes of texts."""

    def __init__(self, words: int = WORDS):
        self.words = words
        draw = np.random.default_rng(4_085)
        self.symbol = draw.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.symbol[65:91] = self.symbol[97:123]  # A-Z as a-z
        gap = np.zeros(256, bool)
        gap[[0x20, *range(0x09, 0x0E)]] = True
        self.gap = gap
        self.base, self.back = 0x9E3779B97F4A7C13, pow(0x9E3779B97F4A7C13, -1, 1 << 64)
        self.step = U(0xC2B2AE3D27D4EB4F)
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        powers = []
        for b in (self.base, self.back):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            powers.append(np.cumprod(factors, dtype=np.uint64))
        self.up, self.down = powers

    def word_hashes(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        inside = np.concatenate([[False], ~self.gap[data], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, stop = edge[::2], edge[1::2]
        if len(data) >= len(self.up):
            self._grow(2 * len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.symbol[data] * self.up[:len(data)], dtype=np.uint64)])
        return _mixed((sums[stop] - sums[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def set_of(self, text: str | None) -> np.ndarray:
        w = self.word_hashes((text or "").encode())
        if not len(w):
            return w
        k = min(self.words, len(w))
        h = np.full(len(w) - k + 1, U(k))
        for i in range(k):
            h = _mixed(h * self.step + w[i:len(w) - k + 1 + i])
        return np.unique(h)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of a set; their number is a power of two near the set's size."""
    bits = max(SKETCH_BITS, 1 << int(len(shingles)).bit_length())
    odd = np.bincount((shingles >> U(8) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch at a smaller size: parities of bits that share a place."""
    while len(words) > size:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def least_overlap(x, y, percent: int):
    """Smallest intersection that links sets of these sizes."""
    return -(-percent * (x + y) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class PrefixTree:
    """Sets in global order, kept sorted; common prefixes are found as the walk goes down."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.place = np.empty(len(sets), np.int64)
        self.place[self.order] = np.arange(len(sets))
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])

    def walk(self, probe: np.ndarray, members: np.ndarray, percent: int, open_) -> Iterator[int]:
        """Members that link with the probe; ``open_(members)`` tells which are still of interest."""
        n = len(probe)
        sorted_members = members[np.argsort(self.place[members], kind="stable")]
        stack = [(sorted_members, 0, 0)]
        while stack:
            branch, depth, overlap = stack.pop()
            branch = branch[open_(branch)]
            if not len(branch):
                continue
            sizes = self.sizes[branch]
            behind = n - int(np.searchsorted(probe, self.sets[branch[0]][depth - 1], "right")) if depth else n
            reach = overlap + np.minimum(behind, sizes - depth)
            branch = branch[reach >= least_overlap(n, sizes, percent)]
            if not len(branch):
                continue
            first, last = self.sets[branch[0]], self.sets[branch[-1]]
            if len(branch) == 1:
                end = len(first)
            else:
                k = min(len(first), len(last))
                apart = np.flatnonzero(first[depth:k] != last[depth:k])
                end = depth + int(apart[0]) if len(apart) else k
            edge = first[depth:end]
            overlap += int((probe[np.minimum(np.searchsorted(probe, edge), n - 1)] == edge).sum())
            done = branch[self.sizes[branch] == end]  # sorted, so shorter sets come first
            for i in done:
                if overlap >= least_overlap(n, end, percent):
                    yield int(i)
            branch = branch[len(done):]
            if len(branch):
                head = np.array([self.sets[i][end] for i in branch])
                cuts = np.flatnonzero(head[1:] != head[:-1]) + 1
                for part in reversed(np.split(branch, cuts)):
                    stack.append((part, end, overlap))


def _near(sketches: list[np.ndarray], sizes: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``others`` whose size and sketch allow a link with ``i``."""
    n = sizes[i]
    others = others[(100 * np.minimum(n, sizes[others]) >= percent * np.maximum(n, sizes[others]))]
    if not len(others):
        return others
    size = min(len(sketches[i]), min(len(sketches[j]) for j in others))
    mine = folded(sketches[i], size)
    theirs = np.stack([folded(sketches[j], size) for j in others])
    apart = np.bitwise_count(theirs ^ mine).sum(1)
    return others[apart <= n + sizes[others] - 2 * least_overlap(n, sizes[others], percent)]


def link_group(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the members of a group into its components."""
    sizes = np.array([len(s) for s in sets])
    sketches = [sketch(s) for s in sets]
    group = np.arange(len(sets))  # component of each member
    tree = PrefixTree(sets)
    links = []
    for i in range(1, len(sets)):
        before = np.arange(i)
        near = _near(sketches, sizes, i, before, percent)
        if not len(near):
            continue
        for j in tree.walk(sets[i], near, percent, lambda m: group[m] != group[i]):  # noqa: B023
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                links.append((i, j))
    return links


def _batches_of_groups(batches, keys: int) -> Iterator[list[tuple]]:
    """Rows of one key at a time, from a sorted partition."""
    held: list[tuple] = []
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                if held and held[-1][:keys] != row[:keys]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def _emit(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _per_text(docs: DataFrame, work, ddl: str) -> DataFrame:
    """``work(ids, texts)`` gives rows for a slice of documents."""
    schema = arrow_schema(ddl)

    def run(batches):
        call = work()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield from _emit(call(part.column(0).to_pylist(), part.column(1).to_pylist()), schema)

    return docs.mapInArrow(run, ddl)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def set_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n, f1, f2``: set sizes and fingerprints, one row per input row."""

    def work():
        shingler = Shingler(words)

        def call(ids, texts):
            out = []
            for i, text in zip(ids, texts):
                s = shingler.set_of(text)
                a = int(_signed(np.sum(_mixed(s + U(1)), keepdims=True, dtype=np.uint64))[0])
                b = int(_signed(np.sum(_mixed(s ^ U(0xA0761D6478BD642F)), keepdims=True, dtype=np.uint64))[0])
                out.append((i, len(s), a, b))
            return out

        return call

    return _per_text(docs, work, "doc_id long, n int, f1 long, f2 long")


def _of(docs: DataFrame, bits) -> DataFrame:
    """Documents whose id may be in a bit filter."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(known & may_hold(bits.value, ids.fill_null(0).to_numpy())))

    return docs.mapInArrow(run, docs.schema)


def _low_shingles(docs: DataFrame, bits, words: int, percent: int) -> DataFrame:
    schema = arrow_schema("token long")
    edge = U(int(COUNTED * 2**64))

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = part.column(0)
                ok = ids.is_valid().to_numpy(zero_copy_only=False) & may_hold(bits.value, ids.fill_null(0).to_numpy())
                found = [np.zeros(0, np.uint64)]
                for keep, text in zip(ok, part.column(1).to_pylist()):
                    if keep:
                        s = shingler.set_of(text)
                        # at least the prefix, if the set is small
                        found.append(s[:max(int(np.searchsorted(s, edge)), prefix_length(len(s), percent))])
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found)))], schema=schema)

    return docs.mapInArrow(run, "token long")


POSTING = "token long, c long, n int, rank int, home boolean, sketch binary"


def _postings(docs: DataFrame, reps, shared, late, words: int, percent: int) -> DataFrame:
    edge = U(int(COUNTED * 2**64))

    def work():
        shingler, late_tokens = Shingler(words), late.value

        def call(ids, texts):
            out = []
            wanted = may_hold(reps.value, np.array([0 if i is None else i for i in ids], np.int64))
            for i, text, ok in zip(ids, texts, wanted):
                if not ok or i is None:
                    continue
                s = shingler.set_of(text)
                if not len(s):
                    continue
                p = prefix_length(len(s), percent)
                low = s[:int(np.searchsorted(s, edge))]
                at = np.minimum(np.searchsorted(late_tokens, low), max(len(late_tokens) - 1, 0))
                is_late = late_tokens[at] == low if len(late_tokens) else np.zeros(len(low), bool)
                prefix = np.concatenate([low[~is_late], low[is_late], s[len(low):len(low) + p]])[:p]
                kept = np.flatnonzero(may_hold(shared.value, _signed(prefix)))
                if len(kept):
                    bits = sketch(s).tobytes()
                    out += [(int(t), i, len(s), int(r), k < HOMES, bits) for k, (t, r) in enumerate(zip(_signed(prefix[kept]), kept))]
            return out

        return call

    return _per_text(docs, work, POSTING)


def _home_links(texts: DataFrame, homes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links inside the groups ``token, part`` of ``homes``."""
    rows = texts.withColumnRenamed("doc_id", "c").join(homes, "c").select("token", "part", "c", "text")
    schema = arrow_schema("a long, b long")

    def run(batches):
        shingler = Shingler(words)
        for group in _batches_of_groups(batches, 2):
            by_id = {row[2]: row[3] for row in group}
            if len(by_id) > 1:
                ids = sorted(by_id)
                sets = [shingler.set_of(by_id[i]) for i in ids]
                yield from _emit([(ids[i], ids[j]) for i, j in link_group(sets, percent)], schema)

    return rows.repartition("token", "part").sortWithinPartitions("token", "part").mapInArrow(run, "a long, b long")


def _open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that size, places and sketch allow, per ``token, one, two``."""
    schema = arrow_schema("a long, b long")
    rows = rows.select("token", "one", "two", "blk", "c", "root", "n", "rank", "sketch")

    def run(batches):
        for group in _batches_of_groups(batches, 3):
            group = list({row[4]: row for row in group}.values())
            sizes = np.array([r[6] for r in group])
            roots = np.array([r[5] for r in group])
            rank = np.array([r[7] for r in group])
            blk = np.array([r[3] for r in group])
            if len(group) < 2 or (roots == roots[0]).all():
                continue
            sketches = [np.frombuffer(r[8], np.uint64) for r in group]
            out = []
            one, two = group[0][1], group[0][2]
            for i in range(len(group)):
                if blk[i] != one:
                    continue
                others = np.arange(i + 1, len(group)) if one == two else np.flatnonzero(blk == two)
                others = others[roots[others] != roots[i]]
                others = others[rank[others] + rank[i] <= sizes[i] + sizes[others] - 2 * least_overlap(sizes[i], sizes[others], percent)]
                out += [(min(group[i][4], group[j][4]), max(group[i][4], group[j][4])) for j in _near(sketches, sizes, i, others, percent)]
            yield from _emit(out, schema)

    return rows.repartition("token", "one", "two").sortWithinPartitions("token", "one", "two").mapInArrow(run, "a long, b long")


def _checked(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs that link, the second ones of a first in one prefix tree of at most ``BLOCK`` sets or so."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    sized = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    members = sized.select("a", "part", F.col("b").alias("doc_id"), F.lit(False).alias("probe"))
    probes = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("doc_id"), F.lit(True).alias("probe"))
    rows = members.unionByName(probes).join(texts, "doc_id").select("a", "part", "doc_id", "probe", "text")
    schema = arrow_schema("a long, b long")

    def run(batches):
        shingler = Shingler(words)
        for group in _batches_of_groups(batches, 2):
            probe = next(row for row in group if row[3])
            others = list({row[2]: row for row in group if not row[3]}.values())
            tree = PrefixTree([shingler.set_of(row[4]) for row in others])
            found = tree.walk(shingler.set_of(probe[4]), np.arange(len(others)), percent, lambda m: np.ones(len(m), bool))
            yield from _emit([(probe[2], others[j][2]) for j in found], schema)

    return rows.repartition("a", "part").sortWithinPartitions("a", "part").mapInArrow(run, "a long, b long")


def _late_tokens(shared: DataFrame) -> np.ndarray:
    """The common shingles; above ``MOST_COMMON`` of them, those of the highest powers of two."""
    common = shared.where(F.col("c") >= COMMON)
    steps = dict(common.groupBy(F.floor(F.log2("c")).alias("step")).count().collect())
    least, total = max(steps, default=0) + 1, 0
    while least - 1 in steps and total + steps[least - 1] <= MOST_COMMON:
        least -= 1
        total += steps[least]
    rows = common.where(F.floor(F.log2("c")) >= least).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().view(np.uint64))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the component is its smallest document id."""
    spark = docs.sparkSession
    docs = id_text(docs, id_col, text_col)
    rows = materialize(set_rows(docs, words), "sets")
    classes = materialize(rows.where("n > 0 and doc_id is not null").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "classes")
    reps = spark.sparkContext.broadcast(key_bits(classes, F.col("rep")))

    counted = _low_shingles(docs, reps, words, percent).groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    counted = materialize(counted, "shingles")
    shared = spark.sparkContext.broadcast(key_bits(counted, F.col("token")))
    late = spark.sparkContext.broadcast(_late_tokens(counted))
    postings = materialize(_postings(docs, reps, shared, late, words, percent), "postings")

    per_token = materialize(postings.where("home").groupBy("token").agg(F.count("*").alias("c"), F.ceil(F.count("*") / block).cast("int").alias("parts")).where("c > 1"), "homes")
    homes = share_join(postings.where("home").select("token", "c").withColumnRenamed("c", "doc"), per_token, ["token"])
    homes = materialize(homes.select("token", F.col("doc").alias("c"), F.pmod(F.xxhash64("doc", "token"), F.col("parts")).cast("int").alias("part")), "home-groups")
    texts = _of(docs, spark.sparkContext.broadcast(key_bits(homes, F.col("c"))))
    links = materialize(_home_links(texts, homes, words, percent), "links")
    roots = materialize(components(links), "components")

    placed = postings.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c")).withColumnRenamed("c", "doc")
    placed = materialize(placed, "placed")
    mixed = placed.groupBy("token").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / block).cast("int").alias("parts")).where("low < high")
    mixed = materialize(mixed.select("token", "c", "parts"), "mixed")
    spread = share_join(placed, mixed, ["token"]).withColumn("blk", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.select("token", F.least("blk", "other").alias("one"), F.greatest("blk", "other").alias("two"), "blk", F.col("doc").alias("c"), "root", "n", "rank", "sketch")
    pairs = materialize(_open_pairs(spread, percent).distinct(), "pairs")
    if not pairs.isEmpty():
        ids = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c")))
        texts = _of(docs, spark.sparkContext.broadcast(key_bits(ids, F.col("c"))))
        links = links.unionByName(materialize(_checked(texts, pairs, words, percent), "late-links"))
        roots = materialize(components(links), "components")

    named = share_join(rows.where("n > 0 and doc_id is not null"), classes, ["f1", "f2", "n"])
    named = named.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", "n", F.coalesce("root", "rep").alias("component"))
    alone = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component"))
    return named.unionByName(alone).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
