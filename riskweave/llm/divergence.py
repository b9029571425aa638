"""How the sources of a language differ in their words.

Single-pass indexing: a task reads its texts once and counts terms in memory; whenever the block is
full it is written out as a run sorted by language, term and source. Runs meet in hash shards of
(language, term), where Spark's sorted shuffle merges them, and one pass over each shard adds equal
entries and drops rare terms. Shares follow from the merged frequencies. The sum of
divergences between two sources over all kept terms is not taken term by term: it starts from the
value that holds if neither source had any of the terms and adds corrections for terms that occur,
first per source (by how often each count occurs there), then for terms both sources have.

Odd rows: null text, language or source counts as empty. Documents without terms still make their
(language, source) group. Repeated rows count repeatedly, ids are not read, an empty table gives no
rows, and further columns of any name do no harm. A long text is read in pieces; only its
distinct terms are held.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from riskweave.operators.skew import sized_join
from riskweave.session import materialize

#: Entries of a block that a task counts before it writes a run, and rows of a batch it writes.
BLOCK, BATCH = 800_000, 50_000
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
#: Least number of documents of a language that have a kept term; ranks of the term report.
LEAST_DOCS, RANKS = 3, 200
#: Fixed value: the unit of shares.
UNIT = 1_000_000_000

_KEYS = [("lang", pa.string()), ("term", pa.string()), ("source", pa.string())]
RUNS = pa.schema([*_KEYS, ("count", pa.int64()), ("docs", pa.int64())])
FREQUENCIES = pa.schema([*_KEYS, ("count", pa.int64()), ("total", pa.int64()), ("first", pa.bool_())])

#: Term bytes stay, A-Z in lower case; all other ASCII bytes become spaces.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time; cuts fall between terms."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            space = text.rfind(b" ", at, end)
            if space <= at:  # one term that long
                space = text.find(b" ", end)
            end = space if space > at else len(text)
        yield text[at:end].split()
        at = end


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of postings, each written as rows sorted by language, term and source."""
    counts: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def spilled() -> Iterator[pa.RecordBatch]:
        tables = []
        for key, terms in counts.items():
            n = len(terms)
            columns = [pa.repeat(key[0], n), pa.array(terms, pa.binary()).cast(pa.string()), pa.repeat(key[1], n), pa.array(terms.values(), pa.int64()), pa.array(map(docs[key].__getitem__, terms), pa.int64())]
            tables.append(pa.table(columns, schema=RUNS))
        counts.clear()
        docs.clear()
        if tables:
            run = pa.concat_tables(tables).sort_by([(name, "ascending") for name, _ in _KEYS])
            yield from run.combine_chunks().to_batches(BATCH)

    held = 0
    for batch in batches:
        for lang, source, text in zip(*batch.columns, strict=True):
            key = (lang.as_py(), source.as_py())
            n, d = counts.setdefault(key, Counter()), docs.setdefault(key, Counter())
            before = len(n)
            own: set[bytes] = set()
            for terms in _pieces(text.as_py().encode().translate(TERM_BYTES)):
                n.update(terms)
                own.update(terms)
            d.update(own)
            held += len(n) - before
            if held >= BLOCK:
                yield from spilled()
                held = 0
    yield from spilled()


def _starts(table: pa.Table, names: list[str]) -> np.ndarray:
    """Places of a sorted table at which any of the columns changes."""
    change = np.zeros(len(table), bool)
    change[:1] = True
    for name in names:
        values = table[name].combine_chunks()
        change[1:] |= pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def _added(table: pa.Table) -> pa.Table:
    """Equal entries as one, in order of language, term and source."""
    table = table.sort_by([(name, "ascending") for name, _ in _KEYS])
    starts = _starts(table, [name for name, _ in _KEYS])
    sums = [pa.array(np.add.reduceat(table[name].to_numpy(), starts)) for name in ("count", "docs")]
    return pa.table([*table.select(range(len(_KEYS))).take(starts).columns, *sums], schema=RUNS)


def _kept(table: pa.Table) -> pa.Table:
    """Entries of terms that enough documents have; the table holds all entries of its terms."""
    starts = _starts(table, ["lang", "term"])
    sizes = np.diff(starts, append=len(table))
    total, docs = (np.repeat(np.add.reduceat(table[name].to_numpy(), starts), sizes) for name in ("count", "docs"))
    first = np.zeros(len(table), bool)
    first[starts] = True
    out = pa.table([table[name] for name in ("lang", "term", "source", "count")] + [pa.array(total), pa.array(first)], schema=FREQUENCIES)
    return out.filter(pa.array(docs >= LEAST_DOCS))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the equal entries of a shard whose rows come sorted by language and term.

    Only the entries of the last term are carried on, one for each source.
    """
    carried = RUNS.empty_table()
    for batch in batches:
        table = _added(pa.concat_tables([carried, pa.Table.from_batches([batch], RUNS)])) if len(batch) else carried
        if not len(table):
            continue
        last = int(_starts(table, ["lang", "term"])[-1])
        carried = table.slice(last)
        if last:
            yield from _kept(table.slice(0, last)).to_batches()
    if len(carried):
        yield from _kept(carried).to_batches()


def _texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def frequencies(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, term, source, count, total, first``: occurrences of kept terms in each source that has them.

    ``total`` counts the term in the whole language, ``first`` marks one row of each term.
    """
    runs = _texts(docs, text_col, lang_col, source_col).mapInArrow(_runs, from_arrow_schema(RUNS))
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(shards, "lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merged, from_arrow_schema(FREQUENCIES))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT (count + 1) / (total + kept)), in whole numbers of any size."""
    return _div(F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), (total + kept).cast("decimal(20,0)")) + 1


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most UNIT + 1, so squares fit a long."""
    return _div((p - q) * (p - q), q)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language."""
    zero, one, other = F.col("zero"), F.col("a"), F.col("b")
    # neither source has the term: V times the same value
    a, b = groups.select("lang", "source", "kept", "zero"), groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("there"))
    base = a.join(b, "lang").where("source <> item").select("lang", "source", "item", F.coalesce(F.col("kept") * _gap(zero, F.col("there")), F.lit(0)).alias("value"))
    # one source has it: terms with the same share there count together
    spread = shares.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("m"))
    met = sized_join(spread, b, ["lang"]).where("source <> item")
    p, there = F.col("p"), F.col("there")
    ones = met.groupBy("lang", "source", "item").agg(
        F.sum(F.col("m") * (_gap(p, there) - _gap(zero, there))).alias("out"), F.sum(F.col("m") * (_gap(there, p) - _gap(there, zero))).alias("back"))
    ones = materialize(ones, "one-sided")
    # both have it: what the two one-sided corrections got wrong; a term has one entry per source at most
    posts = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "zero")).alias("posts")).where(F.size("posts") > 1)
    both = posts.select("lang", F.explode("posts").alias("a"), "posts").select("lang", "a", F.explode("posts").alias("b")).where("a.source <> b.source")
    change = _gap(one.p, other.p) - _gap(one.p, other.zero) - _gap(one.zero, other.p) + _gap(one.zero, other.zero)
    both = both.groupBy("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item")).agg(F.sum(change).alias("value"))
    parts = base.unionByName(ones.select("lang", "source", "item", F.col("out").alias("value"))).unionByName(
        ones.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value"))).unionByName(both)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others, and its telling terms.

    Part ``pair`` has every other source of the language, part ``term`` the first ``RANKS`` terms
    that are more frequent in the source than in the language.
    """
    found = materialize(frequencies(docs, text_col, lang_col, source_col), "frequencies")
    langs = found.groupBy("lang").agg(F.sum("count").alias("lang_total"), F.count_if("first").alias("kept"))
    totals = found.groupBy("lang", "source").agg(F.sum("count").alias("in_source"))
    groups = _texts(docs, text_col, lang_col, source_col).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("in_source", F.lit(0)).alias("in_source"), "lang_total", "kept")
    groups = materialize(groups.withColumn("zero", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("in_source"), F.col("kept")))), "groups")

    shares = sized_join(found, groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("in_source"), F.col("kept")))
    shares = materialize(shares.withColumn("q", _share(F.col("total"), F.col("lang_total"), F.col("kept"))).select("lang", "source", "term", "p", "q", "zero"), "shares")
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    terms = _ranked(terms).where(F.col("rank") <= RANKS)
    pairs = _ranked(_pair_values(shares, groups))
    named = [part.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, part in (("pair", pairs), ("term", terms))]
    return named[0].unionByName(named[1])


#: The same rows, with every kept term taken for every pair.
AUDIT_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM DOCUMENTS_TABLE),
words AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
full_counts AS (SELECT lang, source, term, coalesce(counts.c, 0) AS c, kept.c AS lang_c
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (SELECT lang, source, term, c, 1 + (1000000000 * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p,
    1 + (1000000000 * (lang_c + 1)) // (n + v) AS q FROM full_counts JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM shares WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM every_pair
UNION ALL
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms) WHERE rank <= 200"""
