r"""Benchmark decontamination by template windows, as column expressions and joins only.

Every word becomes a template token: numbers, units after a number and names (capitalised words that
do not follow the end of a sentence) become typed placeholders, all else is lowered and freed of
punctuation at its ends. Windows of ``WINDOW`` tokens of a document are joined by hash with those of
the benchmark items, so a question matches whatever its numbers and names are.

Matches of a document and an item on one diagonal (document place less item place) are one occurrence.
There every value in the item's slots must stand for one value of the document; if one stands for
two, it is disputed. ``veto`` says what that costs. With "diagonal" (the query and its SQL) the whole
occurrence is chance and does not count. With "window" (the pipeline) only windows go that hold a
disputed value and differ from the item in a slot: windows without slots, and windows with all the
item's values, always count, so one altered name does not hide a copy. A document is contaminated by an item when windows
of its consistent occurrences cover ``SHARE`` percent of the item's windows, and two at least.

Items of ``SHORTEST`` to ``WINDOW``-1 words are matched whole. Shorter items, and windows with fewer
than ``LITERALS`` words that are no placeholders, say too little and match nothing. Null and empty
texts have no words. Rows are told apart by id and a hash of the text, so rows that share an id, or
have none, are judged each by its own words. A pair is given once per id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import id_text
from riskweave.llm.quality import GAP
from riskweave.session import materialize

WINDOW, SHORTEST, LITERALS = 8, 4, 4
SHARE = 20
#: Windows of the benchmark that may be broadcast (a few tens of bytes each).
BROADCAST_ROWS = 1_000_000
FILTER_BITS = 1 << 23

NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
# Punctuation at the ends of words, and units.
EDGES = ".,;:!?()[]{}<>\"'`*_~|"
ENDS = (".", "!", "?", ":")
UNITS = (
    "%", "percent", "degrees", "cm", "mm", "m", "km", "meter", "meters", "metre", "metres", "kilometers", "kilometres", "mile", "miles", "inch", "inches", "foot", "feet", "yards",
    "g", "kg", "mg", "gram", "grams", "kilograms", "ton", "tons", "pound", "pounds", "ounces", "l", "ml", "liter", "liters", "litre", "litres", "gallon", "gallons",
    "s", "ms", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur", "kb", "mb", "gb", "hz", "khz", "watts", "volts", "kmh", "mph")
NUMBER = r"^[+-]?[$€£]?[0-9][0-9.,:/]*%?$"


def _core(word: Column) -> Column:
    return F.btrim(word, F.lit(EDGES))


def _before(words: str, i: Column) -> Column:
    return F.coalesce(F.get(words, i - 1), F.lit("."))


def template_tokens(words: str) -> Column:
    """Template of an array of words, token by token."""

    def token(word: Column, i: Column) -> Column:
        core = _core(word)
        first = F.left(core, F.lit(1))
        before = _before(words, i)
        return (
            F.when((F.lower(first) != first) & ~F.right(before, F.lit(1)).isin(*ENDS), NAME)
            .when(first.between("a", "z") & ~F.lower(core).isin(*UNITS), F.lower(core))
            .when(core.rlike(NUMBER), NUM)
            .when(F.lower(core).isin(*UNITS) & _core(before).rlike(NUMBER), UNIT)
            .otherwise(F.lower(core))
        )

    return F.transform(words, token)


def _keyed(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, print, text``: rows with the same id and print are equal."""
    return id_text(rows, id_col, text_col).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("print"), "text")


def templates(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, print, words, tokens``."""
    split = _keyed(rows, id_col, text_col).select("id", "print", F.filter(F.split(F.coalesce("text", F.lit("")), GAP), lambda w: w != "").alias("words"))
    return split.withColumn("tokens", template_tokens("words"))


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """``id, print, at, hash`` of every window; ``rows`` has ``id, print, tokens``."""
    starts = F.sequence(F.lit(0), F.size("tokens") - width)
    # one access per token: slice() would copy the whole array for every window
    hashes = F.when(F.size("tokens") >= width, F.transform(starts, lambda i: F.xxhash64(*[F.get("tokens", i + k) for k in range(width)])))
    return rows.select("id", "print", F.posexplode(hashes).alias("at", "hash"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, at, width, hash, of, slots``: windows that say enough, and what fills their slots."""
    items = templates(benchmark, id_col, text_col).where(F.size("tokens") >= SHORTEST).withColumn("width", F.least(F.size("tokens"), F.lit(WINDOW)))
    starts = F.sequence(F.lit(0), F.size("tokens") - F.col("width"))
    cut = items.select("id", "words", "tokens", "width", F.explode(starts).alias("at")).select(
        "id", "at", "width", F.slice("tokens", F.col("at") + 1, F.col("width")).alias("t"), F.slice("words", F.col("at") + 1, F.col("width")).alias("w"))
    placeholder = F.transform("t", lambda x: x.isin(NUM, UNIT, NAME))
    cut = cut.withColumn("p", placeholder).where(F.size(F.filter("p", lambda p: ~p)) >= LITERALS)
    slots = F.filter(F.transform("w", lambda w, k: F.when(F.get("p", k), F.struct(k.alias("k"), F.get("t", k).alias("kind"), F.lower(_core(w)).alias("value")))), lambda s: s.isNotNull())
    kept = cut.select(F.col("id").alias("item"), "at", "width", F.xxhash64("t").alias("hash"), slots.alias("slots"))
    return kept.join(kept.groupBy("item").agg(F.count("*").alias("of")), "item")


def marked(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_may``: whether their key may be among ``keys``, told without a shuffle of ``rows``.

    A bit filter of ``FILTER_BITS`` bits in words of 64, as a table: at most ``FILTER_BITS`` / 64
    rows whatever the input, joined by broadcast. Nulls count as zero.
    """
    def bit(column: str) -> Column:
        return F.pmod(F.coalesce(F.col(column), F.lit(0)), F.lit(FILTER_BITS))

    words = keys.select(bit(key).alias("b")).groupBy(F.shiftright("b", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("_mask"))
    placed = rows.withColumn("_b", bit(key)).withColumn("_word", F.shiftright("_b", 6))
    met = placed.join(F.broadcast(words), "_word", "left")
    has = F.coalesce(F.expr("(shiftrightunsigned(_mask, cast(_b & 63 as int)) & 1) = 1"), F.lit(False))
    return met.withColumn("_may", has).drop("_word", "_b", "_mask")


def _row() -> Column:
    """What tells rows apart, as one number."""
    return F.xxhash64("id", "print")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["print"] == b["print"])


def without(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows whose id and text are not among ``keys`` (``id, print``); only rows that may be are shuffled."""
    other = materialize(keys.select("id", "print").distinct(), "keys")
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("print"), F.struct("*").alias("_row"))
    seen = marked(keyed.withColumn("_key", _row()), other.select(_row().alias("_key")), "_key")
    open_rows = seen.where("_may")
    kept = open_rows.join(other, _same(open_rows, other), "left_anti")
    return seen.where("not _may").unionByName(kept).select("_row.*")


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", veto: str = "diagonal") -> DataFrame:
    """``id, print, item, n_matched, of, n_slots, n_changed`` of contaminated pairs, for each distinct row.

    ``n_matched`` counts distinct windows of the item, ``n_slots`` its slot values that were met and
    ``n_changed`` those for which the document has another value; under veto "window" both leave
    disputed values out.
    """
    if veto not in ("diagonal", "window"):
        raise ValueError(f"veto {veto!r}")
    items = materialize(benchmark_windows(benchmark, item_col, item_text_col), "benchmark-windows")
    n_windows = items.count()
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # at most five widths
    side = F.broadcast(items) if n_windows <= BROADCAST_ROWS else items

    rows = templates(docs, id_col, text_col).select("id", "print", "tokens")
    found = None
    for width in widths or [WINDOW]:
        met = _windows(rows, width).join(side.where(F.col("width") == width).select("item", F.col("at").alias("item_at"), "hash", "of", F.size("slots").alias("n_slots")), "hash")
        met = met.select("id", "print", "at", "item", "item_at", "of", "n_slots", (F.col("at") - F.col("item_at")).alias("diagonal"))
        found = met if found is None else found.unionByName(met)
    found = materialize(found, "template-matches")

    # occurrences with slots need the words of their documents
    open_matches = found.where("n_slots > 0").groupBy("id", "print").agg(F.collect_set(F.struct("at", "item", "item_at", "diagonal")).alias("matches"))
    open_matches = materialize(open_matches, "open-matches")
    words = marked(_keyed(docs, id_col, text_col).withColumn("_key", _row()), open_matches.select(_row().alias("_key")), "_key").where("_may").drop("_may", "_key")
    met = words.join(open_matches, _same(words, open_matches)).select(
        words["id"], words["print"], F.filter(F.split(F.coalesce("text", F.lit("")), GAP), lambda w: w != "").alias("words"), F.explode("matches").alias("m"))
    # the window's own words, at most eight, go on
    met = met.select("id", "print", "m.*", F.slice("words", F.col("m.at") + 1, WINDOW).alias("here"))
    met = met.join(side.select("item", F.col("at").alias("item_at"), "slots"), ["item", "item_at"])
    # a window with a changed value, else null
    altered = F.when(F.exists("slots", lambda s: F.lower(_core(F.get("here", s.k))) != s.value), F.col("item_at"))
    filled = met.select("id", "print", "item", "diagonal", "here", altered.alias("altered"), F.explode("slots").alias("s")).select(
        "id", "print", "item", "diagonal", "altered", "s.kind", "s.value", F.lower(_core(F.get("here", F.col("s.k")))).alias("met"))
    per_window = veto == "window"
    places = [F.collect_set("altered").alias("altered")] if per_window else []
    slots = filled.groupBy("id", "print", "item", "diagonal", "kind", "value").agg(F.min("met").alias("low"), F.max("met").alias("high"), *places)
    one = F.col("low") == F.col("high")
    counted = one if per_window else F.lit(True)
    chance = F.array_distinct(F.flatten(F.collect_list(F.when(~one, F.col("altered"))))) if per_window else F.lit(None).cast("array<int>")
    judged = slots.groupBy("id", "print", "item", "diagonal").agg(
        F.bool_and(one).alias("consistent"), F.count_if(counted).alias("n_slots"), F.count_if(counted & (F.col("low") != F.col("value"))).alias("n_changed"), chance.alias("chance"))
    judged = materialize(judged, "template-slots")

    per = found.groupBy("id", "print", "item", "diagonal", "of").agg(F.collect_set("item_at").alias("places"))
    same = _same(per, judged) & (per["item"] == judged["item"]) & (per["diagonal"] == judged["diagonal"])
    per = per.join(judged, same, "left").select(per["id"], per["print"], per["item"], "of", "places", "n_slots", "n_changed", "consistent", "chance")
    if per_window:
        per = per.withColumn("places", F.when(F.col("chance").isNull(), F.col("places")).otherwise(F.array_except("places", "chance"))).where(F.size("places") > 0)
    else:
        per = per.where("consistent is null or consistent")
    pairs = per.groupBy("id", "print", "item", "of").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_matched"),
        F.coalesce(F.max("n_slots"), F.lit(0)).cast("long").alias("n_slots"), F.coalesce(F.max("n_changed"), F.lit(0)).cast("long").alias("n_changed"))
    return pairs.where((100 * F.col("n_matched") >= SHARE * F.col("of")) & (F.col("n_matched") >= F.least(F.lit(2), F.col("of"))))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", veto: str = "diagonal") -> DataFrame:
    """``doc_id, item_id, n_matched, n_windows, n_slots, n_changed`` of contaminated pairs, once per id.

    Where rows with other texts share an id, the counts are the largest of any of them.
    """
    rows = contaminated_rows(docs, benchmark, id_col, text_col, item_col, item_text_col, veto)
    counts = rows.groupBy("id", "item", "of").agg(*[F.max(c).alias(c) for c in ("n_matched", "n_slots", "n_changed")])
    return counts.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_matched", F.col("of").alias("n_windows"), "n_slots", "n_changed")


def _sql_windows(table: str, key: str) -> str:
    """SQL for all windows of a table: its key, place, words and template."""
    core, before = "trim(word, edges)", "trim(before, edges)"
    units = "(" + ", ".join(f"'{u}'" for u in UNITS) + ")"
    ends = "(" + ", ".join(f"'{x}'" for x in ENDS) + ")"
    token = (
        f"CASE WHEN lower({core}[1]) <> {core}[1] AND before[-1] NOT IN {ends} THEN '{NAME}' "
        f"WHEN regexp_matches({core}[1], '^[a-z]$') AND lower({core}) NOT IN {units} THEN lower({core}) "
        f"WHEN regexp_matches({core}, '{NUMBER}') THEN '{NUM}' "
        f"WHEN lower({core}) IN {units} AND regexp_matches({before}, '{NUMBER}') THEN '{UNIT}' ELSE lower({core}) END")
    return rf"""
SELECT * FROM (
  SELECT {key}, place, list(word) OVER seen AS w, list(token) OVER seen AS t FROM (
    SELECT *, {token} AS token FROM (
      SELECT *, lag(word, 1, '.') OVER (PARTITION BY row_no ORDER BY place) AS before FROM (
        SELECT row_no, {key}, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM (
          SELECT row_number() OVER () AS row_no, {key}, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM {table}))), e)
  WINDOW seen AS (PARTITION BY row_no ORDER BY place ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING))
WHERE len(t) = {WINDOW}"""


#: The pairs of ``contaminated`` in DuckDB SQL over DOCUMENTS_TABLE, for items of WINDOW words and more.
CONTAMINATED_SQL = rf"""
WITH e AS (SELECT '{EDGES.replace("'", "''")}' AS edges),
b AS ({_sql_windows("benchmark", "item_id")}
      AND len(list_filter(t, lambda x: x NOT IN ('{NUM}', '{UNIT}', '{NAME}'))) >= {LITERALS}),
bo AS (SELECT item_id, place, w, t, count(*) OVER (PARTITION BY item_id) AS total FROM b),
d AS ({_sql_windows("DOCUMENTS_TABLE", "doc_id")}),
m AS (SELECT d.doc_id, d.w AS dw, bo.w AS bw, bo.t, bo.item_id, bo.place AS item_place, d.place - bo.place AS diagonal, bo.total FROM d JOIN bo ON d.t = bo.t),
s AS (SELECT doc_id, item_id, diagonal, t[k] AS kind, lower(trim(bw[k], edges)) AS value, lower(trim(dw[k], edges)) AS met
      FROM (SELECT *, unnest(range(1, {WINDOW + 1})) AS k FROM m), e WHERE t[k] IN ('{NUM}', '{UNIT}', '{NAME}')),
v AS (SELECT doc_id, item_id, diagonal, kind, value, min(met) AS low, max(met) AS high FROM s GROUP BY ALL),
j AS (SELECT doc_id, item_id, diagonal, bool_and(low = high) AS consistent, count(*) AS n_slots, count(*) FILTER (low <> value) AS n_changed FROM v GROUP BY ALL),
p AS (SELECT m.doc_id, m.item_id, m.total, m.item_place, j.n_slots, j.n_changed FROM m
      LEFT JOIN j ON m.doc_id IS NOT DISTINCT FROM j.doc_id AND m.item_id = j.item_id AND m.diagonal = j.diagonal WHERE j.consistent IS NULL OR j.consistent)
SELECT doc_id, item_id, count(DISTINCT item_place)::BIGINT AS n_matched, total::BIGINT AS n_windows,
       coalesce(max(n_slots), 0)::BIGINT AS n_slots, coalesce(max(n_changed), 0)::BIGINT AS n_changed
FROM p GROUP BY doc_id, item_id, total
HAVING 100 * count(DISTINCT item_place) >= {SHARE} * total AND count(DISTINCT item_place) >= least(2, total)
"""
