r"""Quality rules as a short-circuit cascade of column expressions.

Words are maximal runs of ``[^\x20\x09-\x0D]``, lines are cut at ``\n`` and count when they hold a
word. The measures come from array functions inside a row, so nothing is shuffled. Each rule
rejects by an expression of its own; a sample tells what a rule costs and how often it rejects, and
the cascade tries the rule with the most rejections per second first. A row stops at its first
rejection. The order changes the work only, never which rows are kept.

Null texts are empty. An empty text has no words and fails the base rule. Repeated rows stay
repeated; rows with a null id are measured as any other.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rows on which cost and selectivity are estimated.
SAMPLE_ROWS = 1_000


class Rule(NamedTuple):
    """A rule rejects a row when ``rejects`` holds; it may use the measures, ``text``, ``words`` and ``lines``."""

    name: str
    rejects: Callable[[], Column]


def _share(name: str, array: str, pattern: str, percent: int, fewer: bool) -> Rule:
    """More (or fewer) than ``percent`` of the entries of an array match a pattern."""

    def rejects() -> Column:
        matching = F.size(F.filter(array, lambda x: x.rlike(pattern))) * 100
        bound = F.size(array) * percent
        return matching < bound if fewer else matching > bound

    return Rule(name, rejects)


RULES = (
    Rule("symbols", lambda: F.col("n_symbols") * 10 > F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("repeated_lines", lambda: F.col("n_dup_lines") * 2 > F.size("lines")),
    _share("letters", "words", r"[A-Za-z]|[^\x00-\x7F]", 70, fewer=True),
    _share("bullets", "lines", "^ *[*•-] ", 90, fewer=False),
    _share("ellipses", "lines", r"(\.\.\.|…) *$", 30, fewer=False),
    Rule("undecoded", lambda: F.length(F.regexp_replace("text", "[^�]+", "")) * 100 > F.length("text")),
)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """``doc_id, text, words, lines`` and the five measures, all from one pass over the rows.

    With ``whole_rows`` the column ``row`` holds the input row, whatever its columns are called.
    """
    carried = ["row"] if whole_rows else []
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.struct("*").alias(c) for c in carried]).select(
        *carried, "doc_id", "text",
        F.filter(F.split("text", GAP), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    # windows of three words with their places, equal ones side by side
    starts = F.sequence(F.lit(0), F.size("words") - 3)
    spelled = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("w"), i.alias("i")))
    ordered = split.select("*", F.when(F.size("words") > 3, F.sort_array(spelled)).otherwise(F.array().cast("array<struct<w:string,i:int>>")).alias("windows"))

    def repeats(s: Column, at: Column) -> Column:
        return (F.get("windows", at - 1).w.eqNullSafe(s.w)) | (F.get("windows", at + 1).w.eqNullSafe(s.w))

    places = F.flatten(F.transform(F.filter("windows", repeats), lambda s: F.array(s.i, s.i + 1, s.i + 2)))
    return ordered.select(
        *carried, "doc_id", "text", "words", "lines",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(places)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ordered_rules(rows: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """``(rule, seconds, rejected share)``, most rejections per second first.

    The sample is the first ``sample_rows`` measured rows, taken from as few tasks as hold them.
    Seconds are those beyond a job that evaluates nothing, with a floor of a millisecond.
    """
    sample = materialize(rows.sparkSession.createDataFrame(rows.take(sample_rows), rows.schema), "rule-sample")

    def job(rejects: Column) -> tuple[float, int, int]:
        began = time.perf_counter()
        n, rejected = sample.agg(F.count("*"), F.count_if(rejects)).first()
        return time.perf_counter() - began, n, rejected

    job(F.lit(False))
    idle = job(F.lit(False))[0]
    found = []
    for rule in rules:
        seconds, n, rejected = job(rule.rejects())
        found.append((rule, max(seconds - idle, 0.001), rejected / n if n else 0.0))
    return sorted(found, key=lambda x: -x[2] / x[1])


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects the row, null when none does."""
    first = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        first = first.when(rule.rejects(), F.lit(rule.name))
    return first


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``first_failed`` (depends on the order) and ``kept``."""
    rows = measured(docs, id_col, text_col)
    order = [rule for rule, _, _ in ordered_rules(rows, rules, sample_rows)]
    return rows.select("doc_id", *MEASURES, base_failed().alias("base_failed"), cascade(order).alias("first_failed")).withColumn("kept", F.col("first_failed").isNull())


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    rows = measured(docs, id_col, text_col, whole_rows=True)
    order = [rule for rule, _, _ in ordered_rules(rows.drop("row"), rules, sample_rows)]
    # a filter would be pushed below the measures and compute them anew for every word it looks at
    return rows.select(F.explode(F.when(cascade(order).isNull(), F.array("row"))).alias("row")).select("row.*")


#: The verdict of ``judge`` in DuckDB SQL, over the table or subquery put for {documents}.
VERDICT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM {documents}),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS seen
      FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
c AS (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, seen) AS k FROM g),
r AS (SELECT row_no, count(DISTINCT place) AS n FROM (SELECT row_no, unnest([i, i + 1, i + 2]) AS place FROM c WHERE k > 1) GROUP BY row_no),
m AS (SELECT row_no, doc_id, text, words, lines, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (row_no)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             n_symbols * 10 > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR n_dup_lines * 2 > len(lines)
             OR len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) * 100 < len(words) * 70
             OR len(list_filter(lines, lambda x: regexp_matches(x, '^ *[*•-] '))) * 100 > len(lines) * 90
             OR len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) * 100 > len(lines) * 30
             OR length(regexp_replace(text, '[^�]+', '', 'g')) * 100 > length(text) AS ruled_out FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR ruled_out) AS kept FROM v
"""
