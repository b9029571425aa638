"""One named query per corpus operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontam, divergence, exactdup, jaccard, licenses, periodic, pii, quality, secrets, substrings, tokens, toxicity
from riskweave.llm.common import documents


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def _of(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))


def _span_report(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    counts = [F.size(_of(F.col("spans"), (k,))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(_listed(_of(F.col("spans"), kinds)), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_report(documents(spark, sf_dir))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the ids, told by their checksum, teaches nothing."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table has no paths: source, language and thousands of the id serve as directories.

    A document of at most 12 words with a licence cue stands for a licence file of its directory.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    notice = (F.size(F.split("text", r"[\x20\x09-\x0D]+", 14)) <= 12) & F.col("text").rlike(licenses.CUE)
    name = F.concat(F.when(notice, F.lit("LICENSE-")).otherwise(F.lit("doc-")), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), name)
    found = licenses.scan(docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text"))
    return found.withColumnRenamed("file", "doc_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(documents(spark, sf_dir))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_report(secrets.find_secrets(documents(spark, sf_dir)), secrets.BASE_KINDS)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_report(pii.find_personal_data(documents(spark, sf_dir)), pii.BASE_KINDS)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(spark, f"{sf_dir}/documents.parquet").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the documents, told by the checksum of the id, gets a tail of repeated words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def plan(s: Column) -> Column:  # names bound once for the whole text
        n = F.size(s.words).cast("long")
        return F.struct(s.words, s.g, n.alias("n"), (s.g % n).alias("a"))

    def tail(s: Column) -> Column:
        period = 1 + F.floor((s.n - s.a) / (3 + s.g % 8))
        return F.struct(s.words, s.n, s.a, period.alias("p"))

    def repeat(s: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), s.n - 1), lambda i: F.get(s.words, F.when(i < s.a, i).otherwise(s.a + (i - s.a) % s.p).cast("int"))), " ")

    bound = F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g")))
    for step in (plan, tail, repeat):
        bound = F.transform(F.filter(bound, lambda s: F.size(s.words) > 0) if step is plan else bound, step)
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(F.get(bound, 0), F.lit(""))).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_planted(documents(spark, sf_dir)))
    none = F.lit(None).cast(found.schema["runs"].dataType.elementType)
    # by exact comparison of length / period; of equal ones the first stays
    best = F.reduce("runs", none, lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_token_counts": op6_token_counts,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_secret_scan": op9_secret_scan,
    "op10_personal_data": op10_personal_data,
    "op11_source_divergence": op11_source_divergence,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op5_license_scan": licenses.SCAN_SQL.replace("FILES_TABLE", rf"""(
        SELECT doc_id AS file, text, concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR,
          CASE WHEN len(string_split_regex(text, '[\x20\x09-\x0D]+')) <= 12 AND regexp_matches(text, '{licenses.CUE}') THEN 'LICENSE-' ELSE 'doc-' END || doc_id::VARCHAR) AS path
        FROM documents)""").replace("SELECT file, coalesce(license, their", "SELECT file AS doc_id, coalesce(license, their"),
    "op2_decontaminate": decontam.CONTAMINATED_SQL.replace("DOCUMENTS_TABLE", "documents"),
    "op4_quality_rules": quality.VERDICT_SQL.format(documents="documents"),
    "op11_source_divergence": divergence.AUDIT_SQL.replace("DOCUMENTS_TABLE", "documents"),
    "op12_exact_dedup": exactdup.GROUPS_SQL.replace("DOCUMENTS_TABLE", "documents"),
}
