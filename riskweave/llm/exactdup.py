"""Exact duplicates by a keyed state that lives on disk and never expires.

The table is followed as a stream of files. The state has one entry per digest: the identifier of
the row that stays, the place of its content (file and row) and the number of rows seen. It is a
streaming aggregate in RocksDB, so a later run on the same checkpoint reads new files only, and a
lost executor loads its part again from the checkpoint. A digest is only a hint: whenever several
rows share one, every row's text is compared whole with the text at the retained place, and rows
that differ form groups of their own in another round.

Everything here is columns and streams; no Python code meets a row.

Odd rows: a null text counts as empty. A null id ranks below every other. Rows that repeat the id
and the text are told apart by their place, and of them the last place stays, so exactly one row of
a group is kept. An empty table gives no rows. Only the id and the text are read, so further columns
of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.skewed import HEAVY
from riskweave.operators.skew import all_parts, part_of
from riskweave.session import materialize, scratch_path

#: Rows of a group that are compared with one copy of the retained text.
ROWS_PER_COPY = 256
#: Bits of the filter that spares rows without a partner a shuffle, for each group; and the most of them (8 MB).
BITS_PER_GROUP, MOST_BITS = 16, 1 << 26

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # a store would reserve megabytes on disk for logs of a few rows
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _placed(rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """``doc_id, text, file, row, digest`` of a scan; a table of strays brings its first places along."""
    if "_file" in rows.columns:
        place = [F.col("_file").alias("file"), F.col("_row").alias("row")]
    else:
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    read = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *place)
    return read.withColumn("digest", digest(F.col("text")))


def follow(spark: SparkSession, path: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha, files_per_batch: int | None = None) -> DataFrame:
    """Bring the state at ``checkpoint`` up to the files of ``path`` and return it: ``digest, keep, n``.

    ``keep`` is ``(doc_id, file, row)`` of the row that stays. ``files_per_batch`` bounds what a
    micro-batch reads; without it all new files make one.
    """
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    # the source takes folders and patterns; a pattern stands for a single file as well
    rows = _placed(stream.parquet(f"{path[:-1]}[{path[-1]}]"), id_col, text_col, digest)
    kept = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    with _settings(spark, STATE_SETTINGS):
        query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n"))


def _may_repeat(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """``rows`` with ``_may``: false only if no group has their digest. The filter's size follows the number of groups."""
    bits = min(MOST_BITS, 1 << max(10, (BITS_PER_GROUP * n_groups).bit_length()))

    def bit() -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(bits))

    words = groups.select(bit().alias("b")).groupBy(F.shiftright("b", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("_mask"))
    met = rows.withColumn("_b", bit()).withColumn("_word", F.shiftright("_b", 6)).join(F.broadcast(words), "_word", "left")
    has = F.coalesce(F.expr("(shiftrightunsigned(_mask, cast(_b & 63 as int)) & 1) = 1"), F.lit(False))
    return met.withColumn("_may", has).drop("_word", "_b", "_mask")


def _round(spark: SparkSession, path: str, id_col: str, text_col: str, digest: Callable[[Column], Column], files_per_batch: int | None) -> tuple[DataFrame, DataFrame]:
    """Settled rows of one round, and the rows whose text differs from the one retained for their digest."""
    state = follow(spark, path, scratch_path(spark, "digests"), id_col, text_col, digest, files_per_batch)
    groups = materialize(state.where("n > 1"), "groups")
    n_groups, n_rows = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    seen = _may_repeat(_placed(spark.read.parquet(path), id_col, text_col, digest), groups, n_groups).withColumn("text_sha256", sha(F.col("text")))
    place = ["doc_id", "file", "row", "digest", "text_sha256"]

    # digests of more than 1/HEAVY of the grouped rows number HEAVY at most; their rows are not moved to find the entry
    limit = max(ROWS_PER_COPY, n_rows // HEAVY)
    heavy = F.broadcast(groups.where(F.col("n") > limit).limit(HEAVY))
    open_rows = seen.where("_may").select(*place, "text")
    met = open_rows.join(heavy, "digest").unionByName(
        open_rows.join(heavy, "digest", "left_anti").join(groups.where(F.col("n") <= limit), "digest", "left"))
    met = materialize(met.withColumn("text", F.when(F.col("n").isNotNull(), F.col("text"))), "members")

    is_kept = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    parts = F.ceil(F.col("n") / ROWS_PER_COPY).cast("int")
    members = met.where("n is not null")
    texts = members.where(is_kept).select("digest", all_parts(parts).alias("part"), F.col("text").alias("kept_text"))
    hits = members.where(~is_kept).withColumn("part", part_of(parts, F.col("file"), F.col("row")))
    differ = hits.join(texts, ["digest", "part"]).where("text <> kept_text")
    strays = materialize(differ.select("doc_id", "text", "digest", F.col("file").alias("_file"), F.col("row").alias("_row")), "strays")

    alone = seen.where("not _may").select(*place, F.lit(None).cast(groups.schema["keep"].dataType).alias("keep"), F.lit(None).cast("long").alias("n"))
    return alone.unionByName(met.drop("text")), strays


def exact_groups(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha, files_per_batch: int | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, file, row`` of every row of the Parquet table at ``path``.

    Rows of a group have equal texts, byte by byte; the row with the greatest id stays. ``digest``
    may be any function of the text: a weak one costs more rounds, never another result.
    """
    done: list[DataFrame] = []
    while True:
        settled, strays = _round(spark, path, id_col, text_col, digest, files_per_batch)
        away = strays.groupBy("digest").agg(F.count("*").alias("_away"))
        more = not strays.isEmpty()
        if more:  # groups lose the rows that only shared the digest
            gone = strays.select(F.col("_file").alias("file"), F.col("_row").alias("row"))
            settled = settled.join(gone, ["file", "row"], "left_anti").join(away, "digest", "left").withColumn("n", F.col("n") - F.coalesce("_away", F.lit(0)))
        is_kept = F.col("keep").isNull() | ((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row")))
        done.append(settled.select(
            "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), is_kept.alias("kept"), "text_sha256", "file", "row"))
        if not more:
            break
        path, id_col, text_col = scratch_path(spark, "again"), "doc_id", "text"
        strays.drop("digest").write.parquet(path)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


#: The same rows for a table with unique ids.
GROUPS_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM DOCUMENTS_TABLE WINDOW same AS (PARTITION BY coalesce(text, ''))"""
