"""Token counts and SentencePiece encoding of whole texts.

Null and empty texts have no tokens and decode to an empty text. Repeated rows stay repeated. Only
the id and the text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm.common import id_text, map_texts
from riskweave.llm.pieces import loaded

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A model file is a few hundred kilobytes; it is shipped to the executors whole.
MODEL_LIMIT = 64 << 20


def read_model(spark: SparkSession, path: str):
    """Model bytes as a broadcast value, read through Spark so that any store will do."""
    row = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").where(f"length <= {MODEL_LIMIT}").first()
    if row is None:
        raise ValueError(f"no model file below {MODEL_LIMIT} bytes at {path}")
    return spark.sparkContext.broadcast(bytes(row["content"]))


def token_counts(docs: DataFrame, model: str = MODEL, rule: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, n_tokens, score``: ids a tokenizer gives for a text, without building them.

    ``rule`` overrides the selection rule that the model file names (see ``pieces``). ``score`` is
    the sum of the scores of the pieces chosen; byte pieces count by the unknown penalty.
    """
    shipped = read_model(docs.sparkSession, model)

    def start():
        pieces = loaded(shipped.value, rule)
        return lambda text: (len(text), *pieces.count(text))

    return map_texts(id_text(docs, id_col, text_col), start, "doc_id long, n_chars long, n_tokens long, score double")


def encode(docs: DataFrame, model: str = MODEL, rule: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_ids, ids, restored``: ids of a text and whether decoding them gives it back.

    A text that holds U+2581 itself decodes to spaces there, as in the public library, and is
    reported as not restored.
    """
    shipped = read_model(docs.sparkSession, model)

    def start():
        pieces = loaded(shipped.value, rule)

        def work(text):
            ids = pieces.encode(text)
            return len(ids), ids, pieces.decode(ids) == text

        return work

    return map_texts(id_text(docs, id_col, text_col), start, "doc_id long, n_ids long, ids array<int>, restored boolean")


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: texts of id sequences; a null sequence gives an empty text."""
    shipped = read_model(encoded.sparkSession, model)

    def start():
        pieces = loaded(shipped.value)
        return lambda ids: (pieces.decode(ids or ()),)

    return map_texts(encoded.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{ids_col}` text"), start, "doc_id long, text string")
