"""Offset-preserving SentencePiece encoding and decoding of documents."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import map_rows, table
from ordermill.llm.pieces import pieces

MODEL = "piece_bpe_32k.model"


def encode_documents(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    begin: bool = True,
    end: bool = True,
) -> DataFrame:
    """Ids, source spans and decoded text of every whole text.

    Returns doc_id, `ids` (little-endian unsigned 32-bit integers, begin and end included),
    `starts` and `ends` (likewise: byte offsets in the original UTF-8 text, one per id) and `decoded`.
    Begin and end have empty spans at the text's two ends. A NULL text counts as empty; an empty text
    has the begin and end ids alone and decodes to an empty text. NULL or repeated ids stay as they are: every
    input row gives one output row. Other columns are not carried. `model` is a path all workers have.
    """

    def start():
        tool = pieces(model)
        first = np.array([tool.library.bos_id()] if begin else [], "<u4")
        last = np.array([tool.library.eos_id()] if end else [], "<u4")

        def row(doc_id, text):
            text = text or ""
            body = np.frombuffer(tool.encode(text), "<u4")
            starts, ends = tool.spans(text, body)
            size = len(text.encode())
            ids = np.concatenate([first, body, last])
            edges = np.zeros(len(first)), np.full(len(last), size)
            return (
                doc_id,
                ids.tobytes(),
                np.concatenate([edges[0], starts, edges[1]]).astype("<u4").tobytes(),
                np.concatenate([edges[0], ends, edges[1]]).astype("<u4").tobytes(),
                tool.library.decode(ids.tolist()),
            )

        return row

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(kept, "doc_id long, ids binary, starts binary, ends binary, decoded string", start)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of all documents, with the ids' spans as a further digest."""
    encoded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("starts", "ends"), 256).alias("spans_sha256"),
    )
