"""Query of the byte-level BPE (a merge loop: no SQL oracle)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.llm.byte_bpe import Vocabulary, encode
from gridmart.llm.common import table

NAME = "op1_byte_bpe"
SQL = None


def vocabulary() -> Vocabulary:
    return Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and of what they decode to."""
    rows = encode(table(spark, sf_dir, "documents"), vocabulary(), with_digests=True)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256")
