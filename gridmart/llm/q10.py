"""Query of the unigram token counts (a dynamic program: no SQL oracle)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.token_counts import count_tokens

NAME = "op10_token_counts"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
