"""From raw documents to token ids: five stages, each on all its predecessor kept.

Quality classifier -> quality rules -> near-duplicates -> benchmark
decontamination -> byte-level BPE. Every stage is written as Parquet in the
folder that all executors share and read again as the next one's documents, so
a lost executor never costs a finished stage. A stage's table is deleted when
its successor is written.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.llm.byte_bpe import Vocabulary, encode
from gridmart.llm.common import shared_folder, table
from gridmart.llm.decontamination import drop_contaminated
from gridmart.llm.quality_cotraining import fit, keep_good
from gridmart.llm.quality_rules import apply_rules
from gridmart.llm.simhash_dedup import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the co-trained classifier scores below one half."""
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that a quality rule rejects."""
    return apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    v = Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return encode(docs, v, keep=("doc_id", "lang", "source"), with_digests=True).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("simhash near-dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("byte bpe", tokenize),
]

#: Fitted scores, fingerprints and merges are not in SQL; tests compare with brute force.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the ``documents`` table of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    before = None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/stage-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            _delete(spark, before)
        before = path
    return docs
