"""Byte-level BPE against the library and by round trip."""

import hashlib
import struct

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from gridmart.llm import byte_bpe as B

TEXTS = [None, "", " ", "a", "it's we'll 'S", "<|endoftext|>", "\x00\x01 \x1c\x1d", "  two  spaces \n\n\t", "日本語 ἀρχή 𝄞🙂",
         " nbsp　wide  ", "1234567 ½ ٣", "é ﻿", "=" * 700, "x" * 600, "qzjxkv" * 60, "can't  stop"]


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.read(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


@pytest.mark.parametrize("cached", [0, 3, 1 << 17])
def test_texts_match_the_library_and_round_trip(spark, vocabulary, library, cached):
    rows = [(i, t, 1, "x", "y") for i, t in enumerate(TEXTS * 2)] + [(None, "null id", 1, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, words string, __llm_text string")
    out = B.encode(df, vocabulary, cache_limit=cached).select(
        "doc_id", "ids", B.decode(F.col("ids"), vocabulary).alias("back"),
        B.digests(F.col("ids"), vocabulary).alias("d")).collect()
    want = {i: t or "" for i, t, *_ in rows}
    assert len(out) == len(rows)
    made = B.encode(df, vocabulary, cache_limit=cached, with_digests=True).collect()
    assert [(r.doc_id, r.ids, r.ids_sha256, r.decoded_sha256) for r in made] == [(r.doc_id, r.ids, *r.d) for r in out]
    for r in out:
        assert list(r.ids) == library.encode_ordinary(want[r.doc_id])
        assert bytes(r.back).decode() == want[r.doc_id]
        assert r.d.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


def test_kept_columns_pass_whatever_their_names(spark, vocabulary):
    df = spark.createDataFrame([("a b", 1, "w", 2.5), (None, None, None, None)], "text string, numbers int, words string, k0 double")
    got = B.encode(df, vocabulary, keep=("words", "numbers", "k0", "text")).collect()
    assert got[0].asDict() | {"ids": None} == {"words": "w", "numbers": 1, "k0": 2.5, "text": "a b", "ids": None}
    assert list(got[1]) == [None, None, None, None, []]


def test_cached_words_stay_below_the_bound(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n = B.frequent_words(docs, vocabulary, limit=500).num_rows
    assert 0 < n <= 500 < B.frequent_words(docs, vocabulary).num_rows


@pytest.mark.parametrize("bound", [1, 5, 1000])
def test_numbers_come_back_as_ids_however_often_a_task_starts_anew(monkeypatch, library, bound):
    monkeypatch.setattr(B, "TASK_WORDS", bound)
    monkeypatch.setattr(B, "_NUMBERED", 9 * bound)
    monkeypatch.setattr(B, "_LOOKED_UP", 4)
    cached = ["the", " a"]
    rows = [(i, [f"w{(i * k) % 11}" for k in range(i % 5)] + ["the"] * (i % 2)) for i in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part], pa.list_(pa.string()))],
                                          names=["k0", "pre_tokens"]) for part in (rows[:7], rows[7:7], rows[7:30], rows[30:])]
    folds = []

    def folded(batch):
        words = batch.column("words").to_pylist()
        folds.extend(w for ws in words for w in ws or ())
        ids = pa.array([None if ws is None else [library.encode_ordinary(w) for w in ws] for ws in words], pa.list_(pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column("base"), ids], names=["k0", "numbers", "base", "ids"])

    mid = pa.Table.from_batches(map(folded, B._numbered(iter(batches), pa.array(cached)))).combine_chunks()
    ids = pa.array([library.encode_ordinary(w) for w in cached], pa.list_(pa.int32()))
    for size in (4, 1000):  # Spark may cut the rows into other batches in between
        out = list(B._looked_up(iter(mid.to_batches(size)), ids))
        assert [k for part, _ in out for k in part["k0"].to_pylist()] == [k for k, _ in rows]
        assert [i for _, part in out for i in part.to_pylist()] == [sum(map(library.encode_ordinary, ws), []) for _, ws in rows]
    assert bound < 1000 or sorted(folds) == sorted({w for _, ws in rows for w in ws} - set(cached))


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.encode(df, vocabulary).collect() == []
