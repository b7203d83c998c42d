"""Ranked lexical search, reversed: the documents stream past the items.

The items' terms make an inverted index (term -> items) that every task gets. A
first pass over the documents counts, for these terms, the documents that hold
them, and all documents and terms. A second pass streams each document's term
counts through the index: a found term adds its part of the score to the items
that have it, and a document that beats an item's worst kept one enters the
item's heap. A task hands on at most ``top`` documents per item; the heaps are
merged in two steps, first within groups of tasks. No text is shuffled.

The index of one pass is at most about ``PASS_BYTES`` of terms: more items go out
in more passes over the documents, each one's result written and its index
released before the next. An item alone may be larger: it is one row's text, or
those of one id.

Scores are 64-bit integers (see ``part`` and ``weight``). Terms are runs of ASCII
letters, digits and any character beyond ASCII; A-Z are lower-cased.

Edge cases: a null or empty text has no terms and is no document that counts; an
item without terms has no results; items of one id (null is one) are one item, with
the terms of all; rows of documents with one id rank each on their own; a null
doc_id comes after the others at equal scores; empty tables give no rows; extra
columns are ignored, whatever their names; a text of any length counts whole.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from gridmart.llm.common import release, staged

PASS_BYTES = 8 << 20
#: Groups of tasks whose heaps are merged first.
MERGE_GROUPS = 64
_WORD = bytes((*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)))
#: Byte -> itself, lower-cased if A-Z; a blank for a byte that parts terms.
_TERM_BYTES = bytes(b if b in _WORD else 0x20 for b in range(256)).translate(
    bytes.maketrans(ascii_uppercase.encode(), ascii_lowercase.encode()))
_NULL = 2**63 - 1


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    """A term's weight: rarer is more."""
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(n: int, documents: int, total: int) -> int:
    return 10 + (90 * n * documents) // total


def part(tf: np.ndarray, m: int) -> np.ndarray:
    """What a term with ``tf`` occurrences adds, before its weight."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item, terms`` (array of binaries, each term once) of every item with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms(t or b""))) for t in _texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "term"])

    kind = T.StructType([T.StructField("item", items.schema[key].dataType),
                         T.StructField("term", T.ArrayType(T.BinaryType()))])
    each = items.select(F.col(key).alias("item"), F.col(text).alias("text")).mapInArrow(run, kind)
    return each.select("item", F.explode("term").alias("term")).groupBy("item").agg(F.collect_set("term").alias("terms"))


def _statistics(docs: DataFrame, known: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with terms, their terms, and for every known term the documents that hold it."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        held, n, total = np.zeros(len(number) + 2, dtype=np.int64), 0, 0
        for b in batches:
            for t in _texts(b.column(0)):
                found = terms(t or b"")
                n, total = n + bool(found), total + len(found)
                at = [number[x] for x in number.keys() & set(found)]
                held[at] += 1
        held[-2:] = n, total
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["term", "n"])

    out = np.zeros(len(known) + 2, dtype=np.int64)
    for r in docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]  # a row per term of the index
    sent.destroy()
    return int(out[-2]), int(out[-1]), out[:-2]


class Heaps:
    """The best documents of every item: (score, -doc_id), a heap per item, its size bounded."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.heaps = top, [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)  # a lower score cannot enter

    def update(self, doc: int, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            heap, entry = self.heaps[i], (int(scores[i]), -doc)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]


def _search_pass(docs: DataFrame, items: list, top: int) -> DataFrame:
    """``item (number in items), doc, score``: every task's best documents of every item."""
    spark = docs.sparkSession
    known = {t: k for k, t in enumerate(sorted({t for r in items for t in r["terms"]}))}
    documents, total, held = _statistics(docs, known)
    postings: list[list[int]] = [[] for _ in known]
    for i, r in enumerate(items):
        for t in r["terms"]:
            postings[known[t]].append(i)
    index = {t: (np.array(postings[k], dtype=np.int64), weight(documents, int(held[k])))
             for t, k in known.items() if held[k]}
    sent = spark.sparkContext.broadcast(index)
    count = len(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, heaps = sent.value, Heaps(count, top)
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), _texts(b.column(1))):
                found = terms(t or b"")
                tf = Counter(found)
                hits = [x for x in tf if x in index]
                if not hits:
                    continue
                parts = part(np.array([tf[x] for x in hits], dtype=np.int64), length_norm(len(found), documents, total))
                scores = np.zeros(count, dtype=np.int64)
                for x, value in zip(hits, parts.tolist()):
                    at, w = index[x]
                    scores[at] += w * value  # an item stands in a posting list once
                heaps.update(_NULL if doc is None else doc, scores)
        rows = [(i, -doc, s) for i, heap in enumerate(heaps.heaps) for s, doc in heap]
        own = TaskContext.get().partitionId() % MERGE_GROUPS
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (*zip(*rows), [own] * len(rows))], names=["item", "doc", "score", "merge"])

    def best(rows: DataFrame, *group: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "doc"))
        return rows.withColumn("rank", rank).where(F.col("rank") <= top)

    found = docs.select("doc", "text").mapInArrow(run, "item long, doc long, score long, merge long")
    out = staged(best(best(found, "item", "merge").drop("rank"), "item").drop("merge"))
    sent.destroy()
    return out


def search(items: DataFrame, docs: DataFrame, top: int = 10, item_key: str = "item_id", doc_key: str = "doc_id",
           text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents (score above 0) of every item."""
    spark = docs.sparkSession
    listed = staged(item_terms(items, item_key, text))
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t) + 8)
    whole = listed.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    passes = -(-whole // pass_bytes)
    schema = T.StructType([T.StructField(item_key, items.schema[item_key].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField(doc_key, docs.schema[doc_key].dataType), T.StructField("score", T.LongType())])
    rows = docs.select(F.col(doc_key).cast("long").alias("doc"), F.col(text).alias("text"))
    parts = []
    for p in range(passes):
        own = F.pmod(F.xxhash64("item"), F.lit(passes)) == p
        batch = listed.where(own).collect()  # one pass's share of the items' terms
        if not batch:
            continue
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(batch)],
                                      T.StructType([T.StructField("item", T.LongType()), T.StructField("name", schema[0].dataType)]))
        parts.append(_search_pass(rows, batch, top).join(names, "item"))
    release(listed)
    if not parts:
        return spark.createDataFrame([], schema)
    doc = F.when(F.col("doc") != _NULL, F.col("doc")).cast(schema[2].dataType)
    return reduce(DataFrame.unionByName, parts).select(
        F.col("name").alias(item_key), F.col("rank").cast("int").alias("rank"), doc.alias(doc_key), "score")
