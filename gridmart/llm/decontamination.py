"""Benchmark decontamination: SimHash windows, multi-index blocks, exact check.

A document is compared with a benchmark item through windows of the item's
length. Words are white-space separated with A-Z lower-cased; shingles are five
words (a shorter item is one shingle of its own length).

1. Windows: only those that hold at least 0.8 of the item's shingle count in
   shingles that some item has; a window below that cannot reach similarity 0.8,
   so nothing is lost. The test is a running sum over the document.
2. SimHash: each window and item gets a 64-bit fingerprint of its shingle hashes
   (multiplicities are the weights).
3. Multi-index: the bits form ``(radius + 1) / 2`` blocks; within ``radius`` at
   least one block differs in at most one bit. Each item stands in every block's
   posting list under its value and all values one bit off, so a lookup finds
   all items of that length within the radius.
4. Exact check: weighted Jaccard similarity of the two shingle multisets.

The documents are never shuffled, and read once for each pass: items go to the tasks in
passes of at most ``PASS_BYTES`` of item text. A larger benchmark takes more passes, each
written before the next one starts, so no task or driver holds two indexes.

Edge cases: a null or blank text or item matches nothing; a document shorter
than an item is one window; each row of a repeated document reports its pairs, a
repeated item counts once; a null item_id is an id like any other; extra columns are ignored; an empty table on either
side gives no match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridmart.llm.common import release, staged

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 19
#: Item text that one pass over the documents takes to every task.
PASS_BYTES = 16 << 20
#: Document bytes hashed together, and windows whose bits are unpacked together.
_GROUP_BYTES = 1 << 21
_WINDOWS = 1 << 12

_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and per text the index of its first word.

    A word's hash is its polynomial in the byte values, read off a running sum.
    """
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    space = np.concatenate(([True], _SPACE[data]))
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
        (data.astype(np.uint64) + np.uint64(1)) * _powers(_PRIME, len(data)))))
    value = (run[ends] - run[starts]) * _powers(_INVERSE, len(data))[starts]
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return _mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48))), np.searchsorted(starts, at)


def shingle_hashes(ws: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order."""
    n = len(ws) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(_INVERSE) + ws[k:k + n]
    return _mix(out)


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """SimHash of the ``k`` hashes from each start: bits set in over half of them."""
    out = np.empty(len(starts), np.uint64)
    step = max(1, _WINDOWS * 32 // k)
    for i in range(0, len(starts), step):
        part = hashes[starts[i:i + step, None] + np.arange(k)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), k, 8), axis=2, bitorder="little")
        out[i:i + step] = np.packbits(2 * bits.sum(axis=1, dtype=np.int64) > k, axis=1,
                                      bitorder="little").view("<u8")[:, 0]
    return out


class Blocks:
    """Multi-index over fingerprints: all entries within ``radius`` of a query."""

    def __init__(self, fps: np.ndarray, radius: int) -> None:
        self.radius, self.fps = radius, fps
        count = max(1, -(-(radius + 1) // 2))
        edges = [round(64 * i / count) for i in range(count + 1)]
        self.spans = list(zip(edges, edges[1:]))
        if max(hi - lo for lo, hi in self.spans) > 16:
            raise ValueError("radius is too small for posting lists of 16-bit blocks")
        self.lists = []
        for lo, hi in self.spans:
            own = self._value(fps, lo, hi)
            keys = np.concatenate([own] + [own ^ (1 << b) for b in range(hi - lo)])
            ids = np.tile(np.arange(len(fps)), hi - lo + 1)
            order = np.argsort(keys, kind="stable")
            self.lists.append((np.searchsorted(keys[order], np.arange((1 << (hi - lo)) + 1)), ids[order]))

    @staticmethod
    def _value(fps: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return ((fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)

    def find(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, entry index) within the radius, each once."""
        pairs = []
        for (lo, hi), (offsets, ids) in zip(self.spans, self.lists):
            v = self._value(fps, lo, hi)
            n = offsets[v + 1] - offsets[v]
            q = np.repeat(np.arange(len(fps)), n)
            at = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[v], n)
            pairs.append(q * len(self.fps) + ids[at])
        q, e = np.divmod(np.unique(np.concatenate(pairs)), len(self.fps))
        near = np.bitwise_count(fps[q] ^ self.fps[e]) <= self.radius
        return q[near], e[near]


class ItemIndex:
    """The items of one pass, by length."""

    def __init__(self, ids: list, texts: list[str], radius: int, similarity: float) -> None:
        self.ids, self.similarity = ids, similarity
        self.items: list[tuple[np.ndarray, np.ndarray, int]] = []
        by_length: dict[int, list[int]] = {}
        fps = []
        known: dict[int, list[np.ndarray]] = {}
        for i, text in enumerate(texts):
            ws, _ = word_hashes([(text or "").encode("utf-8", "surrogatepass")])
            if not len(ws):
                self.items.append((np.empty(0, np.uint64), np.empty(0, np.int64), 0))
                fps.append(np.uint64(0))
                continue
            width = min(SHINGLE_WORDS, len(ws))
            hs = shingle_hashes(ws, width)
            self.items.append((*np.unique(hs, return_counts=True), len(hs)))
            fps.append(window_fingerprints(hs, np.zeros(1, np.int64), len(hs))[0])
            by_length.setdefault(len(ws), []).append(i)
            known.setdefault(width, []).append(hs)
        self.known = {w: np.unique(np.concatenate(hs)) for w, hs in known.items()}
        self.sizes = [(n, min(SHINGLE_WORDS, n), np.array(at), Blocks(np.array([fps[i] for i in at]), radius))
                      for n, at in sorted(by_length.items())]

    def hits(self, hashes: np.ndarray, width: int) -> np.ndarray:
        known = self.known[width]
        return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes

    def similarity_to(self, window: np.ndarray, item: int) -> float:
        keys, counts, total = self.items[item]
        own, n = np.unique(window, return_counts=True)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        common = int(np.minimum(n, counts[at])[keys[at] == own].sum())
        return common / (len(window) + total - common)

    def match(self, ws: np.ndarray) -> dict[int, tuple[float, int, int, int]]:
        """Best window per item: item -> (similarity, start word, words, bits apart)."""
        best: dict[int, tuple[float, int, int, int]] = {}
        for width in self.known:
            hs = shingle_hashes(ws, width)
            run = np.concatenate(([0], np.cumsum(self.hits(hs, width)))) if len(hs) else np.zeros(1, np.int64)
            if not run[-1]:
                continue
            for n, w, at, index in self.sizes:
                if w != width:
                    continue
                full = n - width + 1
                k = min(full, len(hs))
                starts = np.flatnonzero(run[k:] - run[:-k] >= self.similarity * full)
                for i in range(0, len(starts), _WINDOWS):
                    part = starts[i:i + _WINDOWS]
                    fps = window_fingerprints(hs, part, k)
                    for q, e in zip(*index.find(fps)):
                        s, item = int(part[q]), int(at[e])
                        score = self.similarity_to(hs[s:s + k], item)
                        if score >= self.similarity and (item not in best or score > best[item][0]):
                            apart = int(np.bitwise_count(fps[q] ^ index.fps[e]))
                            best[item] = (score, s, k + width - 1, apart)
        return best

    def match_texts(self, texts: list[str | None]) -> Iterator[tuple[int, dict]]:
        """(position, matches) of every text that has a match."""
        group: list[bytes] = []
        first = size = 0
        for i, text in enumerate(texts):
            group.append((text or "").encode("utf-8", "surrogatepass"))
            size += len(group[-1])
            if size < _GROUP_BYTES and i + 1 < len(texts):
                continue
            ws, at = word_hashes(group)
            # Documents that hold a known shingle at all; runs across two documents only add some.
            marked = np.zeros(len(ws) + 1, bool)
            for width in self.known:
                hs = shingle_hashes(ws, width)
                if len(hs):
                    marked[:len(hs)] |= self.hits(hs, width)
            run = np.concatenate(([0], np.cumsum(marked)))
            for j in np.flatnonzero(run[at[1:]] > run[at[:-1]]):
                found = self.match(ws[at[j]:at[j + 1]])
                if found:
                    yield first + int(j), found
            group, first, size = [], i + 1, 0


def _passes(benchmark: DataFrame, radius: int, similarity: float, pass_bytes: int) -> Iterator[tuple[ItemIndex, bool]]:
    """The items in passes of bounded text, and whether there are several.

    Of several passes each is written before the next begins, so that the driver and
    a task hold one index at a time.
    """
    items = benchmark.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = max(1, -(-2 * total // pass_bytes)) if total > pass_bytes else 1
    for p in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == p).collect()
        if rows:
            yield ItemIndex([r.item_id for r in rows], [r.text for r in rows], radius, similarity), count > 1


def find_matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY,
                 key: str = "doc_id", text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, similarity, bits_apart``: each
    contaminated document with each item it holds, at its best window."""
    key_type, item_type = docs.schema[key].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", key_type), T.StructField("item_id", item_type),
        T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("similarity", T.DoubleType()), T.StructField("bits_apart", T.LongType()),
    ])
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sc = docs.sparkSession.sparkContext
    out = None
    for index, several in _passes(benchmark, radius, similarity, pass_bytes):
        sent = sc.broadcast(index)  # at most PASS_BYTES of item text

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, items, found = [], [], []
                for i, matches in sent.value.match_texts(batch.column(1).to_pylist()):
                    for item, m in sorted(matches.items()):
                        at.append(i)
                        items.append(sent.value.ids[item])
                        found.append(m)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at, pa.int64())), pa.array(items, _arrow(schema).field("item_id").type),
                    pa.array([m[1] for m in found], pa.int64()), pa.array([m[2] for m in found], pa.int64()),
                    pa.array([m[0] for m in found], pa.float64()), pa.array([m[3] for m in found], pa.int64()),
                ], names=schema.names) if at else pa.RecordBatch.from_pylist([], schema=_arrow(schema))

        part = rows.mapInArrow(run, schema)
        if several:
            part = staged(part)
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY,
                      text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged, without a shuffle."""
    out = docs
    at = docs.columns.index(text)
    for index, several in _passes(benchmark, radius, similarity, pass_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, _ in sent.value.match_texts(batch.column(at).to_pylist()):
                    keep[i] = False
                yield batch.filter(pa.array(keep))

        before, out = out, out.mapInArrow(run, docs.schema)
        if several:
            out = staged(out)
            sent.destroy()
            release(before)
    return out
