"""Byte-level BPE in higher-order functions.

Encoding: a text is cut by the vocabulary's pattern; a pre-token that is a token
is that token, any other starts as the array of its bytes and is folded: each
step merges the leftmost adjacent pair of the lowest rank, until no pair has a
rank. The ranks are one literal: an array of small maps, a piece standing in
the map of its hash, so a lookup reads a few entries.

Distinct words are folded, not occurrences. Each task numbers the pre-tokens of the
documents that it reads; words that it has not met go through the fold as one
array, and the numbers of a document become ids when they come back. All of this is
one stage: no text, word or token is shuffled, and no dictionary of the corpus exists.

Words that are frequent in the corpus would be folded in every task. So words are counted
in a sample of about ``SAMPLE_BYTES`` of text, the most frequent ones (at most
``CACHE_WORDS``, each at most ``CACHE_BYTES`` long, so about 20 MB) are folded as a
distributed table, and every task starts from it. This cache saves work only: whatever
it holds, every word of every text is folded the same way, and the ids are the same.

While folding, bytes are held as characters of ISO-8859-1, one per byte, as
Spark cuts strings by characters. Decoding joins the binary pieces of the ids,
in Arrow batches.

Edge cases: a null text is the empty text (no ids, empty binary); repeated rows
encode alike; extra columns are ignored, whatever their names; an empty table gives no
rows; a pre-token of any length is folded whole (the work grows with its square).
Special tokens do not exist: their strings are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridmart.llm.common import bucket_lookup, bucketed, let, release, small_batches, staged

RANK_BUCKETS = 1 << 14
#: Bounds of the cache of frequent words, and of the words that a task numbers before it starts anew.
SAMPLE_BYTES = 1 << 27
CACHE_WORDS = 1 << 19
CACHE_BYTES = 48
TASK_WORDS = 1 << 19
#: Pre-tokens numbered, and looked up, at a time (a document is never cut).
_NUMBERED, _LOOKED_UP = 1 << 20, 1 << 16
_NONE = 2**31 - 1
_LATIN = "ISO-8859-1"


@dataclass(frozen=True)
class Vocabulary:
    """A rank file and the pattern that cuts texts before the merges."""

    ranks: dict[bytes, int]
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return Vocabulary({base64.b64decode(t): int(r) for t, r in (x.split() for x in f if x.strip())}, pattern)

    def rank_map(self) -> Column:
        """array<map<piece, rank * 2**32>>: a literal once the plan is optimised."""
        return F.from_json(F.lit(bucketed({t.decode("latin-1"): r << 32 for t, r in self.ranks.items()}, RANK_BUCKETS)),
                           "array<map<string,bigint>>")


def pre_tokens(text: Column, pattern: str) -> Column:
    """The matches of the pattern; white space is Unicode's, as in the vocabulary's library."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def fold(word: Column, ranks: Column) -> Column:
    """Ids of one pre-token (array<int>) by ranked merges; ``ranks`` is a rank map.

    The state is one array of longs, an element per piece: the rank of the piece
    with its right neighbour in the upper half, the piece's first byte in the
    lower. The smallest element is thus the leftmost pair of the lowest rank.
    Merging it drops the right piece's element and renews two ranks.
    """
    none = F.lit(_NONE << 32).cast("long")
    start = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")
    id_of = lambda x: F.shiftright(x, 32).cast("int")

    def run(c: Column) -> Column:
        n = F.char_length(c)
        piece = lambda a, z: bucket_lookup(ranks, F.substring(c, a + 1, z - a), RANK_BUCKETS)  # noqa: E731  bytes a to z (from 0)
        pair = lambda a, z: F.coalesce(piece(a, z), none) + a
        first = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i + 1 < n, pair(i, i + 2)).otherwise(none + i))

        def merge(s: Column, _: Column) -> Column:
            def at(i: Column) -> Column:
                """Piece i takes in piece i + 1."""
                after, a, left = F.get(s, i + 2), start(F.get(s, i)), start(F.get(s, i - 1))
                own = F.when(after.isNull(), none + a).otherwise(pair(a, F.coalesce(start(F.get(s, i + 3)), n)))
                before = pair(left, F.coalesce(start(after), n))
                return F.transform(
                    F.filter(s, lambda x, k: k != i + 1),
                    lambda x, k: F.when(k == i, own).when(k == i - 1, before).otherwise(x))

            return let(F.array_min(s), lambda low: F.when(low >= none, s).otherwise(
                let((F.array_position(s, low) - 1).cast("int"), at)))

        return F.aggregate(F.sequence(F.lit(2), n), first, merge, lambda s: F.transform(
            s, lambda x, i: id_of(piece(start(x), F.coalesce(start(F.get(s, i + 1)), n)))))

    return let(F.decode(F.encode(word, "UTF-8"), _LATIN), lambda c: let(
        bucket_lookup(ranks, c, RANK_BUCKETS), lambda r: F.when(r.isNotNull(), F.array(id_of(r))).otherwise(run(c))))


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", limit: int = CACHE_WORDS) -> pa.Table:
    """``word, ids`` of the pre-tokens that are most frequent in a sample: all with a count from
    some threshold on, the lowest (by quarter powers of two) that keeps ``limit`` words."""
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    if size > SAMPLE_BYTES:
        docs = docs.sample(SAMPLE_BYTES / size, seed=3)
    found = docs.select(F.explode(pre_tokens(F.col(text), vocabulary.pattern)).alias("word"))
    # A word met once gains nothing from being folded ahead.
    counts = staged(found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                    .where((F.col("n") > 1) & (F.octet_length("word") <= CACHE_BYTES)))
    band = F.floor(F.log2("n") * 4).cast("int")
    rows = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("m")).collect()  # at most 256 bands
    kept, least = 0, 1 << 20
    for r in sorted(rows, key=lambda r: -r["band"]):
        kept += r["m"]
        if kept > limit:
            break
        least = r["band"]
    folded = counts.where(band >= least).select("word", fold_all(F.array("word"), vocabulary)[0].alias("ids"))
    out = folded.toArrow()
    release(counts)
    return out


def fold_all(words: Column, vocabulary: Vocabulary) -> Column:
    """The ids of every word of an array; null for null."""
    return let(vocabulary.rank_map(), lambda ranks: F.transform(words, lambda w: fold(w, ranks)))


def _slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``most`` at most, or that are one row."""
    out, first, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            out.append((first, i))
            first, total = i, 0
        total += n
    return [*out, (first, len(sizes))] if len(sizes) else []


def _numbered(batches: Iterator[pa.RecordBatch], cached: pa.Array) -> Iterator[pa.RecordBatch]:
    """Documents with their pre-tokens' numbers; new words stand once, on a row before or at their first use.

    The last column of a batch are the pre-tokens. Out come, in its place, the
    numbers (32-bit integers, packed), the new words and the number of the first one.
    """
    known = cached
    for b in (whole.slice(i, j - i) for whole in batches
              for i, j in _slices(pc.list_value_length(whole.column(whole.num_columns - 1)).to_numpy(), _NUMBERED)):
        words = b.column(b.num_columns - 1)
        seen = words.flatten().dictionary_encode()
        if len(known) + len(seen.dictionary) > len(cached) + TASK_WORDS:
            known = cached
        at = pc.index_in(seen.dictionary, value_set=known)
        new = seen.dictionary.filter(at.is_null())
        number = at.to_numpy(zero_copy_only=False)
        number = np.where(np.isnan(number), 0, number).astype(np.int32) if at.null_count else number.astype(np.int32)
        number[np.asarray(at.is_null())] = len(known) + np.arange(len(new), dtype=np.int32)
        packed_numbers = number[np.asarray(seen.indices)]
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(words).to_numpy()))) * 4
        blank = [None] * (b.num_rows - 1)
        yield pa.RecordBatch.from_arrays([
            *b.columns[:-1],
            pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [
                None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(packed_numbers)]).cast(pa.binary()),
            pa.array([new.to_pylist(), *blank], pa.list_(pa.string())),
            pa.array([len(known), *blank], pa.int64()),
        ], names=[*b.schema.names[:-1], "numbers", "words", "base"])
        known = pa.concat_arrays([known, new])


class _Ids:
    """Number of a word -> its ids, all in one array."""

    def __init__(self, cached: pa.ListArray) -> None:
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.extend(cached)

    def extend(self, ids: pa.ListArray) -> None:
        sizes = pc.list_value_length(ids).to_numpy()
        self.flat = np.concatenate([self.flat, ids.flatten().to_numpy()])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def cut(self, count: int) -> None:
        self.ends = self.ends[:count + 1]
        self.flat = self.flat[:self.ends[-1]]

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered words, and where each word's end."""
        starts = self.ends[numbers]
        ends = np.cumsum(self.ends[numbers + 1] - starts)
        before = ends - (self.ends[numbers + 1] - starts)
        at = np.repeat(starts - before, np.diff(ends, prepend=0)) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at], ends


def _looked_up(batches: Iterator[pa.RecordBatch], cached: pa.ListArray) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """The kept columns and the ids of runs of rows. The last three columns of a batch are
    numbers, base and the new words' ids."""
    table = _Ids(cached)
    for b in batches:
        sizes = pc.binary_length(b.column(b.num_columns - 3)).to_numpy() // 4
        marked = np.asarray(b.column(b.num_columns - 2).is_valid())
        starts = np.unique([0, *np.flatnonzero(marked), b.num_rows]).tolist()
        for first, last in zip(starts, starts[1:]):
            if marked[first]:
                table.cut(b.column(b.num_columns - 2)[first].as_py())
                table.extend(b.column(b.num_columns - 1)[first].values)
            for i, j in _slices(sizes[first:last], _LOOKED_UP):
                part = b.slice(first + i, j - i)
                numbers = np.frombuffer(b"".join(x.as_py() for x in part.column(part.num_columns - 3)), np.int32)
                ids, word_ends = table.of(numbers)
                ends = np.concatenate(([0], word_ends))[np.concatenate(([0], np.cumsum(sizes[first + i:first + j])))]
                yield (pa.RecordBatch.from_arrays(part.columns[:-3], names=part.schema.names[:-3]),
                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
           cache_limit: int = CACHE_WORDS, with_digests: bool = False) -> DataFrame:
    """The ``keep`` columns and ``ids array<int>`` of every row; ``with_digests`` also ``ids_sha256``
    and ``decoded_sha256`` (see ``digests``), made where the ids are made."""
    small_batches(docs.sparkSession, 4 << 20)
    cache = frequent_words(docs, vocabulary, text, cache_limit)
    sc = docs.sparkSession.sparkContext
    words, ids = (pa.concat_arrays(cache[c].chunks) if cache.num_rows else pa.array([], cache[c].type) for c in ("word", "ids"))
    words, ids = sc.broadcast(words), sc.broadcast(ids)
    kept = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    rows = docs.select(*[F.col(c).alias(f.name) for c, f in zip(keep, kept)],
                       pre_tokens(F.col(text), vocabulary.pattern).alias("pre_tokens"))
    mid = T.StructType([*kept, T.StructField("numbers", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType())),
                        T.StructField("base", T.LongType())])
    made = ["ids", *(_DIGESTS if with_digests else ())]
    kinds = [T.ArrayType(T.IntegerType()), T.StringType(), T.StringType()]
    end = T.StructType([*kept, *[T.StructField(n, k) for n, k in zip(made, kinds)]])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives freed batches back
        yield from _numbered(batches, words.value)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        join = decoder(vocabulary) if with_digests else None
        for rest, row_ids in _looked_up(batches, ids.value):
            columns = [*rest.columns, row_ids]
            if join:
                flat, ends = row_ids.values.to_numpy(), row_ids.offsets.to_numpy().tolist()
                found = [_digest(flat[i:j], join) for i, j in zip(ends, ends[1:])]
                columns += [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=end.names)

    numbered = rows.mapInArrow(number, mid)
    folded = numbered.select(*[f.name for f in kept], "numbers", "base", fold_all(F.col("words"), vocabulary).alias("folded"))
    out = folded.mapInArrow(look_up, end)
    return out.select(*[F.col(f.name).alias(c) for c, f in zip(keep, kept)], *made)


def decoder(vocabulary: Vocabulary) -> Callable[[np.ndarray], bytes]:
    """The function that joins the pieces of a row's ids."""
    pieces = {rank: token for token, rank in vocabulary.ranks.items()}
    return lambda ids: b"".join(map(pieces.__getitem__, ids.tolist()))


def _rows(ids: pa.ListArray) -> Iterator[np.ndarray | None]:
    for x in ids:
        yield None if x.values is None else x.values.to_numpy(zero_copy_only=False)


def packed(ids: np.ndarray) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    return ids.astype("<u4").tobytes()


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The binary that the ids stand for; null stays null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        join = decoder(vocabulary)
        for batch in batches:
            yield pa.array([None if x is None else join(x) for x in _rows(batch)], pa.binary())

    return F.arrow_udf(run, T.BinaryType())(ids)


_DIGESTS = ("ids_sha256", "decoded_sha256")


def _digest(ids: np.ndarray, join: Callable[[np.ndarray], bytes]) -> tuple[str, str]:
    return sha256(packed(ids)).hexdigest(), sha256(join(ids)).hexdigest()


def digests(ids: Column, vocabulary: Vocabulary) -> Column:
    """struct<ids_sha256, decoded_sha256>: hex digests of the packed ids and of their decoded bytes."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        join = decoder(vocabulary)
        for batch in batches:
            found = [(None, None) if x is None else _digest(x, join) for x in _rows(batch)]
            yield pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], names=list(_DIGESTS))

    return F.arrow_udf(run, "ids_sha256 string, decoded_sha256 string")(ids)
