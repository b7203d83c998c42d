"""SimHash near-duplicates through a segment-popcount embedding.

1. Fingerprint: a bit is set if it is set in over half of the shingle hashes.
   Equal fingerprints are one point from here on, so copies cost one row.
2. Embedding: the 64 bits are cut into segments of one or two bits; a point's
   coordinates are the segments' bit counts. The Manhattan distance of two
   points never exceeds the Hamming distance of their fingerprints.
3. Grid range-join: the segments form ``radius + 3`` blocks. Within Manhattan
   distance ``radius`` at most ``radius`` blocks differ, so the points agree on
   the coordinates of at least three blocks. Each choice of three blocks is one
   grid whose cells are those coordinates; points that share a cell are
   compared first by Manhattan distance, then by exact Hamming distance.
   A pair is reported only in the first grid whose cell it shares.
4. Links become components by distributed contraction.

No pair is written unless it is a link. A cell with more than ``CELL_ROWS``
points is dealt out as pairs of chunks, each chunk of at most about that many
points, so no task holds a large cell and no comparison is dropped.

Edge cases: a null, empty or blank text has fingerprint zero and is linked like
any other; fewer words than the shingle length make one shingle; repeated rows
each get their row; a null doc_id never becomes a component id unless its whole
component has none; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridmart.llm.common import checkpointed
from gridmart.llm.components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
AGREE = 3  # blocks that make up a cell
#: Points of a cell compared in one go; larger cells are dealt out in chunks.
CELL_ROWS = 4096
#: Shingle hashes whose bits are unpacked at a time.
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text (unsigned); zero without words."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    joined = memoryview(b" ".join(ws))
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(ws) - shingle_words + 1)
    last = np.minimum(np.arange(n) + shingle_words, len(ws)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[last].tolist())), np.uint64, n)
    bits = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        part = hashes[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * bits > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, copy, fp``: a digest of every row's text and its fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fps.view(np.int64))], names=["doc_id", "copy", "fp"])

    rows = docs.select(F.col(key).alias("doc_id"), _copy(F.col(text)).alias("copy"), F.col(text).alias("text"))
    kind = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("copy", T.BinaryType()),
                         T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, kind)


def _copy(text: Column) -> Column:
    """Equal for equal texts (null: the empty text)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def blocks(radius: int) -> list[list[int]]:
    """Segment masks per block: ``radius + AGREE`` blocks of near equal width."""
    count = radius + AGREE
    edges = [round(64 * i / count) for i in range(count + 1)]
    out = []
    for lo, hi in zip(edges, edges[1:]):
        out.append([sum(1 << b for b in range(s, min(s + 2, hi))) for s in range(lo, hi, 2)])
    return out


def grids(radius: int) -> list[tuple[int, ...]]:
    return list(combinations(range(radius + AGREE), AGREE))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_code(fp: Column, segments: list[int]) -> Column:
    """The block's bit counts, two bits each, as one long."""
    out = F.lit(0).cast("long")
    for k, mask in enumerate(segments):
        count = F.bit_count(fp.bitwiseAND(F.lit(_signed(mask)).cast("long"))).cast("long")
        out = out.bitwiseOR(F.shiftleft(count, 2 * k))
    return out


def grid_cells(points: DataFrame, radius: int) -> DataFrame:
    """``cell, fp``: every point in its cell of every grid."""
    parts = blocks(radius)
    width = 2 * max(map(len, parts))
    coded = points.select("fp", *[_block_code(F.col("fp"), p).alias(f"b{i}") for i, p in enumerate(parts)])
    cells = []
    for g, chosen in enumerate(grids(radius)):
        cell = F.lit(g << (AGREE * width)).cast("long")
        for k, b in enumerate(chosen):
            cell = cell.bitwiseOR(F.shiftleft(F.col(f"b{b}"), k * width))
        cells.append(cell)
    if len(cells) << (AGREE * width) >= 1 << 63:
        raise ValueError(f"radius {radius} needs more bits than a cell number has")
    return coded.select(F.explode(F.array(*cells)).alias("cell"), "fp")


def _counts(fps: np.ndarray, parts: list[list[int]]) -> np.ndarray:
    masks = np.array([m for p in parts for m in p], np.uint64)
    return np.bitwise_count(fps[:, None] & masks[None, :]).astype(np.int8)


def _verify(a: np.ndarray, b: np.ndarray, grid: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs are links first seen in this grid: Manhattan, first grid, Hamming."""
    parts = blocks(radius)
    keep = np.ones(len(a), bool)
    for i in range(0, len(a), _CHUNK):
        at = slice(i, i + _CHUNK)
        gap = np.abs(_counts(a[at], parts) - _counts(b[at], parts))
        near = gap.sum(axis=1, dtype=np.int64) <= radius
        bounds = np.cumsum([0] + [len(p) for p in parts])
        same = np.stack([gap[:, x:y].sum(axis=1) == 0 for x, y in zip(bounds, bounds[1:])])
        first = np.full(gap.shape[0], -1)
        for g, chosen in reversed(list(enumerate(grids(radius)))):
            first[np.logical_and.reduce(same[list(chosen)])] = g
        keep[at] = near & (first == grid[at]) & (np.bitwise_count(a[at] ^ b[at]) <= radius)
    return keep


def _links(cell: np.ndarray, left: np.ndarray, right: np.ndarray, fp: np.ndarray, shift: int,
           radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by (cell, left chunk, right chunk, side).

    Rows of a group carry the side they stand on: -1 in a group that compares
    a chunk with itself, else 0 or 1, and only different sides are compared.
    Pairs are taken lag by lag, so the work is vectorised over all groups.
    """
    found_a, found_b = [], []
    at = np.arange(len(cell))
    lag = 1
    while True:
        at = at[at + lag < len(cell)]
        to = at + lag
        at = at[(cell[at] == cell[to]) & (left[at] == left[to])]
        if not len(at):
            break
        to = at + lag
        a, b = fp[at], fp[to]
        ok = ((right[at] < 0) | (right[at] != right[to])) & (np.bitwise_count(a ^ b) <= radius)
        if ok.any():
            a, b = a[ok], b[ok]
            ok2 = _verify(a, b, cell[at[ok]] >> shift, radius)
            found_a.append(a[ok2])
            found_b.append(b[ok2])
        lag += 1
    if not found_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(found_a), np.concatenate(found_b)


def near_links(points: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``a, b``: every pair of distinct fingerprints within ``radius`` bits, once.

    ``points`` has one row per distinct fingerprint ``fp`` and must be stored
    (it is read twice: to find large cells and to compare).
    """
    cells = grid_cells(points, radius)
    # Cells above the bound are few: each stands for cell_rows points at least.
    large = checkpointed(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > cell_rows))
    whole = cells.select("cell", F.lit(0).alias("pair"), F.lit(-1).alias("side"), "fp")
    if not large.isEmpty():
        # A large cell of k chunks becomes k groups of one chunk and k(k-1)/2 of two.
        whole = whole.join(large, "cell", "left_anti")
        k = F.ceil(F.col("m") / cell_rows).cast("int")
        dealt = cells.join(large, "cell").select("cell", "fp", k.alias("k")).select(
            "cell", "fp", "k", F.pmod(F.xxhash64("fp"), F.col("k").cast("long")).cast("int").alias("own"))
        other = dealt.select("cell", "fp", "k", "own", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
        lo, hi = F.least("own", "o"), F.greatest("own", "o")
        whole = whole.unionByName(other.select(
            "cell", (lo * F.col("k") + hi + 1).cast("int").alias("pair"),
            F.when(F.col("own") == F.col("o"), -1).when(F.col("own") < F.col("o"), 0).otherwise(1).alias("side"),
            "fp",
        ))
    shift = AGREE * 2 * max(map(len, blocks(radius)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            kept = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            last = (kept["cell"] == kept["cell"].iloc[-1]) & (kept["pair"] == kept["pair"].iloc[-1])
            done, kept = kept[~last], kept[last]
            if len(done):
                yield compared(done)
        if kept is not None and len(kept):
            yield compared(kept)

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = _links(rows["cell"].to_numpy(), rows["pair"].to_numpy(), rows["side"].to_numpy(),
                      rows["fp"].to_numpy().view(np.uint64), shift, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (whole.repartition("cell", "pair").sortWithinPartitions("cell", "pair", "side", "fp")
            .mapInPandas(run, "a long, b long"))


def _components(rows: DataFrame, radius: int, cell_rows: int) -> DataFrame:
    """Stored ``fingerprints`` with ``component``, a fingerprint that names it, and ``component_id``."""
    points = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    parts = connected_components(near_links(points.select("fp"), radius, cell_rows))
    joined = points.join(parts, points["fp"] == parts["node"], "left").select("fp", "low", "component")
    # Few fingerprints have a neighbour; the rest are components of their own.
    alone = joined.where("component IS NULL").select(
        "fp", F.col("fp").alias("component"), F.col("low").alias("component_id"))
    linked = checkpointed(joined.where("component IS NOT NULL"))
    # The minima are combined before their shuffle and stored, so that the join deals out
    # both sides anew and adaptive execution can split a component of very many points.
    lows = checkpointed(linked.groupBy("component").agg(F.min("low").alias("component_id")))
    by_fp = alone.unionByName(linked.join(lows, "component").select("fp", "component", "component_id"))
    return rows.join(by_fp, "fp").select("doc_id", "copy", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    key: str = "doc_id", text: str = "text", cell_rows: int = CELL_ROWS) -> DataFrame:
    """``doc_id, fp, component, component_id`` of every row: a fingerprint that names
    the component, and the smallest doc_id reachable."""
    rows = checkpointed(fingerprints(docs, shingle_words, key, text))
    return _components(rows, radius, cell_rows).select("doc_id", "fp", "component", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, that of its smallest doc_id; columns unchanged.

    Of rows that share that doc_id the one with the smallest fingerprint stays (of
    equal ones that with the smallest text digest), and of repeated rows one.
    Fingerprints are made once; the rows are found again by id and text digest.
    """
    found = _components(checkpointed(fingerprints(docs, shingle_words, key, text)), radius, CELL_ROWS)
    first = F.min(F.struct("doc_id", "fp", "copy")).alias("first")
    chosen = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(first)
              .select(F.col("first.doc_id").alias("__llm_id"), F.col("first.copy").alias("__llm_copy")))
    marked = docs.withColumn("__llm_row_copy", _copy(F.col(text)))
    same = (marked["__llm_row_copy"] == chosen["__llm_copy"]) & marked[key].eqNullSafe(chosen["__llm_id"])
    return (marked.join(chosen, same, "left_semi").dropDuplicates([key, "__llm_row_copy"])
            .drop("__llm_row_copy"))
