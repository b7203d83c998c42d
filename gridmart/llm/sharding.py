"""Sharding by jump consistent hashing (SQL functions only).

A key and the shard count alone decide the shard, without a ring table: the
key seeds a 64-bit linear congruential generator whose draws are the jumps.
Appending a shard moves about 1/(n+1) of the keys, and only into the new one.

Slots number the rows of a shard from 0 without gaps. They come from counts
per (shard, bucket) and a running sum inside each bucket, so no task sees a
whole shard. Identical rows are counted before the shuffle, so a hot key or a
hot copy costs one row per map task. They are written out in pieces of bounded
length that are dealt over all tasks.

Edge cases: a null key is key 0; a null text counts as no bytes; repeated rows
get one slot each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

#: Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
#: The generator's state is kept in limbs of 22, 22 and 20 bits, so that no
#: product or sum leaves the range of a long under ANSI arithmetic.
_LIMB = 22
_MASK = (1 << _LIMB) - 1
_A0, _A1, _A2 = (MULTIPLIER & _MASK, (MULTIPLIER >> _LIMB) & _MASK, MULTIPLIER >> (2 * _LIMB))

#: Rows that one slot-numbering bucket holds on average.
ROWS_PER_BUCKET = 100_000
#: Copies of one row that are written out from one array.
COPIES = 1 << 16


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (int, 0 to ``shards`` - 1) of a long key; null counts as key 0."""
    if shards < 1:
        raise ValueError("shards must be positive")
    k = F.coalesce(key.cast("long"), _long(0))
    start = F.struct(
        k.bitwiseAND(_long(_MASK)).alias("k0"),
        F.shiftrightunsigned(k, _LIMB).bitwiseAND(_long(_MASK)).alias("k1"),
        F.shiftrightunsigned(k, 2 * _LIMB).alias("k2"),
        _long(0).alias("b"),
        _long(0).alias("j"),
    )

    def step(s: Column, _: Column) -> Column:
        r0 = s["k0"] * _long(_A0) + _long(1)
        r1 = s["k0"] * _long(_A1) + s["k1"] * _long(_A0) + F.shiftright(r0, _LIMB)
        r2 = (s["k0"] * _long(_A2) + s["k1"] * _long(_A1) + s["k2"] * _long(_A0)
              + F.shiftright(r1, _LIMB)).bitwiseAND(_long((1 << 20) - 1))
        k1 = r1.bitwiseAND(_long(_MASK))
        high31 = F.shiftleft(r2, 11).bitwiseOR(F.shiftright(k1, 11))
        jump = F.floor((s["j"] + 1).cast("double")
                       * (F.lit(float(1 << 31)) / (high31 + 1).cast("double")))
        return F.when(s["j"] >= shards, s).otherwise(F.struct(
            r0.bitwiseAND(_long(_MASK)).alias("k0"), k1.alias("k1"), r2.alias("k2"),
            s["j"].alias("b"), jump.cast("long").alias("j"),
        ))

    # j rises by at least one a step, so `shards` steps always reach the end.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: ``key, size, text_crc32, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus one; ``grown_shard`` the shard with
    one more shard. Slots follow (bucket, key, checksum, size).
    """
    t = F.coalesce(F.col(text), F.lit(""))
    buckets = max(1, -(-docs.count() // (rows_per_bucket * shards)))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(t).cast("long") + 1).alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
    ).groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    placed = rows.select(
        "*", jump_hash(F.col("key"), shards).alias("shard"),
        jump_hash(F.col("key"), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64("key", "text_crc32"), _long(buckets)).alias("bucket"),
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "text_crc32", "size")
    numbered = placed.withColumn("upto", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per (shard, bucket): the table is rows / rows_per_bucket long.
    offsets = (placed.groupBy("shard", "bucket").agg(F.sum("n").alias("m"))
               .withColumn("start", F.coalesce(F.sum("m").over(before), _long(0))).drop("m"))
    first = F.col("start") + F.col("upto") - F.col("n")
    pieces = numbered.join(offsets, ["shard", "bucket"]).select(
        "key", "size", "text_crc32", "shard", "grown_shard", (first + F.col("n")).alias("end"),
        F.explode(F.sequence(first, first + F.col("n") - 1, _long(COPIES))).alias("first"),
    )
    # The number is given, as adaptive execution would merge the few pieces of a hot copy.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(tasks, "shard", "first").select(
        F.col("key").alias(key), "size", "text_crc32", "shard",
        F.explode(F.sequence(F.col("first"), F.least(F.col("first") + COPIES, F.col("end")) - 1)).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id",
                 files_per_shard: int = 1, mode: str = "errorifexists") -> None:
    """Write the rows as Parquet under ``path/shard=<n>``, each in ``files_per_shard`` files."""
    part = F.pmod(F.xxhash64(*docs.columns), _long(files_per_shard))
    (docs.withColumn("shard", jump_hash(F.col(key), shards))
     .repartition(shards * files_per_shard, F.col("shard"), part)
     .write.partitionBy("shard").mode(mode).parquet(path))
