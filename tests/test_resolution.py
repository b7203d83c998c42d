"""Resolution of a batch: the most frequent gap between its distinct stamps."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridmart.operators.resolution import detect_resolution, with_resolution

T0 = datetime(2023, 5, 4, 6)


def frame(spark, batches):
    """batches: name -> minutes after T0 (None: no time could be read)."""
    rows = [(b, None if m is None else str(T0 + timedelta(minutes=m))) for b, ms in batches.items() for m in ms]
    return spark.createDataFrame(rows, "batch string, t string").select("batch", F.col("t").cast("timestamp").alias("ts_utc"))


def found(spark, batches):
    return {r["batch"]: r["resolution_minutes"] for r in detect_resolution(frame(spark, batches), ["batch"]).collect()}


def test_gap_of_each_batch_in_one_pass(spark):
    got = found(spark, {
        "steady quarter hours": range(0, 300, 15),
        "hours with a hole": [0, 60, 120, 360, 420],
        "stamps landed many times": [0, 30, 60] * 7,
        "as often 15 as 45": [0, 15, 60],
        "one stamp": [10],
        "only unreadable stamps": [None, None],
        "unreadable among good ones": [None, 0, 15, 30],
    })
    assert got == {"steady quarter hours": 15, "hours with a hole": 60, "stamps landed many times": 30,
                   "as often 15 as 45": 15, "one stamp": 60, "only unreadable stamps": 60,
                   "unreadable among good ones": 15}


def test_random_batches_against_a_plain_count(spark):
    r = random.Random(8)
    batches = {f"b{i}": [r.choice((15, 30, 60)) * r.randrange(40) for _ in range(r.randrange(2, 60))] for i in range(40)}

    def plain(minutes):
        ms = sorted(set(minutes))
        gaps = Counter(b - a for a, b in zip(ms, ms[1:]))
        return min(gaps, key=lambda g: (-gaps[g], g)) if gaps else 60

    assert found(spark, batches) == {b: plain(ms) for b, ms in batches.items()}


def test_every_row_gets_its_batch_value_null_keys_too(spark):
    df = frame(spark, {"a": [0, 15, 30], "b": [0, 60]}).unionByName(
        frame(spark, {"x": [0, 30, 60]}).withColumn("batch", F.lit(None).cast("string")))
    got = sorted((r["batch"] or "", r["resolution_minutes"]) for r in with_resolution(df, ["batch"]).collect())
    assert got == [("", 30)] * 3 + [("a", 15)] * 3 + [("b", 60)] * 2
