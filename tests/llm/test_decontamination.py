"""Decontamination against a brute-force comparison of all windows."""

from collections import Counter

import numpy as np
import pytest

from gridmart.llm import decontamination as D

SF = "/root/testdata/sf0.001"


def words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


def bag(ws, width):
    return Counter(tuple(ws[i:i + width]) for i in range(len(ws) - width + 1))


def jaccard(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute(docs, items):
    out = {}
    for d, text in docs:
        ws = words(text)
        for i, item in items:
            iw = words(item)
            if not iw or not ws:
                continue
            width = min(5, len(iw))
            own = bag(iw, width)
            n = min(len(iw), len(ws))
            if n < width:
                continue
            best = max(jaccard(bag(ws[s:s + n], width), own) for s in range(len(ws) - n + 1))
            if best >= 0.8:
                out[(d, i)] = max(best, out.get((d, i), 0))
    return out


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.similarity for r in D.find_matches(d, b, **kw).collect()}


def test_blocks_find_everything_within_the_radius():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 40).astype(np.uint64)
    queries = base.copy()
    for i in range(len(queries)):
        for b in r.choice(64, i % 25, replace=False):
            queries[i] ^= np.uint64(1) << np.uint64(b)
    got = set(zip(*[x.tolist() for x in D.Blocks(base, 19).find(queries)]))
    want = {(i, j) for i, q in enumerate(queries) for j, b in enumerate(base) if int(np.bitwise_count(q ^ b)) <= 19}
    assert got == want and len(want) >= 30


ITEM = " ".join(f"Item{i}" for i in range(40))
CASES = [
    (1, "before it " + ITEM.upper().replace(" ", "\n") + " after it"),
    (2, " ".join(ITEM.split()[:36])),  # shorter than the item
    (3, "x " * 30 + " ".join(ITEM.split()[:20]) + " y " * 30),  # half of it
    (4, None), (5, ""), (6, " \n "), (7, "one two"), (8, "say one two now"),
    (9, " ".join(ITEM.split()[:38] + ["changed", "end"])),
    (1, "before it " + ITEM.upper().replace(" ", "\n") + " after it"),
    (10, "very long " * 30000 + ITEM),
]
ITEMS = [(1, ITEM), (2, "one two"), (3, None), (4, ""), (5, "the the the the the the the")]


def test_cases_match_brute_force(spark):
    want = brute([c for c in CASES if c[0] != 10], ITEMS)
    want[(10, 1)] = 1.0
    got = run(spark, CASES, ITEMS)
    assert got == pytest.approx(want) and {(1, 1), (2, 1), (8, 2), (9, 1)} <= set(got) and (3, 1) not in got


def test_more_passes_give_the_same(spark):
    assert run(spark, CASES, ITEMS, pass_bytes=64) == run(spark, CASES, ITEMS)


def test_passes_are_written_one_by_one(spark):
    d = spark.createDataFrame(CASES, "doc_id long, text string")
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = D.drop_contaminated(d, b, pass_bytes=64)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in D.drop_contaminated(d, b).collect())


def test_an_item_without_an_id(spark):
    d = spark.createDataFrame([(1, ITEM), (None, ITEM)], "doc_id long, text string")
    b = spark.createDataFrame([(None, ITEM)], "item_id long, text string")
    assert sorted([(r.doc_id, r.item_id) for r in D.find_matches(d, b).collect()], key=str) == [(1, None), (None, None)]


def test_a_repeated_item_counts_once(spark):
    d = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM)] * 3, "item_id long, text string")
    assert D.find_matches(d, b).count() == 1


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == {} and run(spark, CASES[:2], []) == {}


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    got = {(r.doc_id, r.item_id): r.similarity for r in D.find_matches(docs, bench).collect()}
    assert want and got == pytest.approx(want)


def test_drop_keeps_clean_rows_and_columns(spark):
    d = spark.createDataFrame([(*r, "s") for r in CASES], "doc_id long, text string, similarity string")
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
