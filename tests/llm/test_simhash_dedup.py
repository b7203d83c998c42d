"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridmart.llm import simhash_dedup as S


def plain_fingerprint(text, k=4):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))]
    hs = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_links(fps, radius=4):
    u = sorted({int(x) for x in fps})
    return {(a, b) for i, a in enumerate(u) for b in u[i + 1:] if bin(a ^ b).count("1") <= radius}


def near_points(n_centres, per_centre, seed=5):
    r = random.Random(seed)
    out = set()
    for _ in range(n_centres):
        c = r.getrandbits(64)
        out.add(c)
        for _ in range(per_centre):
            x = c
            for _ in range(r.randint(1, 6)):
                x ^= 1 << r.randrange(64)
            out.add(x)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b", "The cat SAT on the mat", "É a b C d " * 50])
def test_fingerprint_matches_the_definition(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_manhattan_distance_is_a_lower_bound():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 1 << 63, 500).astype(np.uint64), r.integers(0, 1 << 63, 500).astype(np.uint64)
    parts = S.blocks(4)
    assert sum(m for p in parts for m in p) == (1 << 64) - 1
    gap = np.abs(S._counts(a, parts) - S._counts(b, parts)).sum(axis=1)
    assert (gap <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("cell_rows", [4096, 7])
def test_links_equal_brute_force_also_with_split_cells(spark, cell_rows):
    pts = near_points(12, 40)
    df = spark.createDataFrame([(signed(x),) for x in pts], "fp long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in S.near_links(df, 4, cell_rows).collect()]
    assert len(got) == len(set(got))  # a pair is reported in one grid only
    assert {tuple(sorted(p)) for p in got} == brute_links(pts)


def test_components_take_the_smallest_id_and_keep_every_row(spark):
    base = [f"w{i}" for i in range(400)]
    near = base[:]
    near[200] = "other"
    rows = [(7, " ".join(base), "x"), (3, " ".join(near), "y"), (9, " ".join(base), "z"), (9, " ".join(base), "z"),
            (5, None, "n"), (4, "", "e"), (8, "completely different words stand here", "c"), (None, " ".join(base), "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = S.near_duplicates(df).collect()
    assert len(out) == len(rows)
    fp = {t: S.fingerprint(t) for _, t, _ in rows}
    linked = bin(fp[" ".join(base)] ^ fp[" ".join(near)]).count("1") <= 4
    want = {7: 3 if linked else 7, 3: 3, 9: 3 if linked else 7, 5: 4, 4: 4, 8: 8, None: 3 if linked else 7}
    assert {r.doc_id: r.component_id for r in out} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).collect() == []


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = {r.doc_id: S.fingerprint(r.text) for r in rows}
    parent = {x: x for x in fps.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_links(fps.values()):
        parent[root(a)] = root(b)
    low = {}
    for d, x in fps.items():
        low[root(x)] = min(d, low.get(root(x), d))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in S.near_duplicates(docs).collect()}
    assert got == {d: (x, low[root(x)]) for d, x in fps.items()}
    assert any(d != c for d, (_, c) in got.items())


def test_no_cross_join(spark):
    df = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    plan = S.near_duplicates(df).select(F.col("doc_id"))._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
