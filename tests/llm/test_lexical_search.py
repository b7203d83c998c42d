"""Lexical search against plain scores of every document."""

import random
import re
from collections import Counter
from math import floor, log

from gridmart.llm import lexical_search as S

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(items, docs, top=10):
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n_all, length = len(docs), sum(len(t) for _, t in docs)
    df = Counter(x for _, t in docs for x in set(t))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, want in wanted.items():
        scored = []
        for i, t in docs:
            tf, m = Counter(t), 100 - 90 + (90 * len(t) * n_all) // length
            s = sum(floor(1000 * log((2 * n_all + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m))
                    for x in want if x in tf)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k, e[3], -e[0]) for k, e in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, items, docs, **options):
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc long")
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, item string")
    return sorted([tuple(r) for r in S.search(b, d.repartition(5), **options).collect()], key=str)


def test_random_tables(spark):
    rnd = random.Random(2)
    words = ["Alpha", "beta", "GAMMA", "é", "É", "漢字", "x1", "the", "the", "the"]
    docs = [(i, " ".join(rnd.choice(words) + rnd.choice(["", "", "-", str(rnd.randrange(9))])
                         for _ in range(rnd.randrange(30)))) for i in range(300)]
    items = [(i, " ".join(rnd.sample(words, 3))) for i in range(12)]
    want = plain(items, docs)
    assert run(spark, items, docs) == want
    assert run(spark, items, docs, pass_bytes=40) == want  # many passes
    assert run(spark, items, docs, top=3) == plain(items, docs, 3)


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "a b"), (4, "a b"), (None, "A, b"), (5, "b " * 50_000 + "a"), (6, "c")]
    items = [(1, "a"), (1, "B"), (None, "c C"), (2, None), (3, ""), (4, "none such"), (5, "a\x7fb")]
    assert run(spark, items, docs) == plain(items, docs)
    assert run(spark, items[:0], docs) == run(spark, items, docs[:0]) == run(spark, items, docs[:3]) == []


def test_heaps_stay_bounded():
    import numpy as np

    heaps = S.Heaps(2, 3)
    for d in range(100):
        heaps.update(d, np.array([d % 7, 0]))
    assert sorted(heaps.heaps[0], reverse=True) == [(6, -6), (6, -13), (6, -20)] and heaps.heaps[1] == []


def test_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted([tuple(r) for r in S.search(items, docs).collect()], key=str)
    assert got == plain([(r.item_id, r.text) for r in items.collect()], [(r.doc_id, r.text) for r in docs.collect()])
