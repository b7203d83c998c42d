"""Whitening against plain integer sums and numpy's eigenvectors."""

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from gridmart.llm import whitening as W


def plain(rows, count=8):
    """(id, component) -> (n, deviation, |whitened|, explained) by dense algebra."""
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and isfinite(c) for c in v)]
    x = [[floor(1024 * float(c)) + 100_000 for c in v] for _, v in keep]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    y = [[n * r[j] - s[j] for j in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n ** 3)) for j in range(d)] for i in range(d)])
    e, q = np.linalg.eigh(cov)
    out = {}
    for (i, _), r in zip(keep, y):
        for k in range(1, min(count, d) + 1):
            z = np.array(r) / n @ q[:, -k] / np.sqrt(e[-k])
            out.setdefault((i, k), []).append((n, sum(c * c for c in r), z, e[-k] / e.sum()))
    return out


def check(got, want):
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    assert found.keys() == want.keys()
    sign = {}
    for key, rs in found.items():
        assert len(rs) == len(want[key])
        n, dev, z, share = want[key][0]
        for r in rs:
            assert (r.n, r.deviation) == (n, dev)
            assert r.explained == pytest.approx(share, rel=1e-9) and 0 <= r.identity_error <= 1e-9
            assert abs(r.whitened) == pytest.approx(abs(z), rel=1e-6, abs=1e-9)
            if abs(z) > 1e-3:  # one sign per component, for all rows
                assert sign.setdefault(key[1], np.sign(r.whitened * z)) == np.sign(r.whitened * z)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, v int, id string")


def test_given_embeddings(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(W.whiten(t).collect(), plain([(r.vec_id, r.embedding) for r in t.collect()]))


def test_edge_rows(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(c) for c in np.float32(rnd.normal(0, 1 + np.arange(5)))]) for i in range(40)]
    bad = [(91, None), (92, [1.0, None, 0.0, 0.0, 0.0]), (93, [float("nan")] * 5), (94, [float("inf")] + [0.0] * 4),
           (95, [1.0, 2.0]), (96, [])]
    rows += [rows[3], rows[3], (None, rows[5][1])]
    got = W.whiten(frame(spark, rows + bad)).collect()
    check(got, plain(rows))
    assert {r.component for r in got} == {1, 2, 3, 4, 5}
    assert W.whiten(frame(spark, rows[:0])).collect() == []
    assert W.whiten(frame(spark, [(1, [1.0, 2.0])] * 3 + [(2, None)])).collect() == []
    assert W.whiten(frame(spark, [(1, []), (2, [])])).collect() == []
    only = W.whiten(frame(spark, [(1, [1.0, 5.0]), (2, [3.0, 5.0])])).collect()  # one direction has no variance
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 12), r.explained) for r in only) == [
        (1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_equal_eigenvalues_and_large_entries(spark):
    square = [(i, [float(a), float(b), 0.25]) for i, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    got = W.whiten(frame(spark, square)).collect()
    z = np.array([[r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component)) if r.vec_id == i] for i in range(4)])
    assert z.shape == (4, 2) and np.allclose(z.T @ z / 4, np.eye(2)) and got[0].identity_error < 1e-9
    far = [(i, [2.0 ** 40 * (i - 1), float(i * i)]) for i in range(4)]
    got = W.whiten(frame(spark, far)).collect()
    assert len(got) == 8 and {r.deviation for r in got} == {None} and got[0].identity_error < 1e-6


def test_polynomial_and_roots(spark):
    rnd = np.random.default_rng(7)
    a = rnd.integers(-9, 9, (6, 4))
    m = (a @ a.T).astype(object)  # rank 4 of 6
    poly = W.charpoly(spark, m)
    assert [int(round(v)) for v in np.poly(m.astype(float))[::-1]] == poly
    roots = [top / 2.0 ** bits for top, bits in W.largest_roots(poly, 8)]
    assert roots == pytest.approx(sorted(np.linalg.eigvalsh(m.astype(float)))[:1:-1])
    assert [top / 2.0 ** b for top, b in W.largest_roots([-12, 16, -7, 1], 3)] == pytest.approx([3, 2, 2])  # (x-2)^2 (x-3)
    assert W.primes(2 ** 62) == [2147483647, 2147483629, 2147483587]
