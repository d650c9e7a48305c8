"""Exact whitening against fractions, numpy and known spectra, and on odd vectors."""

import math
import os
import random
from fractions import Fraction

import numpy as np
import pytest

from quotemill.llm import entries
from quotemill.llm import exact_whitening as ew

SF = "/root/testdata/sf0.001"
VECS = "vec_id long, embedding array<double>, component string, n string"


@pytest.fixture(scope="module", autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], VECS)


def leverrier(m):
    """The characteristic polynomial by traces of powers, in fractions."""
    d = len(m)
    a = [[Fraction(int(v)) for v in row] for row in m]
    c, work = [Fraction(1)], [[Fraction(i == j) for j in range(d)] for i in range(d)]
    for k in range(1, d + 1):
        work = [[sum(a[i][t] * work[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(work[i][i] for i in range(d)) / k)
        for i in range(d):
            work[i][i] += c[-1]
    return [int(x) for x in reversed(c)]


def gram(seed, d, rank, size=50):
    rng = np.random.default_rng(seed)
    x = rng.integers(-size, size, (rank, d)).astype(object)
    return (x.T @ x).tolist()


def brute(rows, components=4):
    """By numpy on the same integer vectors, for distinct eigenvalues."""
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], dtype=np.float64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    w, c = np.linalg.eigh(np.cov(u.T, bias=True).reshape(x.shape[1], -1))
    w, c = w[::-1][:components], c[:, ::-1][:, :components]
    white = (x - u.mean(axis=0)) @ c / np.sqrt(w)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return n, deviation, white, w / np.trace(np.cov(u.T, bias=True).reshape(x.shape[1], -1))


def check(got, rows, components=4):
    n, deviation, white, explained = brute(rows, components)
    k = white.shape[1]
    assert len(got) == k * len(rows)
    assert {r.n for r in got} == {n}
    assert sorted((r.vec_id, r.deviation) for r in got) == sorted((i, v) for (i, _), v in zip(rows, deviation, strict=True) for _ in range(k))
    by = {(r.vec_id, r.component): r for r in got}
    ours = np.array([[by[i, c + 1].whitened for c in range(k)] for i, _ in rows])
    ours *= np.sign((ours * white).sum(axis=0))
    assert np.abs(ours - white).max() < 1e-9
    assert np.allclose([by[rows[0][0], c + 1].explained for c in range(k)], explained, rtol=1e-12)
    assert len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize(("d", "rank"), [(1, 1), (2, 5), (3, 2), (6, 9), (7, 3), (9, 20)])
def test_polynomial_equals_fractions(spark, d, rank):
    m = gram(d, d, rank)
    assert ew.characteristic_polynomial(spark, m) == leverrier(m)


def test_polynomial_of_sparse_matrices(spark):
    """Zero pivots, blocks that fall apart, zero rows."""
    for m in ([[0, 0], [0, 0]], [[2, 0, 0], [0, 0, 0], [0, 0, 5]], [[3, 0, 1, 0], [0, 3, 0, 0], [1, 0, 3, 0], [0, 0, 0, 9]]):
        assert ew.characteristic_polynomial(spark, m) == leverrier(m)


def test_primes_are_enough():
    m = gram(1, 8, 20)
    primes = ew.primes_for(m)
    assert len(set(primes)) == len(primes)
    assert math.prod(primes) > 2 * max(map(abs, leverrier(m)))
    assert all(all(p % q for q in range(2, 50_000)) for p in primes[:3])


def test_products_are_exact():
    rng = random.Random(3)
    for top in (3, 1 << 19, 1 << 21, 1 << 40, (1 << 63) - 1):
        x = [[rng.randint(-top - (top > 1 << 60), top) for _ in range(3)] for _ in range(50)]
        want = [[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)]
        assert ew.products(np.array(x, dtype=np.int64)).tolist() == want
    extreme = np.array([[-(1 << 63), (1 << 63) - 1, -1]], dtype=np.int64)
    assert ew.products(extreme)[0, 0] == 1 << 126


def test_roots_with_multiplicity():
    """(x - 7)^2 (x - 3)^3 x: counts and places."""
    c = [1]
    for root in (7, 7, 3, 3, 3, 0):
        c = [-root * a + b for a, b in zip([*c, 0], [0, *c], strict=True)]
    assert [ew.roots_above(c, at, 0) for at in (-1, 0, 2, 3, 6, 7)] == [6, 5, 5, 2, 2, 0]
    found = ew.largest_roots(c, 6, 100)
    assert [round((2 * a + 1) / (1 << (b + 1)), 9) if a else 0 for a, b in found] == [7, 7, 3, 3, 3, 0]
    assert found[0] == found[1]
    assert found[2] == found[3] == found[4]


def test_near_roots_are_told_apart():
    """Eigenvalues that differ in the 15th digit."""
    big = 10**15
    c = [1]
    for root in (big + 1, big, 5):
        c = [-root * a + b for a, b in zip([*c, 0], [0, *c], strict=True)]
    found = ew.largest_roots(c, 3, 3 * big)
    assert [(2 * a + 1 + (1 << b)) // (1 << (b + 1)) for a, b in found] == [big + 1, big, 5]


def test_null_space_beyond_doubles():
    """Two eigenvalues so close that doubles cannot separate their vectors."""
    big = 10**17
    m = [[big, 1, 0], [1, big, 0], [0, 0, 3]]  # (1, 1) has big + 1, (1, -1) has big - 1
    trace = 2 * big + 3
    roots = ew.largest_roots(leverrier(m), 2, trace)
    for root, want in zip(roots, ([1, 1], [1, -1]), strict=True):
        (v,) = ew.null_space(m, trace, root, 1)
        v = [x / (1 << ew.BITS) for x in v]
        assert abs(abs(v[0]) - math.sqrt(0.5)) < 1e-15
        assert abs(v[0] * want[1] - v[1] * want[0]) < 1e-15


def test_random_vectors(spark):
    rng = np.random.default_rng(4)
    for d, count in ((1, 5), (2, 7), (3, 50), (5, 40), (12, 90)):
        rows = [(k, (rng.normal(size=d) * np.arange(1, d + 1)).tolist()) for k in range(count)]
        check(ew.whiten(frame(spark, rows)).collect(), rows)


def test_repeated_vectors_count_once(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=4) * [1, 2, 3, 4]).tolist()) for k in range(20)]
    rows += [(100 + k, rows[0][1]) for k in range(300)]
    got = ew.whiten(frame(spark, rows)).collect()
    check(got, rows)
    assert got[0].n == 20


def test_rows_left_out(spark):
    rng = np.random.default_rng(6)
    good = [(k, (rng.normal(size=3) * [1, 2, 3]).tolist()) for k in range(9)]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 0.0, 0.0]),
           (55, [-float("inf"), 0.0, 0.0]), (56, [1.0, 2.0])]
    check(ew.whiten(frame(spark, good + bad)).collect(), good)


def test_ids_may_repeat_or_be_null(spark):
    rng = np.random.default_rng(7)
    rows = [(None if k < 2 else 5, (rng.normal(size=2) * [1, 4]).tolist()) for k in range(6)]
    got = ew.whiten(frame(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), c) for i, _ in rows for c in (1, 2))


def test_equal_variances(spark):
    """A cross: every direction is a component; the whitened covariance is the identity all the same."""
    rows = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, -1.0, 0.0]), (4, [0.0, 0.0, 1.0]), (5, [0.0, 0.0, -1.0])]
    got = ew.whiten(frame(spark, rows)).collect()
    assert got[0].identity_error < 1e-12
    assert all(abs(r.explained - 1 / 3) < 1e-15 for r in got)
    lengths = {i: sum(r.whitened**2 for r in got if r.vec_id == i) for i in range(6)}
    assert all(abs(v - 3) < 1e-12 for v in lengths.values())


def test_components_without_variance(spark):
    rows = [(0, [0.0, 1.0, 5.0]), (1, [1.0, 1.0, 5.0]), (2, [3.0, 1.0, 5.0])]
    got = ew.whiten(frame(spark, rows)).collect()
    assert [r.whitened is None for r in sorted(got, key=lambda r: r.component)] == [False] * 3 + [True] * 6
    assert [r.explained for r in got if r.vec_id == 0] == [1.0, 0.0, 0.0]
    assert got[0].identity_error < 1e-12
    alone = ew.whiten(frame(spark, [(9, [0.5, 0.25]), (8, [0.5, 0.25])])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone} == {(1, 0, None, None, None)}


def test_very_large_entries(spark):
    """Beyond doubles' integers, and a deviation beyond a long."""
    rows = [(k, [float(2**40 * k), float(k % 3)]) for k in range(5)] + [(9, [1e300, -1e300])]
    got = ew.whiten(frame(spark, rows)).collect()
    assert len(got) == 12
    assert {r.deviation for r in got} == {None}
    assert all(math.isfinite(r.whitened) for r in got)
    assert got[0].identity_error < 1e-4


def test_empty_table_and_clashing_columns(spark):
    empty = ew.whiten(frame(spark, []))
    assert empty.collect() == []
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert ew.whiten(frame(spark, [(1, None), (2, [])])).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_query_on_the_whole_table(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(entries.op13_exact_whitening(spark, SF).collect(), rows)
