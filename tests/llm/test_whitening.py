"""Whitening against a dense eigendecomposition of the exact covariance."""

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from paddock.llm import whitening as W

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("x", T.StringType()), T.StructField("ids", T.IntegerType())])


@pytest.fixture()
def vectors(stored):
    def make(rows, name="vectors"):
        return stored([(i, None if v is None else [None if c is None else float(c) for c in v], "a", 1)
                       for i, v in rows], SCHEMA, name, files=3)
    return make


def dense(rows):
    """(ids, exact deviations, centred rows, eigenvalues, eigenvectors)."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(
        c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good]
    n, total = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * c - s)**2 for c, s in zip(row, total)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, total)] for row in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in good], dev, centred, e[::-1], v[:, ::-1]


def held(rows, out, components):
    ids, dev, centred, e, v = dense(rows)
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in out) == Counter(
        (i, c + 1, len(ids), x) for i, x in zip(ids, dev) for c in range(k))
    assert {r.component: r.explained for r in out} == pytest.approx(
        {c + 1: e[c] / e.sum() for c in range(k)}, rel=1e-9)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    want = centred @ v[:, :k] / np.sqrt(e[:k])
    got = np.zeros((len(ids), k))
    place = {i: p for p, i in enumerate(ids)}
    for r in out:
        got[place[r.vec_id], r.component - 1] = r.whitened
    sign = np.sign((want * got).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-7


@pytest.mark.parametrize("shape", ["flat", "steep", "clusters", "narrow"])
def test_against_dense(vectors, shape):
    draw = np.random.default_rng(4)
    d = 5 if shape == "narrow" else 40
    z = draw.standard_normal((400, d))
    if shape == "steep":
        z = z * 2.0 ** -np.arange(d)[None, :]
        z *= 30
    if shape == "clusters":
        z += 20 * draw.standard_normal((4, d))[draw.integers(0, 4, 400)]
    rows = list(enumerate(z.astype(np.float32)))
    out = W.whiten(vectors(rows), 6, guard=4).collect()
    held(rows, out, 6)


def test_query(spark):
    from paddock.llm.queries import op13_whitening
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    held(rows, op13_whitening(spark, sf).collect(), 32)


def test_odd_rows(vectors):
    draw = np.random.default_rng(5)
    good = [(i, draw.standard_normal(4)) for i in range(30)]
    odd = [(100, None), (101, [1, None, 2, 3]), (102, [1, math.nan, 2, 3]), (103, [1, 2, math.inf, 3]),
           (104, []), (105, [1e30, 0, 0, 0]), (106, [1, 2, 3]), (107, [1, 2, 3, 4, 5])]
    same = [(7, good[7][1])]
    out = W.whiten(vectors(good + odd + same)).collect()
    assert {r.vec_id for r in out} == set(range(30)) and len(out) == 31 * 4
    assert out[0].n == 31
    assert len({round(r.whitened, 9) for r in out if r.vec_id == 7}) == 4
    named = W.whiten(vectors([(None, v) for _, v in good], "nameless")).collect()
    assert len(named) == 120 and {r.vec_id for r in named} == {None}


def test_nothing_to_whiten(vectors):
    for name, rows in (("none", []), ("nulls", [(1, None)]), ("one", [(1, [1, 2])]),
                       ("equal", [(i, [1, 2, 3]) for i in range(5)])):
        out = W.whiten(vectors(rows, name))
        assert out.columns == [c.split()[0] for c in W.ROWS.split(", ")] and out.count() == 0


def test_lost_rank(vectors):
    draw = np.random.default_rng(6)
    a = draw.integers(-20, 20, (50, 3))
    rows = [(i, np.concatenate((v, v, [1, 1]))) for i, v in enumerate(a)]
    held(rows, W.whiten(vectors(rows), 8).collect(), 8)
    held(rows, W.whiten(vectors(rows, "again"), 8, guard=0).collect(), 8)


def test_exact_deviations():
    big = np.array([[2**40, 0], [-2**40, 5], [3, 2**39]])
    total = big.astype(object).sum(axis=0)
    for n, sums in ((3, total), (10**12, [123456789012345678901, -7])):
        c = W.Centre(n, tuple(map(int, sums)))
        want = [sum((n * int(x) - int(s))**2 for x, s in zip(row, sums)) for row in big]
        assert c.deviations(big) == [w if w < 2**63 else None for w in want]
        assert c.rows(big) == pytest.approx(np.array([[float(Fraction(n * int(x) - int(s), n))
                                                       for x, s in zip(row, sums)] for row in big]))


@pytest.mark.parametrize("spectrum", [
    np.linspace(10, 9, 60), 2.0 ** -np.arange(60), np.r_[np.full(30, 5.0), np.full(30, 1.0)],
    np.r_[1e6, 1e3, np.linspace(2, 1, 58)], np.r_[np.ones(3), np.zeros(57)], np.ones(60),
    np.linspace(1, 1 + 1e-9, 60)])
def test_filter_on_given_spectra(spectrum):
    spectrum = np.sort(spectrum)[::-1]
    draw = np.random.default_rng(8)
    turn = np.linalg.qr(draw.standard_normal((60, 60)))[0]
    v = (turn * spectrum) @ turn.T
    found = W.leading(lambda q: v @ q, 60, 8, 6)
    assert found.values == pytest.approx(spectrum[:8], abs=1e-11 * spectrum[0])
    assert (found.residuals <= 1e-12 * spectrum[0]).all() and found.passes < 400
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12
    low = W.lower_end(lambda q: v @ q, 60, draw)
    assert low <= spectrum[-1] * (1 + 1e-9)
