import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=4):
    """Exact sums in fractions, eigenvectors in doubles."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in kept:
        z = np.array([float(a - m) for a, m in zip(x, mean)])
        for k in range(min(components, dims)):
            out[i, k + 1] = (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), abs(z @ axes[:, k]) / math.sqrt(values[k]), values[k] / cov.trace())
    return out


def fixture(n=300, dims=7):
    rng = random.Random(5)
    spread = [3.0, 2.0, 1.2, 0.7, 0.2, 0.1, 0.05]
    rows = [(i, [rng.gauss(0.3, spread[d % 7]) + 0.1 * d for d in range(dims)]) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # one vector many times weighs once
    return rows


def test_matches_brute_force(spark):
    rows = fixture()
    bad = [(2000, None), (2001, [1.0, None] + [0.0] * 5), (2002, [float("nan")] * 7), (2003, [float("inf")] + [0.0] * 6), (2004, []), (2005, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + bad, SCHEMA).withColumn("id", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("x", F.lit(2)).repartition(5)
    got = {(r.vec_id, r.component): r for r in whitening.whitened(frame).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for key, (n, deviation, value, explained) in want.items():
        r = got[key]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(value, rel=1e-9, abs=1e-9) and r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9
    # one sign for all rows: whitened columns are orthonormal over the fit list
    w = np.array([[got[i, k].whitened for k in range(1, 5)] for i in range(300)])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9


@pytest.mark.parametrize("bits", [1, 9, 33, 64])
def test_bit_slices_are_exact(bits):
    rng = random.Random(bits)
    y = [[rng.randrange(2**bits) for _ in range(4)] for _ in range(131)]
    out = whitening.cross_products(np.array(y, np.uint64), bits)
    for i in range(4):
        for j in range(i, 4):
            assert sum(int(out[limb, i, j]) << whitening.LIMB * limb for limb in range(len(out))) == sum(r[i] * r[j] for r in y)


def test_packing_round_trip():
    for x in ([], [0], [-1, 32767], [32768, -32769], [2**31, 0], [-(2**63), 2**63 - 1]):
        values = np.array(x, np.int64)
        assert whitening.unpacked(whitening.packed(values)).tolist() == x


def test_large_entries_and_negative_zero(spark):
    rows = [(1, [1e30, -0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0]), (None, [5.0, 2.0]), (3, [5.0, 2.0])]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 10 and {r.n for r in got} == {3}
    # 2 ** 63 times anything is beyond 64 bits
    assert all(r.deviation is None for r in got if r.vec_id in (1, 2))
    assert [r.identity_error < 1e-4 for r in got] == [True] * 10


def test_no_variance_and_empty(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], SCHEMA)
    got = whitening.whitened(same).collect()
    assert len(got) == 15 and all(r.whitened is None and r.identity_error is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in got)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], SCHEMA)
    got = {(r.vec_id, r.component): r for r in whitening.whitened(line).collect()}
    assert len(got) == 10 and got[0, 2].whitened is None and got[0, 1].whitened is not None and got[0, 1].identity_error < 1e-9
    for rows in ([], [(1, None), (2, [])]):
        got = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
        assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_long_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(200)]) for i in range(150)]
    got = {(r.vec_id, r.component): r for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()}
    for key, (n, deviation, value, explained) in brute(rows).items():
        assert got[key].deviation == deviation and abs(got[key].whitened) == pytest.approx(value, rel=1e-6, abs=1e-9)
