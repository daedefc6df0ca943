import math
from collections import defaultdict

import numpy as np
import pytest

from barlake.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n int, x string"


def valid(rows):
    out = []
    for r in rows:
        v = r[1]
        if v and all(c is not None and math.isfinite(c) for c in v):
            out.append((r[0], tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)))
    return out


def plain(rows, k=16):
    """(n, {x: deviation}, eigenvalues, share, unit vectors) by exact integers and a dense eigensolver."""
    distinct = sorted({x for _, x in rows})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    deviation = {x: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in distinct}
    y = (np.array(distinct) - 1_000_000) - (np.array(sums) - n * 1_000_000) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(values)[::-1][:k]
    return n, deviation, values[order], values[order] / values.sum(), vectors[:, order].T, dict(zip(distinct, y))


def compare(got, rows, k=16, rank=None):
    n, deviation, values, share, vectors, centred = plain(rows, k)
    rank = rank or min(k, len(values))
    by_row = defaultdict(list)
    for r in got:
        by_row[r.vec_id].append(r)
    expected = defaultdict(list)
    for i, x in rows:
        expected[i].append(x)
    assert set(by_row) == set(expected) and len(got) == rank * len(rows)
    signs = {}
    for i, xs in expected.items():
        assert sorted(r.component for r in by_row[i]) == sorted(list(range(1, rank + 1)) * len(xs))
        if len(xs) > 1:
            continue
        for r in by_row[i]:
            c = r.component - 1
            assert r.n == n and r.deviation == deviation[xs[0]] and abs(r.explained / share[c] - 1) < 1e-9
            assert r.identity_error < 1e-9
            want = float(centred[xs[0]] @ vectors[c]) / math.sqrt(values[c])
            if abs(want) > 1e-6:
                s = signs.setdefault(c, np.sign(want * r.whitened))
                assert abs(r.whitened - s * want) < 1e-6 * max(1, abs(want))


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op11_whitening(spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = valid((r.vec_id, r.embedding) for r in queries.table(spark, sf, "embeddings").collect())
    compare(got.collect(), rows)


@pytest.fixture()
def run(spark, monkeypatch, tmp_dir):
    def go(data, parts=7):
        spark.createDataFrame(data, SCHEMA).repartition(parts).write.parquet(f"{tmp_dir}/embeddings.parquet")
        return queries.op11_whitening(spark, tmp_dir).collect()
    return go


def test_dropped_vectors_copies_and_many_triangles(run, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 5)
    pick = np.random.default_rng(3)
    good = [(i, [float(c) for c in v], 0, i, "a") for i, v in enumerate(pick.normal(size=(90, 6)) * [9, 5, 3, 2, 1, .5])]
    good += [(100 + i, good[i % 3][1], 0, i, "copy") for i in range(60)] + [(None, good[4][1], None, None, None)]
    bad = [(900, None, 0, 0, ""), (901, [], 0, 0, ""), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0, 0, ""),
           (903, [1.0] * 5 + [float("nan")], 0, 0, ""), (904, [float("inf")] * 6, 0, 0, ""), (905, [1.0, 2.0], 0, 0, "")]
    compare(run(good + bad), valid(good))


def test_fewer_vectors_than_dimensions(run):
    pick = np.random.default_rng(4)
    data = [(i, [float(c) for c in v], 0, 0, "") for i, v in enumerate(pick.normal(size=(4, 9)) * 10)]
    compare(run(data), valid(data), rank=3)


@pytest.mark.parametrize("data", [[], [(1, [1.0, 2.0], 0, 0, "")], [(1, None, 0, 0, ""), (2, [], 0, 0, "")],
                                  [(i, [0.5, 0.25], 0, 0, "") for i in range(5)]])
def test_no_component(run, data):
    assert run(data) == []


def test_deviations_beyond_small_numbers():
    x = np.array([[2**53, 7], [-2**53, 9], [0, 8]])
    sums = [int(c) for c in x.sum(axis=0)]
    m = whitening.Model(3, sums, None, None, None, 0.0)
    exact = [sum((3 * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert whitening._deviations(x, m) == [v if v < 2**63 else None for v in exact]
    m = whitening.Model(3, [24, 24], None, None, None, 0.0)
    assert whitening._deviations(np.array([[7, 9]]), m) == [9 + 9]


def matrices():
    pick = np.random.default_rng(0)
    for d in (1, 2, 3, 17, 64):
        yield pick.normal(size=(300, d))
        yield pick.normal(size=(300, d)) * np.logspace(0, -6, d)
        yield pick.normal(size=(300, d)) * np.logspace(-6, 0, d)
        yield np.eye(d) * 3
        yield np.vstack([np.eye(d), 1e-9 * pick.normal(size=(d, d))])
        yield pick.normal(size=(max(1, d // 2), d))
        yield np.repeat(pick.normal(size=(300, 1)), d, 1)
        yield pick.integers(0, 2, size=(200, d)).astype(float)
        yield np.zeros((4, d))
    yield np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1)


@pytest.mark.parametrize("a", list(matrices()))
def test_solver_against_a_dense_one(a):
    r = whitening._triangle(a[k:k + 37] for k in range(0, len(a), 37))
    values, vectors = whitening.singular(r, 16)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    top = want[0] if len(want) else 0
    real = [v for v in want[:16] if v > (a.shape[1] * 2.3e-16) ** 2 * top * 10 and v > 1e-20 * top]
    assert len(values) == len(real)
    if real:
        assert np.abs(values / real - 1).max() < 1e-7
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
        assert max(np.linalg.norm(a.T @ (a @ v) - e * v) for e, v in zip(values, vectors)) < 1e-12 * top
