"""Contour integration against a dense solver, and whitening against plain NumPy."""

import numpy as np
import pytest

from panelspark.llm.queries import QUERIES
from panelspark.llm.whitening import Spectrum, components, project, whiten

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def symmetric(values, seed=0):
    random = np.random.default_rng(seed)
    q, _ = np.linalg.qr(random.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 40),
        np.r_[np.ones(20), 5, 5, 5, 7.0],
        np.r_[1e-6, 1e-3, 1, 1e3, 1e6],
        np.r_[3.0],
        np.r_[2.0, 2.0],
        np.exp(np.linspace(0, 5, 130)),
    ],
)
@pytest.mark.parametrize("k", [1, 4, 11])
def test_components_equal_a_dense_solver(values, k):
    v = symmetric(values)
    e, rows = components(v, k)
    want = np.sort(values)[::-1][:k]
    assert len(e) == len(want)
    scale = want[0]
    assert np.abs(e - want).max() < 1e-12 * scale
    assert np.abs(rows @ rows.T - np.eye(len(e))).max() < 1e-10
    assert np.abs(v @ rows.T - rows.T * e).max() < 1e-12 * scale * len(values)


def test_inertia_counts_and_places():
    values = np.r_[-3.0, -1, 0, 2, 2, 9]
    s = Spectrum(symmetric(values, 3))
    for shift in (-4, -2, -0.5, 1, 3, 10):
        assert s.above(shift) == (values > shift).sum()
    assert [round(s.place(k), 9) for k in range(1, 7)] == [9, 2, 2, 0, -1, -3]
    # a gap is needed for an end: the two 2s share an interval
    assert [c for _, _, c in s.intervals(2)] == [3]


def test_missing_pairs_are_noticed():
    v = symmetric(np.r_[1.0, 2, 3, 4])
    with pytest.raises(ArithmeticError):
        project(v, 2.5, 5.0, 3)


def brute(rows, k):
    good = [(i, [float(c) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = {i: np.floor(256 * np.array(v)).astype(int) for i, v in good}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(e)[::-1][:k]
    out = {}
    for i, v in x.items():
        for j, o in enumerate(order):
            out[i, j + 1] = (n, int(((n * v - s) ** 2).sum()), abs((v - s / n) @ u[:, o]) / np.sqrt(e[o]), e[o] / e.sum())
    return out


def check(got, want):
    assert {(r["vec_id"], r["component"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - whitened) < 1e-8
        assert abs(r["explained"] / explained - 1) < 1e-9
        assert r["identity_error"] < 1e-9


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op11_whitening"](spark, SMALL).collect()
    check(got, brute(rows, 4))
    signs = {}
    for r in got:  # one sign for all rows: the projections are those of one vector
        signs.setdefault(r["component"], []).append(r["whitened"])
    assert all(abs(np.mean(v)) < 0.2 for v in signs.values())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    random = np.random.default_rng(1)
    rows = [(i, [float(c) for c in random.normal(0, 0.1, 3)]) for i in range(40)]
    rows += [(100, rows[0][1]), (100, rows[1][1]), (101, rows[0][1])] + [(200 + i, rows[2][1]) for i in range(60)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [nan, 0.0, 0.0]), (904, [inf, 0.0, 0.0]), (905, [1.0, 2.0]), (906, [3e38, 0.0, 0.0])]
    clash = spark.createDataFrame([(*r, 1, "a", 2.0) for r in rows + odd], SCHEMA + ", n int, x string, whitened double")
    got = whiten(clash, "vec_id", "embedding", 4).collect()
    seen = [r for r in got if r["vec_id"] == 100]
    assert len(seen) == 2 * 3  # repeated ids stay, three dimensions have three components
    want = brute([r for r in rows if r[0] != 100] + [(100, rows[0][1])], 3)
    check([r for r in got if r["vec_id"] != 100], {key: v for key, v in want.items() if key[0] != 100})


def test_tables_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty, "vec_id", "embedding", 4).collect() == []
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SCHEMA)
    assert whiten(same, "vec_id", "embedding", 4).collect() == []
    line = spark.createDataFrame([(i, [i / 4, i / 2]) for i in range(5)], SCHEMA)
    assert {r["component"] for r in whiten(line, "vec_id", "embedding", 4).collect()} == {1}
    with pytest.raises(ValueError):
        whiten(line.withColumnRenamed("vec_id", "n"), "n", "embedding", 4)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**40 * (i + 1)), float(i * i)]) for i in range(6)]
    got = whiten(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 1).collect()
    x = np.array([[int(256 * c) for c in v] for _, v in rows], object)
    want = [int(((6 * v - x.sum(0)) ** 2).sum()) for v in x]
    assert [r["deviation"] for r in sorted(got)] == [w if w < 2**63 else None for w in want]
