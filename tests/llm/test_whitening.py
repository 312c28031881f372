import math
from fractions import Fraction

import numpy as np
import pytest

from holdfast.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, size string, k int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "n") for i, v in rows], SCHEMA)


def exact_matrix(rows):
    """Whole-number entries, their sums and the covariance as exact fractions."""
    x = [[math.floor(1024 * c) + 100_000 for c in row] for row in rows]
    n, size = len(x), len(x[0])
    s = [sum(row[i] for row in x) for i in range(size)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(size)] for i in range(size)]
    return x, s, cov


def made(seed, n, size, spread=None):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, size)) * (np.ones(size) if spread is None else spread)
    return values.astype(np.float32).astype(float).tolist()


@pytest.mark.parametrize("kind", ["random", "clustered", "multiple", "graded", "rank"])
def test_eigenvectors_to_the_arithmetic(kind):
    rng = np.random.default_rng(3)
    size = 24
    q = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values = {
        "random": rng.uniform(1, 2, size),
        "clustered": 1 + np.arange(size) // 6 + np.arange(size) * 1e-10,
        "multiple": 1.0 + np.arange(size) // 8,
        "graded": 10.0 ** -np.arange(size),
        "rank": np.where(np.arange(size) < 5, 5.0 - np.arange(size), 0.0),
    }[kind]
    matrix = (q * values) @ q.T
    matrix = ((matrix + matrix.T) / 2).astype(wh.WIDE)
    found, x = wh.eigenvectors(matrix)
    assert (np.diff(found) <= 1e-17).all()
    assert np.abs(x.T @ x - np.eye(size)).max() < 1e-17
    assert np.abs(matrix @ x - x * found).max() < 2e-17 * size * values.max()
    assert np.abs(found.astype(float) - np.sort(values)[::-1]).max() < 1e-14 * values.max()


def test_a_cluster_is_resolved_beyond_doubles():
    """Two eigenvectors whose eigenvalues differ by 1e-12: a double solver is off by 1e-4, the refined ones are not."""
    turn = np.array([[3, 4], [-4, 3]], dtype=wh.WIDE) / 5
    values = np.array([1 + wh.WIDE(10) ** -12, 1], dtype=wh.WIDE)
    _, x = wh.eigenvectors((turn * values) @ turn.T)
    assert np.abs(np.abs(x) - np.abs(turn)).max() < 1e-6


def test_products_are_exact():
    for most in (10, 1 << 19, 1 << 40):
        entries = np.random.default_rng(1).integers(-most, most, size=(2_000 if most < 1 << 30 else 50, 5))
        wide = entries.astype(object)
        assert (wh.products_of(entries) == wide.T @ wide).all()


@pytest.mark.parametrize("size,spread", [(12, None), (12, [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1e-3, 1e-3]), (3, None)])
def test_against_exact_arithmetic(spark, size, spread):
    values = made(5, 300, size, spread)
    rows = frame(spark, list(enumerate(values)))
    got = wh.by_component(rows.repartition(4)).collect()
    x, s, cov = exact_matrix(values)
    reference, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    order = np.argsort(-reference)[:8]
    trace = float(sum(cov[i][i] for i in range(size)))
    signs = {}
    assert len(got) == 300 * min(8, size)
    for r in got:
        k, row = r["component"] - 1, x[r["vec_id"]]
        assert r["n"] == 300 and r["deviation"] == sum((300 * row[i] - s[i]) ** 2 for i in range(size))
        assert r["explained"] == pytest.approx(reference[order[k]] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-10
        plain = sum((row[i] - s[i] / 300) * vectors[i, order[k]] for i in range(size)) / math.sqrt(reference[order[k]])
        sign = signs.setdefault(k, 1 if plain * r["whitened"] > 0 else -1)
        assert sign * plain == pytest.approx(r["whitened"], abs=1e-8)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = made(7, 40, 4)
    rows = list(enumerate(good)) + [(None, good[0]), (1, good[1]), (1, good[1])]
    bad = [(90, None), (91, []), (92, [1.0, None, 0.0, 0.0]), (93, [nan, 0.0, 0.0, 0.0]), (94, [inf, 0.0, 0.0, 0.0]),
           (95, [1e30, 0.0, 0.0, 0.0])]
    other = [(200 + i, v) for i, v in enumerate(made(8, 30, 2))]
    got = wh.by_component(frame(spark, rows + bad + other)).collect()
    assert {r["n"] for r in got if r["size"] == 4} == {43} and {r["n"] for r in got if r["size"] == 2} == {30}
    assert len(got) == 43 * 4 + 30 * 2
    assert all(r["vec_id"] is None or r["vec_id"] < 90 or r["vec_id"] >= 200 for r in got)
    assert max(r["identity_error"] for r in got) < 1e-10


def test_directions_without_variance_are_no_components(spark):
    flat = [[a, 2 * a, 0.5] for a in (0.25, 0.5, 1.0, 3.0)]
    got = wh.by_component(frame(spark, list(enumerate(flat)))).collect()
    assert [r["component"] for r in got] == [1] * 4 and got[0]["identity_error"] < 1e-12
    assert wh.by_component(frame(spark, [(1, [1.0, 2.0])] * 9)).count() == 0
    assert wh.by_component(frame(spark, [(1, [1.0, 2.0])])).count() == 0


def test_many_lengths_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(wh, "HANDED_BYTES", 100)
    rows = [(i, v) for size in range(1, 7) for i, v in enumerate(made(size, 20, size))]
    got = wh.by_component(frame(spark, rows)).collect()
    assert len(got) == 20 * sum(range(1, 7)) and max(r["identity_error"] for r in got) < 1e-10


def test_large_entries_and_deviations_beyond_a_long(spark):
    rows = [(i, [c * 1e6 for c in v]) for i, v in enumerate(made(2, 3_000, 2))]
    got = wh.by_component(frame(spark, rows))
    assert got.where("deviation is null").count() > 0 and got.agg({"identity_error": "max"}).first()[0] < 1e-9
    whole, _ = wh.whiten(frame(spark, rows))
    x, s, _ = exact_matrix([v for _, v in rows[:0]] or [[np.float32(c) for c in v] for _, v in rows])
    for r in whole.limit(20).collect():
        assert int(r["deviation"]) == sum((3_000 * x[r["id"]][i] - s[i]) ** 2 for i in range(2))


def test_empty_table(spark):
    assert wh.by_component(frame(spark, [])).count() == 0
