from __future__ import annotations

import random

import pytest

from holdfast.operators import medians
from holdfast.operators.medians import exact_medians


def lower_middle(values):
    return sorted(values)[(len(values) - 1) // 2]


def columns(seed, n):
    rng = random.Random(seed)
    return {
        "plain": [rng.gauss(0, 1) for _ in range(n)],
        "ties": [float(rng.randrange(3)) for _ in range(n)],
        "hot": [7.25 if rng.random() < 0.6 else rng.gauss(0, 100) for _ in range(n)],
        "wide": [rng.choice((-1, 1)) * 10.0 ** rng.uniform(-300, 300) for _ in range(n)],
        "steps": [2.0 ** rng.randrange(-1000, 1000) for _ in range(n)],
        "holes": [None if rng.random() < 0.5 else rng.random() for _ in range(n)],
        "zero": [rng.choice((0.0, -0.0, 1e-320, -1e-320)) for _ in range(n)],
    }


@pytest.mark.parametrize("few,parts", [(20_000, 1_000), (50, 1_000), (10, 5)])
@pytest.mark.parametrize("n", [1, 2, 4_000])
def test_against_sorting(spark, monkeypatch, few, parts, n):
    monkeypatch.setattr(medians, "FEW_ROWS", few)
    monkeypatch.setattr(medians, "PARTS", parts)
    data = columns(n, n)
    rows = list(zip(*data.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in data)).repartition(5)
    found = exact_medians(df, list(data))
    for c, values in data.items():
        present = [v for v in values if v is not None]
        assert found.get(c) == (lower_middle(present) if present else None)


def test_what_is_no_number_does_not_count(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, None), (inf, None), (-inf, None), (3.0, None), (1.0, None)], "a DOUBLE, b DOUBLE")
    assert exact_medians(df, ["a", "b"]) == {"a": 1.0}
    assert exact_medians(df, []) == {} == exact_medians(df.limit(0), ["a"])


def test_a_summary_that_is_off_is_found_out(spark, monkeypatch):
    """Ranges that miss the middle are widened again, because counts decide."""
    monkeypatch.setattr(medians, "FEW_ROWS", 20)
    monkeypatch.setattr(medians, "ACCURACY", 8)
    monkeypatch.setattr(medians, "PARTS", 50)
    data = columns(3, 600)["plain"]
    df = spark.createDataFrame([(v,) for v in data], "a DOUBLE").repartition(3)
    assert exact_medians(df, ["a"]) == {"a": lower_middle(data)}


def test_passes_are_few(spark, monkeypatch):
    passes = []
    learn = medians.Search.learn
    monkeypatch.setattr(medians, "FEW_ROWS", 100)
    monkeypatch.setattr(medians.Search, "learn", lambda *args, **kwargs: passes.append(1) or learn(*args, **kwargs))
    df = spark.range(1_000_000).selectExpr("pow(2.0, id % 1900 - 950) * (1 + id) AS a")
    found = exact_medians(df, ["a"])
    assert df.where(f"a < {found['a']!r}D").count() <= 499_999 < df.where(f"a <= {found['a']!r}D").count()
    assert len(passes) <= 5
