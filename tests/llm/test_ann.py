import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, query_ids, k):
    usable = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, vector in usable:
        if q not in query_ids:
            continue
        scores = [(-(w * vector).sum() / (np.sqrt((w * w).sum()) * np.sqrt((vector * vector).sum())), i) for i, w in usable if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df, is_query, **settings):
    out = {}
    for r in sorted(ann.search(df, is_query, **settings).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]),
            (11, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], SCHEMA)
    expected = brute([r for r in rows if r[0] != 11][:-1], {0, 5, 9}, 5)
    assert found(df, F.col("vec_id").isin(0, 5, 9)) == expected
    assert found(df.limit(0), F.lit(True)) == {}


def test_vectors_of_every_length_are_searched(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3 if i % 3 == 0 else 4).tolist()) for i in range(60)]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], SCHEMA)
    queries = {0, 1, 3, 10}
    expected = {}
    for length in (3, 4):
        expected |= brute([r for r in rows if len(r[1]) == length], queries, 5)
    result = found(df, F.col("vec_id").isin(*queries), recall=1.0, parts=1)
    assert {q: [i for i, _ in near] for q, near in result.items()} == {q: [i for i, _ in near] for q, near in expected.items()}


def test_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    common = rng.standard_normal(8).tolist()
    rows = [(i, common if i % 3 == 0 else rng.standard_normal(8).tolist()) for i in range(300)]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], SCHEMA)
    asked = {i for i in range(300) if i % 30 == 0}
    result = found(df, F.col("vec_id") % 30 == 0)
    assert set(result) == asked
    smallest = [i for i in range(0, 21, 3)]
    for query, near in result.items():
        assert [i for i, _ in near] == [i for i in smallest if i != query][:5]
        assert {s for _, s in near} == {near[0][1]}


@pytest.mark.parametrize("blocks", [20_000, 40])
def test_recall(spark, monkeypatch, blocks):
    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", blocks)
    monkeypatch.setattr(ann, "QUERIES_PER_CHUNK", blocks)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.4 * rng.standard_normal(16)).tolist()) for i in range(1500)]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], SCHEMA)
    expected = brute(rows, set(range(0, 1500, 10)), 5)
    result = found(df, F.col("vec_id") % 10 == 0)
    assert set(result) == set(expected) and all(len(n) == 5 for n in result.values())
    hits = sum(len({i for i, _ in result[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    points = rng.standard_normal((400, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    near = ann.nearest_rows(points, points, 9)
    part = ann.balanced_parts(near, 8, rng)
    assert np.bincount(part).tolist() == [50] * 8
    cut = (part[near] != part[:, None]).mean()
    random_cut = (rng.permutation(part)[near] != part[:, None]).mean()
    assert cut < 0.8 * random_cut


def test_query_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = brute(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    got = ann.query(spark, sf_dir).collect()
    hits = sum(r["vec_id"] in {i for i, _ in expected[r["query_id"]]} for r in got)
    assert len(got) == 5 * len(expected) and hits / len(got) >= 0.9
