import re
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from holdfast.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string, key string, bucket int"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for norm, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        order = known + [None] * (len(ids) - len(known))
        for at, i in enumerate(order):
            digest = sha256(norm.encode()).hexdigest()
            out.append((i, known[0] if known else None, len(ids), at == 0, digest))
    return sorted(out, key=repr)


def found(df):
    rows = ed.exact_groups(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted(map(tuple, rows), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


EDGES = [(5, None), (3, ""), (3, ""), (None, "a b"), (9, "a\tb"), (-4, "a \n b"), (2, " a b"), (None, None), (7, "ab")]


def test_edge_rows(spark):
    assert found(frame(spark, EDGES)) == brute(EDGES)


def test_a_group_over_many_buckets(spark):
    rows = [(i, "same  text" if i % 3 else f"text {i} " * (i % 7)) for i in range(1500)]
    assert found(frame(spark, rows).repartition(7)) == brute(rows)


def test_empty_table(spark):
    assert found(frame(spark, [])) == []
    assert ed.drop_exact_copies(frame(spark, [])).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-50, 50), st.text("ab \t", max_size=3)), max_size=60))
def test_like_brute_force(spark, rows):
    assert found(frame(spark, rows)) == brute(rows)


def test_rows_that_stay_keep_their_columns(spark):
    df = frame(spark, EDGES)
    kept = ed.drop_exact_copies(df)
    assert kept.columns == df.columns
    by_text = {re.sub(r"\s+", " ", r["text"] or ""): r["doc_id"] for r in kept.collect()}
    assert by_text == {"": 3, "a b": -4, " a b": 2, "ab": 7}
    assert kept.count() == 4


def test_long_texts_that_differ_at_the_end(spark):
    rows = [(i, "word " * 40_000 + str(i % 2)) for i in range(6)]
    assert found(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("ids", [[-(2**63), -1, 0, 1, 2**40, 2**63 - 1, None]])
def test_order_key_sorts_identifiers(spark, ids):
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "id long")
    keyed = df.select("id", ed.order_key(ed.F.lit("k"), ed.F.col("id")).alias("key")).orderBy("key")
    assert [r["id"] for r in keyed.collect()] == ids


def test_no_python_in_the_plan(spark, plan_of):
    plan = plan_of(ed.content_sorted(frame(spark, EDGES), "doc_id", "text", ed.F.lit(None).cast("string")))
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.count("Exchange") == 1


def test_the_unpartitioned_windows_carry_no_text(spark, plan_of):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(300)]
    runs = ed.staged(ed.content_sorted(frame(spark, rows), "doc_id", "text", ed.F.lit(None).cast("string")))
    keys = ed.bucket_keys(runs)
    assert not any("text" in c for c in keys.columns)
    single = [line for line in plan_of(keys, "simple").splitlines() if "SinglePartition" in line or "Window" in line]
    assert single and not any("edge_text" in line for line in single)
    assert "Window" not in plan_of(ed.continued_runs(runs)) or "opening_text" not in plan_of(ed.continued_runs(runs))


def test_texts_are_kept_as_they_were(spark):
    rows = [(2, "a  b"), (1, "a\tb"), (3, None), (4, ""), (5, "c\n")]
    assert {(r["doc_id"], r["text"]) for r in ed.drop_exact_copies(frame(spark, rows)).collect()} == {
        (1, "a\tb"), (3, None), (5, "c\n")}
    only = spark.createDataFrame([("x",), ("x",)], "text string").selectExpr("text", "monotonically_increasing_id() AS doc_id")
    assert ed.drop_exact_copies(only).columns == ["text", "doc_id"]
