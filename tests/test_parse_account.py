from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from holdfast.operators import quality
from holdfast.operators.features import derive_features
from holdfast.operators.quality import ReconciliationError, content_digest, reconcile_content, write_reconciled
from holdfast.plans import etl, run_etl, train_churn
from holdfast.schema import CLEANED_SCHEMA, COMPLAINTS, TELCO_SCHEMA, with_complaints
from holdfast.sources.files import load_cleaned, read_csv, read_csv_marked, write_parquet

NAMES = TELCO_SCHEMA.fieldNames()


def line(key, complaints=None, **values):
    fields = [key if n == "customerID" else values.get(n, "") for n in NAMES]
    return ",".join(fields if complaints is None else [*fields, complaints])


COUNTS = {"bad": "abc", "fraction": "2.0", "big": "3000000000", "none": "", "blank": "  ", "some": "4", "zero": "0",
          "huge": "99999999999999999999"}


@pytest.fixture
def counted(csv_file):
    lines = [line(key, text, tenure="5", Churn="No") for key, text in COUNTS.items()]
    return csv_file(",".join([*NAMES, COMPLAINTS]), *lines)


def test_no_unreadable_count_is_taken_for_none(spark, counted, tmp_path):
    report = run_etl(spark, counted, str(tmp_path))
    table = load_cleaned(spark, str(tmp_path), with_complaints(CLEANED_SCHEMA, marked=True))
    found = {r["customerID"]: r["complaints_90d"] for r in derive_features(table).collect()}
    assert found == {"bad": None, "fraction": None, "huge": None, "big": 3_000_000_000, "none": 0, "blank": 0, "some": 4,
                     "zero": 0}
    assert report.unreadable == {"SeniorCitizen": 0, "tenure": 0, "MonthlyCharges": 0, "TotalCharges": 0, COMPLAINTS: 3}


def test_account_by_column(spark, csv_file, tmp_path):
    path = csv_file(
        ",".join(NAMES),
        line("a", tenure="x", MonthlyCharges='"1,200"', Churn="No"),
        line("a", tenure="y", MonthlyCharges="zz", Churn="No"),  # the same row once read
        line("b", tenure=" ", TotalCharges="1e3", Churn="Yes"),
        line("c", SeniorCitizen="1.5", tenure="7", Churn="Yes"),
        "d,Female",
        line("e", tenure="8") + ",more",
        line("", tenure="q"),
    )
    report = run_etl(spark, path, str(tmp_path))
    assert report.unreadable == {"SeniorCitizen": 1, "tenure": 3, "MonthlyCharges": 2, "TotalCharges": 0}
    assert (report.rows_read, report.duplicate_rows, report.rows_without_key, report.rows_written) == (7, 1, 1, 5)
    assert report.malformed_rows == 7  # a blank number, too few and too many fields are irregular too


def test_numbers_kept_as_text_are_accounted_for(spark, csv_file, tmp_path):
    schema = spark.createDataFrame([], "name STRING, n STRING, m INT").schema
    report = run_etl(spark, csv_file("name,n,m", "a,1,1", "b,x,2", "c, ,z"), str(tmp_path), schema, ["n"], "name")
    assert report.unreadable == {"m": 1, "n": 1}


def test_marked_rows_equal_the_plain_ones(spark, csv_file):
    path = csv_file("id,n,amt", '"q""x",5,NaN', "b,xx,4.5", "c,3", "d,4,5.5,EXTRA", ' e ,7, 7.5 ', 'f,6,"1,200"', 'g,,""')
    schema = spark.createDataFrame([], "id STRING, n INT, amt DOUBLE").schema
    marked = read_csv_marked(spark, path, schema, "mark")
    plain = read_csv(spark, path, schema)
    assert sorted(map(str, marked.drop("mark").collect())) == sorted(map(str, plain.collect()))
    marks = {r["id"]: r["mark"] for r in marked.collect()}
    assert {k: v for k, v in marks.items() if v} == {"b": ["n"], "f": ["amt"]}
    assert marks["c"] == [] == marks["d"] and marks["g"] is None


def test_one_pass_over_the_text(spark, counted, plan_of):
    raw = read_csv_marked(spark, counted, with_complaints(TELCO_SCHEMA), etl.UNREADABLE, check_header=True)
    clean, _ = etl.cleanse_counted(raw)
    assert plan_of(clean).count("FileScan csv") == 1 and plan_of(clean).count("Exchange") == 1


def test_training_fills_unreadable_counts(spark, tmp_path, csv_file):
    header = ",".join([*NAMES, COMPLAINTS])
    lines = [line(f"k{i}", "abc" if i % 5 == 0 else str(i % 7), Contract="m", MonthlyCharges=str(20 + i), tenure=str(i),
                  Churn="Yes" if i % 3 else "No") for i in range(60)]
    report = run_etl(spark, csv_file(header, *lines), str(tmp_path))
    assert report.unreadable[COMPLAINTS] == 12
    assert train_churn(spark, str(tmp_path), f"{tmp_path}/models").train_rows > 0


def test_a_failed_run_leaves_the_old_table(spark, counted, csv_file, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    run_etl(spark, counted, base)
    schema = with_complaints(CLEANED_SCHEMA, marked=True)

    def off_by_one(written, table, *args):
        raise ReconciliationError("8 rows written, 7 read back")

    monkeypatch.setattr(etl, "reconcile_content", off_by_one)
    with pytest.raises(ReconciliationError):
        run_etl(spark, csv_file(",".join(NAMES), line("new", Churn="No"), name="next.csv"), base)
    assert {r["customerID"] for r in load_cleaned(spark, base, schema).collect()} == set(COUNTS)
    monkeypatch.undo()
    run_etl(spark, csv_file(",".join(NAMES), line("new", Churn="No"), name="next.csv"), base)
    assert {r["customerID"] for r in load_cleaned(spark, base, schema).collect()} == {"new"}


def digest(df, parts=None):
    return df.agg(*content_digest(df, parts)).first().asDict()


@pytest.mark.parametrize("parts", [None, ["part"]])
def test_digest_tells_swapped_values(spark, parts):
    rows = [(i, f"v{i}", None if i % 3 else "x", [float(i)], {"k": i}) for i in range(40)]
    schema = "id INT, value STRING, part STRING, xs ARRAY<DOUBLE>, m MAP<STRING, INT>"
    df = spark.createDataFrame(rows, schema)
    seen = digest(df, parts)
    assert reconcile_content(seen, df.repartition(7).orderBy("value"), parts) == 40
    swapped = [(i, f"v{j}", p, x, m) for (i, _, p, x, m), j in zip(rows, [1, 0, *range(2, 40)], strict=True)]
    twice = [rows[0], *rows[:39]]
    for wrong in (swapped, twice, [(i, v, "y", x, m) if i == 5 else (i, v, p, x, m) for i, v, p, x, m in rows]):
        with pytest.raises(ReconciliationError, match="not the content"):
            reconcile_content(seen, spark.createDataFrame(wrong, schema), parts)
    with pytest.raises(ReconciliationError, match="40 rows written, 39 read back"):
        reconcile_content(seen, spark.createDataFrame(rows[1:], schema), parts)


def test_a_value_changed_by_the_writer_is_found(spark, tmp_path, monkeypatch):
    df = spark.range(60).select("id", (F.col("id") % 2).cast("string").alias("part"), F.lit("").alias("note"))
    write_reconciled(df, str(tmp_path), "t", ["part"])

    def careless(rows, *args):
        return write_parquet(rows.withColumn("id", F.when(F.col("id") == 7, 9).otherwise(F.col("id"))), *args)

    monkeypatch.setattr(quality, "write_parquet", careless)
    with pytest.raises(ReconciliationError, match=r"not the content.*\('1',\)"):
        write_reconciled(df, str(tmp_path), "t", ["part"])
    assert load_cleaned(spark, str(tmp_path), df.schema, "t").where("id = 7").count() == 1


def test_blank_partition_values_reconcile(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "02")], "id INT, part STRING")
    assert write_reconciled(df, str(tmp_path), "t", ["part"])[1:] == (3, 3)


def test_an_empty_table_reconciles(spark, tmp_path):
    df = spark.createDataFrame([], "id INT, part STRING")
    assert write_reconciled(df, str(tmp_path), "t", ["part"])[1:] == (0, 0)
