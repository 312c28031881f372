from __future__ import annotations

import json
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.checks.queries import QUERIES
from holdfast.checks.views import COMPLAINTS_UNTIL, dirty_telco, telco, write_csv
from holdfast.operators.cleansing import cleanse
from holdfast.operators.quality import SchemaError
from holdfast.operators.splitting import random_split
from holdfast.plans import etl, run_all, run_etl, score_table, train_churn
from holdfast.plans.etl import cleanse_counted
from holdfast.schema import CLEANED_SCHEMA, COUNTED_TABLE, TELCO_SCHEMA, with_complaints
from holdfast.sources.files import load_cleaned, read_csv, write_parquet
from jobs.churn import STEPS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return write_csv(dirty_telco(spark, SF), spark)


def test_etl_counts_and_table(spark, raw, tmp_path):
    report = run_etl(spark, raw, str(tmp_path))
    expected = cleanse(read_csv(spark, raw, TELCO_SCHEMA))
    table = load_cleaned(spark, str(tmp_path))
    assert report.rows_read == 165
    assert report.rows_read == report.rows_without_key + report.duplicate_rows + report.rows_written
    assert report.rows_written == report.rows_read_back == expected.count()
    assert report.null_labels == expected.filter(F.col("Churn").isNull()).count() > 0
    assert report.changed_types == ["SeniorCitizen", "tenure"]
    assert report.columns_checked == 20
    assert len(report.sample) == 5
    assert table.schema.simpleString() == CLEANED_SCHEMA.simpleString()
    ordered = table.select(*expected.columns)
    assert ordered.exceptAll(expected).count() == expected.exceptAll(ordered).count() == 0


def test_etl_counts_behind_its_only_exchange(spark, raw, plan_of):
    clean, figures = cleanse_counted(read_csv(spark, raw, TELCO_SCHEMA))
    plan = plan_of(clean)
    assert plan.count("Exchange") == 1
    assert plan.index("CollectMetrics") < plan.index("Exchange")
    clean.write.format("noop").mode("overwrite").save()
    assert figures.get["read"] == 165


def test_etl_restores_the_session(spark, raw, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_etl(spark, raw, str(tmp_path))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_etl_of_a_file_without_rows(spark, csv_file, tmp_path):
    path = csv_file(",".join(TELCO_SCHEMA.fieldNames()))
    report = run_etl(spark, path, str(tmp_path / "out"))
    assert (report.rows_read, report.rows_written, report.rows_read_back) == (0, 0, 0)


def test_etl_refuses_to_write_over_its_input(spark, tmp_path):
    for path in (f"{tmp_path}/telco_cleaned/", f"{tmp_path}/telco_cleaned/a.csv"):
        with pytest.raises(ValueError, match="lies in the table"):
            run_etl(spark, path, str(tmp_path))


def test_etl_refuses_other_spellings(spark, raw, tmp_path):
    """The source file is still there after each refusal; the folder above is not read and is allowed."""
    base = tmp_path / "out"
    run_etl(spark, raw, str(base))
    header = ",".join(TELCO_SCHEMA.fieldNames())
    source = base / "telco_cleaned" / "in.csv"
    source.write_text(f"{header}\n")
    (tmp_path / "x").mkdir()
    (base / "link").symlink_to(base / "telco_cleaned")
    for path in (source, f"file:{source}", f"{tmp_path}/x/../out/telco_cleaned/in.csv", f"{base}/telco_*/*.csv",
                 f"{base}/telco_cleaned", f"{base}/link/in.csv", f"{base}/*/in.csv"):
        with pytest.raises(ValueError, match="lies in the table"):
            run_etl(spark, str(path), str(base))
        assert source.exists()
    (tmp_path / "above").mkdir()
    (tmp_path / "above" / "in.csv").write_text(f"{header}\na{',' * 20}\n")
    assert run_etl(spark, str(tmp_path / "above"), str(tmp_path / "above")).rows_written == 1


def test_etl_refuses_another_header(spark, csv_file, tmp_path):
    names = TELCO_SCHEMA.fieldNames()
    for header in (names[::-1], names[:-1], [*names, "more"]):
        with pytest.raises(SchemaError, match="the header is"):
            run_etl(spark, csv_file(",".join(header), "a" + "," * 20), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_etl_checks_the_header_of_every_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    names = TELCO_SCHEMA.fieldNames()
    (folder / "a.csv").write_text(",".join(names) + "\na" + "," * 20 + "\n")
    (folder / "b.csv").write_text(",".join(names[::-1]) + "\nb" + "," * 20 + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        run_etl(spark, str(folder), str(tmp_path / "out"))


def test_etl_refuses_another_stored_type(spark, raw, tmp_path, monkeypatch):
    def as_text(df, *args):
        return write_parquet(df.withColumn("tenure", F.col("tenure").cast("string")), *args)

    monkeypatch.setattr(etl, "write_parquet", as_text)
    with pytest.raises(Exception, match="tenure"):
        run_etl(spark, raw, str(tmp_path))


def test_etl_without_key_or_label(spark, csv_file, tmp_path):
    schema = spark.createDataFrame([], "name STRING, n INT").schema
    path = csv_file("name,n", "a,1", "a,1", " b,2", ",")
    report = run_etl(spark, path, str(tmp_path / "out"), schema, ["n"])
    assert (report.rows_read, report.rows_without_key, report.duplicate_rows) == (4, 0, 1)
    assert report.rows_written == 3


def test_training_and_scoring(spark, tmp_path):
    base = str(tmp_path)
    rows = cleanse(telco(spark, SF))
    write_parquet(rows, base, "telco_cleaned", ["Churn"])
    report = train_churn(spark, base, f"{base}/models")
    assert report.train_rows + report.test_rows == 150
    assert 0.0 <= report.auc <= 1.0
    customers = load_cleaned(spark, base, with_complaints(CLEANED_SCHEMA))
    path = score_table(customers.withColumn("Churn", F.lit(None).cast("string")), f"{base}/models", base)
    scored = spark.read.parquet(path)
    assert path.endswith("/predictions")
    assert scored.columns == ["customerID", "prediction", "churn_probability"]
    assert scored.select("customerID").distinct().count() == scored.count() == 150
    assert scored.filter("prediction <> CAST(churn_probability > 0.5 AS DOUBLE)").count() == 0
    first = {tuple(r) for r in scored.collect()}
    submitted = STEPS["score"](spark, base, f"{base}/models")
    assert {tuple(r) for r in spark.read.parquet(submitted).collect()} == first


def test_complaint_column_passes_through(spark, tmp_path):
    schema = with_complaints(TELCO_SCHEMA)
    rows = telco(spark, SF)
    path = write_csv(rows.select(*schema.fieldNames()), spark)
    report = run_etl(spark, path, str(tmp_path))  # the header has the 22nd column
    table = load_cleaned(spark, str(tmp_path), with_complaints(CLEANED_SCHEMA))
    assert report.rows_written == 150
    counts = rows.agg(F.sum("NumComplaints90Days")).first()[0]
    assert table.agg(F.sum("NumComplaints90Days")).first()[0] == counts > 0


def test_training_is_repeatable(spark, tmp_path):
    base = str(tmp_path)
    write_parquet(cleanse(telco(spark, SF)), base, "telco_cleaned", ["Churn"])
    first = train_churn(spark, base, f"{base}/one")
    second = train_churn(spark, base, f"{base}/two")
    assert (first.train_rows, first.auc) == (second.train_rows, second.auc)


def test_same_forest_on_any_number_of_cores(spark, tmp_path):
    """One table, trained here with 8 cores and by a session of its own with 2.

    By that session's event log the learner reads 7 tasks of rows and reduces in 3, whatever the scan's width.
    """
    base = str(tmp_path / "base")
    (tmp_path / "log").mkdir()
    write_parquet(cleanse(telco(spark, SF)), base, "telco_cleaned", ["Churn"])
    job = [sys.executable, os.path.join(os.path.dirname(__file__), "train_job.py"), base, "2", str(tmp_path / "log"), "3"]
    printed = subprocess.run(job, capture_output=True, text=True, timeout=600, check=True).stdout
    here = train_churn(spark, base, f"{base}/models", layout_tasks=7)
    rows, area = printed.split()
    assert int(rows) == here.train_rows
    assert float(area) == pytest.approx(here.auc, abs=1e-12)  # summed up in another order

    (log,) = (tmp_path / "log").iterdir()
    events = [json.loads(line) for line in log.read_text().splitlines()]
    stages = [e["Stage Info"] for e in events if e["Event"] == "SparkListenerStageCompleted"]
    levels = [s["Number of Tasks"] for s in stages if s["Stage Name"].startswith("collectAsMap at RandomForest")]
    mapped = [s["Number of Tasks"] for s in stages if s["Stage Name"].startswith("mapPartitions at RandomForest")]
    assert len(levels) > 3 and set(levels[1:]) == {3}
    assert levels[0] == 6  # candidate splits: a task for each continuous column
    assert set(mapped) == {7}


def test_training_counts_both_sides_in_one_pass(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    write_parquet(cleanse(telco(spark, SF)), base, "telco_cleaned", ["Churn"])
    counted = []
    monkeypatch.setattr(DataFrame, "count", lambda self: counted.append(self) or 0)
    train_churn(spark, base, f"{base}/models")
    assert not counted


def test_scores_in_few_files(spark, tmp_path, plan_of):
    base = str(tmp_path)
    write_parquet(cleanse(telco(spark, SF)), base, "telco_cleaned", ["Churn"])
    train_churn(spark, base, f"{base}/models")
    customers = load_cleaned(spark, base, with_complaints(CLEANED_SCHEMA))
    path = score_table(customers, f"{base}/models", base, max_files=1)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1
    assert spark.read.parquet(path).count() == 150


def test_telco_view_reads_events_once(spark, plan_of):
    assert plan_of(telco(spark, SF)).count("event_type") > 0
    assert len(re.findall(r"FileScan parquet \[[^\]]*user_id", plan_of(telco(spark, SF)))) == 1


def test_complaints_of_an_event_table(spark, raw, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    run_all(spark, raw, str(tmp_path), f"{tmp_path}/models", events, COMPLAINTS_UNTIL)
    counted = load_cleaned(spark, str(tmp_path), with_complaints(CLEANED_SCHEMA), COUNTED_TABLE)
    ids = {r["customerID"] for r in counted.collect()}
    wanted = {str(r["c_custkey"]): r["NumComplaints90Days"] for r in QUERIES["complaint_count"](spark, SF).collect()}
    assert {r["customerID"]: r["NumComplaints90Days"] for r in counted.collect()} == {k: wanted[k] for k in ids}
    assert sum(n or 0 for n in wanted.values()) > 0
    with pytest.raises(ValueError, match="end"):
        run_all(spark, raw, str(tmp_path), f"{tmp_path}/models", events)


def test_training_with_another_split(spark, tmp_path):
    base = str(tmp_path)
    write_parquet(cleanse(telco(spark, SF)), base, "telco_cleaned", ["Churn"])
    report = train_churn(spark, base, f"{base}/models", split=random_split)
    assert report.train_rows + report.test_rows == 150
    assert 100 < report.train_rows < 140


def test_both_steps_and_no_complaint_column(spark, raw, tmp_path):
    etl, trained = run_all(spark, raw, str(tmp_path), f"{tmp_path}/models")
    assert trained.train_rows + trained.test_rows == etl.rows_written - etl.null_labels
