"""Submit one step to a cluster.

    spark-submit --py-files holdfast.zip jobs/churn.py etl   INPUT_CSV OUTPUT_BASE
    spark-submit --py-files holdfast.zip jobs/churn.py train OUTPUT_BASE MODELS_BASE
    spark-submit --py-files holdfast.zip jobs/churn.py score OUTPUT_BASE MODELS_BASE
    spark-submit --py-files holdfast.zip jobs/churn.py all   INPUT_CSV OUTPUT_BASE MODELS_BASE [EVENTS UNTIL]

The complaint count is read from the CSV if its header has it; EVENTS, a Parquet table of user_id, event_type
and ts, with the end of the 90 days (such as 2024-01-31) counts it instead.
"""

from __future__ import annotations

import sys
from datetime import datetime

from pyspark.sql import SparkSession

from holdfast.cluster import MIB, RECOMMENDED_CONF
from holdfast.plans import run_all, run_etl, score_table, train_churn
from holdfast.schema import CLEANED_SCHEMA, with_complaints
from holdfast.sources import load_cleaned


# Scores are some 30 bytes a row, so that a scan's tasks would leave small files.
SCORE_FILE_BYTES = 256 * MIB


def score_cleaned(spark: SparkSession, cleaned_base: str, models_base: str) -> str:
    customers = load_cleaned(spark, cleaned_base, with_complaints(CLEANED_SCHEMA, marked=True))
    return score_table(customers, models_base, cleaned_base, file_bytes=SCORE_FILE_BYTES)


def everything(
    spark: SparkSession, csv: str, output_base: str, models_base: str, events: str = "", until: str = ""
) -> tuple:
    if not events:
        return run_all(spark, csv, output_base, models_base)
    end = datetime.fromisoformat(until)
    return run_all(spark, csv, output_base, models_base, spark.read.parquet(events), end)


STEPS = {"etl": run_etl, "train": train_churn, "score": score_cleaned, "all": everything}


def main(step: str, *paths: str) -> None:
    builder = SparkSession.builder.appName(f"churn-{step}")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    print(STEPS[step](builder.getOrCreate(), *paths))


if __name__ == "__main__":
    main(*sys.argv[1:])
