"""Both steps in one session."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators.complaints import add_complaints, complaint_counts
from holdfast.plans.etl import EtlReport, run_etl
from holdfast.plans.training import TrainReport, train_churn
from holdfast.schema import (
    CLEANED_SCHEMA,
    CLEANED_TABLE,
    COUNTED_TABLE,
    KEY,
    LABEL,
)
from holdfast.sources.files import load_cleaned, write_parquet


def count_complaints(
    spark: SparkSession, cleaned_base: str, events: DataFrame, until: datetime, table_name: str = COUNTED_TABLE
) -> str:
    """Write the cleansed table with the complaint counts of an event table; returns the new table's path."""
    customers = load_cleaned(spark, cleaned_base, CLEANED_SCHEMA)
    counted = add_complaints(customers, complaint_counts(events, until), KEY)
    return write_parquet(counted, cleaned_base, table_name, [LABEL])


def run_all(
    spark: SparkSession,
    input_path: str,
    output_base: str,
    models_base: str,
    events: DataFrame | None = None,
    until: datetime | None = None,
    layout_tasks: int | None = None,
) -> tuple[EtlReport, TrainReport]:
    """Cleanse the CSV, then train on the table that came out.

    The complaint count comes from the file if its header has it, from `events` before `until` if these
    are given, else it is 0.
    """
    report, table_name = run_etl(spark, input_path, output_base), CLEANED_TABLE
    if events is not None:
        if until is None:
            raise ValueError("the events' end is missing")
        count_complaints(spark, output_base, events, until)
        table_name = COUNTED_TABLE
    return report, train_churn(spark, output_base, models_base, table_name=table_name, layout_tasks=layout_tasks)
