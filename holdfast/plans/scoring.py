"""Batch scoring with saved models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.features import derive_features
from holdfast.operators.forest import load_models, score
from holdfast.schema import KEY, PREDICTIONS_TABLE
from holdfast.sources.files import write_parquet


def score_table(
    customers: DataFrame,
    models_base: str,
    output_base: str,
    table_name: str = PREDICTIONS_TABLE,
    key: str = KEY,
    max_files: int | None = None,
    file_bytes: int | None = None,
) -> str:
    """Score every row of a cleansed table, labelled or not, and write (key, prediction,
    churn_probability). Row-wise throughout: one scan, no exchange. Returns the table's path.

    Every scan task writes a file, of some 30 bytes a row. `max_files` lets a task read several splits, so
    that a very large table does not end in very many small files: 20,000 files for 100 TB of customers at
    200 bytes each hold some 25 million rows or 750 MB each. `file_bytes` exchanges the result instead, for files of
    about that size whatever the scan's tasks are.
    """
    preprocessing, forest = load_models(models_base)
    if max_files is not None:
        customers = customers.coalesce(max_files)
    scored = score(forest, preprocessing.transform(derive_features(customers)))
    result = scored.select(
        key, "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("churn_probability")
    )
    return write_parquet(result, output_base, table_name, file_bytes=file_bytes)
