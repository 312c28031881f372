"""CSV to a cleansed, reconciled Parquet table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from holdfast.cluster import input_bytes, is_inside, matches, qualified, sized_for
from holdfast.operators.cleansing import cleanse_with_copies, unreadable_numbers
from holdfast.operators.quality import SchemaError, check_schema, content_digest, preview, reconcile_content
from holdfast.schema import (
    CLEANED_TABLE,
    COMPLAINTS,
    COMPLAINTS_UNREADABLE,
    KEY,
    LABEL,
    NUMERICAL_FEATURES,
    TELCO_SCHEMA,
    cleaned_schema,
    with_complaints,
)
from holdfast.sources.files import csv_header, read_csv_marked, table_path, write_parquet

_COPIES = "_copies"
# Beside the columns read: the names of those whose text could not be read.
UNREADABLE = "_unreadable"
_MALFORMED = "_malformed"


@dataclass(frozen=True)
class EtlReport:
    """What one run read, dropped and wrote."""

    path: str
    rows_read: int
    rows_without_key: int
    duplicate_rows: int
    rows_written: int
    rows_read_back: int
    null_labels: int
    columns_checked: int
    changed_types: list[str]
    sample: list[Row]
    unreadable: dict[str, int] = field(default_factory=dict)  # per column: fields that held text and became null
    malformed_rows: int = 0  # with such a field, a number of blanks only, too few or too many fields


def _account(raw: DataFrame, numerical: list[str]) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """The rows without the mark of what was unreadable, what to count of it per column, and these columns."""
    text_numbers = unreadable_numbers(raw, numerical)
    if UNREADABLE not in raw.columns:
        return raw, {f"{UNREADABLE}_{c}": lost for c, lost in text_numbers.items()}, list(text_numbers)
    typed = [f.name for f in raw.schema.fields if not isinstance(f.dataType, StringType) and f.name != UNREADABLE]
    lost = {c: F.coalesce(F.array_contains(UNREADABLE, c), F.lit(False)) for c in typed} | text_numbers
    if COMPLAINTS in typed:
        raw = raw.withColumn(COMPLAINTS_UNREADABLE, F.when(lost[COMPLAINTS], F.lit(True)))
    return raw, {f"{UNREADABLE}_{c}": condition for c, condition in lost.items()}, list(lost)


def cleanse_counted(
    raw: DataFrame,
    numerical: list[str] = NUMERICAL_FEATURES,
    key: str = KEY,
    label: str = LABEL,
) -> tuple[DataFrame, Observation]:
    """The cleansed rows, and the figures that any action over them yields besides.

    The figures are taken behind the only exchange, in the tasks that hand over the result.
    """
    has_key = F.col(key).isNotNull() if key in raw.columns else F.lit(True)
    no_label = F.col(label).isNull() if label in raw.columns else F.lit(False)
    copies = F.col(_COPIES)
    figures = Observation("cleanse")
    rows, events, _ = _account(raw, numerical)
    if UNREADABLE in raw.columns:
        events[_MALFORMED] = F.col(UNREADABLE).isNotNull()
    columns = [c for c in rows.columns if c != UNREADABLE]
    observed = _cleansed(rows, columns, numerical, key, events).observe(
        figures,
        F.sum(copies).alias("read"),
        F.sum(F.when(~has_key, copies)).alias("without_key"),
        F.sum(F.when(has_key, copies - 1)).alias("duplicates"),
        F.count_if(has_key).alias("written"),
        F.count_if(has_key & no_label).alias("null_labels"),
        *[F.sum(name).alias(name) for name in events],
    )
    return observed.filter(has_key).select(*columns), figures


def _cleansed(
    rows: DataFrame, columns: list[str], numerical: list[str], key: str, events: dict[str, Column]
) -> DataFrame:
    """The rows' `columns` cleansed; the events may be conditions on others as well."""
    marks = [condition.alias(name) for name, condition in events.items()]
    return cleanse_with_copies(rows.select(*columns, *marks), _COPIES, numerical, key, list(events))


def refuse_own_output(spark: SparkSession, input_path: str, target: str) -> None:
    """Raise if a file to read, however its path is spelt, lies in the folder that is to be replaced."""
    folder = qualified(spark, target)
    if any(is_inside(path, folder) for path in matches(spark, input_path)) or any(
        is_inside(qualified(spark, path), folder) for path in spark.read.text(input_path).inputFiles()
    ):
        raise ValueError(f"the input {input_path} lies in the table to write: {target}")


def check_header(found: list[str], schema: StructType) -> None:
    """Raise if the header is not the schema's names in their order; case does not count."""
    wanted = schema.fieldNames()
    if [name.strip().lower() for name in found] != [name.lower() for name in wanted]:
        raise SchemaError(f"the header is {', '.join(found)}, not {', '.join(wanted)}")


def run_etl(
    spark: SparkSession,
    input_path: str,
    output_base: str,
    schema: StructType | None = None,
    numerical: list[str] = NUMERICAL_FEATURES,
    key: str = KEY,
    label: str = LABEL,
    table_name: str = CLEANED_TABLE,
) -> EtlReport:
    """Read, cleanse, write partitioned by the label, read back and compare rows and content.

    Without a schema the declared customer table is expected, with the complaint count if the header has
    it. A header that differs, or a column stored with another type than meant, raises.

    The old table, if there is one, is replaced once the new one has passed all checks; a run that fails leaves it.
    Fields whose text cannot be read are null, counted in the report by column, and an unreadable complaint count
    is marked, so that it is not taken for none.

    The input is read once: every count comes out of the pass that writes the table, from the tasks
    whose output is committed, so repeated tasks do not add to them.
    """
    target = table_path(output_base, table_name)
    refuse_own_output(spark, input_path, target)
    header = csv_header(spark, input_path)
    if schema is None:
        schema = with_complaints(TELCO_SCHEMA) if COMPLAINTS in header else TELCO_SCHEMA
    if header:
        check_header(header, schema)
    partition_cols = [label] if label in schema.fieldNames() else []
    stored = schema
    if COMPLAINTS in schema.fieldNames() and not isinstance(schema[COMPLAINTS].dataType, StringType):
        stored = StructType([*schema.fields, StructField(COMPLAINTS_UNREADABLE, BooleanType())])
    written_schema = cleaned_schema(stored, numerical, partition_cols)
    expected = StructType([f for f in schema.fields if f.name not in partition_cols])
    data_columns = StructType([f for f in written_schema.fields if f.name not in partition_cols])

    found: list[int] = []
    changed: list[str] = []
    sample: list[Row] = []

    with sized_for(spark, input_bytes(spark, input_path)):
        raw = read_csv_marked(spark, input_path, schema, UNREADABLE, check_header=True)
        clean, figures = cleanse_counted(raw, numerical, key, label)
        content = Observation("content")

        def verify(folder: str) -> None:
            """The new table, before it replaces the old one."""
            table = spark.read.schema(written_schema).parquet(folder)
            in_files = spark.read.parquet(folder).schema if figures.get["written"] else data_columns
            wrong = check_schema(in_files, data_columns)
            if wrong:
                raise SchemaError(f"stored with another type than declared: {', '.join(wrong)}")
            found.append(reconcile_content(content.get, table, partition_cols))
            changed.extend(check_schema(in_files, expected))
            sample.extend(preview(table).collect())

        observed = clean.observe(content, *content_digest(clean, partition_cols))
        write_parquet(observed, output_base, table_name, partition_cols, verify)
    seen = {name: value or 0 for name, value in figures.get.items()}
    return EtlReport(
        path=target,
        rows_read=seen["read"],
        rows_without_key=seen["without_key"],
        duplicate_rows=seen["duplicates"],
        rows_written=seen["written"],
        rows_read_back=found[0],
        null_labels=seen["null_labels"],
        columns_checked=len(expected.fields),
        changed_types=changed,
        sample=sample,
        unreadable={name: seen[f"{UNREADABLE}_{name}"] for name in _account(raw, numerical)[2]},
        malformed_rows=seen[_MALFORMED],
    )
