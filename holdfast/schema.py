"""The customer table: columns, types, groups and the model settings that go with it."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column names, types, groups, names of outputs and model settings.
KEY = "customerID"
LABEL = "Churn"
COMPLAINTS = "NumComplaints90Days"

TELCO_COLUMNS: dict[str, DataType] = {
    "customerID": StringType(),
    "gender": StringType(),
    "SeniorCitizen": IntegerType(),
    "Partner": StringType(),
    "Dependents": StringType(),
    "tenure": IntegerType(),
    "PhoneService": StringType(),
    "MultipleLines": StringType(),
    "InternetService": StringType(),
    "OnlineSecurity": StringType(),
    "OnlineBackup": StringType(),
    "DeviceProtection": StringType(),
    "TechSupport": StringType(),
    "StreamingTV": StringType(),
    "StreamingMovies": StringType(),
    "Contract": StringType(),
    "PaperlessBilling": StringType(),
    "PaymentMethod": StringType(),
    "MonthlyCharges": DoubleType(),
    "TotalCharges": DoubleType(),
    "Churn": StringType(),
}

NUMERICAL_FEATURES = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]

CATEGORICAL_FEATURES = [
    "gender",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
]

DERIVED_FEATURES = ["avg_daily_charge", "complaints_90d"]
FEATURE_PROJECTION = [
    "customerID",
    "avg_daily_charge",
    "complaints_90d",
    "Churn",
    "MonthlyCharges",
    "TotalCharges",
    "tenure",
]

LABEL_VALUES = ["No", "Yes"]
CLEANED_TABLE = "telco_cleaned"
COUNTED_TABLE = "telco_counted"
MODEL_NAME = "churn_prediction_pipeline"
PREPROCESSING_SUFFIX = "_preproc"
FOREST_SUFFIX = "_rf"
PREDICTIONS_TABLE = "predictions"
DAYS_PER_MONTH = 30.0
COMPLAINT_DAYS = 90
NUM_TREES = 50
MAX_DEPTH = 10
SEED = 42
TRAIN_RATIO = 0.8
# End of fixed values.


def _schema(columns: dict[str, DataType], key: str = KEY) -> StructType:
    return StructType([StructField(name, kind, name != key) for name, kind in columns.items()])


def cleaned_schema(
    raw: StructType, numerical: list[str] = NUMERICAL_FEATURES, partition_cols: list[str] | None = None
) -> StructType:
    """Schema of a cleansed table: numerical columns are double, partition columns come last."""
    last = partition_cols or []
    fields = {
        f.name: StructField(f.name, DoubleType() if f.name in numerical else f.dataType, f.nullable)
        for f in raw.fields
    }
    order = [n for n in fields if n not in last] + [n for n in last if n in fields]
    return StructType([fields[n] for n in order])


# Says of a cleansed row that its complaint count was text that is no number; null for all others.
COMPLAINTS_UNREADABLE = f"{COMPLAINTS}Unreadable"


def with_complaints(schema: StructType, marked: bool = False) -> StructType:
    """The same schema plus the optional complaint count, and with `marked` the mark of unreadable ones that
    a cleansed table has beside it."""
    wanted = [StructField(COMPLAINTS, LongType(), True)]
    if marked:
        wanted.append(StructField(COMPLAINTS_UNREADABLE, BooleanType(), True))
    return StructType([*schema.fields, *(f for f in wanted if f.name not in schema.fieldNames())])


TELCO_SCHEMA = _schema(TELCO_COLUMNS)
CLEANED_SCHEMA = cleaned_schema(TELCO_SCHEMA, NUMERICAL_FEATURES, [LABEL])
