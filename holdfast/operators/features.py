"""Derived features and the fitted steps that turn a row into a feature vector."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.functions.columns import count_or_zero_sql, daily_charge_sql, present
from holdfast.operators.categories import categories_of, index_stages, one_hot_encoder
from holdfast.operators.medians import exact_medians
from holdfast.operators.wide import RankedCategories
from holdfast.schema import (
    CATEGORICAL_FEATURES,
    COMPLAINTS,
    COMPLAINTS_UNREADABLE,
    DERIVED_FEATURES,
    FEATURE_PROJECTION,
    LABEL,
    LABEL_VALUES,
    NUMERICAL_FEATURES,
)


def derived_columns(schema: StructType) -> dict[str, str]:
    """SQL text of each derived column that a table with this schema gives."""
    derived = {}
    if "MonthlyCharges" in schema.fieldNames():
        derived["avg_daily_charge"] = daily_charge_sql("MonthlyCharges")
    complaints = count_or_zero_sql(schema, COMPLAINTS)
    if COMPLAINTS_UNREADABLE in schema.fieldNames():
        complaints = f"CASE WHEN `{COMPLAINTS_UNREADABLE}` THEN NULL ELSE {complaints} END"
    return derived | {"complaints_90d": complaints}


def derive_sql(schema: StructType, name: str = "telco") -> str:
    """The derivation as SQL text over the table parameter `{name}`."""
    derived = ", ".join(f"{text} AS {column}" for column, text in derived_columns(schema).items())
    return f"SELECT *, {derived} FROM {{{name}}}"


def derive_features(df: DataFrame) -> DataFrame:
    """All columns plus the daily charge and the complaint count: 0 where null or not recorded, missing where a
    cleansed table marks it as unreadable."""
    return df.withColumns({column: F.expr(text) for column, text in derived_columns(df.schema).items()})


def query_table(df: DataFrame, query: str, name: str = "telco") -> DataFrame:
    """Run SQL text that names the table `{name}`; nothing is registered in the session."""
    return df.sparkSession.sql(query, **{name: df})


def project_features(df: DataFrame, columns: list[str] = FEATURE_PROJECTION) -> DataFrame:
    return df.select(*present(df, columns))


def index_label(df: DataFrame, label: str = LABEL, values: list[str] = LABEL_VALUES) -> DataFrame:
    """Add double `label`: the position in `values`. Rows with another or no label are dropped.

    The list is fixed, so the positive class does not move with the data and no fit is needed. The
    filter is a plain predicate and prunes partitions when the table is partitioned by the label. The
    attached metadata names the two classes, which saves the learner a pass to count them.
    """
    if label not in df.columns:
        raise ValueError(f"column {label} is required for training")
    meta = {"ml_attr": {"type": "nominal", "name": "label", "vals": values}}
    index = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(label)) - 1
    return df.filter(F.col(label).isin(values)).withColumn(
        "label", index.cast("double").alias("label", metadata=meta)
    )


def training_medians(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact median of each listed column with a finite value; the others are left out."""
    return exact_medians(train, columns)


def fit_preprocessing(
    train: DataFrame,
    numerical: list[str] = NUMERICAL_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES,
    max_categories: int | None = None,
    held_values: int | None = None,
) -> PipelineModel:
    """Fit everything between a derived row and its `features` vector, on training rows only.

    Vector order: numerical columns, the derived ones, then the encodings in list order. Columns the
    table lacks or that hold no value are skipped. Missing numbers (null, NaN, infinite) become the
    training median. The label is no part of it, so the model also applies to unlabelled rows. The model
    holds the values of narrow category columns; those of wide ones stay a table that is saved beside it, and the
    vector then names no slots. `max_categories` makes more values in a column an error.
    """
    medians = training_medians(train, present(train, [*numerical, *DERIVED_FEATURES]))
    known = categories_of(train, categorical, max_categories, held_values)
    labels = known.labels
    if not medians and not labels and not known.wide:
        raise ValueError("no feature column holds a value")
    stages = []
    if medians:
        filled = ", ".join(
            f"CASE WHEN abs(try_cast(`{c}` AS DOUBLE)) < double('Infinity')"
            f" THEN try_cast(`{c}` AS DOUBLE) ELSE {median!r}D END AS `{c}_filled`"
            for c, median in medians.items()
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
    if known.wide:
        slots = known.sizes(categorical)
        numbers = [f"{c}_filled" for c in medians]
        ranked = RankedCategories(sizes=known.wide, path=known.path, numbers=numbers, slots=slots)
        return PipelineModel([*stages, *index_stages(labels), ranked])
    if labels:
        stages += [*index_stages(labels), one_hot_encoder(list(labels))]
    stages.append(
        VectorAssembler(
            inputCols=[f"{c}_filled" for c in medians] + [f"{c}_enc" for c in labels],
            outputCol="features",
            handleInvalid="error",
        )
    )
    return Pipeline(stages=stages).fit(train)


def assemble_features(
    df: DataFrame,
    numerical: list[str] = NUMERICAL_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES,
) -> tuple[DataFrame, PipelineModel]:
    """Fit on the labelled rows of `df` and transform them; returns (rows with label and features, model)."""
    labelled = index_label(df)
    model = fit_preprocessing(labelled, numerical, categorical)
    return model.transform(labelled), model
