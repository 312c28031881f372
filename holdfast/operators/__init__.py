from holdfast.operators.categories import (
    TooManyCategories,
    category_counts,
    category_ranking,
    encode_categories,
    fit_category_index,
    index_by_ranking,
)
from holdfast.operators.cleansing import (
    blank_to_null,
    cast_numeric,
    cleanse,
    cleanse_with_copies,
    drop_duplicate_rows,
    drop_missing_key,
    normalise,
    trim_strings,
)
from holdfast.operators.complaints import add_complaints, complaint_counts
from holdfast.operators.features import (
    assemble_features,
    derive_features,
    derive_sql,
    fit_preprocessing,
    index_label,
    project_features,
    query_table,
    training_medians,
)
from holdfast.operators.forest import (
    area_under_roc,
    load_models,
    save_models,
    score,
    train_and_evaluate,
    train_forest,
)
from holdfast.operators.medians import exact_medians
from holdfast.operators.quality import (
    ReconciliationError,
    SchemaError,
    check_schema,
    content_digest,
    null_counts,
    preview,
    reconcile,
    reconcile_content,
    row_count,
    rows_with_null,
    schema_report,
    write_reconciled,
)
from holdfast.operators.splitting import hash_split, on_train_side, random_split

__all__ = [
    "ReconciliationError",
    "SchemaError",
    "TooManyCategories",
    "add_complaints",
    "area_under_roc",
    "assemble_features",
    "blank_to_null",
    "cast_numeric",
    "category_counts",
    "category_ranking",
    "check_schema",
    "cleanse",
    "cleanse_with_copies",
    "complaint_counts",
    "content_digest",
    "derive_features",
    "derive_sql",
    "drop_duplicate_rows",
    "drop_missing_key",
    "encode_categories",
    "exact_medians",
    "fit_category_index",
    "fit_preprocessing",
    "hash_split",
    "index_by_ranking",
    "index_label",
    "load_models",
    "normalise",
    "null_counts",
    "on_train_side",
    "preview",
    "project_features",
    "query_table",
    "random_split",
    "reconcile",
    "reconcile_content",
    "row_count",
    "rows_with_null",
    "save_models",
    "schema_report",
    "score",
    "train_and_evaluate",
    "train_forest",
    "training_medians",
    "trim_strings",
    "write_reconciled",
]
