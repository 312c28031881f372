from holdfast.functions.columns import (
    clean_text,
    count_or_zero_sql,
    daily_charge_sql,
    finite_or_null,
    hash_head,
    present,
    to_double,
)

__all__ = [
    "clean_text",
    "count_or_zero_sql",
    "daily_charge_sql",
    "finite_or_null",
    "hash_head",
    "present",
    "to_double",
]
