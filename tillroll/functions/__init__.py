from tillroll.functions.columns import (
    cents,
    from_cents,
    fold_columns,
    full_name,
    header_fields,
    month_key,
    money,
    money_total,
    null_string,
    source_path,
)

__all__ = [
    "cents", "from_cents",
    "fold_columns", "full_name", "header_fields", "month_key", "money",
    "money_total", "null_string", "source_path",
]
