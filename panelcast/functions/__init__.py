"""Column expressions shared by all operators (JVM-side, codegen friendly)."""

from panelcast.functions.core import (
    as_list,
    iso_weekday,
    numeric_columns,
    require_columns,
    safe_corr,
    safe_div,
    series_window,
    sized_broadcast,
    STORE_TYPE_CODES,
    store_type_code,
)

__all__ = [
    "as_list",
    "iso_weekday",
    "numeric_columns",
    "require_columns",
    "safe_corr",
    "safe_div",
    "series_window",
    "sized_broadcast",
    "STORE_TYPE_CODES",
    "store_type_code",
]
