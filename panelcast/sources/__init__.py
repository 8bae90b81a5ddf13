"""Sources and sinks: CSV/parquet readers, writers, fixture views."""

from panelcast.sources.io import (
    list_tables,
    read_csv_table,
    read_if_exists,
    read_table,
    save_model,
    write_table,
)
from panelcast.sources.fixtures import Panel, panel

__all__ = [
    "list_tables",
    "read_csv_table",
    "read_if_exists",
    "read_table",
    "save_model",
    "write_table",
    "Panel",
    "panel",
]
