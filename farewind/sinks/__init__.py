"""Where batch rows go: path tables and catalog tables."""

from farewind.sinks.tables import (
    append_rows,
    drop_generations,
    drop_tables,
    ensure_table,
    replace_table,
    save_as_table,
    write_table,
)

__all__ = [
    "append_rows", "drop_generations", "drop_tables", "ensure_table", "replace_table", "save_as_table", "write_table",
]
