"""Column names that clash with none of a table's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(table: DataFrame, name: str) -> str:
    """``name``, underscored until the table has no such column in any spelling."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
