"""Names for helper columns that no column of a table has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names
