"""Names for columns that an operator adds to a table of the user's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
