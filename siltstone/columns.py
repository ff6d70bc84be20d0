"""Room for an operator's own column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def make_room(df: DataFrame, names: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Columns whose name, in any case, an operator needs for itself get the ending ``_in``."""
    taken, kept = {n.lower() for n in names}, {k.lower() for k in keep}
    renamed = {c: f"{c}_in" for c in df.columns if c.lower() in taken and c.lower() not in kept}
    return df.withColumnsRenamed(renamed) if renamed else df
