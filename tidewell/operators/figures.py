"""Many figures out of one pass over a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def summaries(rows: DataFrame, sets: dict[str, list[str]], **figures: Column) -> DataFrame:
    """Aggregates over several groupings (name -> columns, none for the whole table) out of one scan: ``summary``, every
    grouping column (null where it isn't grouped by) and the figures. Values are combined before they are shuffled; a null
    value of a column is a group of its own."""
    columns = list(dict.fromkeys(c for group in sets.values() for c in group))
    mask = {name: sum((c not in group) << (len(columns) - 1 - i) for i, c in enumerate(columns)) for name, group in sets.items()}
    if len(set(mask.values())) < len(mask):
        raise ValueError("two summaries group by the same columns")
    found = rows.groupingSets([[F.col(c) for c in group] for group in sets.values()], *(F.col(c) for c in columns)).agg(F.grouping_id().alias("_g"), *(f.alias(k) for k, f in figures.items()))
    name = F.lit(None).cast("string")
    for k, m in mask.items():
        name = F.when(F.col("_g") == m, k).otherwise(name)
    return found.select(name.alias("summary"), *columns, *figures)


def observed(rows: DataFrame, **figures: Column) -> tuple[DataFrame, Observation]:
    """The rows, and an observation whose ``get`` has the figures once the rows were written or counted: figures of a
    report out of the pass that writes it."""
    seen = Observation()
    return rows.observe(seen, *(f.alias(k) for k, f in figures.items())), seen
