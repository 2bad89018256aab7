"""Keep the best row per record key.

Semantics: rows are grouped by the ``record_key`` columns (all-null keys
form one group); inside a group, ``order_by`` columns are compared in
order, ascending puts nulls last and descending puts nulls first; an exact
tie keeps the row that comes first in source listing order. A missing
``order_type`` entry means ascending; a plain string ``order_type``
applies to the first order column only.

Plan: ``row_number() = 1`` over a window partitioned by the key. Catalyst
turns the filter into a ``WindowGroupLimit`` that keeps only the best row
per key *before* the shuffle, so a hot key that holds a third of the data
ships at most one row per map task; the final window sees tiny groups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.contract import KeepBest


def _value(df: DataFrame, name: str) -> Column:
    """A named column, or null when the frame has no such column (a record without the field)."""
    return F.col(name) if name in df.columns else F.lit(None)


def keep_best(df: DataFrame, best: KeepBest | Mapping | None, tie_breakers: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """One row per key, or ``df`` unchanged when dedup is off or keyless; a contract block is parsed first."""
    if not isinstance(best, KeepBest):
        best = KeepBest.parse(best)
    if best is None:
        return df
    # Order columns that the frame lacks are null in every row and cannot change the order.
    order = [F.col(c).desc_nulls_first() if down else F.col(c).asc_nulls_last() for c, down in best.order if c in df.columns]
    order += [F.col(c).asc_nulls_last() for c in tie_breakers]
    # A key the records do not have is null for every row: all rows then form
    # one group, which the map-side group limit keeps to one row per task.
    rank, window = "__keep_rank", Window.partitionBy(*[_value(df, k) for k in best.keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)
