"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(
    columns: Sequence[str],
    date: str | None = "ingestion_date",
    delivery: str | None = None,
) -> list[Column]:
    """Latest date first (undated rows last), of one date the latest delivery, then every other
    column, so no tie is left open."""
    latest = [c for c in (date, delivery) if c is not None]
    order = [F.col(c).desc_nulls_last() for c in latest]
    return order + [F.col(c).asc_nulls_last() for c in columns if c not in latest]


def unused(name: str, columns: Sequence[str]) -> str:
    """The name, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group.

    The `= 1` filter lets Catalyst put a group limit before the exchange: each map task
    sends at most one row per key, however many copies of the key it holds.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    name = unused("_rank", df.columns)
    return df.withColumn(name, rank).where(F.col(name) == 1).drop(name)
