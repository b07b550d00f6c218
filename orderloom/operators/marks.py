"""Incremental reading by load date."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame | None, column: str = "ingestion_date") -> datetime.date | None:
    """Latest date present; None for an absent table or one without dates."""
    if df is None:
        return None
    return df.agg(F.max(column)).first()[0]


def newer_than(
    df: DataFrame, mark: datetime.date | None, column: str = "ingestion_date"
) -> DataFrame:
    """Rows strictly after the mark, as a typed literal so that partitions are pruned."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def not_before(
    df: DataFrame, mark: datetime.date | None, column: str = "ingestion_date"
) -> DataFrame:
    """Rows from the mark's own day on, for a reader that drops keys it already holds.

    A second delivery on the day of the mark is then not lost.
    """
    return df if mark is None else df.where(F.col(column) >= F.lit(mark))
