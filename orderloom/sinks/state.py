"""Cursors and marks kept as a small control table, one version per save."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.sinks.folders import current, publish


def load_state(spark: SparkSession, root: str, initial: DataFrame) -> DataFrame:
    """The saved state; the initial one is saved and returned when there is none."""
    saved = current(spark, root, initial.schema)
    if saved is None:
        publish(initial.coalesce(1), root)
        saved = current(spark, root, initial.schema)
    return saved


def save_state(state: DataFrame, root: str) -> None:
    publish(state.coalesce(1), root)
