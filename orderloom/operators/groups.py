"""Whole-group measures without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.skew import join_one_per_key


def with_group_measures(
    df: DataFrame, keys: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    """What `agg OVER (PARTITION BY keys)` returns, as a partial aggregate joined back.

    The aggregate combines on the map side, and the join back does not gather a hot group.
    Rows with a NULL key form groups too; they are joined on the keys as one struct, which
    compares NULLs as equal.
    """

    def measured(rows: DataFrame, group: list[str]) -> DataFrame:
        totals = rows.groupBy(*group).agg(*[m.alias(name) for name, m in measures.items()])
        return join_one_per_key(rows, totals, group).select(*df.columns, *measures)

    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    with_null = df.where(some_null).withColumn("_group", F.struct(*keys))
    return measured(df.dropna(subset=list(keys)), list(keys)).unionByName(
        measured(with_null, ["_group"])
    )
