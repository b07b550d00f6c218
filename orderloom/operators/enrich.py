"""Purchase time on child rows, and reductions of large tables to a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.skew import join_one_per_key


def with_purchase_year(df: DataFrame) -> DataFrame:
    """Year column, and its copy that becomes the partition path."""
    year = F.year("order_purchase_timestamp")
    return df.withColumns({"order_purchase_year": year, "partition_year": year})


def with_order_time(
    children: DataFrame,
    orders: DataFrame,
    then: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Left join on order_id; a child without an order keeps a NULL year."""
    times = orders.select("order_id", "order_purchase_timestamp")
    return join_one_per_key(
        children, times, ["order_id"], "left", then=lambda df: then(with_purchase_year(df))
    )


def reduced_to(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a large table, unique by key, whose key occurs in a batch."""
    return big.join(small.select(*keys).distinct(), keys, "left_semi")


def rows_of_keys(many: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a wanted key, where one key may hold a large part of the rows.

    Meeting each distinct key once, an inner join is a semi join.
    """
    found = join_one_per_key(many, wanted.select(*keys).distinct(), keys)
    return found.select(*many.columns)
