"""Joins of many rows per key to one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def join_one_per_key(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    then: Callable[[DataFrame], DataFrame] = lambda joined: joined,
) -> DataFrame:
    """`many` joined (inner or left) to `one`, which holds each key at most once.

    One plan at every size. A hot key is left to AQE, which splits the `many` side of a skewed
    partition and reads the partner's rows once per split, NULL keys of a left join included
    (`session.RUNTIME_SETTINGS` turns that on even where the next operator then needs an exchange
    of its own). `then` continues on the joined rows, which are still partitioned by key.
    """
    return then(many.join(one, list(keys), how))
