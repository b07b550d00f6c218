"""Pull a landed source page by page, with the cursor in a control table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import struct

# Page sizes.
USERS_PER_RUN = 20
PRODUCTS_PER_RUN = 30

CURSOR = struct(("source", "string"), ("offset", "bigint"), ("last_key", "bigint"))


@dataclass(frozen=True)
class Cursor:
    source: str
    offset: int = 0
    last_key: int | None = None


@dataclass(frozen=True)
class PagedSource:
    name: str
    table: DataFrame
    key: str
    page_size: int
    dataset: str
    transform: Callable[[DataFrame], DataFrame]


def page(source: PagedSource, cursor: Cursor) -> DataFrame | None:
    """The next page in key order, or None when no row is left.

    It starts after the last key seen instead of skipping `offset` rows, so each task sends
    at most one page and the cost does not grow with the offset; nothing is counted. Rows that
    share the page's last key all belong to it, else the next page would skip them.
    """
    rows = source.table
    if cursor.last_key is not None:
        rows = rows.where(F.col(source.key) > F.lit(cursor.last_key))
    keys = rows.select(source.key).dropna().orderBy(source.key).limit(source.page_size)
    last = keys.agg(F.max(source.key)).first()[0]
    return None if last is None else rows.where(F.col(source.key) <= F.lit(last))


def advance(source: PagedSource, cursor: Cursor, pulled: DataFrame) -> Cursor:
    """The cursor moves by a whole page, even when the last page is short."""
    last_key = pulled.agg(F.max(source.key)).first()[0]
    return replace(
        cursor,
        offset=cursor.offset + source.page_size,
        last_key=cursor.last_key if last_key is None else last_key,
    )


def cursors_from(state: DataFrame) -> dict[str, Cursor]:
    """One row per source, so this stays as small as the list of sources."""
    return {row["source"]: Cursor(**row.asDict()) for row in state.collect()}


def state_from(spark: SparkSession, cursors: dict[str, Cursor]) -> DataFrame:
    rows = [(c.source, c.offset, c.last_key) for c in cursors.values()]
    return spark.createDataFrame(rows, CURSOR)
