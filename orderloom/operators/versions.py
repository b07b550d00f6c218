"""Tables that keep every version of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.keys import packed, unpacked
from orderloom.operators.dedup import keep_first
from orderloom.sources.deliveries import DELIVERY

# Undated versions are the oldest.
_DAY = "coalesce(ingestion_date, DATE'0001-01-01')"
# What tells a version from others of its key, besides its content.
VERSION = ("ingestion_date", DELIVERY, "batch_id")


def latest_versions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest version of each key: by load date, then delivery, then the batch that stored it."""
    order = [F.col(c).desc_nulls_last() for c in VERSION if c in rows.columns]
    return keep_first(rows, keys, order)


def content_hash(columns: Sequence[str]) -> Column:
    """A hash of the columns that make up a row's content."""
    return F.xxhash64(*[c for c in columns if c not in VERSION])


def new_versions(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    content: Sequence[str],
    long_keys: Sequence[str] = (),
) -> DataFrame:
    """The rows (one per key) that tell something new about their key.

    A row that is not before the latest version, by day and delivery, is new if its content differs
    from that version; an earlier one if no version of its day has its content. `versions` holds
    the stored versions of the rows' keys, each with the hash of its `content` columns. Long keys are
    exchanged packed.
    """
    keys = list(keys)
    known = (
        versions.select(*keys, F.expr(_DAY).alias("day"), DELIVERY, "batch_id", "content")
        .groupBy(*keys)
        .agg(
            F.max(F.struct("day", DELIVERY, "batch_id", "content")).alias("_latest"),
            F.collect_set(F.struct("day", "content")).alias("_known"),
        )
    )
    day = F.expr(_DAY).alias("day")
    own = rows.withColumns({"_day": day, "_content": content_hash(content)})
    same_day = F.array_contains("_known", F.struct(F.col("_day").alias("day"), F.col("_content").alias("content")))
    arrived = F.struct(F.col("_day").alias("day"), F.col(DELIVERY).alias(DELIVERY))
    latest = F.struct(F.col("_latest.day").alias("day"), F.col(f"_latest.{DELIVERY}").alias(DELIVERY))
    new = F.when(arrived >= latest, F.col("_content") != F.col("_latest.content")).otherwise(~same_day)
    # The keys themselves meet the stored ones as they are.
    long_keys = [name for name in long_keys if name not in keys]
    joined = packed(own, *long_keys).join(known, keys, "left").where(F.col("_latest").isNull() | new)
    return unpacked(joined, *long_keys).select(*rows.columns)
