"""Parquet writers."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.keys import packed, unpacked
from orderloom.functions.scalars import date_label, lenient_timestamp


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows by output partition; AQE splits the large ones and merges the small."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_flat(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, *columns: str, sort_by: Sequence[str] = (), long_keys: Sequence[str] = ()
) -> None:
    """Replace the whole folder, whatever the session's partition overwrite mode.

    The rebalancing exchange buys few and evenly sized files in each partition. Rows sorted
    within a file let later scans skip row groups by their minima and maxima. Long keys are exchanged packed.
    """
    rows = unpacked(spread(packed(df, *long_keys), *columns), *long_keys)
    if sort_by:
        rows = rows.sortWithinPartitions(*columns, *sort_by)
    write_in_place(rows, path, *columns)


def write_in_place(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the whole folder without an exchange: a task writes a file for each partition it has rows of.

    For rows that an exchange has just brought into even tasks, and few partitions.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "zstd")
        .partitionBy(*columns)
        .parquet(path)
    )


def with_year_month(df: DataFrame, column: str, layouts: Sequence[str] = ()) -> DataFrame:
    """Parse the column leniently and add the two path columns; bad dates get NULL parts."""
    moment: Column = F.col(column)
    if dict(df.dtypes)[column] == "string":
        moment = lenient_timestamp(moment, layouts)
    return df.withColumn(column, moment).withColumns(
        {"year": F.year(column), "month": F.month(column)}
    )


def write_year_month(
    df: DataFrame, column: str, path: str, layouts: Sequence[str] = ()
) -> None:
    write_partitioned(with_year_month(df, column, layouts), path, "year", "month")


def write_load_date(
    df: DataFrame, path: str, day: datetime.date, run: int | None = None
) -> None:
    """One load-date partition, or one run's folder in it. An empty batch writes none.

    Repeating a day (or a numbered run of a day) replaces what it wrote, and nothing else.
    """
    folders = ["ingestion_date"] if run is None else ["ingestion_date", "run"]
    dated = df.withColumn("ingestion_date", F.lit(date_label(day)).cast("date"))
    (
        (dated if run is None else dated.withColumn("run", F.lit(run)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )
