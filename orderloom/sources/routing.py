"""Which source file becomes which bronze dataset, and how it is laid out."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.sinks.folders import drop
from orderloom.sinks.parquet import write_flat, write_year_month
from orderloom.sources.files import MALFORMED, malformed_rows, read_csv_marked


@dataclass(frozen=True)
class DatasetSpec:
    file: str
    name: str
    schema: T.StructType | None = None
    partition_column: str | None = None
    excluded: bool = False
    multiline: bool = False
    # Further layouts of the partition column's text, beside ISO.
    timestamp_layouts: tuple[str, ...] = ()

    @property
    def action(self) -> str:
        if self.excluded:
            return "skipped"
        return "partitioned" if self.partition_column else "flat"


def route(file: str, specs: Iterable[DatasetSpec]) -> DatasetSpec:
    """The spec whose file name matches exactly."""
    by_file = {spec.file: spec for spec in specs}
    if file not in by_file:
        raise ValueError(f"no dataset for {file!r}; known files: {sorted(by_file)}")
    return by_file[file]


def malformed_path(bronze_root: str, name: str) -> str:
    return f"{bronze_root}/malformed/{name}"


def land(spark: SparkSession, spec: DatasetSpec, source_root: str, bronze_root: str) -> str | None:
    """Land one CSV dataset as Parquet; the bronze path, or None for an excluded file.

    Malformed rows land with what can be read of them, and are listed with their file and text under
    `malformed_path`. They are counted while the rows are written; the file is read again
    only if there are any.
    """
    if spec.excluded:
        return None
    marked = read_csv_marked(spark, f"{source_root}/{spec.file}", spec.schema, spec.multiline)
    found = Observation()
    rows = marked.observe(found, F.count(MALFORMED).alias("malformed")).drop(MALFORMED)
    path, listed = f"{bronze_root}/{spec.name}", malformed_path(bronze_root, spec.name)
    if spec.partition_column:
        write_year_month(rows, spec.partition_column, path, spec.timestamp_layouts)
    else:
        write_flat(rows, path)
    drop(spark, listed)
    if found.get["malformed"]:
        write_flat(malformed_rows(marked), listed)
    return path
