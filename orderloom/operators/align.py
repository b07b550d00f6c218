"""Bring a frame to a contract by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNFIT = "struct<column:string,value:string,wanted:string>"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _by_lower_name(df: DataFrame) -> dict[str, T.StructField]:
    found: dict[str, T.StructField] = {}
    for field in df.schema.fields:
        if field.name.lower() in found:
            raise ValueError(f"column name {field.name!r} is ambiguous when case is ignored")
        found[field.name.lower()] = field
    return found


def conform(
    df: DataFrame, schema: T.StructType, on_bad: str = "null", also: Sequence[Column] = ()
) -> DataFrame:
    """Match columns by case-insensitive name and cast to the contract.

    Missing columns become typed NULLs, extra ones are dropped. A value that does not fit the
    declared type becomes NULL (`bad_values` lists them), or stops the job with `on_bad="fail"`.
    `also` adds columns made of the frame as it was.
    """
    if on_bad not in ("null", "fail"):
        raise ValueError(f"on_bad is 'null' or 'fail', not {on_bad!r}")
    found = _by_lower_name(df)

    def target(field: T.StructField) -> Column:
        source = found.get(field.name.lower())
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = _quoted(source.name)
        if source.dataType != field.dataType:
            fail = on_bad == "fail"
            column = column.cast(field.dataType) if fail else column.try_cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[target(field) for field in schema.fields], *also)


def _may_fail(source: T.DataType, target: T.DataType) -> bool:
    return source != target and not isinstance(target, T.StringType)


def has_casts(source: T.StructType, schema: T.StructType) -> bool:
    """Whether any value of the source could fail to fit the contract."""
    kinds = {f.name.lower(): f.dataType for f in source.fields}
    return any(_may_fail(kinds.get(f.name.lower(), f.dataType), f.dataType) for f in schema.fields)


def unfit_values(df: DataFrame, schema: T.StructType) -> Column:
    """Of each row, the values that `conform` turns into NULL: column, text and wanted type."""
    found = _by_lower_name(df)
    bad = []
    for field in schema.fields:
        source = found.get(field.name.lower())
        if source is not None and _may_fail(source.dataType, field.dataType):
            value = _quoted(source.name)
            unfit = value.isNotNull() & value.try_cast(field.dataType).isNull()
            entry = F.struct(
                F.lit(field.name).alias("column"),
                value.cast("string").alias("value"),
                F.lit(field.dataType.simpleString()).alias("wanted"),
            )
            bad.append(F.when(unfit, entry))
    if not bad:
        return F.array().cast(f"array<{UNFIT}>")
    return F.filter(F.array(*bad), lambda e: e.isNotNull())


def bad_values(df: DataFrame, schema: T.StructType, *keep: Column | str) -> DataFrame:
    """A row per value that `conform` turns into NULL: its column, text and wanted type.

    `keep` names what identifies the row, such as its key or `_metadata.file_path`.
    """
    return df.select(*keep, F.inline(unfit_values(df, schema)))


def align_union(
    history: DataFrame,
    daily: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
) -> DataFrame:
    """History and daily rows under one contract, duplicates kept."""
    renamed = history.withColumnsRenamed(renames or {})
    return conform(renamed, schema).unionByName(conform(daily, schema))
