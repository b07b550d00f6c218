"""File readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "_malformed"

def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header row. Quotes inside quoted text are doubled.

    A multiline file cannot be split across tasks, so it is asked for by dataset.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_marked(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """`read_csv`, and the text of each row that is malformed in the column MALFORMED, else NULL there.

    A row is malformed if it has too many or too few fields, or a value that its column's type cannot hold.
    """
    if schema is None:
        schema = read_csv(spark, path, None, multiline).schema
    marked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", MALFORMED)
        # Fields are counted whichever columns a query takes.
        .option("columnPruning", False)
        .schema(marked)
        .csv(path)
    )


def malformed_rows(marked: DataFrame) -> DataFrame:
    """The malformed rows of `read_csv_marked`: file, text, and what was read of them as JSON."""
    read = F.to_json(F.struct(*[F.col(f"`{c}`") for c in marked.columns if c != MALFORMED]))
    rows = marked.select(
        F.col("_metadata.file_path").alias("file"), F.col(MALFORMED).alias("record"), read.alias("read_as")
    )
    return rows.where("record IS NOT NULL")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, nested fields kept nested."""
    return spark.read.schema(schema).json(path)


def read_parquet_dir(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet folder with its partition columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """None when the path does not exist; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
