"""The training corpus in five stages: clean, deduplicate, decontaminate, mix, write token records.

Each stage works on all that its predecessor kept; its result is written as Parquet and read again,
so a lost executor never costs more than the stage it was working on. All stages but the last return
the columns of `documents`; the last returns a row per record read back from the files it wrote.

* Failing lines are removed from the texts that stay, and `n_chars` (where there is one) follows.
* Of near-duplicates the document with the smallest id stays.
* A document the mix takes twice is two rows after the mixing stage.

The stages take what their operators take: NULLs, empty and very long texts, repeated rows, empty
tables and extra columns, which are passed on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import curriculum, decontaminate, line_quality, records, simhash
from orderloom.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = line_quality.cleaned(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mixed(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    manifest = records.write_records(docs, public_tokenizers.path("word_bpe_49k.json"))
    return records.read_tokens(manifest)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("SimHash near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("token records", token_records),
]

# SQL has neither the tokenizer nor the hash of the fingerprints; the tests hold run() against
# a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
