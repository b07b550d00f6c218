"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import arc_warc, context_tree, curriculum, decontaminate, drift_kmeans, html_paths
from orderloom.llm import line_quality, norm_codes, oracle, oracle_vectors, records, simhash, unigram_trie
from orderloom.llm import url_cascade, weak_pii
from orderloom.llm.common import table


def op1_pii_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_pii.find(table(spark, sf_dir, "documents"))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"
        " n_lines n_lines_removed lost_chars"
    ).split()
    return line_quality.judged(table(spark, sf_dir, "documents")).select(*columns)


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return records.read_tokens(manifest)


# The rules of the query.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")
    return url_cascade.judged(table(spark, sf_dir, "pages"), rules)


def op5_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.read_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_position"
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop("spans")


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = arc_warc.write_arc(table(spark, sf_dir, "pages"))
    records = arc_warc.with_referred(arc_warc.read_warc(arc_warc.convert(archives)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Fixed value: the longest context, in bytes.
TREE_DEPTH = 6


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scores(table(spark, sf_dir, "documents"), depth=TREE_DEPTH)


def op10_unigram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = unigram_trie.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram_trie.token_counts(table(spark, sf_dir, "documents"), pieces)


def op11_drift_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_kmeans.cluster(table(spark, sf_dir, "embeddings"))


def op12_norm_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_codes.encode(table(spark, sf_dir, "embeddings"))


def op13_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_pii_weak_labels": op1_pii_weak_labels,
    "op2_line_quality": op2_line_quality,
    "op3_token_records": op3_token_records,
    "op4_url_cascade": op4_url_cascade,
    "op5_curriculum": op5_curriculum,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_arc_to_warc": op8_arc_to_warc,
    "op9_context_tree": op9_context_tree,
    "op10_unigram_trie": op10_unigram_trie,
    "op11_drift_kmeans": op11_drift_kmeans,
    "op12_norm_codes": op12_norm_codes,
    "op13_html_paths": op13_html_paths,
}
SQL: dict[str, str] = oracle.SQL | oracle_vectors.SQL
