"""A corpus pipeline of five stages: quality, exact copies, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, jaccard_join, packing, quality, secret_scan
from ledgerloom.llm.common import written
from ledgerloom.llm.queries import trusted_ids, vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, trusted_ids(spark, sf_dir))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs, keep="max").select(*docs.columns)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked near copies the document with the smallest doc_id stays; documents without an id all stay."""
    kept = jaccard_join.link_components(docs).filter("doc_id <=> component_id").select("doc_id").distinct()
    return docs.alias("d").join(kept.alias("k"), F.expr("d.doc_id <=> k.doc_id"), "left_semi").select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by placeholders; n_chars follows. Every document stays."""
    return secret_scan.redact(docs, secret_scan.learn(docs), length_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in training sequences."""
    pieces = packing.pack(docs, vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens")


STAGES = [("quality classifier", keep_good), ("exact dedup", drop_exact), ("n-gram Jaccard join", drop_near), ("secret scans", hide_secrets), ("packing", pack)]

#: A language model, an automaton and a tokenizer are beyond SQL; tests/llm/test_queries.py compares each stage with a brute-force version on the smallest table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
