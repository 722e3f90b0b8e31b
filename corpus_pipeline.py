"""From raw documents to token ids: five stages, each over all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import latent, passages, pieces, secrets, simhash
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.shared import keep, small_batches

#: Classifiers and the near-duplicate groups cannot be expressed in SQL; tests compare with brute force instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more, columns unchanged.

    Null and empty texts are scored like any other, equal texts and repeated rows stay or go together, ids do not matter.
    An empty table stays empty; without labels every document stays.
    """
    small_batches(spark)
    return passages.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each near-duplicate group, columns unchanged.

    Null, empty and blank texts are one group. Of repeated rows of an id one stays; rows without an id stay only where
    their whole group has none. An empty table stays empty.
    """
    small_batches(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item as a copy or paraphrase, columns unchanged.

    Null and empty texts hold none, items without text or of under five words are not looked for, repeated rows stay or go
    together, ids do not matter. An empty table on either side changes nothing.
    """
    small_batches(spark)
    return latent.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark, other columns unchanged.

    Null and empty texts stay as they are, repeated rows stay repeated and are masked alike. An empty table stays empty.
    """
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids): the piece ids of each text under merge-dropout; they decode to the very same text.

    A null or empty text has no ids. Repeated rows give repeated results, since merges are skipped by id and place.
    """
    small_batches(spark)
    return pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, the result of each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
