"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainfold.llm import mixing, packing, quality_cnn, secrets, simhash
from rainfold.llm.common import held_out, materialize, read
from rainfold.llm.q_llm import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network predicts to be good."""
    labels = read(spark, sf_dir, "labels")
    return quality_cnn.keep_good(docs, quality_cnn.learn(docs, labels, ~held_out("_key", 3, 1)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.deduplicate(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts."""
    return secrets.redact(docs, secrets.learn(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix of sources takes, document by document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document and its place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs


#: Trained networks, fingerprints and a tokenizer have no SQL form.
ORACLE_SQL = None
