"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleslake.llm import near_dedup, packing, quality_classifier, quality_rules, secrets
from saleslake.llm.language_id import remainder
from saleslake.llm.registry import query, table
from saleslake.llm.tables import written


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the learnable labels, does not reject."""
    labels = table(spark, sf_dir, "labels").filter(remainder(3) != 1)
    return quality_classifier.drop_rejected(docs, quality_classifier.fit(docs, labels))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality_rules.drop_low_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity of 0.8)."""
    return near_dedup.keep_one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mask."""
    return secrets.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2,048 ids."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality_classifier", classify_quality),
    ("quality_rules", apply_quality_rules),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("packing", pack_sequences),
]

#: Classifier, automaton and tokenizer are beyond SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
