"""Corpus pipeline: the stages and how they are run one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsurvey.llm import decontamination, ngram_join, packing, secrets, toxicity
from cellsurvey.llm.queries import table
from cellsurvey.session import durable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; it is trained on the labelled documents of the table."""
    chain = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), chain).filter(~F.col("is_toxic")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of equal or near texts (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    docs = docs.select(*COLUMNS)
    return ngram_join.keep_one(docs, ngram_join.jaccard_classes(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows in a twentieth of their words or more go."""
    hits = decontamination.find_hits(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return hits.filter(~F.col("contaminated")).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by the names of their kinds."""
    return secrets.redact(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of what is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("decontamination", decontaminate), ("secrets", redact_secrets), ("packing", pack),
]

#: model fits, near-duplicate classes and tokenizers are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs)
    return docs
