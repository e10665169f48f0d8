"""The corpus pipeline: a chain of training-data operators over ``documents``.

Quality classifier, quality rules, near duplicates, mixing by source, packing.
Each stage works on all that the one before it kept and returns the columns of
documents; the last returns pieces with their places in sequences.

Defined results: null and empty texts fail the base rule of the second stage (or the
classifier before it) and go; null ids stay as rows of their own; of rows that share an
id those with different texts count as different documents; repeated rows of one id and
text are one document; null languages and sources are values of their own; very long
texts pass whole; an empty table gives no rows; other columns of documents, whatever
their names, pass through unread up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgrid.llm import mixing, ngram_join, outliers, packing, quality
from landgrid.llm.common import written


def score_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit(written(quality.features(docs), "quality"), *quality.quality_labels(spark, sf_dir))
    return quality.keep_good(docs, model)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie outside their group's estimate go."""
    return outliers.keep_passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group over five-word shingles at a similarity of 0.8 stays: that of the smallest id."""
    return ngram_join.keep_one(docs, ngram_join.Scheme(5, 80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality classifier", score_quality),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("packing", pack_windows),
]
#: Classifier, covariance estimates and packing are no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages, in order, to the documents table; what each keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage{i}")
    return docs
