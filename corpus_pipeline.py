"""A training-data pipeline over `documents`: what the classifier rejects goes, then later copies, then all but one of each
group of near-duplicates; secrets are masked in what stays, and the rest is packed into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweft.llm import exact_dedup, minhash, quality_nbsvm, secrets
from lexweft.llm._common import fresh_path, table
from lexweft.llm.queries import packed


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labelled ones among docs."""
    model = quality_nbsvm.train(docs, table(spark, sf_dir, "labels"))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = model.score(plain, plain.columns, plain.columns[docs.columns.index("text")])
    return scored.where(F.col("predicted") == 1).select(*plain.columns).toDF(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity 0.8 or more.

    36 bands of 5 minima: a pair at exactly 0.8 shares no bucket with probability 6e-7.
    """
    return minhash.keep_one(docs, size=5, percent=80, bands=36, rows=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and n_chars to match."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents and their places in sequences."""
    return packed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("secret_scans", secret_scan),
    ("best_fit_packing", packing_stage),
]

#: A trained classifier, a similarity join and packing: SQL can't express the rows; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
