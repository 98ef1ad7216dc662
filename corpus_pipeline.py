"""A corpus from documents to training sequences: each stage works on all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.llm import dart_minhash, packing, toxicity, unit_dedup
from registrum.llm.queries import WORD_BPE
from registrum.session import write_and_reread

# Iterative stages and whole texts cannot be told in SQL; tests compare with plain versions.
ORACLE_SQL = None
END_ID = 2


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, finds toxic go."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, output="_toxicity").where("_toxicity < 0.5").drop("_toxicity")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates stays."""
    return dart_minhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages that an earlier document has go; ``n_chars`` follows the text."""
    kept = unit_dedup.remove_repeats(docs)
    kept = kept.withColumn("n_chars", F.when(F.size("removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 ids."""
    return packing.pieces(packing.encode_partitions(docs, WORD_BPE, END_ID))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_reread(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
