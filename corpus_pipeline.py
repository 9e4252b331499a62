"""A corpus pipeline of five of the operators, from raw documents to packed sequences.

Each stage is a function of (spark, docs, sf_dir).  A stage's result is written as Parquet below the checkpoint folder
and read back as the next one's input, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import decontamination, order_minhash, packing, pii, quality
from gridtally.llm.common import fresh, id_bucket, shared_folder, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones outside the held-out third."""
    learn_from = F.coalesce(id_bucket(F.col("doc_id"), 3) != 1, F.lit(False))
    own = [c for c in docs.columns if c.lower() in ("score", "predicted")]
    aside = dict(zip(own, fresh(docs, *[f"_{c}" for c in own]), strict=True))
    scored = quality.classify(docs.withColumnsRenamed(aside), table(spark, sf_dir, "labels"), learn_from)
    good = scored.where(F.col("predicted") == 1).drop("score", "predicted")
    return good.withColumnsRenamed({v: k for k, v in aside.items()})


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return order_minhash.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private_data_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    return pii.sanitise(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("minhash near-dedup", distinct_documents),
    ("benchmark decontamination", clean_of_benchmarks),
    ("pii", private_data_removed),
    ("best-fit packing", packed_sequences),
]

#: A trained classifier, sketches and a tokenizer have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
