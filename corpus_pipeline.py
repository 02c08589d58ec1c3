"""The corpus pipeline: stages over ``documents``, each written and read back by the next.

Toxic documents go, one document of each group of near-duplicates stays, documents that leak a benchmark
item go, personal data is replaced, and what remains is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import decontamination, near_dedup, packing, pii, toxicity
from tidewheel.llm.common import bounded, documents, stored


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the doc_ids of ``gone``; a null doc_id stays."""
    return docs.join(bounded(stored(gone.select("doc_id").distinct(), "gone")), "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less those the toxicity chain rejects. Null and empty texts are judged by what is there (nothing)
    and stay; repeated rows go or stay together; a null doc_id and other columns are kept as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, toxicity.judge(docs, labels).where("toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest doc_id. Texts without words
    are alone and stay, as do rows without a doc_id; repeated rows stay together."""
    return _without(docs, near_dedup.link(docs).where("not kept"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less those that leak a benchmark item. Null, empty and short texts leak nothing."""
    return _without(docs, decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced, and ``n_chars`` (if there is one) of the new text; null for a null
    text. Other columns are kept, whatever their names."""
    count = "n_entities"
    while count in docs.columns:  # a column of the documents themselves
        count += "_"
    replaced = pii.replace(docs, count=count).drop(count)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return replaced.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences. Null and empty texts are one end token; repeated rows are packed once each."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

#: Trained models and tokenizers are beyond SQL; tests/llm/test_pipeline.py recomputes the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
