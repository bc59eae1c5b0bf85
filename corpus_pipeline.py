"""A corpus from raw documents to token ids, in five stages; each reads what the one before it has written."""

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.llm import decontam, neardup, pieces, quality, secrets
from accesslake.llm.texts import stage
from accesslake.session import lean_workers


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and n_chars of the text that is left."""
    network = secrets.train(docs)
    done = docs.withColumn("text", secrets.redacted(F.col("text"), network))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else done


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    encoded = pieces.encode_documents(docs.select("doc_id", "lang", "source", "text"), with_ids=True)
    return encoded.select("doc_id", "lang", "source", "encoded.*")


def lean(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, whose Python workers are shared by all stages and keep little between them."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean_workers(spark)
        return function(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", lean(keep_good)),
    ("near_duplicates", lean(drop_near_duplicates)),
    ("decontamination", lean(decontaminate)),
    ("secret_scans", lean(redact_secrets)),
    ("sentencepiece", lean(encode)),
]

#: Fitted cutoffs, a trained network and a piece encoder: not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what passes between stages is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"corpus-{name}")
    return docs
