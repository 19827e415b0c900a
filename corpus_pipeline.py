"""The training-data pipeline: five stages over the documents, each stage a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import exact_dedup, mixing, near_dedup, quality, tokens
from pairloom.session import Workspace, bound_batches, ship_package

MODEL = "piece_bpe_32k.model"
# Stages rest on a fitted classifier, signatures and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def _prepare(spark: SparkSession) -> None:
    """The package on the executors, and batches of texts that leave the rest of their memory to Spark."""
    ship_package(spark)
    bound_batches(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best grade is likelier than not, by a model of the labelled ones."""
    _prepare(spark)
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    _prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    _prepare(spark)
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    _prepare(spark)
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, per document."""
    import public_tokenizers

    _prepare(spark)
    return tokens.encode_digests(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality classifier", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
    ("mixing", mixing_stage), ("piece encoding", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs, tables = spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = tables.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
