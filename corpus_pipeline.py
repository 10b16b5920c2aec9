"""Corpus pipeline: quality classifier, near-dedup, decontamination, secrets, BPE.

``STAGES`` are applied in order; each stage's result is written as Parquet below the
shared folder named by ``spark.checkpoint.dir`` and read again as the next stage's input,
so a lost executor never reaches back over a stage.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yardstick.llm.bpe import bpe_encode
from yardstick.llm.decontaminate import drop_contaminated
from yardstick.llm.kn_quality import keep_good
from yardstick.llm.minhash import drop_near_duplicates
from yardstick.llm.secret_scan import redact_secrets
from yardstick.llm.tables import written


ARROW_ROWS = 1000  # rows of whole texts that a task hands to Python at a time


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts travel in small Arrow batches; a setting of the user's own stays."""
    name, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, str(ARROW_ROWS))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose perplexity is above their language's threshold."""
    bounded_batches(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), whole=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity 0.8."""
    bounded_batches(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark."""
    bounded_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; all rows stay."""
    bounded_batches(spark)
    return redact_secrets(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    bounded_batches(spark)
    import public_tokenizers

    # little memory: the executors still hold what the stages before have left in them
    return bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), known_parts=30_000, slice_bytes=512 << 10)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

# Perplexity, minhash classes and BPE ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
