"""Clean a corpus: stages that each read what the one before kept, as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from parasynth.llm import bin_slack, line_templates, quality_rules, secrets, simhash
from parasynth.llm.queries import TOKENIZER
from parasynth.session import checkpoint_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified threshold go."""
    return quality_rules.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs in ten texts or more, long ones in two, go from all but the first."""
    return _measured(line_templates.drop_recurring_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: four-word shingles, at most four differing bits."""
    return simhash.drop_near_duplicates(docs, shingle_words=4, max_bits=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _measured(secrets.redact_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens: one row per piece of a document."""
    return bin_slack.pack(docs, TOKENIZER)


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


#: (name, function of (spark, docs, sf_dir)), in the order in which they run.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", packing),
]

#: The stages hash shingles and fit thresholds in ways that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each result is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
