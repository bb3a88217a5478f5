"""Query name -> callable(spark, folder), and the SQL counterparts of those that SQL can express."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_folder, table
from . import alignment, backtrack_bpe, bin_slack, kneser_ney, licenses, line_templates, oracles, order_minhash, quality_rules, repeats, secrets, simhash, variants, warc

#: Tokenizer file, ranks of the same vocabulary, pattern of its pieces.
TOKENIZER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, at most 4 differing bits)."""
    return simhash.near_duplicates(table(spark, sf, "documents"), 4, 4).select("doc_id", "fingerprint", "component_id")


@query
def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every document and the verdict of base rules and certified thresholds."""
    judged = quality_rules.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


ORACLES["op4_quality_rules"] = oracles.quality_rules()


@query
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines whose template recurs in ten texts or more, long ones in two."""
    return line_templates.drop_recurring_lines(table(spark, sf, "documents"), counts=True).select("doc_id", "n_lines", "n_dropped", "text")


ORACLES["op10_line_dedup"] = oracles.line_templates(line_templates.MIN_DOCS, line_templates.DEPTH, line_templates.SIMILARITY, line_templates.LONG, line_templates.LONG_DOCS)


@query
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of secrets in every document: patterns, and credential values that are hard to guess."""
    found = secrets.find_secrets(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query
def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of every document and their places in sequences of at most 1,024 tokens."""
    return bin_slack.pack(table(spark, sf, "documents"), TOKENIZER)


@query
def op6_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document under the ranked vocabulary, and their bytes again."""
    return backtrack_bpe.digests(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Order MinHash of every document and of its edited text, and their likeness."""
    return order_minhash.compare_with_next(table(spark, sf, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The licence notices and texts of every document."""
    return licenses.scan_licenses(table(spark, sf, "documents"))


ORACLES["op2_license_scan"] = oracles.licenses(licenses.TEMPLATES, licenses.LEAST)


@query
def op5_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without passages of 400 bytes that occur elsewhere."""
    return repeats.drop_repeats(table(spark, sf, "documents"))


@query
def op8_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Perplexity of every document under a model of trusted text, and the verdict per language."""
    return kneser_ney.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a record of archives written to the shared folder, read back from them."""
    folder = f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op11_warc"] = oracles.warc()


@query
def op12_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document, and how common its links are in the corpus."""
    return alignment.align(table(spark, sf, "documents"), TOKENIZER[0], public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the corpus with its commoner near word and the last of the forms that follow."""
    return variants.group_variants(table(spark, sf, "documents"))
