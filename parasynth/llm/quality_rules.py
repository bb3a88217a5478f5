"""Quality rules whose thresholds carry a guarantee, in DataFrame operations only.

Every rule has a fixed ladder of cutoffs from lax to strict; level ``t`` of the
ladder applies cutoff ``t`` of all rules at once. On labelled documents the
rejections of good ones are counted per stratum and level, and a level is
certified if the exact (Clopper-Pearson) upper bound of its false rejection
rate is at most ``max_false_rejection``. Levels are tested from lax to strict
up to the first that fails, which needs no correction within a stratum, and the
error probability is shared among the strata (Bonferroni): with probability
``1 - error`` no stratum loses more than the stated share of good documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import broadcast_if_small, sealed
from .common import checkpointed

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Cutoffs per rule, lax to strict: a value beyond one is rejected at that level and all stricter ones.
LADDERS = {
    "symbols_per_word": [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25],
    "repeat_word_share": [0.48, 0.46, 0.44, 0.42, 0.4, 0.35, 0.3, 0.25],
    "word_length": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0],
    "short_words": [1.0, 1 / 1.2, 1 / 1.4, 1 / 1.6, 1 / 1.8, 1 / 2.0, 1 / 2.2, 1 / 2.4],
}
LEVELS = 8
MAX_FALSE_REJECTION, ERROR = 0.01, 0.05
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _windows(width: int) -> Column:
    """Each window of ``width`` words as one long: its hash with the low bits (``mask``) replaced by its place."""
    n = F.size("words")
    starts = F.slice("words", F.lit(1), F.greatest(n - (width - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(F.col("words"), i + k) for k in range(1, width)]).bitwiseAND(F.bitwise_not(F.col("mask"))).bitwiseOR(i.cast("long")))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id``, ``stratum`` and the counts of BASE, one row per document, over its whole text.

    A null text has no words; a null stratum is the stratum ''.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return _counted(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")).alias("stratum"), text.alias("text"))).select("doc_id", "stratum", *BASE, "n_lines")


def _counted(rows: DataFrame) -> DataFrame:
    """Adds BASE and n_lines to rows with ``text``; other columns stay.

    Sorted, equal windows of three words lie side by side; neighbours of equal
    hash count if their words are equal too. What the windows that occur again
    cover is summed from place to place.
    """
    own = rows.columns
    rows = rows.select(*own, F.array_remove(F.split("text", SEPARATORS), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    places = F.length(F.bin(F.size("words").cast("long")))
    rows = rows.select(*own, "words", "lines", (F.pow(F.lit(2.0), places) - 1).cast("long").alias("mask"))
    rows = rows.select(*own, "words", "lines", "mask", F.sort_array(_windows(3)).alias("windows"))

    def twin(x: Column, y: Column) -> Column:
        hi = F.col("mask")
        a, b = x.bitwiseAND(hi).cast("int"), y.bitwiseAND(hi).cast("int")
        same = F.lit(True)
        for k in range(3):
            same = same & (F.get(F.col("words"), a + k) == F.get(F.col("words"), b + k))
        return (x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(hi)) == 0) & same

    doubled = F.filter("windows", lambda x, i: F.coalesce(twin(x, F.get(F.col("windows"), i + 1)), F.lit(False)) | F.coalesce(twin(x, F.get(F.col("windows"), i - 1)), F.lit(False)))
    places = F.sort_array(F.transform(doubled, lambda x: x.bitwiseAND(F.col("mask"))))
    rows = rows.select(*own, "words", "lines", places.alias("places"))
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(F.col("places"), i + 1) - p, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda a, x: a + x)
    count = lambda c: c.cast("long")
    return sealed(rows.select(
        *own,
        count(F.size("words")).alias("n_words"),
        count(F.length(F.array_join("words", ""))).alias("word_chars"),
        count(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        count(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        count(F.size("lines")).alias("n_lines"),
    ))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _values() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_word_share": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
        "short_words": words / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
    }


def reject_level() -> Column:
    """The first level of the ladder that rejects the row; LEVELS + 1 if none does."""
    beyond = [sum((F.when(v > F.lit(c), 1).otherwise(0) for c in LADDERS[r]), F.lit(0)) for r, v in _values().items()]
    return F.lit(LEVELS + 1) - F.greatest(*beyond)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for n trials of probability p, summed term by term in logarithms; 1 where k >= n p."""
    first = n * F.lit(math.log1p(-p))
    odds = F.lit(math.log(p) - math.log1p(-p))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (F.greatest(a["total"], term) + F.log1p(F.exp(-F.abs(a["total"] - term)))).alias("total"))

    start = F.struct(first.alias("term"), first.alias("total"))
    total = F.when(k == 0, first).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))), start, step, lambda a: a["total"]))
    return F.when(k >= n * F.lit(p), F.lit(1.0)).otherwise(F.exp(total))


def certified_levels(measured: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """``stratum``, ``n_good`` and ``level``, the strictest certified level (0: none), per stratum with labels.

    ``labels`` has ``doc_id`` and ``quality``; documents labelled 1 that pass the
    base rules are the holdout. Repeated labels count once, null ones not at all.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    held = measured.where(~base_failed()).join(good, "doc_id", "left_semi").groupBy("stratum", reject_level().alias("t")).agg(F.count(F.lit(1)).alias("n"))
    strata = held.groupBy("stratum").agg(F.sum("n").alias("n_good"))
    tests = strata.crossJoin(strata.agg(F.count(F.lit(1)).alias("n_strata"))).select("stratum", "n_good", "n_strata", F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("t"))
    w = Window.partitionBy("stratum").orderBy("t")
    tests = tests.join(held, ["stratum", "t"], "left").withColumn("rejected", F.sum(F.coalesce("n", F.lit(0))).over(w))
    failed = binomial_tail(F.col("rejected"), F.col("n_good"), max_false_rejection) > F.lit(error) / F.col("n_strata")
    return tests.groupBy("stratum", "n_good").agg(F.coalesce(F.min(F.when(failed, F.col("t"))) - 1, F.lit(LEVELS)).alias("level"))


def judged(measured: DataFrame, levels: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept``; a stratum without labels keeps what passes the base rules."""
    known = broadcast_if_small(levels.select("stratum", "level"), 10_000)
    rows = measured.join(known, "stratum", "left")
    kept = ~base_failed() & (reject_level() > F.coalesce("level", F.lit(0)))
    return rows.withColumns({"base_failed": base_failed(), "kept": kept}).drop("level")


def quality_rules(docs: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR, **columns) -> DataFrame:
    """``doc_id``, ``stratum``, BASE, ``n_lines``, ``base_failed``, ``kept``, one row per row of ``docs``.

    Null and empty texts have no words and fail the base rules. Repeated rows
    are judged alike. Without labels only the base rules reject. An empty table
    gives no rows.
    """
    measured = checkpointed(features(docs, **columns))
    return judged(measured, checkpointed(certified_levels(measured, labels, max_false_rejection, error)))


def drop_low_quality(docs: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that quality_rules keeps, columns as they were; texts are not shuffled for it.

    Thresholds come from the labelled documents alone, then each row is judged
    where it is read.
    """
    wanted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("labelled id")).distinct()
    labelled = docs.select(*{id_col, text_col, stratum_col}).join(broadcast_if_small(wanted, 1_000_000), F.col(f"`{id_col}`").cast("long") == F.col("`labelled id`"), "left_semi")
    measured = features(labelled, id_col, text_col, stratum_col)
    levels = checkpointed(certified_levels(measured, labels, max_false_rejection, error))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    rows = rows.select("row", F.coalesce(F.col(f"row.`{stratum_col}`").cast("string"), F.lit("")).alias("stratum"), text.alias("text"))
    return sealed(judged(_counted(rows), levels).select("row", "kept")).where("kept").select("row.*")
