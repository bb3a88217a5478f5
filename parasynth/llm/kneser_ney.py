"""Quality classifier: perplexity under interpolated modified Kneser-Ney.

The model is one of characters, per language, trained on trusted (labelled
good) documents. Counts of the highest order are raw, those of lower orders
count left extensions; discounts per order, context sums and probabilities come
from joins of the count tables, lowest order first, each written down once. A
model of few rows, which are counted, is sent to the tasks and texts are scored
where they are. Beyond that, texts are dealt into blocks of bounded size per
language; the distinct n-grams of each block are joined with the tables, and
the block's texts add up what comes back. A document stays if its perplexity is
within a quantile of those of trusted documents of its language that the model
has not seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, small
from .common import checkpointed, partitions, per_batch, text_key

ORDER = 5
#: Characters of a block of texts whose distinct n-grams are looked up together.
BLOCK_CHARS = 8_000_000
#: Rows of a model that a task may hold: 16 bytes each, a few numbers per language beside them.
MODEL_ROWS = 3_000_000
#: Trusted documents whose identifiers are broadcast.
TRUSTED_IDS = 1_000_000
#: Documents beyond this quantile of trusted ones go; a text counts as this many more characters at its language's mean.
QUANTILE, PRIOR = 0.999, 200
PAD = "\x02"


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"), text.alias("text"))
    key = text_key(F.col("text"))
    return rows.select("doc_id", "lang", "text", key["a"].alias("ka"), key["b"].alias("kb"))


def _counts(rows: DataFrame, order: int) -> DataFrame:
    """``lang``, ``g``, ``c``: the n-grams of the highest order, counted within each batch first."""

    def work(batch: pa.RecordBatch) -> dict:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            padded = PAD * (order - 1) + text
            found.setdefault(lang, Counter()).update(padded[i : i + order] for i in range(len(text)))
        rows = [(lang, g, c) for lang, own in found.items() for g, c in own.items()]
        return {"lang": pa.array([r[0] for r in rows], pa.string()), "g": pa.array([r[1] for r in rows], pa.string()), "c": pa.array([r[2] for r in rows], pa.int64())}

    return per_batch(rows.select("lang", "text"), work, "lang string, g string, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def _discounted(grams: DataFrame, n: int) -> DataFrame:
    """Adds context ``h``, the discounted share ``share`` and the weight ``gamma`` of the lower order."""
    of = lambda k: F.sum((F.col("c") == k).cast("double"))
    stats = grams.groupBy("lang").agg(*[of(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        # Too few counts to tell: the middle of what is possible.
        value = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.when((value > 0) & (value < k), value).otherwise(F.lit(k / 2)).alias(f"d{k}")

    # One row per language, written down before it is counted.
    discounts = checkpointed(stats.select("lang", *[discount(k) for k in (1, 2, 3)]))
    grams = grams.join(broadcast_if_small(discounts), "lang").withColumn("h", F.substring("g", 1, n - 1))
    off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    contexts = grams.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum(off).alias("taken"))
    return grams.join(contexts, ["lang", "h"]).select("lang", "g", "h", ((F.col("c") - off) / F.col("total")).alias("share"), (F.col("taken") / F.col("total")).alias("gamma"))


def _trusted(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def _held_out() -> Column:
    """Half of the trusted documents set thresholds; the model is trained on others, or its own text would look too likely."""
    return F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)) == 1


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``n``, ``g``, ``logp``, ``logw``: log probability of each n-gram of order ``n`` and log weight of ``g`` as a context.

    Either may be null. The row of order 0 has the log probability of unknown
    characters. Null and empty texts and null identifiers add nothing, repeated
    rows count each time, a null language is an empty one; without trusted
    documents the model has no rows.
    """
    good = _trusted(labels).where(~_held_out())
    # Identifiers of eight bytes: up to a million go to the texts, more of them meet the texts in a shuffle.
    good = broadcast_if_small(checkpointed(good), TRUSTED_IDS)
    rows = _rows(docs, id_col, text_col, lang_col).join(good, "doc_id", "left_semi").where(F.length("text") > 0)
    tables = {order: checkpointed(_counts(rows, order))}
    for n in range(order - 1, 0, -1):
        tables[n] = checkpointed(tables[n + 1].groupBy("lang", F.substring("g", 2, n).alias("g")).agg(F.count(F.lit(1)).alias("c")))
    alphabet = tables[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("v"))
    lower = None
    parts = []
    for n in range(1, order + 1):
        made = _discounted(tables[n], n)
        if n == 1:
            made = made.join(alphabet, "lang").withColumn("low", 1 / F.col("v"))
            parts.append(made.groupBy("lang").agg(F.max(F.col("gamma") * F.col("low")).alias("p")).select("lang", F.lit(0).alias("n"), F.lit("").alias("g"), F.log("p").alias("logp"), F.lit(None).cast("double").alias("logw")))
        else:
            made = made.withColumn("tail", F.substring("g", 2, n - 1)).join(lower.select("lang", F.col("g").alias("tail"), F.col("p").alias("low")), ["lang", "tail"])
        lower = checkpointed(made.select("lang", "g", "h", "gamma", (F.col("share") + F.col("gamma") * F.col("low")).alias("p")))
        parts.append(lower.select("lang", F.lit(n).alias("n"), "g", F.log("p").alias("logp"), F.lit(None).cast("double").alias("logw")))
        if n > 1:
            parts.append(lower.select("lang", F.lit(n - 1).alias("n"), F.col("h").alias("g"), F.lit(None).cast("double").alias("logp"), F.log("gamma").alias("logw")).distinct())
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _fold(key: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Key of a string that is one character longer."""
    x = (key ^ points) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


def _keys(grams: list[str], n: int) -> np.ndarray:
    points = _points("".join(grams)).reshape(-1, n) if n else np.zeros((len(grams), 0), np.uint64)
    key = np.zeros(len(grams), np.uint64)
    for i in range(n):
        key = _fold(key, points[:, i])
    return key


class Scorer:
    """Sorted keys and values of a model: scores in memory what the joins below score."""

    def __init__(self, entries: pa.Table, order: int):
        """``entries``: ``lang``, ``n``, ``key``, ``logp``, ``logw``, as _keyed gives them."""
        self.order, self.unknown, self.tables = order, {}, {}
        langs, which = np.unique(np.array(entries.column("lang").to_pylist(), object), return_inverse=True)
        n, key = entries.column("n").to_numpy(), entries.column("key").to_numpy().view(np.uint64)
        for what in ("logp", "logw"):
            value = entries.column(what).to_numpy()
            for l, lang in enumerate(langs):
                for k in range(order + 1):
                    own = np.flatnonzero((which == l) & (n == k) & ~np.isnan(value))
                    if not k and what == "logp" and len(own):
                        self.unknown[lang] = float(value[own[0]])
                    elif k and len(own):
                        own = own[np.argsort(key[own])]
                        self.tables[lang, what, k] = key[own], value[own]

    def _find(self, kind: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.tables:
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        own, values = self.tables[kind]
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return own[at] == keys, values[at]

    def score(self, lang: str, text: str) -> float:
        return float(self.score_many(lang, [text])[0])

    def score_many(self, lang: str, texts: list[str]) -> np.ndarray:
        """The log probability of each text; 0 where the model lacks the language."""
        total = np.zeros(len(texts))
        if lang not in self.unknown or not any(texts):
            return total
        pad = self.order - 1
        points = _points("".join(PAD * pad + t for t in texts))
        size = np.array([len(t) for t in texts])
        place = np.arange(size.sum()) + np.repeat(pad * np.arange(1, len(texts) + 1), size)
        doc = np.repeat(np.arange(len(texts)), size)
        keys = [np.zeros(len(points) + 1, np.uint64)]  # of the n characters before each place
        for _ in range(self.order):
            longer = np.zeros(len(points) + 1, np.uint64)
            longer[1:] = _fold(keys[-1][:-1], points)
            keys.append(longer)
        for n in range(self.order, 0, -1):
            hit, logp = self._find((lang, "logp", n), keys[n][place + 1])
            total += np.bincount(doc[hit], weights=logp[hit], minlength=len(texts))
            place, doc = place[~hit], doc[~hit]
            if not len(place):
                return total
            if n > 1:
                known, logw = self._find((lang, "logw", n - 1), keys[n - 1][place])
                total += np.bincount(doc[known], weights=logw[known], minlength=len(texts))
        return total + np.bincount(doc, minlength=len(texts)) * self.unknown[lang]


def _keyed(model: DataFrame) -> DataFrame:
    """The rows of a model with a number in place of each n-gram."""

    def work(batch: pa.RecordBatch) -> dict:
        n, grams = batch.column(1).to_numpy(), np.array(batch.column(2).to_pylist(), object)
        key = np.zeros(len(n), np.uint64)
        for k in np.unique(n).tolist():
            own = np.flatnonzero(n == k)
            key[own] = _keys(grams[own].tolist(), k)
        return {"lang": batch.column(0), "n": batch.column(1), "key": key.view(np.int64), "logp": batch.column(3), "logw": batch.column(4)}

    return per_batch(model.select("lang", "n", "g", "logp", "logw"), work, "lang string, n int, key long, logp double, logw double")


def _text_keys(text: str, order: int) -> np.ndarray:
    """Keys of the n-grams of highest order that end at each character."""
    points = _points(PAD * (order - 1) + text)
    key = np.zeros(len(text), np.uint64)
    for i in range(order):
        key = _fold(key, points[i : i + len(text)])
    return key


def _distinct_grams(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: the distinct n-grams of each block."""

    def made(block: int, lang: str, known: dict[int, str]) -> pa.RecordBatch:
        n = len(known)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int64)), pa.array([lang] * n, pa.string()), pa.array(list(known.values()), pa.string())], ["block", "lang", "g"])

    now, known = None, {}
    for batch in batches:
        for block, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if now != (block, lang):
                if known:
                    yield made(*now, known)
                now, known = (block, lang), {}
            keys, at = np.unique(_text_keys(text, order), return_index=True)
            padded = PAD * (order - 1) + text
            for key, i in zip(keys.tolist(), at.tolist()):
                if key not in known:
                    known[key] = padded[i : i + order]
    if known:
        yield made(*now, known)


def _looked_up(need: DataFrame, model: DataFrame, n: int) -> DataFrame:
    """``lang``, ``g``, ``logp`` of distinct n-grams of order ``n``; those the model lacks go on to the next lower order."""
    if not n:
        return need.join(model.where("n = 0").select("lang", "logp"), "lang")
    own = model.where((F.col("n") == n) & F.col("logp").isNotNull()).select("lang", "g", "logp")
    found = checkpointed(need.join(own, ["lang", "g"], "left"))
    rest = found.where("logp IS NULL").select("lang", "g", F.substring("g", 1, n - 1).alias("h"), F.substring("g", 2, n - 1).alias("tail"))
    lower = _looked_up(rest.select("lang", F.col("tail").alias("g")).distinct(), model, n - 1)
    weights = model.where((F.col("n") == n - 1) & (F.col("n") > 0) & F.col("logw").isNotNull()).select("lang", F.col("g").alias("h"), "logw")
    rest = rest.join(weights, ["lang", "h"], "left").join(lower.withColumnRenamed("g", "tail"), ["lang", "tail"])
    return found.where("logp IS NOT NULL").unionAll(rest.select("lang", "g", F.coalesce("logw", F.lit(0.0)) + F.col("logp")))


def log_probabilities(docs: DataFrame, model: DataFrame, order: int = ORDER, most: int = BLOCK_CHARS, **columns) -> DataFrame:
    """``doc_id``, ``lang``, ``n_chars``, ``logp`` (null where the model lacks the language), one row per row of ``docs``.

    A model of at most MODEL_ROWS rows, which is counted first, goes to every
    task as sorted numbers and texts stay where they are. A larger one is
    joined with the distinct n-grams of blocks of texts; ``most`` is the number
    of characters of a block, on average. Null and empty texts have 0
    characters and log probability 0; null languages are one of their own; very
    long texts are scored whole. Repeated rows are scored alike, and an empty
    table gives no rows.
    """
    model = checkpointed(model)
    rows = _rows(docs, **columns).withColumn("n_chars", F.length("text").cast("long"))
    if small(model, MODEL_ROWS):
        return _scored_in_place(rows, model, order)
    return _scored_by_joins(docs, rows, model, order, most)


def _scored_in_place(rows: DataFrame, model: DataFrame, order: int) -> DataFrame:
    own = rows.sparkSession.sparkContext.broadcast(Scorer(_keyed(model).toArrow(), order))

    def work(batch: pa.RecordBatch) -> dict:
        langs, texts = (np.array(batch.column(i).to_pylist(), object) for i in (1, 3))
        logp = np.full(len(langs), np.nan)
        for lang in set(langs.tolist()).intersection(own.value.unknown):
            at = np.flatnonzero(langs == lang)
            logp[at] = own.value.score_many(lang, texts[at].tolist())
        return {"doc_id": batch.column(0), "lang": batch.column(1), "n_chars": batch.column(2), "logp": pa.array(logp, from_pandas=True)}

    return per_batch(rows.select("doc_id", "lang", "n_chars", "text"), work, "doc_id long, lang string, n_chars long, logp double")


def _scored_by_joins(docs: DataFrame, rows: DataFrame, model: DataFrame, order: int, most: int) -> DataFrame:
    known = model.where("n = 0").select("lang", F.lit(True).alias("known"))
    blocks = rows.groupBy("lang").agg(F.ceil(F.greatest(F.sum("n_chars"), F.lit(1)) / F.lit(most)).cast("long").alias("blocks")).join(known, "lang", "left")
    rows = rows.join(broadcast_if_small(checkpointed(blocks)), "lang")
    block = F.xxhash64("lang", F.pmod(F.xxhash64("doc_id", "ka", "kb"), F.col("blocks")))
    rows = rows.select(block.alias("block"), "lang", "text", "doc_id", "n_chars", "known")
    dealt = rows.where("known AND n_chars > 0").select("block", "lang", "text").repartition(partitions(docs), "block").sortWithinPartitions("block", "lang")
    grams = dealt.mapInArrow(lambda batches: _distinct_grams(batches, order), "block long, lang string, g string")
    scores = checkpointed(_looked_up(grams.select("lang", "g").distinct(), model, order))
    back = grams.join(scores, ["lang", "g"]).select("block", "lang", "g", "logp")

    def summed(texts: pa.Table, scored: pa.Table) -> pa.Table:
        of = {}
        for lang in scored.column("lang").unique().to_pylist():
            own = scored.filter(pa.compute.equal(scored.column("lang"), lang))
            keys = _keys(own.column("g").to_pylist(), order)
            by = np.argsort(keys)
            of[lang] = keys[by], own.column("logp").to_numpy()[by]
        sums = []
        for lang, text in zip(texts.column("lang").to_pylist(), texts.column("text").to_pylist()):
            if lang not in of:
                sums.append(0.0)
                continue
            keys, values = of[lang]
            sums.append(float(values[np.searchsorted(keys, _text_keys(text, order))].sum()))
        known = texts.column("known").to_pylist()
        logp = pa.array([x if k else None for x, k in zip(sums, known)], pa.float64())
        return pa.table({"doc_id": texts.column("doc_id"), "lang": texts.column("lang"), "n_chars": texts.column("n_chars"), "logp": logp})

    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(summed, "doc_id long, lang string, n_chars long, logp double")


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE, prior: int = PRIOR, **columns) -> DataFrame:
    """``doc_id``, ``lang``, ``n_chars``, ``perplexity``, ``threshold``, ``kept``, one row per row of ``docs``.

    The perplexity is per character, drawn towards the language's mean by
    ``prior`` characters, so that very short texts aren't judged by chance; an
    empty or null text has the mean. Documents of a language without trusted
    ones stay, with null perplexity; null languages are one of their own.
    Repeated rows are judged alike, and an empty table gives no rows.
    """
    columns = {"id_col": "doc_id", "text_col": "text", "lang_col": "lang"} | columns
    scored = checkpointed(log_probabilities(docs, train(docs, labels, order, **columns), order, **columns))
    good = _trusted(labels).where(_held_out())
    held = scored.where("n_chars > 0 AND logp IS NOT NULL").join(good, "doc_id", "left_semi")
    means = checkpointed(held.groupBy("lang").agg((-F.sum("logp") / F.sum("n_chars")).alias("mean")))
    perplexity = F.exp((F.lit(prior) * F.col("mean") - F.col("logp")) / (F.lit(prior) + F.col("n_chars")))
    cut = held.join(broadcast_if_small(means), "lang").groupBy("lang").agg(F.percentile_approx(perplexity, F.lit(quantile), F.lit(100_000)).alias("threshold"))
    limits = checkpointed(means.join(cut, "lang"))  # one row per language
    out = scored.join(broadcast_if_small(limits), "lang", "left").withColumn("perplexity", perplexity)
    return out.select("doc_id", "lang", "n_chars", F.round("perplexity", 6).alias("perplexity"), F.round("threshold", 6).alias("threshold"), F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"))
