"""Order MinHash: signatures that follow edit distance.

A text's k-mers are numbered by occurrence, so each (k-mer, number) is unique.
For each of a number of hash functions the few with the least hashes are
taken, put back in text order, and the tuple of k-mers is hashed. Two texts
agree in a tuple if they share those k-mers in the same order, so moving
passages about lowers the likeness as well as changing them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, slices, texts

#: Code points in a k-mer, hash functions, k-mers in a tuple.
K, SKETCHES, TUPLE = 8, 64, 2
#: Places that fit beside the hash of a k-mer when occurrences are counted by one sort.
_PLACE_BITS = 20


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = _mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def kmers(points: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k-mer of code points; a shorter text is one k-mer, an empty one none."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    wide = points.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = (h + wide[i : n - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return _mix(h)


def numbered(h: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how often it came before)."""
    n = len(h)
    if n < 1 << _PLACE_BITS:  # hash and place in one value: one fast sort
        low = np.uint64((1 << _PLACE_BITS) - 1)
        both = np.sort((h & ~low) | np.arange(n, dtype=np.uint64))
        order, value = (both & low).astype(np.int64), both & ~low
    else:
        cut = h & ~np.uint64((1 << _PLACE_BITS) - 1)
        order = np.argsort(cut, kind="stable")
        value = cut[order]
    first = np.ones(n, bool)
    first[1:] = value[1:] != value[:-1]
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    count = np.empty(n, np.uint64)
    count[order] = (np.arange(n) - start).astype(np.uint64)
    return np.where(count == 0, h, _mix(h + count * np.uint64(0xD1B54A32D192ED03)))


def signature(text: str, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """One 32-bit tuple hash per hash function; all zero for the empty text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(sketches, np.uint32)
    h = kmers(points, k)
    unique = numbered(h)
    n, take = len(h), min(size, len(h))
    least = np.empty((sketches, take), np.int64)
    for s in range(sketches):
        values = unique * _ODD[s]
        values ^= values >> np.uint64(32)
        if take == n:
            least[s] = np.arange(n)
            continue
        for j in range(take):
            at = int(values.argmin())
            least[s, j] = at
            values[at] = np.uint64(2**64 - 1)
    least.sort(axis=1)  # text order
    made = np.arange(sketches, dtype=np.uint64)
    for j in range(take):
        made = _mix(made * np.uint64(0x9E3779B97F4A7C15) + h[least[:, j]])
    return (made >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal tuples, 0 to 1."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the start of another text as there is."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


def _row(doc_id: int | None, text: str, own: np.ndarray, following: str, after: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = signature(changed)
    return doc_id, len(text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own.astype(">u4").tobytes().hex(), other.astype(">u4").tobytes().hex(), likeness(own, other), likeness(own, after)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (bucket, guest, doc_id, text): each is compared with the one after it; a guest only follows."""
    last = None  # (bucket, doc_id, text, signature) of the row that waits for the next
    for batch in batches:
        for part in slices(batch):
            rows = []
            for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                if guest and (last is None or last[0] != bucket):
                    continue  # only the first guest of a bucket is the next document
                own = signature(text)
                if last is not None and last[0] == bucket:
                    rows.append(_row(*last[1:], text, own))
                last = None if guest else (bucket, doc_id, text, own)
            columns = list(zip(*rows)) or [[]] * len(_NAMES)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _NAMES)


def compare_with_next(docs: DataFrame, rows_per_bucket: int = 2_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signatures of every text and of its edited text, and the likeness to that and to the next document.

    Next is by ascending identifier, ties by text; after the last comes the
    first, so a lone document is its own next. Null identifiers come first. A
    null text counts as empty; the empty text's signature is zero. An empty
    table gives no rows.

    The order is dealt out by cuts that are identifiers of the table: a bucket
    begins at its cut, and the rows of the next cut come along as guests, so no
    text is sent anywhere but to its own bucket and, for one in a bucket, to
    the one before.
    """
    rows = texts(docs, id_col, text_col).withColumn("place", F.coalesce("doc_id", F.lit(-(2**63))))
    n = rows.count()
    if not n:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    buckets = max(1, min(10_000, n // rows_per_bucket))
    ends = rows.agg(F.min("place").alias("least"), F.percentile_approx("place", [i / buckets for i in range(1, buckets)] or [0.5], 100_000).alias("cuts")).first()
    cuts = sorted({c for c in ends["cuts"] if c > ends["least"]}) if buckets > 1 else []
    # Cut points are few by construction (10,000 at most), so the plan holds them.
    last = len(cuts)
    starts = F.array(*[F.lit(c) for c in [ends["least"], *cuts]])
    bucket = F.size(F.filter(starts, lambda c: c <= F.col("place"))) - 1
    rows = rows.withColumn("bucket", bucket).withColumn("starts", F.get(starts, F.col("bucket")) == F.col("place"))
    before = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    seats = F.when(F.col("starts"), F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")), F.struct(before.alias("bucket"), F.lit(True).alias("guest")))).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))))
    dealt = rows.select(F.explode(seats).alias("seat"), "doc_id", "place", "text").select(F.col("seat.bucket").alias("bucket"), F.col("seat.guest").alias("guest"), "place", "doc_id", "text")
    parts = max(partitions(docs), 1)
    dealt = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", "place", "text")
    return dealt.select("bucket", "guest", "doc_id", "text").mapInArrow(_in_order, _SCHEMA)
