"""SimHash near-duplicates, with candidates from the pigeonring principle.

A fingerprint's bits lie on a ring of ``max_bits + 1`` segments. If two
fingerprints differ in at most ``max_bits`` bits, some segment starts a chain
whose first 1, 2, 3, ... segments differ in at most their share of the budget
(l * max_bits / segments, rounded down). The share of one segment is 0 and that
of two is 1, so the first segment is equal and one half of the second is equal:
this pair of values is the key under which candidates meet. The further shares
of the chain prune candidates before the full Hamming distance is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, column, partitions, per_batch, text_key, texts
from .components import components

BITS = 64
#: Fingerprints of one key that one task compares at a time.
BLOCK = 1024
#: Up to this many are compared by offset, all keys of a batch at once.
SHORT = 32
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: str, shingle_words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle, in text order; fewer words than one shingle: of all of them."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - shingle_words + 1
    if n <= 1:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1))
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle_words - 1 :].tolist())], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """Bit by bit, whether it is set in over half the hashes; 0 without any."""
    # A histogram per byte, then eight bits from each: cheaper than unpacking every hash.
    counts = np.stack([np.bincount(byte, minlength=256) for byte in hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T]) @ _BYTE_BITS
    return int.from_bytes(np.packbits((2 * counts > len(hashes)).ravel()).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ka``, ``kb`` (key of the text) and ``fp``, the fingerprint as a signed long, one row per document."""

    def work(batch: pa.RecordBatch) -> dict:
        made = np.array([majority_bits(shingle_hashes(t, shingle_words)) for t in batch.column(1).to_pylist()], np.uint64)
        return {"doc_id": batch.column(0), "ka": batch.column(2), "kb": batch.column(3), "fp": made.view(np.int64)}

    return per_batch(_keyed(docs, id_col, text_col), work, "doc_id long, ka long, kb long, fp long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = text_key(F.col("text"))
    return texts(docs, id_col, text_col).select("doc_id", "text", key["a"].alias("ka"), key["b"].alias("kb"))


def layout(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments of the ring."""
    m = max_bits + 1
    ends = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _field(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1))


def chain_keys(fp: Column, max_bits: int) -> Column:
    """The keys of a fingerprint: for each start on the ring, its segment and either half of the next."""
    ring, keys = layout(max_bits), []
    for i, (start, width) in enumerate(ring):
        after, size = ring[(i + 1) % len(ring)]
        first = _field(fp, start, width)
        for h, (a, w) in enumerate([(after, size // 2), (after + size // 2, size - size // 2)]):
            keys.append(F.lit((2 * i + h) << 56).bitwiseOR(F.shiftleft(first, size)).bitwiseOR(_field(fp, a, w)))
    return F.array(*keys)


class Chains:
    """Chain shares of a candidate pair, then its Hamming distance."""

    def __init__(self, max_bits: int):
        ring = layout(max_bits)
        self.max_bits, m = max_bits, len(ring)
        self.masks = np.array([((1 << w) - 1) << a for a, w in ring], np.uint64)
        self.share = [max_bits * (j + 1) // m for j in range(m)]

    def from_start(self, x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        """x: the differing bits of pairs that met at segment ``start``."""
        m, total, ok = len(self.masks), np.zeros(x.shape, np.int64), np.ones(x.shape, bool)
        for j in range(m - 1):
            total += np.bitwise_count(x & self.masks[(start + j) % m])
            ok &= total <= self.share[j]
        ok[ok] = np.bitwise_count(x[ok]) <= self.max_bits
        return ok


def _by_chain(max_bits: int) -> Callable:
    test = Chains(max_bits)
    return lambda rows, i, j: test.from_start(rows["node"][i].view(np.uint64) ^ rows["node"][j].view(np.uint64), ((rows["key"][i] >> 56) >> 1).astype(np.int64))


def _run_edges(rows: dict, start: int, size: int, linked: Callable) -> tuple[np.ndarray, np.ndarray]:
    """A forest of what is linked within one long run: each pass joins every row's tree with those it links to."""
    n, root = size, np.arange(size)
    adj = np.zeros((n, n), bool)
    for a in range(0, n, 256):  # rows of the matrix at a time
        i, j = np.meshgrid(np.arange(a, min(a + 256, n)), np.arange(n), indexing="ij")
        i, j = (x[i < j] for x in (i, j))
        adj[i, j] = linked(rows, i + start, j + start)
    adj |= adj.T
    np.fill_diagonal(adj, True)
    while True:
        least = np.where(adj, root[None, :], n).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == root).all():
            break
        root = least
    moved = np.flatnonzero(root != np.arange(n))
    node = rows["node"][start : start + size]
    return node[moved], node[root[moved]]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """Union-find over the links of one batch: fewer edges than fingerprints leave it."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return list(parent), [find(x) for x in parent]


def _edges_of_runs(batches: Iterator[pa.RecordBatch], names: list[str], linked: Callable) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, lo, hi): links among the nodes of each run of equal ones."""
    rest: dict = {}
    for batch in _with_end(batches):
        rows = rest
        if batch is not None:
            now = {c: column(batch, c) for c in names}
            rows = {c: np.concatenate((rest[c], now[c])) for c in names} if rest else now
        if not rows:
            continue
        n = len(rows["key"])
        changed = np.zeros(max(n - 1, 0), bool)
        for c in ("key", "lo", "hi"):
            changed |= rows[c][1:] != rows[c][:-1]
        change = np.flatnonzero(changed) + 1
        end = n if batch is None else (int(change[-1]) if len(change) else 0)
        rest = {c: x[end:] for c, x in rows.items()}
        if not end:
            continue
        starts = np.concatenate(([0], change[change < end])).astype(np.int64)
        sizes = np.diff(np.append(starts, end))
        left, right = [], []
        short, run = np.repeat(sizes <= SHORT, sizes), np.repeat(np.arange(len(sizes)), sizes)
        for d in range(1, min(SHORT, int(sizes.max()))):
            at = np.flatnonzero((run[d:] == run[:-d]) & short[d:])
            if not len(at):
                break
            ok = at[linked(rows, at, at + d)]
            left.append(rows["node"][ok]), right.append(rows["node"][ok + d])
        for i in np.flatnonzero(sizes > SHORT):
            a, b = _run_edges(rows, int(starts[i]), int(sizes[i]), linked)
            left.append(a), right.append(b)
        a, b = _forest(np.concatenate(left), np.concatenate(right)) if left else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _met(keys: DataFrame, linked: Callable) -> DataFrame:
    """Edges (``a``, ``b``) among nodes that share a key and are ``linked``.

    Not every pair: each task gives a forest of what is linked within a block of
    a key. A key with more than BLOCK nodes is dealt out as pairs of blocks, so
    no task holds more than two blocks at once.
    """
    keys = checkpointed(keys)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = keys.join(shared, "key").select("key", "node", F.ceil(F.col("n") / F.lit(BLOCK)).cast("long").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = dealt.select("key", "node", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node")
    dealt = dealt.repartition(partitions(keys), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    names = dealt.columns
    return dealt.mapInArrow(lambda batches: _edges_of_runs(batches, names, linked), "a long, b long")


def links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges that connect all distinct ``fp`` with at most ``max_bits`` differing bits."""
    keys = prints.select("fp").distinct().select(F.col("fp").alias("node"), F.explode(chain_keys(F.col("fp"), max_bits)).alias("key"))
    return _met(keys, _by_chain(max_bits))


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and ``fp``, ``least`` (its smallest identifier), ``component`` (a fingerprint that names it)."""
    if max_bits < 1:
        raise ValueError("max_bits must be 1 or more")
    prints = checkpointed(fingerprints(docs, shingle_words, id_col, text_col))
    found = components(links(prints, max_bits), "a", "b").withColumnRenamed("node", "fp")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return prints, least.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``ka``, ``kb``, ``fingerprint`` (16 hex digits), ``component_id``.

    A component is what chains of links reach; its number is the smallest
    identifier in it. Null and empty texts have fingerprint zero and are linked
    like any other. Repeated rows come back as often as they went in. A null
    identifier stays null and gives no component its number: a component of
    such rows alone has a null one. An empty table gives no rows.
    """
    prints, named = _grouped(docs, shingle_words, max_bits, id_col, text_col)
    numbers = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = named.join(numbers, "component").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(labelled, "fp").select("doc_id", "ka", "kb", hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component (see near_duplicates), columns as they were.

    The row with the smallest identifier stays (null ones come last, then the
    smallest text key decides); of repeated rows one stays. Null and empty
    texts are one group; an empty table gives no rows.
    """
    prints, named = _grouped(docs, shingle_words, max_bits, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb")
    # The first row of each fingerprint before those of a component, so a large group is few rows.
    firsts = prints.groupBy("fp").agg(F.min(order).alias("first")).join(named.select("fp", "component"), "fp")
    kept = firsts.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.ka").alias("ka"), F.col("first.kb").alias("kb"), F.col("first.doc_id").alias("keep_id"))
    key = text_key(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key["a"].alias("ka"), key["b"].alias("kb"))
    # Written down, so that a text with most of the rows is a join that Spark can split.
    rows = rows.join(checkpointed(kept), ["ka", "kb"]).where(F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("keep_id")))
    one = rows.withColumn("nth", F.row_number().over(Window.partitionBy("ka", "kb").orderBy("ka"))).where("nth = 1")
    return one.select("row.*")
