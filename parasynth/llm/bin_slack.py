"""Sequences of bounded length by minimum bin slack.

Bins are planned on the histogram of piece lengths, which has at most
``capacity`` entries whatever the size of the corpus: take the longest length
left, find the fullest combination of the others that fits beside it (a
bitset subset-sum over the lengths still available), and use that combination
as often as its lengths last. Pieces then find their place by their rank among
pieces of equal length.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, per_batch, texts

CAPACITY, END = 1024, 2
#: Pieces per salt of a length, on average, when ranks are taken.
SALTED = 20_000
#: Cached encodings in a worker.
CACHE = 200_000
#: Spaces after a visible character: no token of the vocabulary's pattern reaches across one.
JOINT = re.compile(r"(?<=\S) ")


class Encoder:
    """Ids of a tokenizer file, as little-endian unsigned 32-bit bytes.

    What lies between two joints is encoded on its own and kept, so common
    words are encoded once; new ones are encoded together by the ranks of the
    same vocabulary, which is several times faster than one at a time. Texts
    that spell a special token are encoded whole.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.size = np.zeros(max(known.values()) + 1, np.int64)
        for token, rank in known.items():
            self.size[rank] = len(token)
        self.known: dict[str, bytes] = {}

    def _one_by_one(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """Words that follow a space and end in a visible character, so tokens end where words do."""
        ids = np.array(self.ranked.encode_ordinary(" " + " ".join(words)), np.int64)
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words)))
        cuts = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1
        made = ids.astype("<u4").tobytes()
        return [made[4 * a : 4 * b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def __call__(self, batch: list[str]) -> list[bytes]:
        whole = {i for i, t in enumerate(batch) if any(s in t for s in self.special)}
        cut = [[t] if i in whole else JOINT.split(t) for i, t in enumerate(batch)]
        first = self._one_by_one([parts[0] for parts in cut])
        if len(self.known) > CACHE:
            self.known.clear()
        new = {w for parts in cut for w in parts[1:]}.difference(self.known)
        blank = [w for w in new if not w or w[-1].isspace()]
        self.known.update(zip(blank, self._one_by_one([" " + w for w in blank])))
        new = list(new.difference(blank))
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            self.known.update(zip(some, self._together(some)))
        return [head + b"".join(map(self.known.__getitem__, parts[1:])) for head, parts in zip(first, cut)]


@functools.cache
def encoder(path: str, ranks: str, pattern: str) -> Encoder:
    return Encoder(path, ranks, pattern)


def pieces(docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``: documents cut so that only the first piece is short.

    ``tokenizer``: tokenizer file, ranks of the same vocabulary, pattern of its pieces.
    """

    def work(batch: pa.RecordBatch) -> dict:
        ids, rows = batch.column(0).to_pylist(), []
        for doc_id, made in zip(ids, encoder(*tokenizer)(batch.column(1).to_pylist())):
            made += np.array([end], "<u4").tobytes()
            n = len(made) // 4
            at, piece = 0, 0
            while at < n:
                length = n if n <= capacity else ((n - at) % capacity or capacity)
                rows.append((doc_id, piece, at, length, zlib.crc32(made[4 * at : 4 * (at + length)])))
                at, piece = at + length, piece + 1
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), (pa.array(c, k) for c, k in zip(columns, kinds))))

    return per_batch(texts(docs, id_col, text_col), work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of which lengths fill ``room`` best, with at most ``counts`` of each."""
    reach, steps, whole = 1, [], 1 << room
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        before, left, step = reach, min(counts[length], room // length), 1
        while left:  # powers of two make up any number of copies
            take = min(step, left)
            reach |= (reach << (length * take)) & ((whole << 1) - 1)
            left, step = left - take, step * 2
        steps.append((length, before))
        if reach & whole:
            break
    target, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> (target - n * length) & 1:
            n += 1
        if n:
            used[length] = n
            target -= n * length
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies in a bin, first bin, offset) for runs of pieces of one length."""
    left, taken, runs, bins = dict(counts), dict.fromkeys(counts, 0), [], 0
    for seed in sorted(counts, reverse=True):
        while left[seed]:
            left[seed] -= 1
            used = fullest(left, capacity - seed)
            left[seed] += 1
            used[seed] = used.get(seed, 0) + 1
            times = min(left[x] // n for x, n in used.items())
            offset = 0
            for x, n in sorted(used.items(), reverse=True):
                runs.append((x, taken[x], taken[x] + n * times, n, bins, offset))
                taken[x] += n * times
                left[x] -= n * times
                offset += n * x
            bins += times
    return runs


def pack(docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``: one row per piece.

    A null text counts as empty; an empty one is the end token alone. Repeated
    rows are packed as often as they come; null identifiers stay null. An empty
    table gives no rows. The driver sees the histogram of lengths, at most
    ``capacity`` rows, and the plan made of it.
    """
    spark = docs.sparkSession
    cut = checkpointed(pieces(docs, tokenizer, capacity, end, id_col, text_col))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.createDataFrame(plan(counts, capacity), "length long, from long, until long, n long, bin long, at long")
    # Ranks within a length: salted, as one length may hold a third of all pieces.
    salts = -(-sum(counts.values()) // SALTED) or 1
    order = ["doc_id", "piece", "ids_crc32"]
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("length").orderBy("salt")) - F.col("size")
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1
    ranked = salted.withColumn("nth", nth).join(sizes.select("length", "salt", before.alias("before")), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth"))
    # The plan has a bounded number of rows: some per length, and there are at most ``capacity`` lengths.
    placed = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("until"))).drop(runs["length"])
    q = F.col("rank") - F.col("from")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("bin") + (q - F.pmod(q, F.col("n"))) / F.col("n")).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(q, F.col("n")) * F.col("length")).alias("offset"),
    )
