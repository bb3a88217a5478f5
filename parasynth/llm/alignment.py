"""Alignment of two tokenizers: which tokens of one stand where tokens of the other stand.

Both tokenizers cut the same bytes, a space and the text. Tokens of both are
sorted by start; where a start reaches the running maximum of the ends before
it, a new group begins, and every token of one side in a group is linked to
every token of the other.

No token of either side reaches across a single space between two visible
characters, so texts fall into segments there. A segment seen before is not
encoded and coalesced again; new ones are, many at a time. Texts are handled in
blocks of some megabytes. A block keeps the distinct pairs of its documents;
how many documents hold a pair is counted over all blocks and joined back to
each block's distinct pairs, so a frequent pair is one row per block.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_folder
from .common import checkpointed, slices

#: Bytes of texts of a block, segments and their bytes kept in a worker, segments encoded together.
BLOCK, CACHE, CACHE_BYTES, TOGETHER = 2 << 20, 150_000, 16 << 20, 10_000
#: Links of a group up to which its pairs are listed one by one; in larger ones distinct tokens are paired.
PLAIN = 4_096
#: Characters that either side may take for white space.
BLANK = r"\s\u180e\u200b\ufeff"
SEGMENT = re.compile(rf"(?<=[^{BLANK}]) (?=[^{BLANK}])")
LOWER = "\u2581"


def ends_blank(segment: str) -> bool:
    return segment[-1:].isspace() or segment[-1:] in "\u180e\u200b\ufeff"  # an empty one as well


def coalesced(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each token, given the lengths of the tokens of two ways to cut the same bytes."""
    size = np.concatenate([a_size, b_size])
    end = np.concatenate([np.cumsum(a_size), np.cumsum(b_size)])
    start = end - size
    order = np.lexsort((end, start))
    furthest = np.maximum.accumulate(end[order])
    group = np.empty(len(size), np.int64)
    group[order] = np.cumsum(np.append(False, start[order][1:] >= furthest[:-1])) if len(size) else 0
    return group[: len(a_size)], group[len(a_size) :]


def _ranges(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (number[i] of them), for each i."""
    until = np.cumsum(number)
    return np.repeat(first - (until - number), number) + np.arange(until[-1] if len(until) else 0)


def _exclusive(number: np.ndarray) -> np.ndarray:
    return np.cumsum(number) - number


class Aligner:
    """Segments seen so far: their numbers of tokens, groups and links, their groups as text, their distinct pairs."""

    def __init__(self, tokenizer: str, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(LOWER, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.strings: list[str] = []
        self.numbers = np.zeros((5, 0), np.int64)  # tokens of A and B, groups, links, 1 if it can't be aligned
        self.first, self.codes, self.times, self.held = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a space and ``text``; None where their bytes are others."""
        a = self.a.encode(f" {text}", add_special_tokens=False).ids
        b = self.b.encode(text)
        want = f" {text}".encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _all_encoded(self, new: list[str]) -> tuple[list[str], np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The segments in another order, which can't be aligned, and the ids and numbers of ids of both sides.

        Segments that end in a visible character are joined, as tokens end where they do.
        """
        order, bad, ids, numbers = [], [], ([], []), ([], [])
        apart = [s for s in new if ends_blank(s)]
        joined = [s for s in new if not ends_blank(s)]
        for at in range(0, len(joined), TOGETHER):
            some = joined[at : at + TOGETHER]
            both = self._encoded(" ".join(some))
            if both is None:
                apart += some
                continue
            ends = np.cumsum(np.fromiter((len(s) + 1 if s.isascii() else len(s.encode()) + 1 for s in some), np.int64, len(some)))
            for side, size in enumerate((self.a_size, self.b_size)):
                cuts = np.searchsorted(np.cumsum(size[both[side]]), ends) + 1
                ids[side].append(both[side])
                numbers[side].append(np.diff(cuts, prepend=0))
            order += some
            bad += [0] * len(some)
        for s in apart:
            both = self._encoded(s)
            order.append(s)
            bad.append(int(both is None))
            for side in (0, 1):
                ids[side].append(np.zeros(0, np.int64) if both is None else both[side])
                numbers[side].append(np.array([len(ids[side][-1])]))
        return order, np.array(bad), [np.concatenate(x) for x in ids], [np.concatenate(x) for x in numbers]

    def _learn(self, new: list[str]) -> None:
        none = np.zeros(0, np.int64)
        new, bad, (a, b), (n_a, n_b) = self._all_encoded(new)
        a_group, b_group = coalesced(self.a_size[a], self.b_size[b])
        groups = int(a_group[-1]) + 1 if len(a) else 0
        a_of, b_of = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_first, b_first = _exclusive(a_of), _exclusive(b_of)
        links = a_of * b_of
        segment = np.repeat(np.arange(len(new)), n_a)[a_first]
        n_groups = np.bincount(segment, minlength=len(new))
        n_links = np.bincount(segment, weights=links, minlength=len(new)).astype(np.int64)
        # Pairs of small groups one by one, of large ones between distinct tokens.
        plain = np.flatnonzero(links[a_group] <= PLAIN)
        times = b_of[a_group[plain]]
        code = [np.repeat(a[plain], times) << 32 | b[_ranges(b_first[a_group[plain]], times)]]
        owner, count = [np.repeat(segment[a_group[plain]], times)], [np.ones(len(code[0]), np.int64)]
        for g in np.flatnonzero(links > PLAIN):
            x, nx = np.unique(a[a_first[g] : a_first[g] + a_of[g]], return_counts=True)
            y, ny = np.unique(b[b_first[g] : b_first[g] + b_of[g]], return_counts=True)
            code.append((x[:, None] << 32 | y[None, :]).ravel())
            count.append((nx[:, None] * ny[None, :]).ravel())
            owner.append(np.full(len(code[-1]), segment[g]))
        code, owner, count = (np.concatenate(x) for x in (code, owner, count))
        order = np.lexsort((code, owner))
        code, owner, count = code[order], owner[order], count[order]
        fresh = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1]))) if len(code) else none
        count = np.add.reduceat(count, fresh) if len(fresh) else none
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        said = [
            f"{a_text[i] if n == 1 else ','.join(a_text[i : i + n])}|{b_text[j] if m == 1 else ','.join(b_text[j : j + m])}"
            for i, n, j, m in zip(*(x.tolist() for x in (a_first, a_of, b_first, b_of)))
        ]
        ends = np.cumsum(n_groups).tolist()
        at = len(self.known)
        self.known.update(zip(new, range(at, at + len(new))))
        self.strings += [said[i] if j - i == 1 else ";".join(said[i:j]) for i, j in zip([0, *ends], ends)]
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, n_groups, n_links, bad])], axis=1)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.bincount(owner[fresh], minlength=len(new)))])
        self.codes, self.times = np.concatenate([self.codes, code[fresh]]), np.concatenate([self.times, count])
        self.held += sum(map(len, new)) + sum(map(len, self.strings[at:]))

    def segments(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the document and of the segment, for each segment of documents that can be aligned."""
        cut = [SEGMENT.split(t) if t and LOWER not in t else [] for t in texts]
        if len(self.known) > CACHE or self.held > CACHE_BYTES:
            self.clear()
        new = set(chain.from_iterable(cut)).difference(self.known)
        if new:
            self._learn(list(new))
        doc = np.repeat(np.arange(len(texts)), np.array([len(c) for c in cut], np.int64))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, len(doc))
        bad = np.bincount(doc, weights=self.numbers[4, at], minlength=len(texts)) > 0
        fine = ~bad[doc]
        return doc[fine], at[fine]

    def block(self, texts: list[str | None]) -> dict:
        """Numbers and digest per document; distinct pairs of the block and, per document, where its pairs are and how often."""
        doc, at = self.segments(texts)
        n = len(texts)
        out = {c: np.bincount(doc, weights=self.numbers[i, at], minlength=n).astype(np.int64) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
        numbers, cuts = at.tolist(), np.searchsorted(doc, np.arange(n + 1)).tolist()
        out["sha"] = [sha256(";".join(map(self.strings.__getitem__, numbers[i:j])).encode()).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:])]
        own, often = np.unique(doc << 32 | at, return_counts=True)
        doc, at = own >> 32, own & 0xFFFFFFFF
        size = self.first[at + 1] - self.first[at]
        where = _ranges(self.first[at], size)
        codes, pair = np.unique(self.codes[where], return_inverse=True)
        held, which = np.unique(np.repeat(doc, size) << 32 | pair, return_inverse=True)
        times = np.bincount(which, weights=self.times[where] * np.repeat(often, size), minlength=len(held)).astype(np.int64)
        pair = held & 0xFFFFFFFF
        return out | {"codes": codes, "docs": np.bincount(pair, minlength=len(codes)), "first": np.searchsorted(held >> 32, np.arange(n + 1)), "pair": pair, "times": times}


@functools.cache
def aligner(tokenizer: str, model: str) -> Aligner:
    return Aligner(tokenizer, model)


@functools.cache
def _byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, "
    "codes array<long>, docs array<long>, links binary"
)
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _blocks(docs: DataFrame, tokenizer: str, model: str, id_col: str, text_col: str) -> DataFrame:
    """A row per block: what Aligner.block gives, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, BLOCK):
                made = aligner(tokenizer, model).block(part.column(1).to_pylist())
                links = pack(np.concatenate([made["first"], made["pair"], made["times"]]).astype("<i8").tobytes())
                lists = [part.column(0).to_pylist(), *(made[c].tolist() for c in ("n_a", "n_b", "n_groups", "n_links")), made["sha"], made["codes"], made["docs"]]
                kinds = [pa.int64()] * 5 + [pa.string()] + [pa.int64()] * 2
                columns = [pa.array([number]), *(pa.array([x], pa.list_(k)) for x, k in zip(lists, kinds)), pa.array([links], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in BLOCKS.split(", ")])
                number += 1
        aligner(tokenizer, model).clear()  # later stages share the worker's memory

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    path = f"{checkpoint_folder(docs.sparkSession)}/alignment-{uuid.uuid4().hex}"
    rows.mapInArrow(run, BLOCKS).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _pairs(blocks: DataFrame) -> DataFrame:
    """``code``, ``n``, ``best``: in how many documents a pair is linked, and whether no other pair of its first token is in more."""
    counted = blocks.select(F.inline(F.arrays_zip("codes", "docs"))).groupBy(F.col("codes").alias("code")).agg(F.sum("docs").alias("n"))
    counted = checkpointed(counted.withColumn("a", F.shiftright("code", 32)))
    # At most one row per entry of the first vocabulary.
    most = F.broadcast(counted.groupBy("a").agg(F.max("n").alias("most")))
    return counted.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def token_pairs(docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a``, ``b``, ``n``, ``best``: the linked ids of both sides, the documents that hold them linked, and whether that is the most for ``a``."""
    made = _pairs(_blocks(docs, tokenizer, model, id_col, text_col))
    return made.select(F.shiftright("code", 32).alias("a"), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n", "best")


def align(docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, numbers of tokens (``n_a``, ``n_b``), groups and links, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``tokenizer`` is a byte-level BPE file, used on a space and the text;
    ``model`` a sentencepiece model that adds the space. Strings of special
    tokens are plain text. ``n_best`` counts the links whose pair is held by
    most documents for its first token, ties included; ``count_sum`` adds the
    documents of each link's pair. Null and empty texts, and texts that either
    side doesn't give back byte for byte, have zeros and an empty digest.
    Repeated rows count as documents of their own, null identifiers stay; a
    very long text is a block of its own. An empty table gives no rows.
    """
    blocks = _blocks(docs, tokenizer, model, id_col, text_col)
    wanted = blocks.select("block", F.posexplode("codes").alias("at", "code"))
    found = wanted.join(_pairs(blocks), "code").select("block", "at", "n", "best")

    def summed(block: pa.Table, pairs: pa.Table) -> pa.Table:
        ids = block.column("doc_id")[0].as_py()
        numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(block.column("links")[0].as_py()), "<i8")
        first, (pair, times) = numbers[: len(ids) + 1], np.split(numbers[len(ids) + 1 :], 2)
        n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        at = pairs.column("at").to_numpy()
        n[at], best[at] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy().astype(np.int64)
        totals = [np.diff(np.append(0, np.cumsum(times * x[pair]))[first]) for x in (best, n)]
        lists = [block.column(c)[0].values for c in ("n_a", "n_b", "n_groups", "n_links")]
        return pa.table([pa.array(ids, pa.int64()), *lists, *map(pa.array, totals), block.column("sha")[0].values], [c.split()[0] for c in OUT.split(", ")])

    # Under another name, as both sides come from the same table.
    kept = blocks.select(F.col("block").alias("of"), *[c for c in blocks.columns if c not in ("block", "codes", "docs")])
    return kept.groupBy("of").cogroup(found.groupBy("block")).applyInArrow(summed, OUT)
