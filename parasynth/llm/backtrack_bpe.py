"""Byte-level BPE by backtracking over longest matches, exact to the merges.

An encoding is right exactly if each token is the encoding of its own bytes and
each adjacent pair is the encoding of the pair's bytes. So a piece is read from
the left with the longest token that starts there (an Aho-Corasick automaton
over Latin-1, one character per byte, finds them); a token that doesn't fit its
left neighbour gives way to its next shorter prefix, and a place from which
nothing fits is never tried again, which keeps the work linear. Whether two
tokens fit is remembered.
"""

from __future__ import annotations

import base64
import functools
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bin_slack import JOINT
from .common import per_batch, texts

#: Entries that a worker keeps of each kind before it starts anew.
KEPT = 300_000


def merged(ranks: dict[bytes, int], piece: bytes) -> list[bytes]:
    """The definition: join the neighbours of least rank, leftmost first, while any are a token."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 31), i) for i in range(len(parts) - 1))
        if rank == 1 << 31:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.text_of = {rank: str(rank) for rank in self.bytes_of}
        self.pattern = regex.compile(pattern)
        # Tokens that the merges reach; the others stand only for a whole piece.
        reached = {t for t in self.ranks if merged(self.ranks, t) == [t]}
        self.automaton = ahocorasick.Automaton()
        for token in reached:
            self.automaton.add_word(token.decode("latin-1"), (self.ranks[token], len(token)))
        self.automaton.make_automaton()
        self.shorter = {}  # the longest proper prefix that is a token
        for token in reached:
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in reached:
                    self.shorter[self.ranks[token]] = self.ranks[token[:n]]
                    break
        self.fits: dict[int, bool] = {}
        self.pieces: dict[str, tuple] = {}
        self.units: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            a, b = self.bytes_of[left], self.bytes_of[right]
            if len(self.fits) > KEPT:
                self.fits.clear()
            known = self.fits[key] = merged(self.ranks, a + b) == [a, b]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        size = [0] * n
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            start = end - length + 1
            if length > size[start]:
                longest[start], size[start] = token, length
        alive = [True] * (n + 1)
        tokens: list[int] = []
        pos, token = 0, longest[0]
        while pos < n:
            end = pos + len(self.bytes_of[token])
            if alive[end] and (not tokens or self.compatible(tokens[-1], token)):
                tokens.append(token)
                pos = end
                token = longest[pos] if pos < n else -1
                continue
            while token not in self.shorter:  # nothing fits from here: back to the token before
                alive[pos] = False
                token = tokens.pop()
                pos -= len(self.bytes_of[token])
            token = self.shorter[token]
        return tokens

    def _encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit bytes, each match of the pattern on its own."""
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            known = self.pieces.get(piece)
            if known is None:
                known = tuple(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
                if len(piece) <= 64:
                    if len(self.pieces) > KEPT:
                        self.pieces.clear()
                    self.pieces[piece] = known
            ids.extend(known)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> list[int]:
        first, *rest = JOINT.split(text)
        made = [self._encode(first)]
        for unit in rest:
            known = self.units.get(unit)
            if known is None:
                known = self._encode(" " + unit)
                if len(unit) <= 64:
                    if len(self.units) > KEPT:
                        self.units.clear()
                    self.units[unit] = known
            made.append(known)
        return np.frombuffer(b"".join(made), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def listed(self, ids: list[int]) -> str:
        return ",".join(map(self.text_of.__getitem__, ids))


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text; null and empty ones have no ids."""

    def work(batch: pa.RecordBatch) -> dict:
        own = codec(path, pattern)
        return {"doc_id": batch.column(0), "ids": pa.array([own.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))}

    return per_batch(texts(docs, id_col, text_col), work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``bytes`` for rows of ``doc_id`` and ``ids``; null ids count as none."""

    def work(batch: pa.RecordBatch) -> dict:
        own = codec(path, pattern)
        return {"doc_id": batch.column(0), "bytes": pa.array([own.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.binary())}

    return per_batch(encoded.select("doc_id", "ids"), work, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: encoded and decoded again in one pass.

    One row per row of ``docs``; a null text counts as empty.
    """

    def work(batch: pa.RecordBatch) -> dict:
        own, out = codec(path, pattern), {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch.column(1).to_pylist():
            ids = own.encode(text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(sha256(own.listed(ids).encode()).hexdigest())
            out["decoded_sha256"].append(sha256(own.decode(ids)).hexdigest())
        return {"doc_id": batch.column(0), **out}

    return per_batch(texts(docs, id_col, text_col), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
