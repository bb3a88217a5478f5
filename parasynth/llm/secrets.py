"""Secrets in texts: fixed patterns, and credential values that are hard to guess.

A value that stands where a credential stands is judged by how many guesses it
takes: the cheapest way to cut it into dictionary words, dates, repeats,
keyboard walks and brute-force characters, found by dynamic programming over
its characters. Placeholders and words are cheap, keys and good passwords dear.
"""

from __future__ import annotations

import base64
import functools
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_batch, replace_texts, texts

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "guess")
#: log10 of the guesses from which on a value counts as a secret.
MIN_GUESSES = 9.0
#: What redaction puts in place of a secret; not one itself.
MARK = "[SECRET]"

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Wider than ASSIGN: more names, and values with any visible characters.
CONTEXT = re.compile(r"""(?ai:(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?))["']?[\x20\t]*[:=][\x20\t]*["']?([^\s"'<>,;]{6,})""")
STEMS = ("pass", "pwd", "secret", "token", "key", "auth", "credential")

YEAR = re.compile(r"(?:19|20)\d\d")
DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)")
REPEAT = re.compile(r"(.{1,4}?)\1{2,}")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
LEET = str.maketrans("4@310$57", "aaeiosst")
LONGEST_WORD = 24


def _keys() -> dict[str, set[str]]:
    """Neighbours: along a row, the keys above and below it, and the next letter."""
    near: dict[str, set[str]] = {c: set() for c in ALPHABET + ROWS[0]}
    place = {c: (y, x) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    for a, (y, x) in place.items():
        near[a] |= {b for b, (v, u) in place.items() if b != a and (abs(v - y), u - x) in {(0, 1), (0, -1), (1, 0)}}
    for a, b in zip(ALPHABET, ALPHABET[1:]):
        near[a].add(b), near[b].add(a)
    return near


NEAR = _keys()


@functools.cache
def dictionary(path: str) -> dict[str, int]:
    """Words (three letters or more) of a ranked vocabulary file, with the least rank of any spelling."""
    words: dict[str, int] = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            word = base64.b64decode(token).strip()
            if len(word) >= 3 and word.isalpha() and word.isascii():
                words.setdefault(word.decode().lower(), int(rank) + 1)
    return words


def _char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _word_cost(part: str, words: dict[str, int]) -> float | None:
    low = part.lower()
    plain = low.translate(LEET)
    rank, changed = words.get(low), 0
    if rank is None:
        rank, changed = words.get(plain), sum(a != b for a, b in zip(low, plain))
    if rank is None:
        return None
    upper = sum(c.isupper() for c in part)
    case = 0.0 if not upper else math.log10(2) if upper == len(part) or (upper == 1 and part[0].isupper()) else upper * math.log10(2)
    return math.log10(rank) + case + changed * math.log10(2)


def guess_cost(value: str, words: dict[str, int]) -> float:
    """log10 of the guesses that the cheapest segmentation takes; 0 for the empty value."""
    n = len(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # (end, cost) by start
    for m in REPEAT.finditer(value):
        unit = m[1]
        ends[m.start()].append((m.end(), sum(map(_char_cost, unit)) + math.log10(len(m[0]) // len(unit))))
    low, i = value.lower(), 0
    while i < n:  # maximal walks
        j, turns = i + 1, 0
        while j < n and low[j] in NEAR.get(low[j - 1], ()):
            turns += j - i >= 2 and ord(low[j]) - ord(low[j - 1]) != ord(low[j - 1]) - ord(low[j - 2])
            j += 1
        if j - i >= 3:
            ends[i].append((j, math.log10(len(NEAR) * (j - i)) + min(turns, j - i) * math.log10(1.5)))
        i = max(j - 1, i + 1)
    best = [0.0] + [math.inf] * n
    for i in range(n):
        at = best[i]
        best[i + 1] = min(best[i + 1], at + _char_cost(value[i]))
        for j, cost in ends[i]:
            best[j] = min(best[j], at + cost)
        if value[i].isdigit():
            if YEAR.match(value, i):
                best[i + 4] = min(best[i + 4], at + math.log10(130))
            if m := DATE.match(value, i):
                best[m.end()] = min(best[m.end()], at + math.log10(365 * 130))
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            cost = _word_cost(value[i:j], words)
            if cost is not None:
                best[j] = min(best[j], at + cost)
    return best[n]


def scan(text: str, words: dict[str, int], min_guesses: float = MIN_GUESSES) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of every secret, sorted; code points, end exclusive.

    The patterns give their whole matches; a guessed one is the value alone.
    """
    found = []
    low = text.lower()
    if any(s in low for s in STEMS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(1), 3, m.end(1)) for m in CONTEXT.finditer(text) if MARK not in m[1] and guess_cost(m[1], words) >= min_guesses]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def find_secrets(docs: DataFrame, vocabulary: str, min_guesses: float = MIN_GUESSES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end), one row per row of ``docs``.

    ``vocabulary`` is a ranked vocabulary file that every executor has. Null and
    empty texts have no spans; repeated rows come back as often as they went in.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batch: pa.RecordBatch) -> dict:
        words = dictionary(vocabulary)
        spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t, words, min_guesses)] for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "spans": pa.array(spans, span)}

    return per_batch(texts(docs, id_col, text_col), work, "doc_id long, spans array<struct<kind string, start int, end int>>")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: str | None, words: dict[str, int], mark: str = MARK, min_guesses: float = MIN_GUESSES) -> str | None:
    """The text with each secret (overlapping ones as one) replaced by ``mark``."""
    if not text:
        return text
    parts, at, until = [], 0, -1
    for a, _, b in scan(text, words, min_guesses):
        if a > until:  # a new one, not touching the last
            parts += [text[at:a], mark]
        at = until = max(until, b)
    return "".join(parts) + text[at:] if parts else text


def redact_secrets(docs: DataFrame, vocabulary: str, min_guesses: float = MIN_GUESSES, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets in ``text_col`` replaced; every row and column stays, null texts stay null."""

    def work(values: list) -> list:
        words = dictionary(vocabulary)
        return [redact(t, words, min_guesses=min_guesses) for t in values]

    return replace_texts(docs, text_col, work)
