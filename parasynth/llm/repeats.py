"""Repeated passages by depth-limited radix sort of suffixes, digit by digit.

A passage of ``length`` bytes that occurs again is a group of suffixes equal
through that depth. Suffixes are sorted from the most significant digit on,
each pass looking only at groups that still have two members. A digit is a
block of bytes and has as many values as there are such blocks, so a pass deals
suffixes into buckets by a hash that names the digit's value; which of two
different buckets comes first plays no part in which suffixes share one. The
digits are:

1. *Sampled suffixes.* Of the ``window`` places from a start on, the one with
   the least hash of its next bytes is the start's anchor. Equal passages have
   equal anchors, so it is enough to sort the suffixes at anchors, one in some
   hundred, by the bytes that every start of the anchor still covers. Anchors
   alone in their group are done.
2. *The whole reach of an anchor*, from the first byte of its first start to
   the last byte of its last one. If that occurs again, all its starts repeat.
3. *Single starts*, for anchors whose reach is unique but whose group is not,
   and one anchor of each repeated reach in the same group: groups of two or
   more equal passages are the repeated ones.

Texts travel once, compressed, to the partition of their key. What was found
meets them there, and so do the identifiers of their documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import checkpointed, partitions, per_batch, text_key, texts, written

#: Bytes of a passage, places among which an anchor is chosen, bytes that choose it.
LENGTH, WINDOW, GRAM = 400, 128, 16
#: Level at which texts are compressed for their way.
PACK = 6
#: Texts with something to remove, and their spans, that are broadcast.
FEW_TEXTS, FEW_SPANS = 400_000, 2_000_000
#: Copies of a text whose identifiers go to the text; those of texts with more of them are a join that Spark can split.
MANY = 1_000
#: Starts handled at a time, below 2**20 so that a place fits beside a hash.
CHUNK = 1 << 19


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each place."""
    x = data.astype(np.uint64)
    x = x[:-1] | x[1:] << np.uint64(8)
    x = x[:-2] | x[2:] << np.uint64(16)
    x = x[:-4] | x[4:] << np.uint64(32)
    x = x[: -(GRAM - 8)] * np.uint64(0x9E3779B97F4A7C15) ^ x[GRAM - 8 :] * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The minimum of each run of ``window`` values, from block-wise running minima of both directions."""
    n = len(values)
    blocks = -(-n // window)
    padded = np.full(blocks * window, np.uint64(2**64 - 1))
    padded[:n] = values
    grid = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - window + 1], ahead[window - 1 : n])


def anchors(data: bytes, length: int = LENGTH, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first start, last start) of each anchor of the passages of ``data``."""
    starts = len(data) - length + 1
    places, firsts, lasts = [], [], []
    view, low = np.frombuffer(data, np.uint8), np.uint64((1 << 20) - 1)
    for at in range(0, starts, CHUNK):
        n = min(CHUNK, starts - at)
        h = _gram_hashes(view[at : at + n + window + GRAM - 2])
        h = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first place counts
        least = (_least(h, window) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        places.append(least[first] + at), firsts.append(first + at), lasts.append(np.append(first[1:], n) - 1 + at)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, firsts, lasts))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _plain(batch: pa.RecordBatch, name: str = "body") -> Iterator[bytes]:
    """Bodies, unpacked one at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for body in batch.column(batch.schema.get_field_index(name)):
        yield unpack(body.as_py())


def _packed(docs: DataFrame, length: int) -> DataFrame:
    """``ka``, ``kb``, ``copies``, ``body`` (compressed) of each different text of ``length`` bytes or more, dealt out by key."""

    def work(batch: pa.RecordBatch) -> dict:
        pack = zstandard.ZstdCompressor(level=PACK).compress
        return {"ka": batch.column(0), "kb": batch.column(1), "body": pa.array([pack(t.encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()], pa.binary())}

    rows = docs.where(F.octet_length("text") >= length).select("ka", "kb", "text")
    made = per_batch(rows, work, "ka long, kb long, body binary")
    made = made.repartition(partitions(docs), "ka", "kb")
    made = made.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("copies"), F.first("body").alias("body"))
    # A plan that may still change has no known partitioning. Fixed, it keeps its own, and later joins don't move the texts.
    conf = docs.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return checkpointed(made)
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def _anchor_rows(bodies: DataFrame, length: int, window: int) -> DataFrame:
    """Pass 1 and 2 digits of each anchor: ``dh`` of the bytes its starts all cover, ``eh`` of its whole reach."""
    depth = length - window + 1

    def work(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("dh", "eh", "ka", "kb", "lo", "hi", "copies")}
        digest = xxhash.xxh3_64_intdigest
        keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
        for (ka, kb, copies), data in zip(keys, _plain(batch)):
            place, lo, hi = (x.tolist() for x in anchors(data, length, window))
            out["dh"] += [_signed(digest(data[p : p + depth])) for p in place]
            out["eh"] += [_signed(digest(data[a : b + length], p - a)) for p, a, b in zip(place, lo, hi)]
            out["lo"] += lo
            out["hi"] += hi
            for c, v in (("ka", ka), ("kb", kb), ("copies", copies)):
                out[c] += [v] * len(place)
        return {c: pa.array(v, pa.int64() if c not in ("lo", "hi") else pa.int32()) for c, v in out.items()}

    return per_batch(bodies.select("ka", "kb", "copies", "body"), work, "dh long, eh long, ka long, kb long, lo int, hi int, copies long")


def _window_rows(bodies: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Pass 3 digit of each start of the ``wanted`` anchors: 128 bits (``wa``, ``wb``) of its passage."""
    lists = wanted.groupBy("ka", "kb").agg(F.collect_list(F.struct("lo", "hi", "single")).alias("reaches"))

    def work(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("wa", "wb", "ka", "kb", "start", "single")}
        digest = xxhash.xxh3_128_intdigest
        for ka, kb, reaches, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), _plain(batch)):
            before = len(out["wa"])
            for r in reaches:
                made = [digest(data[s : s + length]) for s in range(r["lo"], r["hi"] + 1)]
                out["wa"] += [_signed(h >> 64) for h in made]
                out["wb"] += [_signed(h & (2**64 - 1)) for h in made]
                out["start"] += range(r["lo"], r["hi"] + 1)
                out["single"] += [r["single"]] * len(made)
            out["ka"] += [ka] * (len(out["wa"]) - before)
            out["kb"] += [kb] * (len(out["wa"]) - before)
        kinds = {"start": pa.int32(), "single": pa.bool_()}
        return {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()}

    rows = bodies.select("ka", "kb", "body").join(lists, ["ka", "kb"])
    return per_batch(rows.select("ka", "kb", "body", "reaches"), work, "wa long, wb long, ka long, kb long, start int, single boolean")


def repeated_starts(bodies: DataFrame, length: int, window: int) -> DataFrame:
    """``ka``, ``kb``, ``lo``, ``hi``: runs of starts whose passage starts anywhere else too."""
    rows = _anchor_rows(bodies, length, window)
    # Written down like the others below, so that a group with most of the rows is a join that Spark can split.
    groups = checkpointed(rows.groupBy("dh").agg(F.sum("copies").alias("n")).where("n > 1").select("dh"))
    left = written(rows.join(groups, "dh"))
    reaches = left.groupBy("dh", "eh").agg(F.sum("copies").alias("n"), F.min(F.struct("ka", "kb", "lo")).alias("one"))
    reaches = written(reaches)
    mixed = checkpointed(reaches.groupBy("dh").agg(F.min("n").alias("least")).where("least = 1").select("dh", F.lit(True).alias("mixed")))
    reaches = reaches.join(mixed, "dh", "left").withColumn("mixed", F.coalesce("mixed", F.lit(False)))
    sorted_out = left.join(reaches, ["dh", "eh"])
    chosen = (F.col("one.ka") == F.col("ka")) & (F.col("one.kb") == F.col("kb")) & (F.col("one.lo") == F.col("lo"))
    sorted_out = written(sorted_out.select("ka", "kb", "lo", "hi", (F.col("n") == 1).alias("single"), (F.col("mixed") & ((F.col("n") == 1) | chosen)).alias("wanted")))
    windows = _window_rows(bodies, sorted_out.where("wanted"), length)
    equal = windows.groupBy("wa", "wb").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("wa", "wb")
    found = windows.where("single").join(equal, ["wa", "wb"]).select("ka", "kb", F.col("start").alias("lo"), F.col("start").alias("hi"))
    return sorted_out.where("NOT single").select("ka", "kb", "lo", "hi").unionAll(found)


def _joined_up(length: int):
    """Per text, runs of starts whose passages overlap or touch as one: the same bytes, in as many runs as there are spans."""

    def work(batch: pa.RecordBatch) -> dict:
        lists = batch.column(2)
        lo, hi = (pc.struct_field(lists.flatten(), c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi"))
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) << 32
        order = np.argsort(row | lo, kind="stable")
        lo, reach = (row | lo)[order], np.maximum.accumulate((row | (hi + length))[order])
        first = np.flatnonzero(np.append(True, lo[1:] > reach[:-1])) if len(lo) else np.zeros(0, np.int64)
        last, low = np.append(first[1:], len(lo)) - 1, (1 << 32) - 1
        offsets = np.append(0, np.cumsum(np.bincount(lo[first] >> 32, minlength=len(lists)))).astype(np.int32)
        columns = [pa.array(x.astype(np.int32)) for x in (lo[first] & low, (reach[last] & low) - length)]
        return {"ka": batch.column(0), "kb": batch.column(1), "runs": pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["lo", "hi"]))}

    return work


def removed(data: bytes, runs: list[tuple[int, int]], length: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left, given runs of repeated starts."""
    kept, at, n, spans, until = [], 0, 0, 0, -1
    for lo, hi in sorted(runs):
        end = hi + length
        if lo > until:
            kept.append(data[at:lo])
            spans += 1
            n += end - lo
        else:
            n += max(0, end - until)
        at = until = max(until, end)
    return n, spans, b"".join(kept) + data[at:]


def drop_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``text`` (what is left), one row per row of ``docs``.

    Each byte goes that lies in a passage of ``length`` bytes that starts
    anywhere else as well, in any text or the same one; passages are judged on
    the input. A character of which some bytes stay is left as U+FFFD in
    ``text``; the digest is of the bytes. Null counts as empty; texts shorter
    than ``length`` stay whole. Repeated rows are copies of each other, so
    their passages all go. An empty table gives no rows.
    """
    if not GRAM <= length - window + 1:
        raise ValueError("window leaves no room for the bytes that choose an anchor")
    key = text_key(F.col("text"))
    rows = texts(docs, id_col, text_col).select("doc_id", "text", key["a"].alias("ka"), key["b"].alias("kb"))
    bodies = _packed(rows, length)
    runs = repeated_starts(bodies, length, window).groupBy("ka", "kb").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    # Written down, so that a text with most of the rows is a join that Spark can split.
    runs = checkpointed(per_batch(runs, _joined_up(length), "ka long, kb long, runs array<struct<lo:int,hi:int>>"))

    def finished(ids: pa.Array, found: list, bodies: Iterator[bytes]) -> dict:
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "text")}
        for own, data in zip(found, bodies):
            n, spans, left = removed(data, [(r["lo"], r["hi"]) for r in own], length) if own else (0, 0, data)
            for c, v in zip(out, (len(data), n, spans, sha256(left).hexdigest(), left.decode("utf-8", "replace"))):
                out[c].append(v)
        return {"doc_id": ids} | out

    def in_place(batch: pa.RecordBatch) -> dict:
        return finished(batch.column(0), batch.column(2).to_pylist(), (t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    # Spans of up to this many texts, so many bytes, are counted and go to the texts; more of them meet the texts that were dealt out.
    size = runs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("runs")), F.lit(0)).alias("runs")).first()
    if size["n"] <= FEW_TEXTS and size["runs"] <= FEW_SPANS:
        return per_batch(rows.join(F.broadcast(runs), ["ka", "kb"], "left").select("doc_id", "text", "runs"), in_place, schema)
    short = rows.where(F.octet_length("text") < length).select("doc_id", "text", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"))
    ids = rows.where(F.octet_length("text") >= length).select("doc_id", "ka", "kb")
    found = bodies.join(runs, ["ka", "kb"], "left").select("ka", "kb", "copies", "runs", "body")
    parts = [found.where(F.col("copies") <= MANY)]
    if not bodies.where(F.col("copies") > MANY).isEmpty():
        parts.append(written(found.where(F.col("copies") > MANY)))
        copied = broadcast_if_small(parts[1].select("ka", "kb"))
        owners = [ids.join(copied, ["ka", "kb"], "left_anti"), ids.join(copied, ["ka", "kb"], "left_semi")]
    else:
        owners = [ids]
    out = per_batch(short, in_place, schema)
    for own, part in zip(owners, parts):
        both = own.join(part, ["ka", "kb"]).select("doc_id", "runs", "body")
        out = out.unionAll(per_batch(both, lambda batch: finished(batch.column(0), batch.column(1).to_pylist(), _plain(batch)), schema))
    return out
