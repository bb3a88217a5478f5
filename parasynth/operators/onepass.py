"""Statistics of many sources in one scan: partial sums per task in NumPy, merged by sum.

A scan is for data as vectors and variables that the driver has counted to be
few. It keeps, per source, moments, label counts, the sums and products of every
pair of positions, and a histogram of each continuous variable's places in its
distribution. :func:`cell_sums` needs to know no variables, so there may be any
number of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .draws import Source, drawn

#: Most variables of all sources; sources that a task keeps before it hands its sums on.
VARIABLES, KEPT = 20_000, 16
MOMENTS, LABELS, PLACES, PAIRS = range(4)
PARTS = "source_id string, kind int, i int, j int, n double, a double, b double, c double, d double, e double"

#: ``value`` is null in the row of all values of a position, and one code in a row that counts it.
CELL_SUMS = "source_id string, idx int, value double, n long, seen long, whole boolean, total double, near double, square double, lo double, hi double"


def _matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as lines of equal length: values, which of them are there, which are there or null."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat, k = lists.flatten(), int(sizes.max(initial=0))
    values, known = flat.to_numpy(zero_copy_only=False).astype(float), flat.is_valid().to_numpy(zero_copy_only=False)
    given = np.arange(k) < sizes[:, None]
    if given.all():
        return values.reshape(given.shape), known.reshape(given.shape), given
    x, there = np.zeros(given.shape), np.zeros(given.shape, bool)
    x[given], there[given] = values, known
    return x, there, given


def _code_counts(cell: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (cell, whole value) and how often each comes."""
    if not len(cell):
        return cell, value, cell
    least, span = value.min(), value.max() - value.min() + 1
    if span * (cell.max() + 1) <= 4 * len(cell) + 100_000:
        n = np.bincount(cell * int(span) + (value - least).astype(np.int64))
        key = np.flatnonzero(n)
        return key // int(span), key % int(span) + least, n[key]
    order = np.lexsort((value, cell))
    cell, value = cell[order], value[order]
    first = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (value[1:] != value[:-1])))
    return cell[first], value[first], np.diff(np.append(first, len(cell)))


def cell_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source_id, x) to CELL_SUMS of the batch, ``near`` and ``square`` being sums of distances from ``lo`` and of their squares.

    A position with whole numbers only may hold codes, so these are counted too.
    """
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(0)))
        names = batch.column(0).dictionary_encode()
        which = names.indices.to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        if (which[1:] < which[:-1]).any():
            order = np.argsort(which, kind="stable")
            which, lists = which[order], lists.take(pa.array(order))
        x, there, given = _matrix(lists)
        if not x.size:
            continue
        starts, k = np.flatnonzero(np.append(True, which[1:] != which[:-1])), x.shape[1]
        with np.errstate(invalid="ignore", over="ignore"):
            n, seen = (np.add.reduceat(m, starts, axis=0, dtype=np.int64) for m in (given, there))
            only = (lambda m, other: m) if there.all() else (lambda m, other: np.where(there, m, other))
            lo = np.minimum.reduceat(only(x, np.inf), starts, axis=0)
            hi = np.maximum.reduceat(only(x, -np.inf), starts, axis=0)
            runs = np.diff(np.append(starts, len(which)))
            away = only(x - np.repeat(lo, runs, axis=0), 0.0)
            total, near, square = (np.add.reduceat(m, starts, axis=0) for m in (only(x, 0.0), away, away * away))
            whole = np.logical_and.reduceat(only((x == np.floor(x)) & np.isfinite(x), True), starts, axis=0)
        cell = (np.repeat(np.arange(len(starts)) * k, runs)[:, None] + np.arange(k))
        coded = there & np.repeat(whole, runs, axis=0)
        at, code, times = _code_counts(cell[coded], x[coded])
        own = np.flatnonzero(n.ravel())
        nothing = (seen.ravel() == 0)[own]
        column = lambda m, then: pa.concat_arrays([pa.array(m.ravel()[own], mask=nothing), pa.array(then)])
        both, zero = np.concatenate([own, at]), np.zeros(len(at))
        yield pa.RecordBatch.from_arrays([
            names.dictionary.take(pa.array(which[starts][both // k])), pa.array((both % k).astype(np.int32)),
            pa.concat_arrays([pa.nulls(len(own), pa.float64()), pa.array(code)]),
            pa.array(np.append(n.ravel()[own], times)), pa.array(np.append(seen.ravel()[own], times)), pa.array(np.append(whole.ravel()[own], np.ones(len(at), bool))),
            column(total, code * times), column(near, zero), column(square, zero), column(lo, code), column(hi, code),
        ], [c.split()[0] for c in CELL_SUMS.split(", ")])


def drawn_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks as ``draws.drawn`` takes them to the CELL_SUMS of their rows, which don't leave the task."""
    return cell_sums(rows.select(["source_id", "x"]) for rows in drawn(batches))


def _by_source(batches: Iterator[pa.RecordBatch], sources: dict[str, list[dict]]) -> Iterator[tuple[str, np.ndarray]]:
    """Per batch and known source, its values, a row each, NaN for none."""
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        which = names.indices.to_numpy(zero_copy_only=False)
        for k, source in enumerate(names.dictionary.to_pylist()):
            if source in sources:
                lists = batch.column(1) if len(names.dictionary) == 1 else batch.column(1).take(pa.array(np.flatnonzero(which == k)))
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
                yield source, flat.reshape(len(lists), -1)


class _Sums:
    def __init__(self, variables: list[dict], buckets: int):
        self.variables, self.buckets, k = variables, buckets, len(variables)
        self.shift = np.array([0.0 if v["distribution"] == "categorical" else v["mean"] for v in variables])
        self.rows, self.pairs = 0, np.zeros((4, k, k))
        self.labels = [np.zeros(len(v["categories"]) + 1) if v["distribution"] == "categorical" else None for v in variables]
        self.hist: list = [None if v["distribution"] == "categorical" else (np.zeros(buckets), np.full(buckets, np.inf), np.full(buckets, -np.inf)) for v in variables]

    def add(self, x: np.ndarray) -> None:
        own = x[:, [v["idx"] for v in self.variables]]
        there = ~np.isnan(own)
        self.rows += len(own)
        near, known = np.where(there, own - self.shift, 0.0), there.astype(float)
        self.pairs += np.stack([known.T @ known, near.T @ known, (near * near).T @ known, near.T @ near])
        for at, v in enumerate(self.variables):
            values = own[there[:, at], at]
            if self.labels[at] is not None:
                self.labels[at][:-1] += np.bincount(values.astype(int), minlength=len(v["categories"]))
                self.labels[at][-1] += len(own) - len(values)
                continue
            u = Source.position(v, values)
            if u is None or not len(u):
                continue
            u = np.sort(u[~np.isnan(u)])
            path = np.minimum(np.floor(u * self.buckets), self.buckets - 1).astype(int)
            n, lo, hi = self.hist[at]
            first = np.flatnonzero(np.append(True, path[1:] != path[:-1])) if len(path) else path
            n += np.bincount(path, minlength=self.buckets)
            lo[path[first]] = np.minimum(lo[path[first]], u[first])
            last = np.append(first[1:], len(u)) - 1
            hi[path[last]] = np.maximum(hi[path[last]], u[last])

    def parts(self) -> list[tuple]:
        n, s, q, p = self.pairs
        out = []
        for at, v in enumerate(self.variables):
            if self.labels[at] is None:
                out.append((MOMENTS, v["idx"], -1, n[at, at], float(self.rows), s[at, at], q[at, at], 0.0, 0.0))
                count, lo, hi = self.hist[at]
                out += [(PLACES, v["idx"], b, count[b], lo[b], hi[b], 0.0, 0.0, 0.0) for b in np.flatnonzero(count).tolist()]
            else:
                out += [(LABELS, v["idx"], code, c, 0.0, 0.0, 0.0, 0.0, 0.0) for code, c in enumerate(self.labels[at][:-1].tolist()) if c]
                out += [(LABELS, v["idx"], -1, self.labels[at][-1], 0.0, 0.0, 0.0, 0.0, 0.0)] if self.labels[at][-1] else []
            for b in range(at + 1, len(self.variables)):
                out.append((PAIRS, v["idx"], self.variables[b]["idx"], n[at, b], s[at, b], s[b, at], q[at, b], q[b, at], p[at, b]))
        return out


class Scan:
    """What one scan of ``vectors`` found for the variables ``v``."""

    def __init__(self, vectors: DataFrame, v: DataFrame, buckets: int):
        sources: dict[str, list[dict]] = {}
        for r in v.orderBy("source_id", "idx").collect():
            sources.setdefault(r["source_id"], []).append(r.asDict(recursive=True))
        self.vectors, self.sources, self.buckets = vectors.select("source_id", "x"), sources, buckets

        def handed_on(kept: dict[str, _Sums]) -> pa.RecordBatch:
            rows = [(source, *part) for source, sums in kept.items() for part in sums.parts()]
            columns = list(zip(*rows)) or [[]] * 10
            kinds = [pa.string(), *[pa.int32()] * 3, *[pa.float64()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in PARTS.split(", ")])

        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[str, _Sums] = {}
            for source, x in _by_source(batches, sources):
                if source not in kept and len(kept) == KEPT:
                    yield handed_on(kept)
                    kept = {}
                kept.setdefault(source, _Sums(sources[source], buckets)) if source not in kept else None
                kept[source].add(x)
            yield handed_on(kept)

        merged = self.vectors.mapInArrow(scanned, PARTS).groupBy("source_id", "kind", "i", "j")
        sums = [F.sum(c).alias(c) for c in ("n", "a", "b", "c", "d", "e")]
        self.merged = cut_lineage(merged.agg(*sums, F.min("a").alias("lo"), F.max("b").alias("hi")))

    def summary(self) -> DataFrame:
        """(source_id, idx, code, count, seen, avg, std): like ``validate.summary``."""
        shift = self.merged.sparkSession.createDataFrame(
            [(s, v["idx"], float(v["mean"])) for s, own in self.sources.items() for v in own], "source_id string, i int, mean double"
        )
        n, s, q = F.col("n"), F.col("b"), F.col("c")
        moments = self.merged.where(F.col("kind") == MOMENTS).join(F.broadcast(shift), ["source_id", "i"])
        variance = F.greatest((q - s * F.try_divide(s, n)) / (n - 1), F.lit(0.0))
        moments = moments.select(
            "source_id", F.col("i").alias("idx"), F.lit(None).cast("int").alias("code"), F.col("a").cast("long").alias("count"), n.cast("long").alias("seen"),
            (F.col("mean") + F.try_divide(s, n)).alias("avg"), F.when(n > 1, F.sqrt(variance)).alias("std"),
        )
        code = F.when(F.col("j") >= 0, F.col("j"))
        labels = self.merged.where(F.col("kind") == LABELS).select(
            "source_id", F.col("i").alias("idx"), code.alias("code"), n.cast("long").alias("count"), F.when(code.isNotNull(), n.cast("long")).otherwise(0).alias("seen"),
            F.lit(None).cast("double").alias("avg"), F.lit(None).cast("double").alias("std"),
        )
        return moments.unionAll(labels)

    def histogram(self) -> DataFrame:
        """(source_id, idx, path, n, lo, hi) of the places in the distribution."""
        return self.merged.where(F.col("kind") == PLACES).select("source_id", F.col("i").alias("idx"), F.col("j").cast("long").alias("path"), F.col("n").cast("long").alias("n"), "lo", "hi")

    def correlations(self) -> DataFrame:
        """(source_id, i, j, r), i < j: pairwise complete, constants give 0."""
        n, a, b, aa, bb, ab = (F.col(c) for c in ("n", "a", "b", "c", "d", "e"))
        left, right = n * aa - a * a, n * bb - b * b
        spread = (left > 1e-12 * n * aa) & (right > 1e-12 * n * bb)
        r = F.when(spread, (n * ab - a * b) / F.sqrt(left * right))
        return self.merged.where(F.col("kind") == PAIRS).select("source_id", "i", "j", F.coalesce(r, F.lit(0.0)).alias("r"))

    def places(self) -> DataFrame:
        """(source_id, idx, u) of every value, by the formulas of the scan."""
        sources = self.sources

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for source, x in _by_source(batches, sources):
                for v in sources[source]:
                    values = x[:, v["idx"]]
                    u = None if v["distribution"] == "categorical" else Source.position(v, values[~np.isnan(values)])
                    if u is not None:
                        columns = [pa.array([source] * len(u), pa.string()), pa.array(np.full(len(u), v["idx"], np.int32)), pa.array(u, from_pandas=True)]
                        yield pa.RecordBatch.from_arrays(columns, ["source_id", "idx", "u"])

        return self.vectors.mapInArrow(placed, "source_id string, idx int, u double")
