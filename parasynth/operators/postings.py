"""Blocks of queries and of documents as NumPy arrays: build them, meet them, keep the best hits.

A document block holds its terms with the documents of each (postings). A query
block meets a document block in one task. The hits that a query's k-th best
document of a kind has at least are known before, from a share of the documents,
those with most terms, and so is its place: a number that never falls along the
order in which documents of equal hits are taken. A later document needs one hit
more. A document that gets there without a query's most common
terms is found by the rarer ones alone, so only the postings of these are put
together and the common ones are looked up, one after the other from the rarest,
for the documents that can still get there.

Terms are 64-bit hashes. Repeated rows of a query or a document add up, so terms
have weights, mostly 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

#: Rows of a block, below 2**16; terms of a block; terms or postings that are handled at a time.
ROWS, TERMS, AT_ONCE = 16_384, 4_000_000, 1_000_000
#: Terms in one of so many documents of a block can be looked up (with weights, without); hits that a document then needs besides these.
COMMON, PLAIN, RARER = 32, 256, 2
#: Long documents of a block; cells of a matrix product that take the time of a posting, and those made at a time.
LONG, CELLS, PRODUCT = 1_024, 200, 4_000_000
#: Bytes of document blocks that a task keeps between query blocks.
HELD = 64_000_000


def ranges(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (number[i] of them), for each i."""
    until = np.cumsum(number)
    return np.repeat(first - (until - number), number) + np.arange(until[-1] if len(until) else 0)


def packed(*arrays: np.ndarray) -> bytes:
    """Lengths, then the arrays; a reader knows their types."""
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def unpacked(body: bytes, *kinds: type) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(body, np.int64, len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(body, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out


# --- blocks ------------------------------------------------------------------------------------


def _pairs(major: np.ndarray, minor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order and how often each comes."""
    order = np.argsort(major, kind="stable") if (minor[1:] >= minor[:-1]).all() else np.lexsort((minor, major))
    major, minor = major[order], minor[order]
    first = np.flatnonzero(np.append(True, (major[1:] != major[:-1]) | (minor[1:] != minor[:-1]))) if len(major) else np.zeros(0, np.int64)
    return major[first], minor[first], np.diff(np.append(first, len(order))).astype(np.int32)


def _weights(weight: np.ndarray) -> np.ndarray:
    """None where all are 1."""
    return weight if (weight != 1).any() else weight[:0]


def document_body(row: np.ndarray, term: np.ndarray) -> bytes:
    """Terms, where their postings begin, weights and documents of postings."""
    term, row, weight = _pairs(term, row)
    names, first = np.unique(term, return_index=True)
    return packed(names, np.append(first, len(term)).astype(np.int64), _weights(weight), row.astype(np.uint16))


def query_body(row: np.ndarray, term: np.ndarray) -> bytes:
    """Terms; place among the terms, weight and query of each entry."""
    row, term, weight = _pairs(row, term)
    names, place = np.unique(term, return_inverse=True)
    return packed(names, place.astype(np.int32), weight, row.astype(np.uint16))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], kind: str | None = None) -> Iterator[tuple]:
    """(kind, keys as a table, row of each term, term) of blocks: rows sorted by kind and keys, equal ones together."""
    heads, rows, terms, n, size, last, of = [], [], [], 0, 0, None, None

    def block():
        return of, pa.concat_tables(heads), np.concatenate(rows), np.concatenate(terms)

    for batch in batches:
        head = pa.Table.from_batches([batch]).select(keys)
        listed = batch.column(batch.schema.get_field_index("terms"))
        sizes = np.diff(listed.offsets.to_numpy())
        flat, ends = listed.flatten().to_numpy(), np.append(0, np.cumsum(sizes))
        kinds = batch.column(batch.schema.get_field_index(kind)).to_pylist() if kind else [None] * batch.num_rows
        own, fresh, at = np.zeros(batch.num_rows, np.int64), [], 0

        def take(until: int) -> None:
            nonlocal fresh, at
            heads.append(head.take(pa.array(fresh, pa.int64())))
            rows.append(np.repeat(own[at:until], sizes[at:until]))
            terms.append(flat[ends[at] : ends[until]])
            fresh, at = [], until

        for i, key in enumerate(zip(kinds, *(c.to_pylist() for c in head.columns))):
            if n == 0 or key != last:
                if n and (n >= ROWS or size >= TERMS or key[0] != of):
                    take(i)
                    yield block()
                    heads, rows, terms, n, size = [], [], [], 0, 0
                last, of = key, key[0]
                fresh.append(i)
                n += 1
            own[i] = n - 1
            size += int(sizes[i])
        take(batch.num_rows)
    if n:
        yield block()


def listed(table: pa.Table) -> pa.Array:
    """The rows of a table as one list of structs."""
    rows = pa.StructArray.from_arrays([c.combine_chunks() for c in table.columns], fields=list(table.schema))
    return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)


# --- a query block meets a document block --------------------------------------------------------


class Documents:
    def __init__(self, body: bytes, n: int):
        self.n = n
        self.names, self.first, weight, self.row = unpacked(body, np.int64, np.int64, np.int32, np.uint16)
        self.number = np.diff(self.first)
        self.most = np.maximum.reduceat(weight, self.first[:-1]).astype(np.int64) if len(weight) else np.ones(len(self.names), np.int64)
        self.plain, self.weight = not len(weight), weight if len(weight) else np.broadcast_to(np.int32(1), len(self.row))

    @cached_property
    def line(self) -> np.ndarray:
        """Number of each common term, -1 for others."""
        common = self.number * (PLAIN if self.plain else COMMON) >= self.n
        return np.where(common, np.cumsum(common) - 1, -1)

    @cached_property
    def there(self) -> np.ndarray:
        """For each common term (line), a bit per document, or its weight in each: at most PLAIN bits or COMMON cells per posting."""
        terms = np.flatnonzero(self.line >= 0)
        out = np.zeros((len(terms), self.n + 7 >> 3), np.uint8) if self.plain else np.zeros((len(terms), self.n), np.int32)
        for a, b in _parts(self.number[terms], AT_ONCE):
            line, at = self.postings(terms[a:b])
            row = self.row[at].astype(np.int64)
            if self.plain:
                np.add.at(out[a:b].reshape(-1), line * out.shape[1] + (row >> 3), np.left_shift(1, row & 7).astype(np.uint8))
            else:
                out[a + line, row] = self.weight[at]
        return out

    def looked_up(self, line: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Weights of common terms in documents."""
        cells, width = self.there.reshape(-1), self.there.shape[1]
        return cells[line * width + (row >> 3)] >> (row & 7).astype(np.uint8) & 1 if self.plain else cells[line * width + row]

    def size(self) -> int:
        """Bytes."""
        return self.there.nbytes + self.row.nbytes * (1 if self.plain else 3) + 5 * self.names.nbytes

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and term of each posting, as often as it weighs."""
        return np.repeat(self.row.astype(np.int64), self.weight), np.repeat(np.repeat(self.names, self.number), self.weight)

    def sizes(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.n)

    def only(self, places: np.ndarray) -> bytes:
        """The body of a block of some of the documents."""
        to = np.full(self.n, -1)
        to[places] = np.arange(len(places))
        kept = np.flatnonzero(to[self.row] >= 0)
        term = np.repeat(self.names, self.number)[kept]
        names, first = np.unique(term, return_index=True)
        return packed(names, np.append(first, len(term)).astype(np.int64), _weights(self.weight[kept]), to[self.row[kept]].astype(np.uint16))

    def postings(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each posting of some terms, the number of the entry and the place of the posting."""
        return np.repeat(np.arange(len(entry)), self.number[entry]), ranges(self.first[entry], self.number[entry])


class Queries:
    def __init__(self, body: bytes, n: int):
        self.n = n
        self.names, self.place, self.weight, self.row = unpacked(body, np.int64, np.int32, np.int32, np.uint16)

    def found(self, docs: Documents) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of entries whose term is in the block: query, term there, weight, number of postings; a query's common terms first."""
        if not len(docs.names) or not len(self.names):
            return (np.zeros(0, np.int64),) * 4
        at = np.minimum(np.searchsorted(docs.names, self.names), len(docs.names) - 1)
        at[docs.names[at] != self.names] = -1
        term = at[self.place]
        kept = np.flatnonzero(term >= 0)
        query, term, weight = self.row[kept].astype(np.int64), term[kept], self.weight[kept].astype(np.int64)
        number = docs.number[term]
        order = np.argsort((query << 32) - number)
        return query[order], term[order], weight[order], number[order]

    def hits(self, docs: Documents) -> Iterator[np.ndarray]:
        """Hits of some queries (lines) at a time and documents, for blocks of few documents: terms with many postings by a matrix product."""
        query, term, weight, number = self.found(docs)
        bound = np.bincount(query, weights=weight * docs.most[term], minlength=self.n).max(initial=0)
        kind = np.float32 if bound < 2**24 else np.int64  # float32 is exact that far
        often = np.bincount(term, minlength=len(docs.names)) * docs.number
        dense = np.flatnonzero((often * CELLS > self.n * docs.n) & (kind == np.float32))
        line = np.full(len(docs.names), -1)
        line[dense] = np.arange(len(dense))
        there = np.zeros((len(dense), docs.n), np.float32)
        which, at = docs.postings(dense)
        there[which, docs.row[at]] = docs.weight[at]
        for first, last in _parts(np.full(self.n, docs.n + len(dense)), PRODUCT):
            some = slice(*np.searchsorted(query, (first, last)))
            q, t, w, own = query[some] - first, term[some], weight[some], line[term[some]] >= 0
            asked = np.zeros((last - first, len(dense)), np.float32)
            asked[q[own], line[t[own]]] = w[own]
            out = (asked @ there).astype(kind, copy=False)
            q, t, w = q[~own], t[~own], w[~own]
            for a, b in _parts(docs.number[t], AT_ONCE):
                which, at = docs.postings(t[a:b])
                np.add.at(out.reshape(-1), q[a:b][which] * docs.n + docs.row[at], (w[a:b][which] * docs.weight[at]).astype(kind))
            yield out

    def all_hits(self, docs: Documents) -> np.ndarray:
        """Hits of each query (line) and document."""
        return np.concatenate([np.zeros((0, docs.n)), *self.hits(docs)])

    def most_hits(self, docs: Documents, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hits and places of the k best of each query among documents in order of their places."""
        m, keys = docs.n, [np.zeros((0, min(k, docs.n)), np.int64)]
        for hits in self.hits(docs):
            kind = np.int32 if m * (int(hits.max(initial=0)) + 1) < 2**31 else np.int64
            key = hits.astype(kind) * kind(m) + np.arange(m - 1, -1, -1, dtype=kind)
            keys.append(np.partition(key, m - k, axis=1)[:, m - k :] if m > k else key)
        key = np.concatenate(keys)
        return key // m, places[m - 1 - key % m]

    def best(self, docs: Documents, least: np.ndarray, k: int, until: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, document and hits of the k best of each query that have its ``least`` hits, or one more from document ``until`` on; of equal hits the first documents."""
        until = np.full(self.n, docs.n) if until is None else until
        most = least + (until < docs.n)
        query, term, weight, number = self.found(docs)
        begin = np.searchsorted(query, np.arange(self.n + 1))
        before = np.append(0, np.cumsum(weight * docs.most[term]))
        # Common terms come first among a query's entries, so these are the first ones.
        common = (before[1:] - before[begin[query]] <= most[query] - RARER) & (docs.line[term] >= 0)
        rare = begin[:-1] + np.bincount(query[common], minlength=self.n)
        need = least - (before[rare] - before[begin[:-1]])
        whole = before[begin[1:]] - before[begin[:-1]]
        live = np.flatnonzero((whole >= np.where(until > 0, least, most)) & (whole > 0))
        line, first = docs.line[term], docs.first[term]
        out = []
        for a, b in _parts(np.bincount(query, weights=number * ~common, minlength=self.n)[live], AT_ONCE):
            q = live[a:b]
            size = begin[q + 1] - rare[q]
            entry = ranges(rare[q], size)
            at = ranges(first[entry], number[entry])
            # A cell is a query of this part and a document.
            cell = np.repeat(np.repeat(np.arange(len(q), dtype=np.uint32) << 16, size), number[entry]) | docs.row[at]
            plain = docs.plain and (weight[entry] == 1).all()
            if plain:
                cell.sort()
            else:
                order = np.argsort(cell)
                cell, weights = cell[order], (np.repeat(weight[entry], number[entry]) * docs.weight[at])[order]
            runs = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            hits = np.diff(np.append(runs, len(cell))) if plain else np.add.reduceat(weights, runs)
            cell = cell[runs]
            which = cell >> 16
            kept = np.flatnonzero(hits >= need[q][which] + ((cell & 0xFFFF) >= until[q][which]))
            hits, q, d = hits[kept], q[which[kept]], (cell[kept] & 0xFFFF).astype(np.int64)
            # Common terms not looked up yet are entries from ``start`` up to ``entry``.
            entry, start, done = rare[q], begin[q], []
            goal = least[q] + (d >= until[q]) + before[start]
            while len(q):
                over = entry == start
                if over.any():
                    done.append((q[over], d[over], hits[over]))
                    open_ = np.flatnonzero(~over)
                    q, d, hits, entry, start, goal = (x[open_] for x in (q, d, hits, entry, start, goal))
                entry = entry - 1
                hits = hits + docs.looked_up(line[entry], d) * weight[entry]
                open_ = np.flatnonzero(hits + before[entry] >= goal)
                q, d, hits, entry, start, goal = (x[open_] for x in (q, d, hits, entry, start, goal))
            if done:
                q, d, hits = map(np.concatenate, zip(*done))
                order = np.lexsort((d, -hits, q))
                q, d, hits = q[order], d[order], hits[order]
                kept = np.arange(len(q)) - np.searchsorted(q, q) < k
                out.append((q[kept], d[kept], hits[kept]))
        return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64),) * 3


def _parts(cost: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Ranges of entries of at most so much cost together, or of one entry."""
    total, a = np.cumsum(cost), 0
    while a < len(cost):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


# --- Arrow batches -------------------------------------------------------------------------------


def document_blocks(keys: list[str], share: float):
    """Rows of ``pdf``, keys, ``place`` and ``terms``, sorted, to blocks and ``long``, the ``share`` of their documents with most terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, (pdf, head, row, term) in enumerate(grouped(batches, [*keys, "place"], "pdf"), first):
            body, places = document_body(row, term), head["place"].to_numpy()
            docs = Documents(body, len(head))
            long = np.sort(np.argsort(-docs.sizes(), kind="stable")[: int(np.ceil(docs.n * share))])
            out = {"block": pa.array([number]), "pdf": pa.array([pdf]), "ids": listed(head.select(keys)), "places": _list(places), "body": _binary(body)}
            out |= {"long_places": _list(places[long]), "long": _binary(docs.only(long))}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _list(x: np.ndarray) -> pa.Array:
    return pa.array([x], pa.list_(pa.int64()))


def _binary(x: bytes | np.ndarray) -> pa.Array:
    return pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary())


def long_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pdf, long_places, long) to fewer and larger rows of these, of one kind each, documents in order of their places."""

    def block(pdf: bool, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        places, ends = np.concatenate([x[0] for x in held]), np.cumsum([len(x[0]) for x in held])
        order, to = np.argsort(places, kind="stable"), np.empty(len(places), np.int64)
        to[order] = np.arange(len(order))
        row = np.concatenate([to[end - len(x[0]) + x[1]] for end, x in zip(ends, held)])
        body = document_body(row, np.concatenate([x[2] for x in held]))
        return pa.RecordBatch.from_pydict({"pdf": pa.array([pdf]), "long_places": _list(places[order]), "long": _binary(body)})

    held = {True: [], False: []}
    for batch in batches:
        for i in range(batch.num_rows):
            pdf, places, body = batch.column(0)[i].as_py(), batch.column(1)[i].values.to_numpy(), batch.column(2)[i].as_py()
            if held[pdf] and sum(len(x[0]) for x in held[pdf]) + len(places) > LONG:
                yield block(pdf, held[pdf])
                held[pdf] = []
            held[pdf].append((places, *Documents(body, len(places)).entries()))
    yield from (block(pdf, x) for pdf, x in held.items() if x)


def _firsts(parts: list[tuple[np.ndarray, np.ndarray]], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each of n lines of (hits, places), in order; where there are fewer, no hits at the last place."""
    none = np.zeros((n, k), np.int64)
    hits, places = (np.concatenate(x, axis=1) for x in zip((none, none), *parts))
    places = np.where(hits > 0, places, np.iinfo(np.int64).max)
    order = np.lexsort((places, -hits), axis=-1)[:, :k]
    return np.take_along_axis(hits, order, 1), np.take_along_axis(places, order, 1)


def best_long(k: int):
    """Pairs of a query block (block, n, asked) and a block of long documents to (block, pdf, hits, places): the k best of each query."""

    def row(block: int, pdf: bool, best: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block]), "pdf": pa.array([pdf]), "hits": _binary(best[0]), "places": _binary(best[1])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, asked, best = None, None, {}
        for batch in batches:
            at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                if at["block"][i].as_py() != block:
                    yield from (row(block, *x) for x in best.items())
                    block, best = at["block"][i].as_py(), {}
                    asked = Queries(at["asked"][i].as_py(), at["n"][i].as_py())
                pdf, places = at["pdf"][i].as_py(), at["long_places"][i].values.to_numpy()
                made = asked.most_hits(Documents(at["long"][i].as_py(), len(places)), places, k)
                best[pdf] = _firsts([x for kind, x in best.items() if kind == pdf] + [made], asked.n, k)
        yield from (row(block, *x) for x in best.items())

    return run


def with_least(k: int):
    """(block, queries, body, best) to blocks with ``least`` and ``last``, the hits and the place of the k-th best among the long documents in ``best``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = {c: batch.column(j).slice(i, 1) for j, c in enumerate(batch.schema.names)}
                n, best = len(out["queries"][0]), out.pop("best")[0].as_py() or []
                for kind in ("pdf", "html"):
                    parts = [tuple(np.frombuffer(x[c], np.int64).reshape(n, k) for c in ("hits", "places")) for x in best if x["pdf"] == (kind == "pdf")]
                    hits, places = _firsts(parts, n, k)
                    out |= {f"least_{kind}": _list(hits[:, -1]), f"last_{kind}": _list(places[:, -1])}
                yield pa.RecordBatch.from_pydict(out)

    return run


def query_blocks(keys: list[str]):
    """Rows of keys and ``terms``, sorted, to (block, queries, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, (_, head, row, term) in enumerate(grouped(batches, keys), first):
            yield pa.RecordBatch.from_pydict({"block": pa.array([number]), "queries": listed(head), "body": _binary(query_body(row, term))})

    return run


def met(k: int, order: str):
    """Pairs of a query and a document block to rows of their structs and ``hits``: the k best of each kind that a task sees, of equal hits by ``order``."""

    def best(keys: pa.Array, parts: list[tuple[pa.Array, pa.Array, pa.Array]]) -> pa.RecordBatch:
        q, ids, hits = (pa.concat_arrays(x) for x in zip(*parts))
        table = pa.table([q, pc.negate(hits), ids.field(order)], ["q", "hits", "id"])
        at = pc.sort_indices(table, [("q", "ascending"), ("hits", "ascending"), ("id", "ascending")], null_placement="at_start")
        own = q.take(at).to_numpy()
        at = at.filter(pa.array(np.arange(len(own)) - np.searchsorted(own, own) < k))
        return pa.RecordBatch.from_arrays([keys.take(q.take(at)), ids.take(at), hits.take(at)], ["query", "document", "hits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, parts, asked, bounds, held, room = None, None, {}, None, {}, {}, HELD
        for batch in batches:
            at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                now, number, pdf = at["asking"][i].as_py(), at["block"][i].as_py(), at["pdf"][i].as_py()
                if now != block:
                    yield from (best(keys, p) for p in parts.values())
                    block, keys, parts = now, at["queries"][i].values, {}
                    asked = Queries(at["asked"][i].as_py(), len(keys))
                    bounds = {kind == "pdf": [at[f"{c}_{kind}"][i].values.to_numpy().copy() for c in ("least", "last")] for kind in ("pdf", "html")}
                ids, places, (least, last) = at["ids"][i].values, at["places"][i].values.to_numpy(), bounds[pdf]
                docs = held.get(number) or Documents(at["body"][i].as_py(), len(ids))
                q, d, hits = asked.best(docs, least, k, np.searchsorted(places, last, side="right"))
                parts.setdefault(pdf, []).append((pa.array(q, pa.int64()), ids.take(pa.array(d, pa.int64())), pa.array(hits, pa.int64())))
                kth = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == k - 1)
                least[q[kth]], last[q[kth]] = hits[kth], places[d[kth]]
                if number not in held and docs.size() <= room:
                    held[number], room = docs, room - docs.size()
        yield from (best(keys, p) for p in parts.values())

    return run
