"""WARC archives of pages: a deterministic sharded writer and its reader.

Records are ordered by (identifier, payload digest). Their sizes are summed
along that order, and cuts at multiples of a shard's size make ranges that
don't depend on how Spark deals out rows; a shard's task writes its records in
order and rolls files by compressed size. Each record is its own gzip member,
with headers and digests made from the page, so equal pages make equal files.

Files are written under temporary names of one attempt. Spark collects the
names of successful attempts, a second job renames those files, and its output,
the manifest, is what makes them part of the archive: files of lost or repeated
attempts are in no manifest.

Of pages with equal payloads the one of largest identifier is stored in full
and the others refer to it. Which ones refer is decided on (identifier, digest)
rows; these travel to the shard as notes that sort in front of their page.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from base64 import b32encode
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, column, partitions, per_batch, slices

#: Compressed bytes after which a file is rolled; bytes of a shard before compression, and most shards.
ROLL, SHARD, SHARDS = 1 << 30, 16 << 20, 10_000
#: Bytes of headers that a record counts besides its payload when shards are cut.
HEADERS = 700
#: Pages have no fetch time, so all records carry this one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, seq int, name string, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


# --- records ---------------------------------------------------------------------------


def digest(data: bytes) -> str:
    """Upper-case base32 of SHA-1."""
    return b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, payload_digest: str, number: int = 0) -> str:
    seed = hashlib.sha1(f"{page_id}:{payload_digest}:{number}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>"


def _line(value: str) -> str:
    """A header value on one line: control characters and percent signs before them can't be told apart otherwise."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Date", DATE), *((k, v) for k, v in fields if v is not None)]
    head += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, payload_bytes: int, payload_digest: str, keeper: int | None, number: int = 0) -> bytes:
    """A response; without ``payload``, a revisit of page ``keeper``. Extension headers carry the identifiers."""
    fields = [
        ("WARC-Record-ID", _record_id(page_id, payload_digest, number)), ("X-Page-ID", page_id), ("WARC-Target-URI", url if url is None else _line(url)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    if payload is not None:
        return record("response", fields, http + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(keeper, payload_digest)), ("X-Refers-To-Page-ID", keeper)]
    return record("revisit", fields, http)


def member(data: bytes) -> bytes:
    """One gzip member, without a time."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of an unpacked archive."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip(" \r\n")
        block = stream.read(int(head["content-length"]))
        if len(block) < int(head["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        if f"sha1:{digest(block)}" != head["warc-block-digest"]:
            raise ValueError(f"block digest of {head.get('warc-record-id')} differs")
        yield head, block


def page_of(head: dict[str, str], block: bytes) -> tuple[dict, bytes | None]:
    """A row of RECORDS, and the payload of a response, whose digest is checked."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    stored = head["warc-type"] == "response"
    if stored and (len(payload) != size or f"sha1:{digest(payload)}" != head["warc-payload-digest"]):
        raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
    number = lambda name: int(head[name]) if name in head else None
    row = {
        "page_id": number("x-page-id"), "url": head.get("warc-target-uri"), "record_type": head["warc-type"], "payload_bytes": size,
        "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"), "refers_to": number("x-refers-to-page-id"),
    }
    return row, payload if stored else None


# --- what refers to what, and shards -------------------------------------------------------


def _pages(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit("").cast("binary"))
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))


def _with_keeper(rows: DataFrame, least: int) -> DataFrame:
    """Adds ``keeper``: the page that a revisit refers to, else null.

    A payload with over a thousandth of all rows joins by broadcast, and there
    are fewer than a thousand of those; others join by shuffle.
    """
    groups = rows.where(F.col("size") >= least).groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    groups = checkpointed(groups.where("n > 1 AND keeper IS NOT NULL"))
    often = rows.count() / 1000
    heavy = groups.where(F.col("n") > often).select("sha", F.col("keeper").alias("heavy"))
    light = groups.where(F.col("n") <= often).select("sha", F.col("keeper").alias("light"))
    rows = rows.join(F.broadcast(heavy), "sha", "left")
    # Rows that are decided have no partner, each in a place of its own.
    apart = rows.where("heavy IS NOT NULL").select("page_id", "sha", "size", "n", F.col("heavy").alias("keeper"))
    rest = rows.where("heavy IS NULL").join(light, "sha", "left").select("page_id", "sha", "size", "n", F.col("light").alias("keeper"))
    keeper = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return apart.unionAll(rest).withColumn("keeper", keeper)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the rows before each one in its partition."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        weight = column(batch, "weight")
        until = total + np.cumsum(weight)
        made = [batch.column(0), batch.column(1), batch.column(2), pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(until - weight), pa.array(until)]
        total = int(until[-1]) if len(until) else total
        yield pa.RecordBatch.from_arrays(made, ["page_id", "sha", "keeper", "part", "before", "until"])


def _cuts(decided: DataFrame, shard: int, shards: int) -> tuple[DataFrame, list[tuple]]:
    """The rows in order, and the first (identifier is known, identifier, digest) of each shard: at most ``shards``."""
    weight = (F.when(F.col("keeper").isNull(), F.col("size")).otherwise(0) + HEADERS) * F.col("n")
    ordered = decided.select("page_id", "sha", "keeper", weight.alias("weight"))
    ordered = ordered.repartitionByRange(partitions(decided), F.col("page_id").asc_nulls_first(), "sha").sortWithinPartitions(F.col("page_id").asc_nulls_first(), "sha")
    ordered = checkpointed(ordered.mapInArrow(_running, "page_id long, sha string, keeper long, part int, before long, until long"))
    # One row per partition.
    sizes = dict(map(tuple, ordered.groupBy("part").agg(F.max("until")).collect()))
    at, offset = 0, {}
    for part in sorted(sizes):
        offset[part], at = at, at + sizes[part]
    if not at:
        return ordered, []
    size = max(shard, -(-at // shards))
    offsets = decided.sparkSession.createDataFrame(sorted(offset.items()), "part int, offset long")
    start = ((F.col("before") + F.col("offset")) / F.lit(size)).cast("long")
    first = F.min(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "sha"))
    cuts = ordered.join(F.broadcast(offsets), "part").groupBy(start.alias("shard")).agg(first.alias("first"))
    return ordered, [(r["first"]["known"], r["first"]["page_id"] or 0, r["first"]["sha"]) for r in cuts.orderBy("shard").collect()]


def _shard_of(cuts: list[tuple], page_id: int | None, sha: str) -> int:
    return bisect_right(cuts, (page_id is not None, page_id or 0, sha)) - 1


# --- writing -----------------------------------------------------------------------------


def _members(pages: DataFrame, cuts: list[tuple]) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("shard", "sha", "size", "member")}
        for page_id, url, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            sha = hashlib.sha1(payload)
            out["sha"].append(sha.hexdigest())
            out["shard"].append(_shard_of(cuts, page_id, out["sha"][-1]))
            out["size"].append(len(payload))
            out["member"].append(member(page_record(page_id, url, payload, len(payload), b32encode(sha.digest()).decode(), None)))
        kinds = {"shard": pa.int32(), "sha": pa.string(), "size": pa.int64(), "member": pa.binary()}
        return {c: pa.array(v, kinds[c]) for c, v in out.items()} | {"page_id": batch.column(0), "url": batch.column(1), "keeper": pa.nulls(batch.num_rows, pa.int64())}

    return per_batch(pages, work, "shard int, page_id long, sha string, url string, size long, keeper long, member binary")


def _notes(ordered: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Revisits as rows like those of pages, without a member, so that they sort in front."""

    def work(batch: pa.RecordBatch) -> dict:
        ids, shas = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        return {"shard": pa.array([_shard_of(cuts, *x) for x in zip(ids, shas)], pa.int32()), "page_id": batch.column(0), "sha": batch.column(1), "keeper": batch.column(2)}

    made = per_batch(ordered.where("keeper IS NOT NULL").select("page_id", "sha", "keeper"), work, "shard int, page_id long, sha string, keeper long")
    empty = F.lit(None)
    return made.select("shard", "page_id", "sha", empty.cast("string").alias("url"), empty.cast("long").alias("size"), "keeper", empty.cast("binary").alias("member"))


class _File:
    """One archive file under a temporary name."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, seq: int, prefix: str):
        self.shard, self.seq, self.name = shard, seq, f"{prefix}-{shard:06d}-{seq:05d}.warc.gz"
        self.temp = f"{self.name}.{uuid.uuid4().hex}"
        self.records, self.bytes, self.sha = 0, 0, hashlib.sha1()
        self.out = store.open_output_stream(f"{folder}/{self.temp}")
        about = f"software: parasynth\r\nformat: WARC File Format 1.1\r\nisPartOf: {prefix}\r\n".encode()
        self.add(member(record("warcinfo", [("WARC-Record-ID", _record_id(None, self.name)), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], about)))

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.records, self.bytes = self.records + 1, self.bytes + len(data)

    def close(self) -> tuple:
        self.out.close()
        return self.shard, self.seq, self.name, self.records, self.bytes, self.sha.hexdigest(), self.temp


def _written(temp: str, roll: int, prefix: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(temp)
        file, done, note, last, number = None, [], None, None, 0
        for batch in batches:
            for part in slices(batch):
                for shard, page_id, sha, url, size, keeper, data in zip(*(part.column(i).to_pylist() for i in range(7))):
                    if data is None:
                        note = (shard, page_id, sha), keeper
                        continue
                    key = shard, page_id, sha
                    number, last = (number + 1 if key == last else 0), key
                    name = b32encode(bytes.fromhex(sha)).decode()
                    if note and note[0] == key:
                        data = member(page_record(page_id, url, None, size, name, note[1], number))
                    elif number:  # a repeated page has an identifier of its own
                        data = member(zlib.decompress(data, 31).replace(_record_id(page_id, name).encode(), _record_id(page_id, name, number).encode(), 1))
                    if file and (file.shard != shard or file.records > 1 and file.bytes + len(data) > roll):
                        done.append(file.close())
                        file = _File(store, folder, shard, file.seq + 1 if file.shard == shard else 0, prefix)
                    file = file or _File(store, folder, shard, 0, prefix)
                    file.add(data)
        if file:
            done.append(file.close())
        columns = list(zip(*done)) or [[]] * 7
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "seq", "name", "records", "bytes", "sha1", "temp"])

    return run


def _renamed(temp: str, final: str) -> Callable:
    """Moves each file to its name; done again after a lost task, it finds the file there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, old), (_, new) = fs.FileSystem.from_uri(temp), fs.FileSystem.from_uri(final)
        for batch in batches:
            for name, size, at in zip(*(batch.column(i).to_pylist() for i in (2, 4, 6))):
                if store.get_file_info(f"{old}/{at}").type == fs.FileType.File:
                    store.move(f"{old}/{at}", f"{new}/{name}")
                if store.get_file_info(f"{new}/{name}").size != size:
                    raise OSError(f"{name} is not as it was written")
            yield batch.select(["shard", "seq", "name", "records", "bytes", "sha1"])

    return run


def write(
    pages: DataFrame, folder: str, least: int = 0, roll: int = ROLL, shard: int = SHARD, shards: int = SHARDS, prefix: str = "pages",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """Write ``pages`` as archives in ``folder`` and return the manifest, a row per file.

    ``folder`` is a path or URI that pyarrow opens from every executor; an
    archive there already is an error. Of pages with equal payloads of at least
    ``least`` bytes, the one of largest identifier is a response and the others
    revisit it. A null payload is empty; a null identifier is smaller than any
    other and isn't referred to, so payloads with null identifiers only are all
    responses, as are rows that repeat identifier and payload of the page
    referred to. A null address is left out, control characters in one are
    percent-encoded. A very long payload is one record, larger than ``roll`` if
    need be. Rows equal in identifier and payload lie in one shard. An empty
    table makes an empty manifest. Other columns aren't read.
    """
    store, path = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{path}/manifest").type != fs.FileType.NotFound:
        raise FileExistsError(f"{folder} has an archive")
    temp = f"{folder}/_temporary-{uuid.uuid4().hex}"
    store.create_dir(fs.FileSystem.from_uri(temp)[1], recursive=True)
    spark, rows = pages.sparkSession, _pages(pages, id_col, url_col, payload_col)
    sizes = rows.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("long").alias("size"))
    sizes = checkpointed(sizes.groupBy("page_id", "sha").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")))
    ordered, cuts = _cuts(_with_keeper(sizes, least), shard, shards)
    if cuts:
        both = _members(rows, cuts).unionAll(_notes(ordered, cuts)).repartitionById(len(cuts), "shard")
        # Notes have no member and null sorts first.
        both = both.sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "sha", F.col("member").isNotNull(), "url")
        both.mapInArrow(_written(temp, roll, prefix), MANIFEST + ", temp string").write.parquet(f"{temp}/written")
        done = spark.read.parquet(f"{temp}/written")
        done = done.repartition(min(partitions(pages), len(cuts))).mapInArrow(_renamed(temp, folder), MANIFEST)
    else:
        done = spark.createDataFrame([], MANIFEST)
    done.write.parquet(f"{folder}/manifest")
    store.delete_dir(fs.FileSystem.from_uri(temp)[1])
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


# --- reading -----------------------------------------------------------------------------


def read(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The pages of the archives that the manifest of ``folder`` names: RECORDS, and ``payload`` (null for revisits) if asked for.

    Files are read as streams, a record at a time. Digests of blocks and
    payloads are checked; a damaged or missing file is an error.
    """
    schema = RECORDS + ", payload binary" * payload
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for files in batches:
            for name in files.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) as stream:
                    for head, block in records(stream):
                        if head["warc-type"] not in ("response", "revisit"):
                            continue
                        row, body = page_of(head, block)
                        rows.append(row | {"payload": body if payload else None})
                        held += len(body or b"") if payload else 0
                        if held > 4 << 20 or len(rows) >= 10_000:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    files = manifest(spark, folder).select("name")
    return files.repartition(max(partitions(files), spark.sparkContext.defaultParallelism)).mapInArrow(run, schema)
