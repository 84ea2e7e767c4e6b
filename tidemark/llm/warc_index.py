"""WARC archives with a two-level capture index.

`write` puts a record per page into gzip members, each page's place becoming an index entry.
`index` sorts the entries by (reversed-host URL key, page_id) over index files: compressed
blocks of LINES entries, and at the end of the file a directory with the first entry of each
block.  `lookup` takes captures, bisects the list of files, then a file's directory, then the
block that it reads by range; `fetch` reads the records by range in order of place.

Only the list of index files goes to every task: one row per partition of the sort, at
most FILES.  Directories and blocks stay in the files.

A null html is an empty payload, a null url an empty key.  A null page_id sorts first and is
found again.  Rows that repeat a page_id are records of their own.  Of equal payloads of
LEAST bytes or more, rows with the largest page_id are responses, the others revisits.

Tasks write files under names of their own; only those named in the written manifest
are read, so a task that ran twice does no harm.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import common

LEAST = 1000  # bytes of a payload that may be stored once for several pages
LINES = 1000  # entries in an index block
FILES = 10_000  # most index files
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TAIL = "<QQ"


def url_key(url: Column) -> Column:
    """Host labels in reverse, a closing bracket, then path and query: `org,example,www)/a?b`."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$|[\t\r\n]", "")
    place = F.regexp_extract(rest, r"^([^/?]*)", 1)
    host = F.regexp_replace(F.lower(place), r"^.*@|:\d*$", "")
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.concat(labels, F.lit(")"), rest.substr(F.length(place) + 1, F.length(rest)))


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, key, html, digest, size, and refers_to where the page is a revisit."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    described = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        url_key(F.col("url")).alias("key"),
        payload.alias("html"),
        F.sha1(F.encode(payload, "utf-8")).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    large = described.where(F.col("size") >= LEAST).select("page_id", "digest")
    # One row per payload and task is shuffled, however many pages share it.
    repeated = large.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("k")).where("k > 1")
    revisits = (
        large.join(repeated, "digest")
        .where("page_id is null or page_id <> kept")
        .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("kept").alias("refers_to"))
        .distinct()
    )
    matched = described["page_id"].eqNullSafe(F.col("_id")) & (described["digest"] == F.col("_digest"))
    return described.join(revisits, matched, "left").drop("_id", "_digest")


def _text(value: object) -> str:
    """A header value without line ends."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in str(value))


def record_id(page_id: int | None, digest: str) -> str:
    """The id of a page's record, as it follows from the page and its payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, date: str) -> bytes:
    """A WARC record; a revisit has the same headers and no payload."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_text(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Page-Id: {'' if page_id is None else page_id}",
        f"Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        headers += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        headers += [f"Refers-To-Page-Id: {refers_to}"]
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Headers of a record, and its payload's length and digest as read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    found = {
        "page_id": int(fields["Page-Id"]) if fields["Page-Id"] else None,
        "payload_bytes": int(fields["Payload-Length"]),
        "payload_digest": stated,
        "record_type": fields["WARC-Type"],
        "refers_to": None,
        "url": fields["WARC-Target-URI"],
    }
    if found["record_type"] == "revisit":
        found["refers_to"] = int(fields["Refers-To-Page-Id"])
    else:
        found["payload_bytes"] = len(payload)
        found["payload_digest"] = hashlib.sha1(payload).hexdigest()
        if found["payload_digest"] != stated:
            raise ValueError(f"payload of page {found['page_id']} does not match its digest")
    return found


def _columns(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def write(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write archives; entries: key, page_id, path, offset, length."""
    spark = pages.sparkSession
    folder = session.run_dir(spark, "warc")
    fs, inner = common.filesystem(folder)
    fs.create_dir(inner, recursive=True)
    common.ship(spark)
    names = ["key", "page_id", "path", "offset", "length"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        fs, inner = common.filesystem(path)
        offset = 0
        with fs.open_output_stream(inner, compression=None) as out:
            for batch in batches:
                for part in common.narrow(batch, 256):
                    rows = []
                    for row in part.to_pylist():
                        data = record(row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"], date)
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        rows.append((row["key"], row["page_id"], path, offset, len(member)))
                        offset += len(member)
                    yield _columns(rows, names, types)

    made = with_roles(pages).mapInArrow(run, "key string, page_id long, path string, offset long, length long")
    return common.store(made, "warc-entries")


def _order(key: str, page_id: int | None) -> tuple[bytes, int]:
    """How Spark orders entries: keys by their bytes, null ids first."""
    return key.encode(), -(1 << 63) if page_id is None else page_id


def index(entries: DataFrame) -> DataFrame:
    """Write index files; one row per file: path, and its first entry."""
    spark = entries.sparkSession
    folder = session.run_dir(spark, "capture-index")
    fs, inner = common.filesystem(folder)
    fs.create_dir(inner, recursive=True)
    common.ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        fs, inner = common.filesystem(path)
        directory, lines, at = [], [], 0
        with fs.open_output_stream(inner, compression=None) as out:

            def block() -> int:
                data = zlib.compress("\n".join(map(json.dumps, lines)).encode())
                out.write(data)
                directory.append([*lines[0][:2], at, len(data)])
                lines.clear()
                return len(data)

            for batch in batches:
                for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    lines.append(line)
                    if len(lines) == LINES:
                        at += block()
            if lines:
                at += block()
            tail = zlib.compress(json.dumps(directory).encode())
            out.write(tail + struct.pack(TAIL, at, len(tail)))
        if directory:
            first = [(path, directory[0][0], directory[0][1])]
            yield _columns(first, ["path", "key", "page_id"], [pa.string(), pa.string(), pa.int64()])

    parts = min(FILES, int(spark.conf.get(session.SHUFFLE_PARTITIONS)))
    ordered = entries.select("key", "page_id", "path", "offset", "length")
    ordered = ordered.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    return common.store(ordered.mapInArrow(run, "path string, key string, page_id long"), "capture-index-files")


class _IndexFile:
    """An index file's directory, and the block read last."""

    def __init__(self, path: str):
        fs, inner = common.filesystem(path)
        self.source = fs.open_input_file(inner)
        start, size = struct.unpack(TAIL, self._at(self.source.size() - 16, 16))
        self.directory = json.loads(zlib.decompress(self._at(start, size)))
        self.firsts = [_order(*d[:2]) for d in self.directory]
        self.held: tuple[int, list, list] = (-1, [], [])

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def block(self, i: int) -> tuple[list, list]:
        if self.held[0] != i:
            lines = list(map(json.loads, zlib.decompress(self._at(*self.directory[i][2:])).decode().split("\n")))
            self.held = (i, lines, [_order(*line[:2]) for line in lines])
        return self.held[1:]

    def find(self, wanted: tuple[bytes, int]) -> Iterator[list]:
        i = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while i < len(self.directory) and self.firsts[i] <= wanted:
            lines, orders = self.block(i)
            yield from lines[bisect.bisect_left(orders, wanted) : bisect.bisect_right(orders, wanted)]
            i += 1


def lookup(files: DataFrame, captures: DataFrame) -> DataFrame:
    """Places of captures (key, page_id): page_id, path, offset, length.

    Captures are sorted as the index is, so that a task reads neighbouring blocks once.
    """
    spark = captures.sparkSession
    if files.count() > FILES:
        raise ValueError(f"more than {FILES} index files")
    listed = sorted(((_order(r["key"], r["page_id"]), r["path"]) for r in files.collect()))
    shared = spark.sparkContext.broadcast(listed)
    names = ["page_id", "path", "offset", "length"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
    held: dict[str, _IndexFile] = {}

    def opened(path: str) -> _IndexFile:
        if path not in held:
            held.clear()
            held[path] = _IndexFile(path)
        return held[path]

    def run(batch: pa.RecordBatch):
        firsts = [f for f, _ in shared.value]
        rows = []
        for key, page_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            wanted = _order(key, page_id)
            i = max(0, bisect.bisect_left(firsts, wanted) - 1)
            while i < len(firsts) and firsts[i] <= wanted:
                rows += [(page_id, *line[2:]) for line in opened(shared.value[i][1]).find(wanted)]
                i += 1
        yield _columns(rows, names, types)

    parts = int(spark.conf.get(session.SHUFFLE_PARTITIONS))
    ordered = captures.select("key", "page_id").distinct().repartitionByRange(parts, "key", "page_id")
    return common.in_batches(
        ordered.sortWithinPartitions("key", "page_id"), run, "page_id long, path string, offset long, length long"
    )


def fetch(places: DataFrame) -> DataFrame:
    """Read records by range, in order of place within their files."""
    held: dict[str, object] = {}
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batch: pa.RecordBatch):
        rows = []
        for path, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if path not in held:
                held.clear()
                fs, inner = common.filesystem(path)
                held[path] = fs.open_input_file(inner)
            held[path].seek(offset)
            found = parsed(zlib.decompress(held[path].read(length), 31))
            rows.append(tuple(found[n] for n in names))
        yield _columns(rows, names, types)

    parts = int(places.sparkSession.conf.get(session.SHUFFLE_PARTITIONS))
    ordered = places.select("path", "offset", "length").repartitionByRange(parts, "path", "offset")
    return common.in_batches(
        ordered.sortWithinPartitions("path", "offset"),
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string",
        rows=512,
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write a record per page, index the captures, look every one up and read it back."""
    entries = write(pages)
    files = index(entries)
    captures = pages.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    return fetch(common.store(lookup(files, captures), "warc-places"))
