"""WARC archives: writing, normalising monolithic gzip files, reading by index.

``write_monolithic`` writes records into archives that are one gzip stream
each, as some crawlers do; such a file can only be read from its start.
``normalise`` inflates each of them once, rewrites every record as a gzip
member of its own and writes a sidecar index of the members' offsets next to
the new archive (JSON lines) and as a table.  ``read`` fetches records by
their offsets, so any part of an archive can be read by any task.

Equal payloads are stored once: normalising turns all records of a payload but
that with the smallest id into revisits of it.  This is decided on the table
of written records (digests, no payloads): an aggregation over digests finds
the smallest id, and its join back is split where a payload is very frequent.
Payloads are never shuffled.

An archive is streamed through a task with one record in memory at a time.
File names have the task attempt in them and count only once a written
table names them, so repeated or lost attempts change nothing.

Defined results: an archive that is cut, also within the checksum at its end, is
an error; a null payload is an empty one; a null address gives a record
without a target; control characters and spaces in an address are
percent-encoded; a null id is written as an empty one and comes after all
others; among rows with equal id and payload the first written is the
response; other columns are ignored; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import open_store, shared_uri, write_file
from civicflow.session import scratch_path

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 8 << 20
#: The tables have no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = re.compile(r"<urn:page:(-?\d*):(\d+)>")

RECORD_SCHEMA = "file string, id long, row long, digest string, payload_bytes long"
INDEX_SCHEMA = "file string, offset long, length long, record_id string, record_type string, target_uri string, payload_digest string"
PAGE_SCHEMA = "page_id long, uri string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id, row) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def safe_uri(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def response_bytes(page_id, row, uri, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: {urn(page_id, row)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {safe_uri(uri)}"] if uri is not None else []
    head += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    return whole_record([*head, "Content-Type: application/http; msgtype=response"], http + payload)


def whole_record(head: list[str], block: bytes) -> bytes:
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisit_bytes(record: bytes, refers_to: str) -> bytes:
    """The response ``record`` as a revisit of another one: its headers, and of
    its block only the HTTP header."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = [x for x in head.decode().split("\r\n") if x.partition(":")[0].lower() not in ("warc-type", "content-length")]
    http = rest.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
    return whole_record([lines[0], "WARC-Type: revisit", *lines[1:], f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"], http)


def headers_of(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def records_of(chunks):
    """(headers, block, whole record) of every record in a stream of bytes."""
    held = bytearray()
    chunks = iter(chunks)

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        searched = 0
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                if held:
                    raise ValueError("the archive ends within a record's header")
                return
        headers = headers_of(bytes(held[:end]))
        size = end + 4 + int(headers["content-length"])
        if not fill(size + 4):
            raise ValueError("the archive ends within a record")
        yield headers, bytes(held[end + 4:size]), bytes(held[:size + 4])
        del held[:size + 4]


def inflate(stream, size: int = 1 << 20):
    """Inflated pieces of a gzip file, of one member or several.  A member that
    ends before its checksum and length is an error: the file was cut."""
    d, within = zlib.decompressobj(31), False
    while raw := stream.read(size):
        while raw:
            piece, within = d.decompress(raw), True
            if piece:
                yield piece
            raw = d.unused_data if d.eof else b""
            if d.eof:
                d, within = zlib.decompressobj(31), False
    if within:
        raise ValueError("the archive ends within a gzip member")


def batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def write_monolithic(pages: DataFrame, folder: str, page_id: str = "page_id", uri: str = "url", payload: str = "html",
                     archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` as responses into archives of one gzip stream each; the
    table of written records."""
    folder = shared_uri(pages.sparkSession, folder)

    def write(batches):
        task, n_files, n_rows = TaskContext.get(), 0, 0
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        row = next(rows, None)
        while row is not None:
            name = f"{folder}/raw/{task.partitionId():06d}-{task.taskAttemptId()}-{n_files:04d}.warc.gz"
            found = []

            def parts():
                nonlocal row, n_rows
                z, size = zlib.compressobj(1, zlib.DEFLATED, 31), 0
                while row is not None and size < archive_bytes:
                    number, data = (task.partitionId() << 33) + n_rows, (row[2] or "").encode()
                    record = response_bytes(row[0], number, row[1], data)
                    yield z.compress(record)
                    found.append((name, row[0], number, base32_sha1(data), len(data)))
                    size, n_rows, row = size + len(record), n_rows + 1, next(rows, None)
                yield z.flush()

            write_file(name, parts())
            n_files += 1
            yield batch(found, RECORD_SCHEMA)

    rows = pages.select(F.col(page_id).cast("long"), F.col(uri).cast("string"), F.col(payload).cast("string"))
    rows.mapInArrow(write, RECORD_SCHEMA).write.parquet(f"{folder}/raw-records")
    return pages.sparkSession.read.parquet(f"{folder}/raw-records")


def with_responses(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(file, row, refers_id, refers_row): the response that a record repeats, or null."""
    first = records.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("digest").alias("d")).agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first"))
    same = (F.col("digest") == F.col("d")) & (F.col("payload_bytes") >= least_bytes)
    repeats = F.col("first.row") != F.col("row")
    return records.join(first, same, "left").select(
        "file", "row", F.when(repeats, F.col("first.id")).alias("refers_id"), F.when(repeats, F.col("first.row")).alias("refers_row"))


def normalise(records: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive named in ``records`` (file, row, refers_id,
    refers_row) with a member per record; the index of all new archives, which
    stands beside each of them too.  Rows that refer become revisits."""
    folder = shared_uri(records.sparkSession, folder)

    def rewrite(table: pa.Table) -> pa.Table:
        source = table.column("file")[0].as_py()
        refers = {row: urn(i, r) for row, i, r in zip(*(table.column(c).to_pylist() for c in ("row", "refers_id", "refers_row"))) if r is not None}
        stem = f"{folder}/warc/{source.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{TaskContext.get().taskAttemptId()}"
        index, at = [], 0

        def members():
            nonlocal at
            store, path = open_store(source)
            with store.open_input_stream(path, compression=None) as stream:
                for headers, _, whole in records_of(inflate(stream)):
                    known = URN.fullmatch(headers["warc-record-id"])
                    to = refers.get(int(known[2])) if known else None
                    kind = "revisit" if to else headers["warc-type"]
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = z.compress(revisit_bytes(whole, to) if to else whole) + z.flush()
                    index.append((f"{stem}.warc.gz", at, len(member), headers["warc-record-id"], kind,
                                  headers.get("warc-target-uri"), headers.get("warc-payload-digest")))
                    at += len(member)
                    yield member

        write_file(f"{stem}.warc.gz", members())
        names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
        write_file(f"{stem}.index.jsonl", ((json.dumps(dict(zip(names[1:], row[1:]))) + "\n").encode() for row in index))
        return pa.Table.from_batches([batch(index, INDEX_SCHEMA)])

    # One group per archive: a gzip stream can't be divided, and its size is
    # bounded.  The rows are narrow, so by their bytes all would go to one task.
    n_archives = max(1, records.select("file").distinct().count())
    records.repartition(n_archives, "file").groupBy("file").applyInArrow(rewrite, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return records.sparkSession.read.parquet(f"{folder}/index")


def read(index: DataFrame) -> DataFrame:
    """The record behind every row of ``index``, parsed and, for responses,
    checked against its digest."""

    def fetch(batches):
        for b in batches:
            places = sorted(zip(*(b.column(i).to_pylist() for i in range(3))))
            at = 0
            while at < len(places):  # neighbouring members are read at once
                file, start, size = places[at]
                to = at + 1
                while to < len(places) and places[to][:2] == (file, start + size) and size < READ_BYTES:
                    size += places[to][2]
                    to += 1
                store, path = open_store(file)
                with store.open_input_file(path) as f:
                    f.seek(start)
                    raw = f.read(size)
                rows = [parsed(zlib.decompress(raw[o - start:o - start + n], 31)) for _, o, n in places[at:to]]
                yield batch(rows, PAGE_SCHEMA)
                at = to

    return index.select("file", "offset", "length").mapInArrow(fetch, PAGE_SCHEMA)


def parsed(record: bytes) -> tuple:
    (headers, block, _), = records_of([record])
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(headers_of(http)["content-length"])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {headers['warc-record-id']}")
    number = lambda name: int(m[1]) if (m := URN.fullmatch(headers.get(name, ""))) and m[1] else None
    return (number("warc-record-id"), headers.get("warc-target-uri"), payload if kind == "response" else None, size, digest, kind, number("warc-refers-to"))


def archive(pages: DataFrame, page_id: str = "page_id", uri: str = "url", payload: str = "html", least_bytes: int = 0,
            archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write, normalise; the index of the archives."""
    folder = scratch_path(pages.sparkSession, "warc")
    written = write_monolithic(pages, folder, page_id, uri, payload, archive_bytes)
    return normalise(with_responses(written, least_bytes), folder)


def archived_pages(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from the archives."""
    return read(archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
