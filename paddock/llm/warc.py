"""WARC archives: a normaliser of monolithic gzip files.

``write_archives`` writes each partition's records as one gzip stream a file (what
many crawlers leave, and what no reader can seek in). ``normalise`` inflates such a
file once as a stream, rewrites every record as a gzip member of its own and writes a
sidecar index of member offsets. ``read_archives`` reads members through the index.

Memory is bounded by one record. Files lie in the shared folder of
``spark.checkpoint.dir`` (any store pyarrow's file systems open); a task attempt
writes under a name of its own, and only names that finished tasks returned are read,
so lost or repeated attempts leave at most unread files.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest
page_id is the response and the others revisit it; smaller ones are all responses.

Defined cases: null html is an empty payload; null page_id sorts below any other and
is written without a page number; of repeated rows one is the response and the others
revisit it; a null url is written empty and control characters in it are percent-coded;
an empty table gives no file and an empty result; extra columns are not read. Rows are
numbered once, and the numbers stored with what is written of them.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import numbered, staged
from paddock.session import work_dir

MIN_BYTES = 1000
FILE_BYTES = 256 << 20     # uncompressed size after which a task starts another file
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the WARC format.
VERSION = "WARC/1.0"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

MANIFEST = "path string, n_records long"
NORMAL = "path string, index_path string, n_records long"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string")


def _store(path: str):
    """(file system, path in it) of a shared folder's path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (
        fs.LocalFileSystem(), path)


def record_name(page_id: int | None, row: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:row:{row}>"


def record(row: int, page_id: int | None, url: str, payload: bytes, digest: str,
           revisit: bool, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit carries the HTTP head only."""
    head = (HTTP % len(payload)).encode()
    block = head if revisit else head + payload
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
              f"WARC-Record-ID: {record_name(page_id, row)}", f"WARC-Target-URI: {safe}",
              f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
              f"X-Payload-Length: {len(payload)}"]
    if revisit:
        fields += [f"WARC-Profile: {REVISIT}"]
        if refers_to is not None:
            fields += [f"WARC-Refers-To: {record_name(refers_to, row)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of a stream of bytes."""
    held = bytearray()
    need = None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                m = re.search(rb"^content-length:\s*(\d+)\s*$", bytes(held[:end]), re.I | re.M)
                if not held.startswith(b"WARC/") or m is None:
                    raise ValueError("not a WARC record")
                need = end + 4 + int(m[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the archive ends inside a record")


def inflated(source, size: int = READ_BYTES) -> Iterator[bytes]:
    """The content of a gzip stream of one or several members, in pieces."""
    z, inside = zlib.decompressobj(31), False
    while data := source.read(size):
        while True:
            piece = z.decompress(data, size)
            inside = True
            if piece:
                yield piece
            if z.eof:
                data, z, inside = z.unused_data, zlib.decompressobj(31), False
                if not data:
                    break
            else:
                data = z.unconsumed_tail
                if not data and len(piece) < size:
                    break
    if inside:
        raise ValueError("the archive ends inside a gzip member")


def fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse(rec: bytes) -> tuple:
    """Columns of ``RECORD`` and the payload (None for a revisit); checks the digest."""
    end = rec.index(b"\r\n\r\n")
    f = fields(rec[:end])
    block = rec[end + 4:-4]
    payload = block[block.index(b"\r\n\r\n") + 4:]
    page = re.fullmatch(r"<urn:page:(-?\d+)>", f["warc-record-id"])
    refers = re.fullmatch(r"<urn:page:(-?\d+)>", f.get("warc-refers-to", ""))
    digest = f["warc-payload-digest"].removeprefix("sha1:")
    kind, size = f["warc-type"], int(f["x-payload-length"])
    if kind == "response":
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged record {f['warc-record-id']}")
    return (int(page[1]) if page else None, f["warc-target-uri"], kind,
            int(refers[1]) if refers else None, size, digest, payload if kind == "response" else None)


def _writer(folder: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        done, out, z, path, size, n = [], None, None, None, 0, 0

        def close():
            nonlocal out
            if out is not None:
                out.write(z.flush())
                out.close()
                done.append((path, n))
                out = None

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("row", "page_id", "url", "payload", "digest",
                                                      "revisit", "refers_to")]
            for values in zip(*cols):
                if out is None or size > file_bytes:
                    close()
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{base}/{path.rsplit('/', 1)[1]}", compression=None)
                    z, size, n = zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                rec = record(*values)
                out.write(z.compress(rec))
                size, n = size + len(rec), n + 1
        close()
        yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in done], pa.string()),
                                          "n_records": pa.array([k for _, k in done], pa.int64())})
    return run


def _make_folder(path: str) -> str:
    store, base = _store(path)
    store.create_dir(base, recursive=True)
    return path


def with_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """row, page_id, url, payload, digest, revisit, refers_to for every page."""
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    source = numbered(source.withColumn("digest", F.sha1("payload")), "warc_rows")
    large = staged(source.filter(F.octet_length("payload") >= min_bytes)
                   .select("row", "page_id", F.unhex("digest").alias("digest")), "warc_digests")
    winners = (large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"),
                                           F.max(F.struct("page_id", "row")).alias("first"))
               .filter("n > 1").drop("n"))
    revisits = (large.join(winners, "digest").filter("row <> first.row")
                .select("row", F.lit(True).alias("again"), F.col("first.page_id").alias("refers_to")))
    return (source.join(revisits, "row", "left")
            .select("row", "page_id", "url", "payload", "digest",
                    F.coalesce("again", F.lit(False)).alias("revisit"), "refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES,
                   file_bytes: int = FILE_BYTES, level: int = 6) -> DataFrame:
    """Writes a record per page into monolithic gzip files; (path, n_records) of each."""
    folder = _make_folder(folder or work_dir(pages.sparkSession, "warc"))
    return staged(with_revisits(pages, min_bytes)
                  .mapInArrow(_writer(folder, file_bytes, level), MANIFEST), "warc_manifest")


def _rewrite(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                store, at = _store(path)
                to_store, base = _store(folder)
                name = uuid.uuid4().hex
                offset = n = 0
                with store.open_input_stream(at, compression=None) as source, \
                        to_store.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out, \
                        to_store.open_output_stream(f"{base}/{name}.idx.jsonl", compression=None) as index:
                    for rec in split_records(inflated(source)):
                        f = fields(rec[:rec.index(b"\r\n\r\n")])
                        z = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = z.compress(rec) + z.flush()
                        out.write(member)
                        line = {"id": f["warc-record-id"], "type": f["warc-type"],
                                "offset": offset, "length": len(member)}
                        index.write(json.dumps(line).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([f"{folder}/{name}.warc.gz"]),
                     "index_path": pa.array([f"{folder}/{name}.idx.jsonl"]),
                     "n_records": pa.array([n], pa.int64())})
    return run


def _one_task_a_file(manifest: DataFrame) -> DataFrame:
    """A few bytes a file: the files are dealt out evenly over tasks."""
    return manifest.repartition(max(1, manifest.count()))


def normalise(manifest: DataFrame, folder: str | None = None, level: int = 6) -> DataFrame:
    """Rewrites monolithic archives (path, ...) with a member per record and a sidecar
    offset index: (path, index_path, n_records) of each."""
    folder = _make_folder(folder or work_dir(manifest.sparkSession, "warc_members"))
    return staged(_one_task_a_file(manifest).mapInArrow(_rewrite(folder, level), NORMAL),
                  "warc_members_manifest")


def index_entries(source) -> Iterator[dict]:
    held = b""
    while data := source.read(READ_BYTES):
        *lines, held = (held + data).split(b"\n")
        yield from map(json.loads, lines)
    if held:
        yield json.loads(held)


def _read(with_payload: bool, rows: int = 500):
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {n: pa.array([r[i] for r in found], kinds[i]) for i, n in enumerate(names)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, index_path in zip(b.column("path").to_pylist(),
                                        b.column("index_path").to_pylist()):
                store, at = _store(path)
                _, index_at = _store(index_path)
                found: list[tuple] = []
                with store.open_input_file(at) as archive, \
                        store.open_input_stream(index_at, compression=None) as index:
                    for entry in index_entries(index):
                        member = archive.read_at(entry["length"], entry["offset"])
                        found.append(parse(zlib.decompress(member, 31)))
                        if len(found) == rows:
                            yield batch(found)
                            found = []
                if found:
                    yield batch(found)
    return run


def read_archives(normal: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of normalised archives, through their indexes."""
    return _one_task_a_file(normal).mapInArrow(
        _read(with_payload), RECORD + (", payload binary" if with_payload else ""))
