"""WARC archives: a writer with one gzip member for each record, and a sequential reader.

The reader inflates a file bit by bit, takes each record's block by its content length, checks
that each record is a gzip member of its own, and verifies block and payload digests. Files lie in
the folder that all executors share; only files that a finished task reported are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import Any, BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import join_counted, map_batches, materialize, new_path

#: A file is closed once it holds so many bytes, and read in parts of so many bytes.
FILE_BYTES, READ_BYTES = 256 << 20, 1 << 18
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A record that is cut short, badly framed or doesn't match its digest."""


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, place: str = "") -> bytes:
    """One record, compressed as a gzip member: a response, or a revisit that leaves the payload out.

    ``place``, the record's own in the archives, tells ids of repeated pages apart.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    key = "" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place} {key} {url}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("X-Page-ID", key),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


class _Member:
    """Reads the inflated bytes of one gzip member after another."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw = stream, b""

    def begin(self) -> bool:
        """Whether another member follows."""
        if not self.raw:
            self.raw = self.stream.read(READ_BYTES)
        self.inflate, self.ready = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def _more(self) -> bool:
        """Inflate another part; False at the member's end."""
        if self.inflate.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(READ_BYTES)
            if not self.raw:
                raise WarcError("the file ends inside a record")
        try:
            self.ready += self.inflate.decompress(self.raw, READ_BYTES)
        except zlib.error as e:
            raise WarcError(str(e)) from e
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        at = self.ready.find(mark)
        while at < 0:
            start = max(0, len(self.ready) - len(mark))
            if not self._more():
                raise WarcError("a record's header has no end")
            at = self.ready.find(mark, start)
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise WarcError("a record is shorter than its content length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def end(self) -> None:
        while self._more():
            pass
        if self.ready:
            raise WarcError("a record is longer than its content length")


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def read_records(stream: BinaryIO) -> Iterator[dict[str, Any]]:
    """Records in file order: ``fields``, ``payload`` and ``payload_bytes`` (the full payload's length)."""
    member = _Member(stream)
    while member.begin():
        head = member.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise WarcError("a record doesn't begin with its version")
        fields = _fields(head)
        block = member.exactly(int(fields["content-length"]))
        if member.exactly(4) != b"\r\n\r\n":
            raise WarcError("a record doesn't end after its content length")
        member.end()
        if fields.get("warc-block-digest") != f"sha1:{digest(block)}":
            raise WarcError(f"block digest of {fields.get('warc-record-id')}")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(_fields(http).get("content-length", len(payload)))
        if fields["warc-type"] == "response" and (size != len(payload) or fields.get("warc-payload-digest") != f"sha1:{digest(payload)}"):
            raise WarcError(f"payload of {fields.get('warc-record-id')}")
        yield {"fields": fields, "payload": payload, "payload_bytes": size}


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to of each page.

    ``refers_to`` is the smallest page_id with the same payload, for pages with a larger page_id;
    payloads of fewer than ``least_bytes`` bytes refer to nothing. A null page_id neither refers nor
    is referred to; rows that repeat the smallest page_id are all responses. Digests are counted,
    combined before their shuffle, and digests and pages meet what belongs to them by counted keys,
    so a payload or a page_id that many rows share lands in no single task.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    sums = pages.select("page_id", "url", "html", F.unhex(F.sha1(payload.cast("binary"))).alias("sha1"), (F.octet_length(payload) >= least_bytes).alias("counts"))
    with_id = sums.where("page_id is not null")
    pairs = materialize(with_id.groupBy("page_id", "sha1", "counts").agg(F.count(F.lit(1)).alias("copies")), "page-digests")
    firsts = materialize(pairs.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")), "first-pages")
    refers_to = F.when(F.col("counts") & (F.col("page_id") > F.col("first")), F.col("first")).alias("refers_to")
    keyed = materialize(join_counted(pairs, firsts, ["sha1"]).select("page_id", "sha1", refers_to, F.col("copies").alias("n")), "references")
    names = ["page_id", "url", "html", "refers_to"]
    return join_counted(with_id.drop("counts"), keyed, ["page_id", "sha1"]).select(names).unionByName(sums.where("page_id is null").select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (page_id, url, html, refers_to) as WARC files below ``folder``; a lazy row for each file.

    Null html is an empty payload, a null url an empty one; white space in a url becomes single
    spaces; a null page_id is written empty and read as null; repeated rows are records of their
    own; other columns are ignored. Each row says path, records and bytes; a task that is run again
    writes files of its own, and those of lost attempts are never reported.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, done = None, []

        def finish():
            out.close()
            done.append((name, records, held))

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    name, records, held = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                data = record(page_id, url, (html or "").encode(), refers_to, f"{name}/{records}")
                out.write(data)
                records, held = records + 1, held + len(data)
                if held >= file_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{n}" for n, _, _ in done], pa.string()), pa.array([r for _, r, _ in done], pa.int64()), pa.array([h for _, _, h in done], pa.int64())],
            names=["path", "records", "bytes"],
        )

    return map_batches(pages.select("page_id", "url", "html", "refers_to"), run, "path string, records long, bytes long")


def read_archives(files: DataFrame) -> DataFrame:
    """Read the archives of column ``path``; one row for each record, digests verified.

    page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to.
    Empty ids are null; a url without characters is empty; records of repeated pages are rows of their
    own; a path that occurs twice is read twice; no path gives no row; other columns are ignored. A damaged file is a
    :class:`WarcError`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def number(text: str | None) -> int | None:
            return int(text) if text else None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inside = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_stream(inside, compression=None) as stream:
                    for r in read_records(stream):
                        f = r["fields"]
                        kind = f["warc-type"]
                        rows.append((number(f.get("x-page-id")), f.get("warc-target-uri"), r["payload"] if kind == "response" else None, r["payload_bytes"], f["warc-payload-digest"].removeprefix("sha1:"), kind, number(f.get("x-refers-to-page-id"))))
                        held += len(r["payload"])
                        if held > 8 << 20 or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return map_batches(files.select("path"), run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in the shared folder and read them back, as :func:`read_archives` gives them.

    Null html is an empty payload, a null url reads back as empty, a null page_id as null; every row, repeated ones too, is a
    record; an empty table gives an empty result; other columns, whatever their names, are ignored.
    """
    folder = new_path(spark, "warc")
    files = materialize(write_archives(with_references(pages, least_bytes), folder), "warc-files")
    return read_archives(files.repartition(min(4096, max(1, files.count()))))
