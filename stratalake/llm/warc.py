"""WARC archives as a table of chunk rows.

Payloads travel as ``(record, chunk number, bytes)`` rows of at most
``chunk_bytes``. The writer appends each chunk to a per-record gzip member as it
arrives; the reader inflates members piece by piece and yields chunk rows that
carry the SHA-1 of the payload so far. Neither holds a record as a whole, so
memory follows the chunk size and not the largest payload.

A write task makes a file of its own and reports it as manifest rows, one for
each ``segment_bytes`` of file, through Spark's commit: files of lost attempts
are in no manifest. Segments begin at a member, so one large file is read by
many tasks. Archives go wherever ``pyarrow.fs`` can open a stream.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import staged
from stratalake.session import scratch_path

CHUNK_BYTES = 1 << 20
SEGMENT_BYTES = 16 << 20
_READ = 1 << 16

# Header fields and profile of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, begin long, length long, n_records long"
CHUNKS = (
    "page_id long, url string, record_type string, refers_to long, chunk_no int, "
    "data binary, payload_bytes long, sha1_so_far string, is_last boolean"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 bits are ten hex digits and eight digits of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """One row per row of ``pages`` with its payload and its type.

    Of equal payloads of ``min_revisit_bytes`` or more, the row (or rows, if it
    repeats) of the smallest id is the response. Only digests that occur twice
    go through the join; the planner broadcasts them if they are small.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload"))})
    repeated = rows.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1 AND head IS NOT NULL")
    heads = staged(repeated.select("digest", "head"), "heads")
    eligible = F.when(F.col("payload_bytes") >= min_revisit_bytes, F.col("digest"))
    joined = rows.withColumn("join_digest", eligible).join(heads.withColumnRenamed("digest", "join_digest"), "join_digest", "left")
    refers = F.when(F.col("head").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("head"), F.lit(False)), F.col("head"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "digest", refers.alias("refers_to"))


def chunk_rows(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Cut payloads into rows, the chunks of a record next to each other and in order."""
    stored = F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(F.lit(0))
    last = F.floor(F.greatest(stored - 1, F.lit(0)) / chunk_bytes).cast("int")
    numbered = rows.withColumns({"last_no": last, "stored": stored}).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), "last_no")))
    piece = F.when(F.col("stored") > 0, F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return numbered.select("page_id", "url", "payload_bytes", "digest", "refers_to", "chunk_no", "last_no", piece.alias("data"))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:none:{digest}>" if page_id is None else f"<urn:page:{page_id}>"


def _page_id(record_id: str | None) -> int | None:
    last = (record_id or "").strip("<>").removeprefix("urn:page:")
    return int(last) if last and not last.startswith("none:") else None


def record_head(page_id: int | None, url: str | None, payload_bytes: int, digest: str, refers_to: int | None) -> bytes:
    """WARC and HTTP header of a record; a revisit keeps the length in its HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url is not None else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", None if refers_to is None else _record_id(refers_to, digest)),
        ("WARC-Profile", None if refers_to is None else REVISIT_PROFILE),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + (payload_bytes if refers_to is None else 0))),
    ]
    return "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), "", ""]).encode() + http


def _write_partition(folder: str, segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = out = packer = None
        path, begin, at, count, made = "", 0, 0, 0, []
        for batch in batches:
            names = batch.schema.names
            heads = zip(*(batch.column(names.index(c)).to_pylist() for c in ("page_id", "url", "payload_bytes", "digest", "refers_to", "chunk_no", "last_no")))
            data = batch.column(names.index("data"))
            for row, (page_id, url, size, digest, refers_to, chunk_no, last_no) in enumerate(heads):
                if out is None:
                    store, base = fs.FileSystem.from_uri(folder)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", store.open_output_stream(f"{base}/{name}", compression=None)
                if chunk_no == 0:
                    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                    at += out.write(packer.compress(record_head(page_id, url, size, digest, refers_to)))
                if (piece := data[row].as_py()) is not None:
                    at += out.write(packer.compress(piece))
                if chunk_no == last_no:
                    at += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    count += 1
                    if at - begin >= segment_bytes:
                        made.append((path, begin, at - begin, count))
                        begin, count = at, 0
        if out is not None:
            out.close()
            if count:
                made.append((path, begin, at - begin, count))
        columns = list(zip(*made)) or [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["path", "begin", "length", "n_records"])

    return run


def write_archives(
    pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Write ``pages (page_id, url, html)`` as archives and return their manifest.

    A null html is an empty payload; a null url gets no target field; a null id
    is written as ``none`` and read back as null; columns of other names are
    ignored. An empty table makes no archive.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    chunks = chunk_rows(records(pages, min_revisit_bytes), chunk_bytes)
    return staged(chunks.mapInArrow(_write_partition(folder, segment_bytes), MANIFEST), "manifest")


class _Inflated:
    """The bytes of gzip members ``begin … begin + length`` of a stream, never more than a piece at a time."""

    def __init__(self, source, length: int):
        self.source, self.left, self.raw, self.ready, self.member = source, length, b"", b"", None

    def _more(self) -> bool:
        if not self.raw:
            self.raw = self.source.read(min(_READ, self.left))
            self.left -= len(self.raw)
        if not self.raw:
            return False
        self.member = self.member or zlib.decompressobj(31)
        self.ready += self.member.decompress(self.raw, _READ)
        self.raw = self.member.unconsumed_tail or self.member.unused_data
        if self.member.eof:
            self.member = None
        return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``; empty at the end of the data."""
        while (at := self.ready.find(mark)) < 0:
            if not self._more():
                if self.ready:
                    raise ValueError("archive ends inside a record")
                return b""
        head, self.ready = self.ready[: at + len(mark)], self.ready[at + len(mark) :]
        return head

    def upto(self, n: int) -> bytes:
        while not self.ready:
            if not self._more():
                raise ValueError("archive ends inside a record")
        head, self.ready = self.ready[:n], self.ready[n:]
        return head


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def read_records(source, length: int, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk tuples ``(fields, no, data, payload bytes so far, digest so far, is last)`` of a stream."""
    data = _Inflated(source, length)
    while head := data.until(b"\r\n\r\n"):
        fields = _fields(head)
        http = data.until(b"\r\n\r\n")
        left = int(fields["content-length"]) - len(http)
        fields["http-length"] = _fields(http)["content-length"]
        digest, done, number, piece = hashlib.sha1(), 0, 0, bytearray()
        while left:
            part = data.upto(min(left, chunk_bytes - len(piece)))
            piece += part
            left -= len(part)
            if len(piece) == chunk_bytes or not left:
                digest.update(piece)
                done += len(piece)
                yield fields, number, bytes(piece), done, base64.b32encode(digest.digest()).decode(), not left
                number, piece = number + 1, bytearray()
        if not done:
            yield fields, 0, b"", 0, base64.b32encode(digest.digest()).decode(), True
        if data.until(b"\r\n\r\n") != b"\r\n\r\n":
            raise ValueError("record without its end mark")


def _read_partition(chunk_bytes: int, with_data: bool, batch_bytes: int = 8 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        rows, size = [], 0

        def flush():
            nonlocal rows, size
            batch = pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
            rows, size = [], 0
            return batch

        for batch in batches:
            for path, begin, length, count in zip(*(batch.column(c).to_pylist() for c in range(4))):
                store, name = fs.FileSystem.from_uri(path)
                done = 0
                with store.open_input_file(name) as source:
                    source.seek(begin)
                    for fields, no, data, so_far, digest, last in read_records(source, length, chunk_bytes):
                        revisit = fields["warc-type"] == "revisit"
                        told = fields["warc-payload-digest"].removeprefix("sha1:")
                        if last and not revisit and (told != digest or so_far != int(fields["http-length"])):
                            raise ValueError(f"payload of {fields['warc-record-id']} differs from its header")
                        done += last
                        if not (with_data or last):
                            continue
                        rows.append((
                            _page_id(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], _page_id(fields.get("warc-refers-to")), no,
                            data if with_data and not revisit else None, int(fields["http-length"]) if revisit else so_far, told if revisit else digest, last,
                        ))
                        size += len(data) + 200
                        if size >= batch_bytes:
                            yield flush()
                if done != count:
                    raise ValueError(f"{path} at {begin}: {done} records, {count} expected")
        if rows:
            yield flush()

    return run


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives in ``manifest``, one task per segment.

    ``payload_bytes`` and ``sha1_so_far`` cover the payload up to and with the
    chunk; the ``is_last`` row has those of the whole, checked against the header.
    A revisit is one row without data, with the length and digest its header
    keeps. ``with_data=False`` returns the last rows only, without bytes.
    """
    segments = manifest.repartition(max(1, manifest.count()))
    return segments.mapInArrow(_read_partition(chunk_bytes, with_data), CHUNKS)


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write all pages, read the archives back; one row per record."""
    last = read_archives(write_archives(pages, None, min_revisit_bytes, chunk_bytes), chunk_bytes, with_data=False).filter("is_last")
    return last.select("page_id", "payload_bytes", F.col("sha1_so_far").alias("payload_digest"), "record_type", "refers_to", "url")
