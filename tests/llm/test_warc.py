"""WARC round trips: bytes, digests, revisits, chunk sizes."""

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from stratalake.llm import warc

LONG = "<p>é</p>" + "x" * 70_001
ROWS = [
    (5, "http://a.example/1", "<p>same</p>"), (3, "http://a.example/2", "<p>same</p>"), (9, "http://a.example/3 ü", "<p>same</p>"),
    (1, None, None), (2, "http://b.example/", ""), (4, "http://c.example/", LONG), (6, "http://c.example/x", "WARC/1.1\r\n\r\n\r\n\r\n"),
    (7, "http://d.example/", "alone"), (7, "http://d.example/", "alone"), (None, "http://e.example/", "<p>same</p>"), (None, "u", "only null"), (None, "u", "only null"),
]


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        head = first.get(html or "") if len(data) >= least else None
        again = head is not None and i != head
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", head if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes,least", [(1 << 20, 0), (1000, 0), (7, 12)])
def test_round_trip(spark, chunk_bytes, least):
    rows = ROWS if chunk_bytes > 7 else [r for r in ROWS if r[2] != LONG]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("head", F.lit(1))
    got = warc.round_trip(pages, least, chunk_bytes).drop("url").collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, least)


def test_chunks_give_the_payload_back(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[4:7], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path / "out"), chunk_bytes=4096, segment_bytes=100)
    rows = warc.read_archives(manifest, 4096).orderBy("page_id", "chunk_no").collect()
    for page_id, url, html in ROWS[4:7]:
        own = [r for r in rows if r.page_id == page_id]
        whole, sha = b"", hashlib.sha1()
        for n, r in enumerate(own):
            assert r.chunk_no == n and len(r.data) <= 4096
            whole += bytes(r.data)
            sha.update(r.data)
            assert r.sha1_so_far == base64.b32encode(sha.digest()).decode() and r.payload_bytes == len(whole)
            assert r.is_last == (n == len(own) - 1)
        assert whole == html.encode() and own[0].url == url
    assert manifest.count() >= 2


def test_file_is_a_warc(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(pages, str(tmp_path / "out")).collect()
    raw = b"".join(gzip.decompress(open(r.path.removeprefix("file://"), "rb").read()) for r in manifest)
    stream, kinds = io.BytesIO(raw), []
    while (line := stream.readline()) == b"WARC/1.1\r\n":
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            k, v = line.decode().rstrip("\r\n").split(": ", 1)
            fields[k] = v
        stream.read(int(fields["Content-Length"]))
        assert stream.read(4) == b"\r\n\r\n"
        kinds.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
    assert sorted(kinds) == [("response", "<urn:page:3>", None), ("revisit", "<urn:page:5>", "<urn:page:3>"), ("revisit", "<urn:page:9>", "<urn:page:3>")]


def test_changed_payload_is_noticed(spark, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame([(1, "u", "text" * 9)], "page_id long, url string, html string").coalesce(1), str(tmp_path / "out"))
    path = manifest.first().path.removeprefix("file://")
    changed = gzip.compress(gzip.decompress(open(path, "rb").read()).replace(b"texttext", b"texttezt"))
    open(path, "wb").write(changed)
    resized = manifest.withColumn("length", F.lit(len(changed)).cast("long"))
    with pytest.raises(Exception, match="differs from its header"):
        warc.read_archives(resized).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
