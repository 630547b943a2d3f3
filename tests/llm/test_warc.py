import hashlib
import base64

import pytest
from pyspark.sql import functions as F

from tickloom.llm import warc

SF = "/root/testdata/sf0.01"


def _expected(rows, min_bytes=0):
    first: dict = {}
    for page_id, html in rows:
        data = (html or "").encode()
        if len(data) >= min_bytes and page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        to = first.get(data, page_id)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, *(("response", None) if to == page_id else ("revisit", to))))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    index = warc.write_pages(pages)
    records = warc.read_archives(index)
    assert _got(warc.page_digests(records)) == _expected([(r.page_id, r.html) for r in pages.collect()])
    html = {r.page_id: r.html for r in pages.collect()}
    back = records.where("record_type = 'response'").collect()
    assert all(bytes(r.payload) == html[int(r.record_id.split(":")[-1])].encode() for r in back)


ROWS = [(5, "u", "same"), (3, "v", "same"), (9, None, "same"), (None, "w", "same"), (4, "x", ""), (2, "y\r\nz", None),
        (7, "q", "\r\n\r\nHTTP é"), (8, "q", "\r\n\r\nHTTP é"), (3, "v", "same"), (11, "p", "big " * 400_000)]


def test_copies_nulls_and_repeats(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr(
        "*", "1 as frame", "2 as sha1", "3 as first_page"
    )
    got = _got(warc.page_digests(warc.read_archives(warc.write_pages(pages))))
    assert got == _expected([(r[0], r[2]) for r in ROWS])
    few = _got(warc.page_digests(warc.read_archives(warc.write_pages(pages, min_bytes=5))))
    assert few == _expected([(r[0], r[2]) for r in ROWS], 5)
    empty = warc.write_pages(pages.limit(0))
    assert empty.count() == 0
    assert warc.read_archives(empty).count() == 0


def test_seeking_reads_one_record(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 4000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 20000)
    pages = spark.range(300).select(
        F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 9).alias("html")
    )
    # the settings above only hold in this process: write the bundle here
    import os
    import tempfile
    path = os.path.join(tempfile.mkdtemp(), "one.warc.zst")
    bundle = warc.BundleWriter(path)
    for r in pages.collect():
        bundle.add(f"urn:x-page:{r.page_id}", r.page_id,
                   warc.make_record(f"urn:x-page:{r.page_id}", r.url, r.html.encode(), warc.base32_sha1(r.html.encode()), None))
    index = spark.createDataFrame(bundle.close(), warc.INDEX)
    assert len({r.frame for r in index.collect()}) > 20
    wanted = spark.createDataFrame([("urn:x-page:250",), ("urn:x-page:7",), ("urn:x-page:9999",)], "record_id string")
    got = {r.record_id: bytes(r.payload).decode() for r in warc.fetch(index, wanted).collect()}
    html = {f"urn:x-page:{r.page_id}": r.html for r in pages.collect()}
    assert got == {k: html[k] for k in ("urn:x-page:250", "urn:x-page:7")}
    with open(path, "r+b") as file:
        file.seek(-1, 2)
        file.write(b"x")
    with pytest.raises(ValueError):
        warc.BundleReader(path)
