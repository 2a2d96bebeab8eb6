import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import warc
from corpusprep.work import new_path
from tests.llm.frames import CLASHES

BIG = "<p>é" + "x" * 1200
PAGES = [
    (1, "http://a/1", BIG),
    (5, "http://a/5", BIG),
    (3, "http://a/3", BIG),
    (5, "http://b/5", BIG),  # shares the largest id
    (5, "http://b/5", BIG),  # repeats a row
    (8, "http://a/8", "short"),
    (7, "http://a/7", "short"),
    (9, None, None),
    (10, "http://a/\r\nX-Evil: 1", ""),
    (None, "http://n/", BIG),
    (None, "http://n/", "only here " * 200),
    (11, "http://a/11", "y" * 999),
    (12, "http://a/12", "y" * 999),
    (13, "http://a/13", "\r\n\r\nWARC/1.1\r\n" * 100),
]
SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)
    return warc.write_archive(pages, new_path(spark, "archive"))


def expected(page_id, html):
    size = len((html or "").encode())
    same = [i for i, _, h in PAGES if (h or "") == (html or "") and i is not None]
    if size < 1000 or not same or page_id == max(same):
        return "response", None
    return "revisit", max(same)


def test_records(spark, archive):
    rows = warc.read_archive(spark, archive).collect()
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in rows)
    want = sorted(
        (str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), *expected(i, h), (h or "").encode())
        for i, _, h in PAGES
    )
    assert got == want
    addresses = {r["page_id"]: r["url"] for r in rows}
    assert addresses[9] is None and addresses[10] == "http://a/%0D%0AX-Evil: 1"


def test_each_payload_is_stored_once(spark, archive):
    stored = spark.read.parquet(f"{archive}/payloads").collect()
    assert len(stored) == len({h or "" for _, _, h in PAGES})
    assert all(hashlib.sha256(bytes(r["payload"])).hexdigest() == r["digest"] for r in stored)


def read_warc(data):
    """Headers and blocks by the lengths that the headers state."""
    at = 0
    while at < len(data):
        assert data[at : at + 10] == b"WARC/1.1\r\n"
        end = data.index(b"\r\n\r\n", at)
        header = data[at:end].decode()
        size = int(re.search(r"(?m)^Content-Length: (\d+)", header)[1])
        yield header, data[end + 4 : end + 4 + size]
        at = end + 4 + size
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4


def test_export_is_a_warc_file(spark, archive, tmp_path):
    warc.export_warc(spark, archive, str(tmp_path / "out"))
    records = [r for f in sorted((tmp_path / "out").glob("part-*")) for r in read_warc(f.read_bytes())]
    assert len(records) == len(PAGES)
    for header, block in records:
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        if "WARC-Type: response" in header:
            assert f"WARC-Payload-Digest: sha1:{hashlib.sha1(body).hexdigest()}" in header
            assert f"Content-Length: {len(body)}".encode() in http
        else:
            assert body == b"" and "WARC-Refers-To: <urn:x-page:5>" in header and warc.PROFILE in header


def test_a_changed_payload_is_found(spark, archive, tmp_path):
    path = str(tmp_path / "bad")
    spark.read.parquet(f"{archive}/records").write.parquet(f"{path}/records")
    changed = F.when(F.col("payload") == F.encode(F.lit("short"), "UTF-8"), F.encode(F.lit("shorn"), "UTF-8")).otherwise(F.col("payload"))
    spark.read.parquet(f"{archive}/payloads").withColumn("payload", changed).write.parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="not what its digest says"):
        warc.read_archive(spark, path).select("page_id", "payload_bytes").collect()


def test_no_pages(spark):
    path = warc.write_archive(spark.createDataFrame([], SCHEMA), new_path(spark, "archive"))
    assert warc.read_archive(spark, path).count() == 0


def plain_record(page_id, url, page):
    """A record as a plain writer writes it, by the rules of the format."""
    body = (page or "").encode()
    kind, refers_to = expected(page_id, page)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(body)
    block += body if kind == "response" else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", None if page_id is None else f"<urn:x-page:{page_id}>"),
        ("WARC-Target-URI", url and url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Date", warc.DATE),
        ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(body).hexdigest()),
        ("WARC-Profile", warc.PROFILE if refers_to else None),
        ("WARC-Refers-To", f"<urn:x-page:{refers_to}>" if refers_to else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    header = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    return header.encode() + block + b"\r\n\r\n"


def test_rebuilt_records_are_those_of_a_plain_writer(spark, archive):
    got = sorted(bytes(r["record"]) for r in warc.read_records(spark, archive).collect())
    assert got == sorted(plain_record(*p) for p in PAGES)
    assert got == sorted(bytes(r["record"]) for r in warc.read_archive(spark, archive).collect())


def test_parsed_records(spark, archive):
    rows = warc.parse_records(warc.read_records(spark, archive)).collect()
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)
    want = sorted(
        (str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), *expected(i, h)) for i, _, h in PAGES
    )
    assert got == want
    assert {r["page_id"]: r["url"] for r in rows}[10] == "http://a/%0D%0AX-Evil: 1"


def test_parsing_reads_the_bytes_of_the_records(spark, archive):
    records = warc.read_records(spark, archive)
    turned = F.col("record").cast("string")
    shorn = records.select(F.encode(F.regexp_replace(turned, "short\r\n", "shorn\r\n"), "UTF-8").alias("record"))
    with pytest.raises(Exception, match="not what its header says"):
        warc.parse_records(shorn)
    only = records.where(turned.contains("WARC-Type: revisit"))
    lost = warc.parse_records(only).collect()
    assert lost and all(r["payload_bytes"] is None and r["payload_digest"] is None for r in lost)
    assert warc.parse_records(records.where("false")).count() == 0
