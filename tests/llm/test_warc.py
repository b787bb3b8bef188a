"""WARC archives: round trips, byte ranges of every size, nested and damaged archives."""

import base64
import glob
import gzip
import hashlib
import random
import tempfile
import zlib

import pytest
from pyspark.sql import functions as F

from sentimart.llm import warc as W
from sentimart.llm.common import table
from sentimart.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, digest string, size string, payload string"


def expected(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) by the contract, as a multiset."""
    heads = {}
    for page, url, html in rows:
        data = (html or "").encode()
        heads.setdefault(data, []).append((page is not None, page, url is not None, url))
    out = []
    for data, found in heads.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        found.sort(key=lambda x: (x[0], x[1] or 0, x[2], (x[3] or "").encode()))
        for k, (_, page, _, _) in enumerate(found):
            response = len(data) < least or k == len(found) - 1
            out.append((page, len(data), digest, "response" if response else "revisit", None if response else found[-1][1]))
    return sorted(out, key=str)


def digest_rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], PAGES)


ODD = [(1, "u", "same"), (2, "u", "same"), (2, "u", "same"), (2, None, "same"), (3, "a b\r\nWARC-Type: x", None), (4, "", ""),
       (None, "n", "alone"), (None, None, "both"), (None, None, "both"), (None, None, "both"), (5, "é", "ß" * 3),
       (6, "x", "\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"), (-7, "y", "same"), (8, "z", "\x00 nul")]


@pytest.mark.parametrize("least", [0, 5, 10**6])
def test_odd_rows(spark, least):
    got = W.archived(frame(spark, ODD), least, range_bytes=64, payloads=True)
    assert digest_rows(got) == expected(ODD, least)
    rows = got.collect()
    assert len({r.record_id for r in rows}) == len(rows)
    responses = {r.record_id: r for r in rows if r.record_type == "response"}
    assert all(r.intact for r in responses.values())
    want = sorted((h or "").encode() for i, u, h in ODD)
    held = [responses.get(r.refers_to_id, r).payload for r in rows]
    assert sorted(map(bytes, held)) == want
    urls = {r.url for r in rows}
    assert "a%20b%0D%0AWARC-Type:%20x" in urls and None in urls and "" in urls


def test_empty(spark):
    got = W.archived(frame(spark, []))
    assert got.collect() == [] and got.columns == [c.split()[0] for c in W.RECORD.split(", ")]


def test_whole_table_in_any_ranges(spark):
    pages = table(spark, SMALL, "pages")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    folder = tempfile.mkdtemp() + "/warc"
    W.write(pages.unionByName(pages.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 10000)), folder)
    rows += [(p + 10000, u, h) for p, u, h in rows if p % 3 == 0]
    results = [digest_rows(W.records(spark, folder, n, payloads=False).where("record_type <> 'warcinfo'")) for n in (777, 20_000, 1 << 26)]
    assert results[0] == results[1] == results[2] == expected(rows)


def test_standard_gzip_reads_it(spark):
    folder = tempfile.mkdtemp() + "/warc"
    W.write(frame(spark, ODD), folder)
    text = b"".join(gzip.open(f).read() for f in glob.glob(folder + "/part-*"))
    assert text.count(b"WARC-Type: response") + text.count(b"WARC-Type: revisit\r\n") == len(ODD)


def member(page, payload, level=6):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = W.base32(hashlib.sha1(payload).hexdigest())
    data = W.record([("WARC-Type", "response"), ("WARC-Payload-Digest", "sha1:" + digest), ("Page-Id", page),
                     ("Content-Type", "application/http; msgtype=response")], http + payload)
    if level:
        return data
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(gzip.decompress(data)) + packer.flush()


def archive(data):
    folder = tempfile.mkdtemp()
    with open(folder + "/a.warc.gz", "wb") as f:
        f.write(data)
    return folder


def test_archive_inside_a_payload(spark):
    """A payload that is an archive, stored uncompressed: its records are not the file's."""
    inner = b"".join(member(100 + k, b"inner %d" % k) for k in range(20))
    data = member(1, b"first") + member(2, inner, level=0) + member(3, b"last")
    assert inner in data
    for step in (50, 300, 1000, 1 << 20):
        got = W.records(spark, archive(data), step)
        assert sorted(r.page_id for r in got.collect()) == [1, 2, 3]


def test_damage_costs_one_record(spark):
    parts = [member(k, random.Random(k).randbytes(300)) for k in range(6)]
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 255
    data = b"".join([*parts[:2], bytes(broken), b"\x1f\x8b\x08 junk", *parts[3:5], parts[5][:-3]])
    for step in (40, 1 << 20):
        assert sorted(r.page_id for r in W.records(spark, archive(data), step).collect()) == [0, 1, 3, 4]


def test_magic_across_ranges():
    import pyarrow as pa
    data = b"".join(member(k, b"x" * k) for k in range(40))
    for step in (1, 2, 3, 7, 129):
        with pa.BufferReader(data) as source:
            found = [r["page_id"] for s in range(0, len(data), step) for r in W.owned(source, s, min(s + step, len(data)))]
        assert found == list(range(40))


def test_long_record(spark):
    rows = [(1, "u", "word " * 3_600_000), (2, "u", "short"), (3, "v", "word " * 3_600_000)]
    assert W.ended(b"ab\x01")[:3] == b"ab\x01" and gzip.decompress(W.ended(W.gzipped(b"q")) + b"\0") == b"q"
    assert digest_rows(W.archived(frame(spark, rows), range_bytes=5000)) == expected(rows)


def test_query(spark):
    pages = table(spark, SMALL, "pages").select("page_id", "url", "html").collect()
    assert digest_rows(QUERIES["op11_warc"](spark, SMALL)) == expected([tuple(r) for r in pages])


def test_query_equals_sql(spark, duck):
    from sentimart.llm.oracle import ORACLE_SQL
    got = sorted((tuple(r) for r in QUERIES["op11_warc"](spark, SMALL).collect()), key=str)
    assert got == sorted(duck.execute(ORACLE_SQL["op11_warc"]).fetchall(), key=str)
