"""WARC archives: one gzip member a record, read back by byte ranges.

Writing. Of the pages with one payload (the html in UTF-8; null: empty) of at
least ``least_bytes`` bytes, the one of the largest page_id (then url) is the
response record, the others are revisit records that refer to it and carry no
payload; smaller payloads are all responses. Heads of shared payloads are found
by a grouped maximum over narrow rows; texts meet no group. Records are
compressed in the tasks and written by Spark's text sink, so its commit
protocol covers lost executors and any store Spark writes to: the zero byte
that ends a gzip member (of a record under 16 MiB; a larger one is followed by
an empty member) stands where the sink puts its line separator.

Reading. Files are listed by Spark and cut into byte ranges; a task reads its
range, looks for the gzip magic, inflates a candidate and takes it for a record
only if its head is a WARC head whose lengths and whose CRC hold. It owns the
records that start in its range and reads past its end to finish the last one.
A range that begins inside a record whose payload holds a whole archive, stored
as it is, finds that archive's records first; those lie before the end of a
record of an earlier range of the file, and go by that. Payloads are whole.

Tasks read ranges through ``pyarrow.fs``, so archives may lie in any store it
opens (a shared mount; HDFS with its client library).

Defined results: a null page_id or url has no field and reads back as null (a
null page_id ranks below all); control characters and spaces of a url read back
percent-encoded; rows repeated as a whole give one response and revisits; an
empty table gives no archive and no record; other columns are ignored; a
damaged record is passed over, those after it are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentimart.llm.common import shared_folder, text_of, written

DATE = "2000-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
#: Read beyond a range at once, to finish its last record.
AHEAD = 1 << 16
#: From this size on the last byte of a gzip member may be other than zero.
LONG = 1 << 24
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PLAN = "page_id long, url string, payload binary, digest string, size long, record_type string, head_page long, head_url string, at long"
RECORD = ("file string, offset long, stop long, record_type string, record_id string, refers_to_id string, url string, date string, "
          "page_id long, refers_to long, payload_bytes long, payload_digest string, intact boolean")


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_id(*what) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(what).encode()).digest())}>"


def gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record's gzip member; fields of None are left out."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return gzipped(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n")


def escaped(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f-\x9f]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), url)


def page_record(row: dict, date: str) -> bytes:
    """The response or revisit record of a planned row."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    response = row["record_type"] == "response"
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(row["page_id"], row["url"], row["digest"], row["at"])),
              ("WARC-Date", date), ("WARC-Target-URI", escaped(row["url"])), ("WARC-Payload-Digest", "sha1:" + base32(row["digest"])),
              ("Content-Type", "application/http;msgtype=response"), ("Page-Id", row["page_id"])]
    if not response:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(row["head_page"], row["head_url"], row["digest"], None)),
                   ("WARC-Refers-To-Target-URI", escaped(row["head_url"])), ("Refers-To-Page-Id", row["head_page"])]
    return record(fields, http + (row["payload"] if response else b""))


# --- writing ------------------------------------------------------------------------

def planned(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """What to write for each row of ``pages(page_id, url, html)``: columns PLAN; ``at`` tells rows apart that no other refers to."""
    raw = text_of("html").cast("binary")
    rows = pages.select("page_id", "url", raw.alias("payload"), F.sha1(raw).alias("digest"), F.octet_length(raw).cast("long").alias("size"))
    copies = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size", "page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    heads = copies.groupBy("digest", "size").agg(F.max(F.struct("page_id", "url", "copies")).alias("head"), F.sum("copies").alias("n"))
    heads = written(heads.where("n > 1").selectExpr("digest", "size", "head.page_id AS head_page", "head.url AS head_url", "head.copies AS copies"))
    marked = rows.join(heads, ["digest", "size"], "left").withColumn(
        "is_head", F.expr("copies is not null and page_id <=> head_page and url <=> head_url"))
    kind = F.when(F.col("copies").isNull() | F.col("is_head"), "response").otherwise("revisit")
    out = marked.where("not is_head or copies = 1").withColumn("record_type", kind)
    columns = [c.split()[0] for c in PLAN.split(", ")]
    out = out.withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload"))).withColumn(
        "at", F.when(~F.coalesce("is_head", F.lit(False)), F.monotonically_increasing_id())).select(*columns)
    if heads.where("copies > 1").isEmpty():
        return out
    # A head that is repeated as a whole row: its copies meet as one response, the rest revisit it.
    same = ["digest", "size", "page_id", "url"]
    one = marked.where("is_head and copies > 1").groupBy(*same).agg(F.max("payload").alias("payload")).selectExpr(
        "*", "'response' AS record_type", "page_id AS head_page", "url AS head_url", "cast(null AS bigint) AS at")
    rest = heads.where("copies > 1").selectExpr(
        "digest", "size", "head_page AS page_id", "head_url AS url", "cast(null AS binary) AS payload", "'revisit' AS record_type",
        "head_page", "head_url", "explode(sequence(-copies + 1, -1L)) AS at")
    return out.unionByName(one.select(*columns)).unionByName(rest.select(*columns))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Archives of ``pages(page_id, url, html)`` in ``folder``, one file a task."""
    software = b"software: sentimart\r\nformat: WARC File Format 1.1\r\n"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pylist()
                members = [page_record(row, date) for row in rows]
                if not opened:
                    members.insert(0, record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", rows[0]["digest"], rows[0]["at"])),
                                              ("WARC-Date", date), ("Content-Type", "application/warc-fields")], software))
                    opened = True
                yield pa.RecordBatch.from_arrays([pa.array([ended(m) for m in members], pa.binary())], ["member"])

    packed = planned(pages, least_bytes).mapInArrow(pack, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)


def ended(member: bytes) -> bytes:
    """A member without its last byte, a zero; behind an empty member if its own is none."""
    return (member if member.endswith(b"\0") else member + gzipped(b""))[:-1]


# --- reading ------------------------------------------------------------------------

def inflated(source: pa.NativeFile, data: bytes, at: int, base: int) -> tuple[bytes, int] | None:
    """The member at ``data[at:]`` and where it ends in the file; None if none is there."""
    try:
        if not zlib.decompressobj(31).decompress(data[at:at + 1024]).startswith(b"WARC/"):
            return None
        unpacker, parts, stop, view = zlib.decompressobj(31), [], at, memoryview(data)
        while not unpacker.eof:
            piece = bytes(view[stop:stop + (1 << 20)]) if stop < len(data) else source.read_at(1 << 20, base + stop)
            if not piece:
                return None
            parts.append(unpacker.decompress(piece))
            stop += len(piece)
        return b"".join(parts), base + stop - len(unpacker.unused_data)
    except zlib.error:
        return None


def fields_of(head: bytes) -> dict[str, str]:
    """Fields of a WARC or HTTP head, names in lower case; folded lines join."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parsed(data: bytes) -> dict | None:
    """A record's columns, ``payload`` included; None if its head or length is none of a record."""
    head, found, block = data.partition(b"\r\n\r\n")
    fields = fields_of(head)
    if not found or not head.startswith(b"WARC/") or not fields.get("content-length", "").isdigit():
        return None
    length = int(fields["content-length"])
    if len(block) != length + 4 or not block.endswith(b"\r\n\r\n"):
        return None
    payload, named, size = block[:-4], fields.get("warc-payload-digest"), None
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        http, _, payload = payload.partition(b"\r\n\r\n")
        size = fields_of(http).get("content-length")
    kind = fields.get("warc-type")
    digest = base32(hashlib.sha1(payload).hexdigest())
    if kind == "revisit":
        intact, digest, payload = None, named.split(":")[-1].upper() if named else None, None
        size = int(size) if size and size.isdigit() else None
    else:
        intact, size = None if named is None or not named.lower().startswith("sha1:") else named[5:].upper() == digest, len(payload)
    number = {k: int(v) if (v := fields.get(k)) is not None and re.fullmatch(r"-?\d+", v) else None for k in ("page-id", "refers-to-page-id")}
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "refers_to_id": fields.get("warc-refers-to"),
            "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "page_id": number["page-id"],
            "refers_to": number["refers-to-page-id"], "payload_bytes": size, "payload_digest": digest, "intact": intact, "payload": payload}


def owned(source: pa.NativeFile, start: int, end: int) -> Iterator[dict]:
    """The records that start in bytes ``start`` to ``end`` of an archive."""
    data, at = source.read_at(end - start + AHEAD, start), 0
    while 0 <= (at := data.find(MAGIC, at)) < end - start:
        member = inflated(source, data, at, start)
        found = parsed(member[0]) if member else None
        if found is None:
            at += 1
            continue
        yield {"offset": start + at, "stop": member[1], **found}
        at = member[1] - start


def opened(path: str) -> pa.NativeFile:
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def ranges(spark: SparkSession, folder: str, range_bytes: int) -> DataFrame:
    """``(file, start, end)``: the archives under ``folder`` cut into byte ranges, spread evenly over tasks."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .where("length > 0").selectExpr("path AS file", "length"))
    cut = files.selectExpr("file", "length", f"explode(sequence(0L, length - 1, {range_bytes}L)) AS start").selectExpr(
        "file", "start", f"least(start + {range_bytes}L, length) AS end")
    return cut.repartition(max(cut.count(), 1))


def records(spark: SparkSession, folder: str, range_bytes: int | None = None, payloads: bool = True) -> DataFrame:
    """The records of the archives under ``folder``: columns RECORD and, if ``payloads``, ``payload``.

    ``range_bytes``: what a task reads; by default the session's split size.
    """
    step = range_bytes or int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    schema = RECORD + (", payload binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    arrow = pa.schema([*zip(names, types, strict=True), ("range_start", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                with opened(row["file"]) as source:
                    for found in owned(source, row["start"], row["end"]):
                        rows.append({"file": row["file"], "range_start": row["start"], **found})
                        held += len(found["payload"] or b"") if payloads else 256
                        if held > 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    found = written(ranges(spark, folder, step).mapInArrow(scan, schema + ", range_start long"))
    spans = found.groupBy("file", "range_start").agg(F.min("offset").alias("first"), F.max("stop").alias("last"))
    earlier = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = spans.withColumn("reached", F.max("last").over(earlier)).where("first < reached").select("file", "range_start", "reached")
    return found.join(inside, ["file", "range_start"], "left").where("reached is null or offset >= reached").select(*names)


def archived(pages: DataFrame, least_bytes: int = 0, range_bytes: int | None = None, payloads: bool = False) -> DataFrame:
    """``pages`` written as archives in the shared folder and read back: columns of :func:`records`, page records only."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    write(pages, folder, least_bytes)
    return records(spark, folder, range_bytes, payloads).where("record_type in ('response', 'revisit')")
