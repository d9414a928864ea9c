"""Web archives: written with an index, read back through it by few long ranges.

Each task writes its records into files of its own below a shared folder, one gzip member per record, and hands back
an index row for each: file, offset, length, URL and digest. The files of a lost task stay unnamed by the index, so
a retry needs no clean-up. Reading starts from index rows: those wanted are sorted by place, neighbours are joined to
one range as long as the gap between them costs less than another request, and only these ranges are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from orderloom.session import materialize, scratch_path

# Payloads below this size are kept as they are, as a reference to another record would hardly be shorter.
REVISIT_BYTES = 100
FILE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
# Bytes of records that one task reads.
TASK_BYTES = 16 << 20
_ROWS = 512
_PRINTABLE = "".join(map(chr, range(33, 127)))
_INDEX = ("file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, "
          "record_type string, refers_to bigint")
_RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, "
           "payload binary")


def _file_system(uri: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, digest: str, payload: bytes | None, refers_to: int | None,
           date: str) -> bytes:
    """One WARC 1.1 record as a gzip member. ``payload`` None makes a revisit, which has no body."""
    kind = "revisit" if payload is None else "response"
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(),
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>".encode(),
            f"WARC-Date: {date}".encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + quote(url, safe=_PRINTABLE).encode())
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}".encode())
    head.append(f"WARC-Payload-Digest: sha256:{digest}".encode())
    if payload is None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}:{digest}')}>".encode(),
                 f"X-Refers-To-Page-ID: {refers_to}".encode()]
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                 + str(len(payload)).encode() + b"\r\n\r\n" + payload)
    head += [b"Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}".encode()]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields of a record, and its payload."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b": ")
        fields[name.decode().lower()] = value.decode()
    block = rest[:int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _whole(value: str | None) -> int | None:
    return None if value is None else int(value)


def write_archives(pages: DataFrame, root: str | None = None, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and return the index, itself a written table.

    The payload is the html in UTF-8, empty for null. Of records with equal payloads of 100 bytes or more, the one
    with the smallest page_id holds the payload and the others refer to it; rows that repeat the smallest page_id
    hold it as well, and rows without a page_id refer to the smallest there is, or hold it if there is none. A null
    url leaves the record without one; characters that a header cannot hold are percent-encoded in the record and
    kept as they are in the index. An empty table gives an empty index; other columns are not looked at.
    """
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = materialize(
        rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("same"), "first"), "warc-firsts")
    later = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    rows = rows.join(firsts, F.col("digest") == F.col("same"), "left").select(
        "page_id", "url", "digest", F.when(later, F.col("first")).alias("refers"),
        F.when(~F.coalesce(later, F.lit(False)), F.col("payload")).alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _file_system(root)
        fs.create_dir(folder, recursive=True)
        part, out, name, at = TaskContext.get().partitionId(), None, None, 0
        try:
            for batch in batches:
                index = []
                for i in range(batch.num_rows):
                    page_id, url, digest, refers, body = (c[i].as_py() for c in batch.columns)
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    member = record(page_id, url, digest, body, refers, date)
                    out.write(member)
                    index.append((f"{root}/{name}", at, len(member), page_id, url, digest,
                                  "response" if body is not None else "revisit", refers))
                    at += len(member)
                if index:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*index), _INDEX_TYPES)], _INDEX_NAMES)
        finally:
            if out is not None:
                out.close()
    return materialize(rows.mapInArrow(write, _INDEX), "warc-index")


_INDEX_NAMES = [part.split()[0] for part in _INDEX.split(", ")]
_INDEX_TYPES = [pa.string() if part.endswith("string") else pa.int64() for part in _INDEX.split(", ")]


def ranges(index: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The byte ranges that cover the wanted index rows: file, start, end and the places of the records inside.

    Records less than ``gap`` bytes apart share a range, which is ended after about ``most`` bytes.
    """
    by_place = Window.partitionBy("file").orderBy("offset")
    before = F.lag(F.struct("offset", (F.col("offset") + F.col("length")).alias("end"))).over(by_place)
    cut = before.isNull() | (F.col("offset") - before["end"] > gap) | (
        F.floor(F.col("offset") / most) != F.floor(before["offset"] / most))
    marked = index.select("file", "offset", "length", cut.cast("int").alias("cut"))
    numbered = marked.withColumn("range", F.sum("cut").over(by_place))
    return numbered.groupBy("file", "range").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("places")).drop("range")


def read_records(index: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records at the rows of ``index``, which may be any part of it. A revisit has no payload of its own."""
    names, kinds = [p.split()[0] for p in _RECORD.split(", ")], [
        pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def batch(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ranges_ in batches:
            for wanted in ranges_.to_pylist():
                fs, path = _file_system(wanted["file"])
                with fs.open_input_file(path) as source:
                    source.seek(wanted["start"])
                    data = source.read(wanted["end"] - wanted["start"])
                found = []
                for place in wanted["places"]:
                    first = place["offset"] - wanted["start"]
                    fields, payload = parse(data[first:first + place["length"]])
                    kind = fields["warc-type"]
                    found.append((
                        _whole(fields.get("x-page-id")), fields.get("warc-target-uri"), kind,
                        _whole(fields.get("x-refers-to-page-id")),
                        fields["warc-payload-digest"].removeprefix("sha256:"),
                        payload if kind == "response" else None))
                    if len(found) >= _ROWS:
                        yield batch(found)
                        found = []
                if found:
                    yield batch(found)
    # Ranges are dealt out by the bytes to be read, not by those of the index.
    wanted = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    return ranges(index, gap, most).repartition(max(1, -(-wanted // TASK_BYTES)), "file", "start").mapInArrow(
        read, _RECORD)


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write all pages, read them back, and describe each record; the size of a revisit is that of its payload."""
    records = read_records(write_archives(pages)).select(
        "page_id", "record_type", "refers_to", F.octet_length("payload").cast("bigint").alias("own_bytes"),
        F.coalesce(F.sha2("payload", 256), F.col("payload_digest")).alias("payload_digest"))
    records = materialize(records, "warc-records")
    held = records.where("record_type = 'response'").groupBy("page_id", "payload_digest").agg(
        F.max("own_bytes").alias("held_bytes")).select(
            F.col("page_id").alias("held_id"), F.col("payload_digest").alias("held_digest"), "held_bytes")
    own = records.where("record_type = 'response'").select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    referred = records.where("record_type = 'revisit'").join(
        held, (F.col("refers_to") == F.col("held_id")) & (F.col("payload_digest") == F.col("held_digest"))).select(
            "page_id", F.col("held_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return own.unionByName(referred)


ORACLE = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
firsts AS (SELECT body, min(page_id) AS first FROM payloads WHERE strlen(body) >= 100 GROUP BY body)
SELECT page_id, strlen(p.body)::BIGINT AS payload_bytes, sha256(p.body) AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON f.body = p.body
"""
