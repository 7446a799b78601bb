"""Conversion of legacy ARC archives to WARC, with revisit records for repeated payloads."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import forget_on_exit, table
from orderflow.sources import scratch

#: The fields of an ARC record's header line, by version of the format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed value: the profile of a revisit whose payload equals that of another record.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Records of an archive file that ``write_arc`` makes, and the least payload that may become a revisit.
FILE_RECORDS, REVISIT_BYTES = 2000, 1000
#: Bytes of records that a reader hands on at once, or one record.
BATCH_BYTES = 8 << 20
PAGE_HEADER = "X-Page-Id"

_ARC = pa.schema([("archive", pa.string()), ("position", pa.int64()), ("version", pa.int32()), ("url", pa.string()),
                  ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("head", pa.binary()),
                  ("payload", pa.binary())])
_WARC = pa.schema([("kind", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
                   ("digest", pa.string()), ("head", pa.binary()), ("payload", pa.binary())])
_ARC_DDL = ("archive string, position long, version int, url string, ip string, date string, mime string, "
            "head binary, payload binary")
_WARC_DDL = "kind string, record_id string, refers_to_id string, digest string, head binary, payload binary"


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> None:
    """Writes ``pages`` (page_id, url, html) as gzipped ARC files, by turns of version 1 and 2.

    A null html is an empty payload, a null url a ``urn:``; blanks in a url are escaped, as they part the
    fields of a header line. Every file begins with its version block, which the file's first row carries.
    """
    empty, end = F.lit(""), F.lit("\r\n")
    at = F.monotonically_increasing_id()
    starts = {}
    for version, fields in FIELDS.items():
        body = f"{version} 0 own\n{fields}\n\n"
        between = "" if version == 1 else "200 - - 0 part.arc "
        starts[version] = F.lit(f"filedesc://part.arc 0.0.0.0 {date} text/plain {between}{len(body)}\n{body}\n")
    rows = pages.select(
        F.coalesce("html", empty).alias("html"), F.coalesce(F.col("page_id").cast("string"), empty).alias("page"), "url",
        at.bitwiseAND((1 << 33) - 1).alias("row"), F.shiftright(at, 33).alias("part"))
    page_line = F.when(F.col("page") == "", empty).otherwise(F.concat(F.lit(f"{PAGE_HEADER}: "), "page", end))
    length = F.octet_length("html").cast("string")
    rows = rows.select(
        F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), "page")), r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), page_line,
                 F.lit("Content-Length: "), length, end, end, "html").alias("block"),
        (F.col("row") % FILE_RECORDS == 0).alias("opens"),
        ((F.floor(F.col("row") / FILE_RECORDS) + F.col("part")) % 2 + 1).alias("version"))
    first = F.col("version") == 1
    opening = F.when(~F.col("opens"), empty).when(first, starts[1]).otherwise(starts[2])
    between = F.when(first, F.lit(" ")).otherwise(F.lit(" 200 - - 0 part.arc "))
    (rows.select(F.concat(opening, "url", F.lit(f" 0.0.0.0 {date} text/html"), between,
                          F.octet_length("block").cast("string"), F.lit("\n"), "block").alias("value"))
     .write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _opened(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _split(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP header of a block, with its empty line, and the payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, mark, payload = block.partition(b"\r\n\r\n")
    return head + mark, payload


def _line(stream) -> bytes:
    """The next line that isn't empty, or nothing at the end."""
    while line := stream.readline():
        if line.strip():
            return line.rstrip(b"\r\n")
    return b""


def _exactly(stream, length: int, where: str) -> bytes:
    data = stream.read(length)
    if len(data) != length:
        raise ValueError(f"{where}: {length} bytes are declared, {len(data)} are there")
    return data


def arc_records(name: str, content: bytes) -> Iterator[tuple]:
    """Records of one archive. The version block says which fields the header lines have; lengths are declared."""
    stream, version = _opened(content), 1
    while True:
        line = _line(stream)
        if not line:
            return
        position, where = stream.tell(), f"{name} at {stream.tell()}"
        width = 5 if line.startswith(b"filedesc:") else len(FIELDS[version].split())
        fields = line.decode("utf-8", "replace").rsplit(" ", width - 1)
        if len(fields) < width or not fields[-1].isdigit():
            raise ValueError(f"{where}: no header line of version {version}")
        block = _exactly(stream, int(fields[-1]), where)
        if line.startswith(b"filedesc:"):
            version = int(block.split(b" ", 1)[0])
            fields = line.decode("utf-8", "replace").split(" ")
        head, payload = _split(block)
        yield name, position, version, *fields[:4], head, payload


def warc_records(content: bytes) -> Iterator[tuple]:
    """Records of one WARC file, by their declared lengths."""
    stream = _opened(content)
    while True:
        line = _line(stream)
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {stream.tell()}")
        named = {}
        while line := stream.readline().rstrip(b"\r\n"):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            named[key.strip().lower()] = value.strip()
        head, payload = _split(_exactly(stream, int(named["content-length"]), str(stream.tell())))
        yield (named.get("warc-type"), named.get("warc-record-id"), named.get("warc-refers-to"),
               named.get("warc-payload-digest"), head, payload)


def _read(spark: SparkSession, path: str, parse, schema: pa.Schema, ddl: str) -> DataFrame:
    def rows(batches):
        held, size = [], 0
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                for record in parse(name.as_py(), content.as_py()):
                    held.append(record)
                    size += len(record[-1])
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(rows, ddl)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files under ``path``, gzipped or not; the unit of work is a file.

    An empty file or folder has no records. A header line that doesn't fit the file's version, or a file that
    ends before a declared length, raises an error that names the place, so no record is lost in silence.
    """
    return _read(spark, path, arc_records, _ARC, _ARC_DDL)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``; errors as for ``read_arc``."""
    return _read(spark, path, lambda _, content: warc_records(content), _WARC, _WARC_DDL)


def header(name: str) -> Column:
    """A field of the HTTP header, or null."""
    found = F.regexp_extract(F.col("head").cast("string"), rf"(?i)\r\n{name}:\s*([^\r\n]*)", 1)
    return F.when(found != "", found)


def convert(records: DataFrame, rank: Column | None = None) -> DataFrame:
    """ARC records to WARC records: ``value`` is the record as text, beside kind and identifiers.

    - Type: ``filedesc:`` gives warcinfo, an HTTP block a response, anything else a resource.
    - WARC-Record-ID comes from archive, position, url, date and digest, so a repeated run gives the same.
    - WARC-Date comes from 8 to 14 digits; a date that is neither is the epoch's first second.
    - Of responses with equal payloads of ``REVISIT_BYTES`` or more, the one with the largest ``rank`` (by default
      the place in the archives) stays a response; others become revisits that refer to it and keep only the
      HTTP header. Equal means equal SHA-1 and length. Only digests are grouped, never payloads.
    """
    empty, end = F.lit(""), F.lit("\r\n")
    rank = F.struct(rank if rank is not None else F.lit(0), "archive", "position")
    digest = F.sha1("payload")
    tag = F.sha1(F.concat_ws("|", "archive", F.col("position").cast("string"), "url", "date", "digest"))
    uuid = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.substring(tag, 1, 32), "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-5$3-8$4-$5"), F.lit(">"))
    kind = (F.when(F.col("url").startswith("filedesc:"), F.lit("warcinfo"))
            .when(F.col("head").cast("string").startswith("HTTP/"), F.lit("response")).otherwise(F.lit("resource")))
    rows = (records.withColumn("digest", digest).withColumn("bytes", F.octet_length("payload"))
            .withColumn("kind", kind).withColumn("rank", rank).withColumn("record_id", uuid))
    groups = (rows.where((F.col("kind") == "response") & (F.col("bytes") >= REVISIT_BYTES))
              .groupBy("digest", "bytes").agg(F.max(F.struct("rank", "record_id")).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "bytes", F.col("first.record_id").alias("refers_to_id"), F.lit("response").alias("kind")))
    rows = (rows.join(groups, ["digest", "bytes", "kind"], "left")
            .withColumn("refers_to_id", F.when(F.col("refers_to_id") != F.col("record_id"), F.col("refers_to_id")))
            .withColumn("kind", F.when(F.col("refers_to_id").isNotNull(), F.lit("revisit")).otherwise(F.col("kind"))))
    d = F.rpad(F.when(F.col("date").rlike(r"^\d{8,14}$"), F.col("date")).otherwise(F.lit("19700101")), 14, "0")
    stamp = F.regexp_replace(d, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    revisit = F.col("kind") == "revisit"
    block = F.when(revisit, F.col("head").cast("string")).otherwise(
        F.concat(F.col("head").cast("string"), F.col("payload").cast("string")))
    mime = F.when(F.col("kind").isin("response", "revisit"), F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))

    def line(name: str, value: Column, where: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, end)
        return text if where is None else F.when(where, text).otherwise(empty)

    return (rows.withColumn("block", block).select("kind", "record_id", "refers_to_id", F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.col("kind")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", stamp), line("WARC-Target-URI", F.col("url"), F.col("kind") != "warcinfo"),
        line("WARC-IP-Address", F.col("ip"), F.col("kind").isin("response", "revisit")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Profile", F.lit(PROFILE), revisit), line("WARC-Refers-To", F.coalesce("refers_to_id", empty), revisit),
        line("Content-Type", mime), line("Content-Length", F.octet_length("block").cast("string")), end,
        "block").alias("value")))


def write_warc(records: DataFrame, path: str) -> None:
    """Writes converted records as gzipped WARC files; the line separator is the mark that ends a record."""
    (records.select("value").write.option("compression", "gzip").option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def op1_arc_to_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as legacy archives, those as WARC, and what the WARC files say of each page."""
    old, new = scratch.new_folder(spark, "arc"), scratch.new_folder(spark, "warc")
    for path in (old, new):
        forget_on_exit(spark, path)
    write_arc(table(spark, folder, "pages"), old)
    write_warc(convert(read_arc(spark, old), header(PAGE_HEADER).cast("long")), new)
    rows = (read_warc(spark, new).where(F.col("kind").isin("response", "revisit"))
            .withColumn("page_id", header(PAGE_HEADER).cast("long")))
    revisit = F.col("kind") == "revisit"
    rows = rows.select(
        "page_id", F.when(revisit, header("Content-Length").cast("long")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha1:", "")).otherwise(F.sha1("payload")).alias("payload_digest"),
        F.col("kind").alias("record_type"), "record_id", "refers_to_id")
    targets = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    pointing = rows.where("record_type = 'revisit'").join(targets, "refers_to_id", "left")
    own = rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.select(columns).unionByName(pointing.select(columns))


OP1_SQL = """
with payloads as (select page_id, coalesce(html, '') as html from pages),
sized as (
  select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest,
         max(page_id) over (partition by html) as first
  from payloads)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> first then first end as refers_to
from sized
"""
