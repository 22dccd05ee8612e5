"""Operator 11: content-addressed WARC archive.

A page becomes a WARC record: a response, or a revisit of the response that
already holds the same payload.  The archive is two tables in the shared folder:
``payloads`` has every different payload once, under its SHA-256 address, and
``headers`` the exact header bytes of every record with the address of its
payload.  Joining them on the address gives the original records back, byte by
byte; what is read is verified against its address and against the digest and
the lengths that the record's own headers state.

Writing is verified too: payloads are grouped by address *and* bytes, so equal
ones meet byte by byte (combined before the shuffle) and two payloads that
shared an address would raise.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlens.llm.common import read_back, write_table
from tutorlens.session import shared_folder

#: Line end of WARC and HTTP headers, end of a record, and the profile of revisits by payload digest.
CRLF, RECORD_END = "\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: WARC-Date of records made from tables that hold no capture time.
CAPTURED = "1970-01-01T00:00:00Z"
#: Bytes of records after which an exported file is closed.
FILE_BYTES = 64 << 20

PAYLOADS = "address binary, payload_bytes long, payload_digest string, payload binary, response_id long"
HEADERS = "page_id long, address binary, warc_header binary, http_header binary"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column (160 bits: 32 digits, no padding)."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # those of base 32 in Spark's conv
    groups = [F.lpad(F.conv(F.substring(F.sha1(payload), 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), digits, BASE32)


def record_id(page_id: Column) -> Column:
    """The URI of a page's record; a page without id has the bare prefix."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, address: null html is empty; line ends in a url are escaped, as a header line has none."""
    url = F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    )
    return rows.withColumn("address", F.unhex(F.sha2("payload", 256)))


def write_payloads(rows: DataFrame, folder: str) -> DataFrame:
    """Store each different payload of ``rows`` (page_id, payload, address) once; returns the stored table.

    The address and the bytes are the grouping key, so copies combine before
    the shuffle whatever their number, and equality is that of the bytes.
    """
    once = rows.groupBy("address", "payload").agg(F.min("page_id").alias("response_id"))
    once = once.select(
        "address", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), "payload", "response_id"
    )
    write_table(once, f"{folder}/payloads", compression="zstd")
    stored = read_back(rows.sparkSession, f"{folder}/payloads", PAYLOADS)
    twice = stored.groupBy("address").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two payloads share the address {twice[0]['address'].hex()}")
    return stored


def _lines(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; one whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value.cast("string"), F.lit(CRLF)) for name, value in pairs]
    return F.concat_ws("", *lines)


def record_headers(rows: DataFrame, stored: DataFrame, min_bytes: int = 0, captured: str = CAPTURED) -> DataFrame:
    """page_id, address, warc_header, http_header of the record of each row (page_id, url, address).

    ``stored`` tells each address's digest, size and the smallest page_id that
    has it.  Payloads of fewer than ``min_bytes`` are never revisited.  Both
    sides of the join are plain exchanges of narrow rows, so that the rows of a
    payload with a great share of all pages can be split.
    """
    facts = stored.select("address", "payload_bytes", "payload_digest", "response_id")
    both = rows.select("page_id", "url", "address").join(facts, "address")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"),
        _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("payload_bytes"))),
        F.lit(CRLF),
    )
    both = both.withColumn("revisit", revisit).withColumn("http", http)
    only = lambda value: F.when(F.col("revisit"), value)
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _lines(
            ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            ("WARC-Record-ID", record_id(F.col("page_id"))),
            ("WARC-Date", captured),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("WARC-Refers-To", only(record_id(F.col("response_id")))),
            ("WARC-Profile", only(F.lit(PROFILE))),
            ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("payload_bytes"))),
        ),
        F.lit(CRLF),
    )
    return both.select("page_id", "address", warc.cast("binary").alias("warc_header"), F.col("http").cast("binary").alias("http_header"))


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, captured: str = CAPTURED) -> str:
    """Write the pages' records to a content-addressed archive; returns its folder.

    Of records with equal payloads of at least ``min_bytes``, that with the
    smallest page_id is the response, the others revisit it.  Rows that repeat
    page_id and payload are the same record and share its type; where no page of
    a payload has an id, all are responses, and a page without id revisits one
    with it.  An empty table gives an empty archive; extra columns are not read.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/llm/warc-{uuid.uuid4().hex}"
    rows = _pages(pages)
    stored = write_payloads(rows.drop("url"), folder)
    write_table(record_headers(rows, stored, min_bytes, captured), f"{folder}/headers", compression="zstd")
    return folder


def restore(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, warc_header, http_header, payload, payload_digest, of every record of an archive.

    The payload is the full one, of revisits too.  A payload that does not have
    its address as SHA-256, or a record whose headers state another digest or
    length, raises.  The record's bytes are given by ``record_bytes``.
    """
    payloads = read_back(spark, f"{folder}/payloads", PAYLOADS).select("address", "payload", "payload_bytes")
    sound = F.unhex(F.sha2("payload", 256)) == F.col("address")
    payloads = payloads.select("address", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not have its address as digest"))).alias("payload"))
    payloads = payloads.withColumn("payload_digest", base32_sha1(F.col("payload")))
    rows = read_back(spark, f"{folder}/headers", HEADERS).join(payloads, "address")
    stated = header_field(F.col("warc_header"), "WARC-Payload-Digest")
    length = header_field(F.col("warc_header"), "Content-Length").cast("long")
    real = F.octet_length("http_header") + F.when(record_type() == "revisit", F.lit(0)).otherwise(F.octet_length("payload"))
    good = (stated == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (length == real)
    return rows.select(
        "page_id", F.when(good, F.col("warc_header")).otherwise(F.raise_error(F.lit("a record's headers do not fit its payload"))).alias("warc_header"),
        "http_header", "payload", "payload_digest",
    )


def header_field(header: Column, name: str) -> Column:
    """The value of a header line, null where there is none."""
    found = F.regexp_extract(header.cast("string"), rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def record_type() -> Column:
    return header_field(F.col("warc_header"), "WARC-Type")


def record_bytes() -> Column:
    """The whole record, as it stands in a WARC file: a revisit holds no payload."""
    body = F.when(record_type() == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat("warc_header", "http_header", body, F.lit(RECORD_END))


def record_facts(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from restored records."""
    target = F.regexp_extract(header_field(F.col("warc_header"), "WARC-Refers-To"), r"^<urn:x-page:(-?\d+)>$", 1)
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest",
        record_type().alias("record_type"),
        F.when(target != "", target.cast("long")).alias("refers_to"),
    )


def export_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write restored records as WARC files of about ``file_bytes``, one record's size more at most."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            # the sink itself ends each row with the end of a record
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[: -len(RECORD_END)]], pa.binary())], ["file"])

        for batch in batches:
            for record in batch.column(0):
                record = record.as_py()
                held.append(record)
                size += len(record)
                if size >= file_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    files = records.select(record_bytes().alias("record")).mapInArrow(chunks, "file binary")
    files = files.select(F.col("file").cast("string").alias("value"))
    files.write.option("lineSep", RECORD_END.decode()).option("maxRecordsPerFile", 1).text(path)


def split_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(WARC header, block) of each record of a WARC file, by the stated lengths."""
    at = 0
    while at < len(data):
        end = data.index(RECORD_END, at) + len(RECORD_END)
        header = data[at:end]
        if not header.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        size = next(int(line.split(b":", 1)[1]) for line in header.split(b"\r\n") if line.lower().startswith(b"content-length:"))
        if data[end + size : end + size + len(RECORD_END)] != RECORD_END:
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield header, data[end : end + size]
        at = end + size + len(RECORD_END)


def import_warc(spark: SparkSession, path: str, folder: str | None = None) -> str:
    """Store the records of WARC files (as ``export_warc`` writes them) in a new archive; returns its folder.

    Each file is one row of a task, so files should stay small (``FILE_BYTES``).
    A revisit's address is that of the response with the same payload digest,
    among the files; one without it raises.
    """
    folder = folder or f"{shared_folder(spark)}/llm/warc-{uuid.uuid4().hex}"

    def parse(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for header, block in split_records(data.as_py()):
                    end = block.index(RECORD_END) + len(RECORD_END)
                    rows.append((header, block[:end], block[end:]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], ["warc_header", "http_header", "payload"])

    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(parse, "warc_header binary, http_header binary, payload binary")
    uri = F.regexp_extract(header_field(F.col("warc_header"), "WARC-Record-ID"), r"^<urn:x-page:(-?\d+)>$", 1)
    found = found.withColumn("page_id", F.when(uri != "", uri.cast("long"))).withColumn("digest", header_field(F.col("warc_header"), "WARC-Payload-Digest"))
    responses = found.where(record_type() == "response").withColumn("address", F.unhex(F.sha2("payload", 256)))
    stored = write_payloads(responses.select("page_id", "payload", "address"), folder)
    known = stored.select("address", F.concat(F.lit("sha1:"), F.col("payload_digest")).alias("digest"))
    headers = found.select("page_id", "warc_header", "http_header", "digest").join(known, "digest", "left")
    address = F.coalesce("address", F.raise_error(F.lit("a record revisits a payload that no file holds")).cast("binary"))
    write_table(headers.select("page_id", address.alias("address"), "warc_header", "http_header"), f"{folder}/headers", compression="zstd")
    return folder
