"""WARC archives: a deduplicating writer and a reader that salvages what it can from damaged files.

Writing is Spark's own text writer with its commit protocol, so it works on every store Spark writes to and a lost executor
leaves nothing half written. Each record is a gzip member of its own. The writer ends every row with a separator that can not be
empty; members are made to end with a zero byte (the top byte of the stored length is zero below 16 MiB, and a longer record is
followed by an empty member, which readers skip), and that byte is the separator.

Reading goes through `binaryFile`, an archive at a time. A member or version line whose checks fail (framing, length, block
digest, checksum of the member) opens a quarantined gap; the reader then looks for the next place where a whole valid record
begins, byte by byte, and closes the gap there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, scratch_path

# Fixed values of the WARC 1.1 format and of gzip.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_VERSION_LINE = re.compile(rb"WARC/1\.\d+\r\n")

MIN_REVISIT_BYTES = 100
_ID = "<urn:x-page:{}>"
_EMPTY_MEMBER = zlib.compress(b"", wbits=31)


def gzip_member(record: bytes) -> bytes:
    """The record as a gzip member ending with a zero byte."""
    member = zlib.compress(record, 4, wbits=31)
    return member if member[-1] == 0 else member + _EMPTY_MEMBER


def one_line(value: str) -> str:
    """A header value without line breaks or blanks: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: str, url: str, date: str, payload: bytes | None, payload_bytes: int, digest: str, refers_to: str | None) -> bytes:
    """A response record with its payload, or, given `refers_to`, a revisit record with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _ID.format(one_line(page_id))), ("WARC-Date", date),
        ("WARC-Target-URI", one_line(url)), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _ID.format(one_line(refers_to)))]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, id_col: str, payload: Column) -> DataFrame:
    """`pages` with __payload, __bytes, __digest and __refers (id of the response that this row revisits, else null).

    Only digests that occur twice are looked up, and short payloads carry keys that match nothing, so that neither they nor nulls
    meet in one place. Rows that repeat the smallest id of their payload are responses too. A null id never is the smallest."""
    full = pages.withColumn("__payload", payload)
    full = full.withColumn("__bytes", F.octet_length("__payload").cast("long")).withColumn("__digest", F.sha2("__payload", 256))
    long_enough = F.col("__bytes") >= MIN_REVISIT_BYTES
    groups = full.filter(long_enough).groupBy("__digest").agg(F.min(id_col).alias("__first"), F.count("*").alias("__n"))
    groups = groups.filter("__n > 1").select(F.col("__digest").alias("__key"), "__first")
    keyed = full.withColumn(
        "__key", F.when(long_enough, F.col("__digest")).otherwise(F.concat(F.lit("-"), F.xxhash64(id_col, "__digest").cast("string")))
    )
    joined = keyed.join(groups, "__key", "left").drop("__key")
    revisit = F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(F.col(id_col))
    return joined.withColumn("__refers", F.when(revisit, F.col("__first"))).drop("__first")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", records_per_file: int = 1000) -> None:
    """One record a row in gzip-member archives below `folder` (Spark names the files). Null html or url: empty; a null id is written
    as `null`; extra columns are not stored; an empty table writes an archive without records."""
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    rows = with_revisits(own, "id", F.coalesce(F.col("html"), F.lit("")).cast("binary")).select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("id"), F.coalesce("url", F.lit("")).alias("url"),
        F.when(F.col("__refers").isNull(), F.col("__payload")).alias("payload"), "__bytes", "__digest", F.col("__refers").cast("string").alias("refers"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, url, payload, size, digest, refers, date in zip(*(batch.column(k).to_pylist() for k in range(7))):
                out.append(gzip_member(record_bytes(i, url, date, payload, size, digest, refers))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    packed = rows.mapInArrow(members, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\u0000").option(
        "maxRecordsPerFile", records_per_file
    ).text(folder)


class Damaged(ValueError):
    """A record or member that fails a check; the text says which."""


def _digest_matches(stated: str, data: bytes) -> bool:
    name, _, value = stated.partition(":")
    if name.lower() not in ("sha1", "sha256", "md5"):
        return True  # an algorithm this reader does not know proves nothing
    own = hashlib.new(name.lower(), data)
    return value.lower() == own.hexdigest() or value.upper() == base64.b32encode(own.digest()).decode().rstrip("=")


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block and end of the record at `at`; raises `Damaged`."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", line.end() - 2)
    if end < 0:
        raise Damaged("headers do not end")
    headers = {}
    for row in data[line.end() : end].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            raise Damaged("a header without a colon")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    start, stop = end + 4, end + 4 + int(length)
    if stop + 4 > len(data):
        raise Damaged("the block is cut short")
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("the block does not end where its length says")
    block = data[start:stop]
    if "warc-block-digest" in headers and not _digest_matches(headers["warc-block-digest"], block):
        raise Damaged("block digest")
    return headers, block, stop + 4


def inflate_member(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int]:
    """Content and end of the gzip member at `at`; its checksum and length are checked; raises `Damaged`."""
    stream, out, pos = zlib.decompressobj(wbits=31), [], at
    try:
        while not stream.eof:
            if pos >= len(data):
                raise Damaged("the member is cut short")
            out.append(stream.decompress(data[pos : pos + step]))
            pos += step
    except zlib.error as e:
        raise Damaged("gzip: " + str(e)[:80]) from e
    return b"".join(out), min(pos, len(data)) - len(stream.unused_data)


def parse_at(data: bytes, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int]:
    """The records of the member or of the plain record at `at`, and where it ends."""
    if not data.startswith(GZIP_MAGIC, at):
        headers, block, end = parse_record(data, at)
        return [(headers, block)], end
    content, end = inflate_member(data, at)
    records, pos = [], 0
    while pos < len(content):
        headers, block, pos = parse_record(content, pos)
        records.append((headers, block))
    return records, end


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | str]]:
    """(offset, length, headers, block) of each readable record and (offset, length, None, reason) of each gap, in file order; the
    records' members and the gaps cover the file."""
    pos, gap, reason = 0, None, ""
    while pos < len(data):
        try:
            records, end = parse_at(data, pos)
        except Damaged as e:
            if gap is None:
                gap, reason = pos, str(e)
            found = _START.search(data, pos + 1)
            pos = found.start() if found else len(data)
            continue
        if gap is not None:
            yield gap, pos - gap, None, reason
            gap = None
        for headers, block in records:
            yield pos, end - pos, headers, block
        pos = end
    if gap is not None:
        yield gap, len(data) - gap, None, reason


RECORD_SCHEMA = (
    "path string, offset long, length long, gap_reason string, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload binary"
)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every record below `folder`, and every quarantined gap as a row with `gap_reason` and nulls in the record's columns.

    `offset` and `length` are bytes of the file (of the member, for a compressed record). `payload` is what follows the HTTP headers
    of a response; null for other types. An empty file gives no rows. Memory: the archives of one Arrow batch."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[tuple] = []
                for offset, length, headers, block in salvage(content.as_py() or b""):
                    if headers is None:
                        rows.append((path, offset, length, block, *[None] * 6))
                        continue
                    is_response = headers.get("warc-type") == "response"
                    payload = block.partition(b"\r\n\r\n")[2] if is_response and block.startswith(b"HTTP/") else block if is_response else None
                    rows.append((path, offset, length, None, *[headers.get(k) for k in ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")], payload))
                    if len(rows) >= 512:
                        yield _record_batch(rows)
                        rows = []
                if rows:
                    yield _record_batch(rows)

    return files.mapInArrow(run, RECORD_SCHEMA)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.binary()]
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:x-page:(.*)>$", 1)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the pages' archives to `folder` (a new one below the shared folder if None), reads them back and returns, per record,
    page_id, payload_bytes, payload_digest, record_type and refers_to. A revisit's two payload columns are those of the response it
    refers to, found by the record's id and stated digest; a response that was lost would leave them null."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_warc(pages, folder)
    stated = F.regexp_extract("payload_digest", "^sha256:(.*)$", 1)
    payload = F.octet_length("payload").cast("long")
    read = read_warc(spark, folder).filter("gap_reason is null").select(
        page_of(F.col("record_id")).try_cast("long").alias("page_id"), "record_type", "record_id", "refers_to", stated.alias("stated"),
        payload.alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
    )
    records = cut_lineage(read)
    responses = records.filter("record_type = 'response'")
    found = responses.select(F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes", "payload_digest").distinct()
    revisits = records.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "stated").join(found, ["refers_to", "stated"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select(*columns, page_of(F.col("refers_to")).try_cast("long").alias("refers_to"))
    )
