"""RFC 822 archives: one row per message with headers, plain-text body and attachments."""

from __future__ import annotations

from collections.abc import Iterator
from email import message_from_bytes, policy
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.intake import header_id, recipients
from paperloom.schemas import MAIL


HEADERS = {
    "message_id": "Message-ID", "in_reply_to": "In-Reply-To", "references": "References", "subject": "Subject", "sender": "From", "to_header": "To", "cc_header": "Cc",
}


@lru_cache(maxsize=1024)
def _parsed_header(name: str, value: str):
    return policy.default.header_fetch_parse(name, value)


class ParsedOnce(policy.EmailPolicy):
    """The standard library's current policy, which parses a header again each time it is asked for; here a header is parsed once. Long
    ones are not kept."""

    def header_fetch_parse(self, name: str, value: str):
        kept = type(value) is str and len(value) <= 4096
        return _parsed_header(name, value) if kept else super().header_fetch_parse(name, value)


PARSED_ONCE = ParsedOnce()


def scan_archive(spark: SparkSession, path: str, pattern: str = "*.eml") -> DataFrame:
    """(path, content) of the message files; large archives are split over tasks by size."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "content")


def part_text(part) -> str:
    """The decoded text of a part; UTF-8 where it names no character set or an unknown one."""
    data = part.get_payload(decode=True) or b""
    try:
        return data.decode(part.get_content_charset() or "utf-8", errors="replace")
    except LookupError:
        return data.decode("utf-8", errors="replace")


def read_message(raw: bytes) -> dict:
    """A MAIL record of one message, as the standard library's current policy reads it: headers are decoded text, the body is all
    plain-text parts at any depth that are no attachments (or the only part there is), joined by line ends, and attachments are the named
    parts at any depth that hold something. A named text/plain part needs a disposition to count as an attachment."""
    message = message_from_bytes(raw, policy=PARSED_ONCE)
    parts = [(part, part.get_content_type(), part.get_content_disposition()) for part in message.walk() if not part.is_multipart()]
    texts = [part_text(p) for p, kind, how in parts if not message.is_multipart() or (kind == "text/plain" and how != "attachment")]
    named = [(p, p.get_payload(decode=True)) for p, kind, how in parts if p.get_filename() and (how in ("attachment", "inline") or (not how and kind != "text/plain"))]
    text = {name: str(message[header] or "").strip() for name, header in HEADERS.items()}
    return text | {
        "subject": text["subject"] or "(no subject)", "body_text": "\n".join(t for t in texts if t).strip(), "parse_error": None,
        "attachments": [{"filename": p.get_filename(), "content_type": p.get_content_type(), "content": data} for p, data in named if data],
    }


def parse_mail(messages: DataFrame, keep: list[str] = ["path"]) -> DataFrame:  # noqa: B006
    """Parse a `content` column. `keep` names the columns carried along. A message that cannot be parsed stays as a row
    with `parse_error`, so that the reject output can show it."""
    schema = T.StructType([*[messages.schema[c] for c in keep], *MAIL.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records = []
            for raw in batch["content"]:
                try:
                    records.append(read_message(bytes(raw)))
                except Exception as error:  # a broken message must not fail the task
                    records.append(dict.fromkeys(MAIL.fieldNames()) | {"parse_error": str(error)})
            out = pd.DataFrame(records, columns=MAIL.fieldNames(), index=batch.index)
            for i, c in enumerate(keep):
                out.insert(i, c, batch[c])
            yield out

    return normalise_headers(messages.select(*keep, "content").mapInPandas(run, schema))


def normalise_headers(mail: DataFrame) -> DataFrame:
    """Ids without angle brackets, empty headers as null, `To` and `Cc` as one list."""
    return (
        mail.withColumn("message_id", header_id(F.col("message_id"))).withColumn("in_reply_to", header_id(F.col("in_reply_to")))
        .withColumn("references", F.nullif(F.col("references"), F.lit("")))
        .withColumn("recipients", recipients(F.col("to_header"), F.col("cc_header"))).drop("to_header", "cc_header")
    )


def attachment_infos(attachments="attachments"):
    """Attachment metadata without the bytes: filename, content type, size and checksum."""
    return F.transform(attachments, lambda a: F.struct(
        a.filename.alias("filename"), a.content_type.alias("content_type"), F.length(a.content).cast("bigint").alias("size_bytes"),
        F.sha2(a.content, 256).alias("checksum_sha256"),
    ))
