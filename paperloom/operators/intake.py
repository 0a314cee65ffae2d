"""From parsed messages to validated `paper.ingested.v1` events, with a disposition for every message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import bind, blank_to_null, dated_key, sha256, stable_id, strip
from paperloom.functions.pii import redact
from paperloom.functions.rules import Rule, violations
from paperloom.operators.dedup import ttl_accepted
from paperloom.schemas import CONTRACT_VERSION, INGESTED_STATUS
from paperloom.session import cut_lineage
from paperloom.settings import DEFAULTS, Settings

CLEAN = "CLEAN"
NO_ATTACHMENT = "no-attachment"


def sender_address(header: Column) -> Column:
    """The bare address of a `From` header, with or without a display name."""
    bracketed = F.regexp_extract(header, r"<([^<>]*)>\s*$", 1)
    return strip(F.when(F.length(bracketed) > 0, bracketed).otherwise(header))


def in_domain(address: Column, settings: Settings = DEFAULTS) -> Column:
    """Exactly the institution's domain, any case; sub-domains and look-alikes fail, missing addresses too."""
    return F.coalesce(F.lower(strip(address)).endswith("@" + settings.institution_domain), F.lit(False))


def header_id(header: Column) -> Column:
    """A message id without its angle brackets; empty becomes null."""
    return blank_to_null(F.regexp_replace(header, r"^[<>]+|[<>]+$", ""))


def recipients(to_header: Column, cc_header: Column) -> Column:
    both = F.concat(F.coalesce(to_header, F.lit("")), F.lit(","), F.coalesce(cc_header, F.lit("")))
    return F.filter(F.transform(F.split(both, ","), strip), lambda r: r != "")


def idempotency_key(message_id: Column, primary_filename: Column) -> Column:
    """An absent message id counts as empty text."""
    return sha256(F.concat(F.coalesce(message_id, F.lit("")), F.lit(":"), F.coalesce(primary_filename, F.lit(NO_ATTACHMENT))))


def long_enough(text: Column, settings: Settings = DEFAULTS) -> Column:
    return F.coalesce(F.length(strip(text)) >= settings.min_body_chars, F.lit(False))


def within_size(attachments: Column, settings: Settings = DEFAULTS) -> Column:
    """Attachments over the size limit are left out; the message itself goes on."""
    return F.filter(attachments, lambda a: a.size_bytes <= settings.max_attachment_bytes)


def hashes_collide(attachments: Column, text_hash: Column) -> Column:
    return F.coalesce(F.exists(attachments, lambda a: a.checksum_sha256 == text_hash), F.lit(False))


def needs_quarantine(attachments: Column) -> Column:
    return F.coalesce(F.exists(attachments, lambda a: ~a.scan_verdict.eqNullSafe(F.lit(CLEAN))), F.lit(False))


def contract_rules(as_of: Column, settings: Settings = DEFAULTS) -> list[Rule]:
    """Rules of an ingested event; `as_of` stands for the current time."""
    latest = F.timestamp_add("SECOND", F.lit(settings.future_tolerance_seconds), as_of)
    return [
        ("contract_version", ~F.col("contract_version").eqNullSafe(F.lit(CONTRACT_VERSION)), "contract version must be v1"),
        ("pipeline_status", ~F.col("pipeline_status").eqNullSafe(F.lit(INGESTED_STATUS)), "status must be ingested"),
        ("sender_domain", ~in_domain(F.col("email.sender"), settings), "sender is outside the institution"),
        ("received_at", F.col("email.received_at") > latest, "received more than the tolerance after now"),
        ("raw_text", ~long_enough(F.col("content.raw_text"), settings), "text is too short"),
        ("attempts", F.size("processing.attempts") > 0, "attempts must be empty at ingestion"),
        ("pii_redacted", ~F.col("security.pii_redacted").eqNullSafe(F.lit(True)), "personal data was not redacted"),
        ("source_domain_verified", ~F.col("security.source_domain_verified").eqNullSafe(F.lit(True)), "domain not verified"),
        ("hash_separation", hashes_collide(F.col("content.attachments"), F.col("content.raw_text_hash")), "file and text hash are equal"),
    ]


def check_contract(events: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> DataFrame:
    return events.withColumn("violations", violations(contract_rules(as_of, settings)))


def screen(messages: DataFrame, settings: Settings = DEFAULTS, bucket: str = "ingest") -> DataFrame:
    """Every message with its redacted text, keys, and `refused`: why it cannot be ingested, or null.

    Needs `message_id`, `sender`, `body_text`, `received_at`, `attachments` (filename, content_type, size_bytes,
    checksum_sha256, scan_verdict) and a unique `msg_seq`. Only messages that pass all other checks take part in the
    duplicate gate, because only published messages are remembered.
    """
    checked = (
        redact(messages, "body_text", settings)
        .withColumn("sender_address", sender_address(F.col("sender")))
        .withColumn("primary_filename", F.get("attachments", F.lit(0)).getField("filename"))
        .withColumn("idempotency_key", idempotency_key(F.col("message_id"), F.col("primary_filename")))
        .withColumn("raw_text", strip(F.col("redacted_text")))
        .withColumn("raw_text_hash", sha256(F.col("redacted_text")))
        .withColumn("attachments", within_size(F.col("attachments"), settings))
    )
    files = F.col("attachments")
    by_content = bind(F.col("redacted_text"), lambda text: (
        F.when(~long_enough(text, settings), "BODY_TOO_SHORT").when(hashes_collide(files, sha256(text)), "HASH_COLLISION")
        .when(needs_quarantine(files), "QUARANTINED")
    ))
    refused = F.when(~in_domain(F.col("sender_address"), settings), "DOMAIN_REJECTED").otherwise(by_content)
    return checked.withColumn("refused", refused).withColumn(
        "s3_prefix", dated_key("attachments", F.col("received_at"), F.col("idempotency_key"), F.lit(""))
    ).withColumn("s3_bucket", F.lit(bucket))


def gate_keys(message_id: Column, idempotency_key: Column, in_reply_to: Column, references: Column) -> tuple[Column, Column]:
    """(checked, marked) key arrays of a message for the multi-key gate. Its own ids and the message it replies to are checked and
    marked; a message it refers to is checked only, against the ids of messages. Empty and null headers give no key."""
    def key(kind: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(kind + ":"), value))

    ids = F.transform(F.split(F.coalesce(references, F.lit("")), r"\s+"), lambda r: F.trim(r, F.lit("<>")))
    marked = F.array_compact(F.array(key("msgid", message_id), key("idem", idempotency_key), key("reply", in_reply_to)))
    refers = F.transform(F.filter(ids, lambda r: r != ""), lambda r: F.concat(F.lit("msgid:"), r))
    return F.array_union(marked, refers), marked


def dispositions(screened: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The outcome of every message of `screen` after the duplicate gate: (msg_seq, message_id, received_at, disposition).

    Messages without an id are told apart by their idempotency key; messages without a time are refused as NO_TIME.

    Only these narrow columns are materialised and joined. Join the result with the messages where their text is needed.
    """
    gate = F.coalesce("message_id", "idempotency_key").alias("gate_key")
    narrow = cut_lineage(screened.select("msg_seq", "message_id", "received_at", "refused", gate))
    candidates = narrow.filter(F.col("refused").isNull() & F.col("received_at").isNotNull())
    accepted = ttl_accepted(candidates, ["gate_key"], "received_at", "msg_seq", settings.dedup_ttl_seconds)
    marked = narrow.join(accepted.select("msg_seq", F.lit(True).alias("accepted")), "msg_seq", "left")
    judged = F.when(F.col("accepted"), "INGESTED").when(F.col("received_at").isNull(), "NO_TIME").otherwise("DUPLICATE")
    return marked.withColumn("disposition", F.coalesce(F.col("refused"), judged)).drop("refused", "accepted", "gate_key")


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """Messages processed and messages ingested."""
    return outcomes.agg(
        F.count("*").alias("processed"), F.count_if(F.col("disposition") == "INGESTED").alias("successful")
    )


def ingested_events(screened: DataFrame, as_of: Column, worker_id: str = "intake") -> DataFrame:
    """`paper.ingested.v1` events for screened messages that were not refused."""
    stored = F.transform("attachments", lambda a: F.struct(
        a.filename.alias("filename"), a.content_type.alias("content_type"), a.size_bytes.alias("size_bytes"),
        a.checksum_sha256.alias("checksum_sha256"),
        F.concat(F.col("s3_prefix"), a.filename).alias("s3_key"), F.col("s3_bucket").alias("s3_bucket"),
    ))
    return screened.select(
        stable_id(F.lit("ingested"), F.col("idempotency_key"), F.col("msg_seq")).alias("event_id"),
        F.lit(CONTRACT_VERSION).alias("contract_version"),
        F.lit(INGESTED_STATUS).alias("pipeline_status"),
        as_of.alias("created_at"),
        F.struct(
            "message_id", F.col("in_reply_to").alias("thread_id"), "subject", F.col("sender_address").alias("sender"),
            "recipients", F.col("received_at").cast("timestamp").alias("received_at"), "idempotency_key",
        ).alias("email"),
        F.struct(
            "raw_text", sha256(F.col("raw_text")).alias("raw_text_hash"), F.lit("en").alias("language"),
            stored.alias("attachments"),
        ).alias("content"),
        F.struct(
            F.array().cast("array<string>").alias("attempts"), F.lit(worker_id).alias("worker_id"),
            as_of.alias("processed_at"),
        ).alias("processing"),
        F.struct(
            F.lit(True).alias("pii_redacted"), F.lit(True).alias("source_domain_verified"),
            F.lit(True).alias("clamav_scanned"), F.lit(CLEAN).alias("clamav_result"),
        ).alias("security"),
    )


def malware_metric(quarantined: DataFrame) -> DataFrame:
    """Detections by environment and whole reason."""
    return quarantined.groupBy("environment", "reason").agg(F.count("*").alias("n"))
