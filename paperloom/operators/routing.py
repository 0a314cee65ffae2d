"""Directory enrichment, issue rules, routing and the extracted event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import lookup, sha256, stable_id, storage_uri
from paperloom.operators.extract import FORMULA
from paperloom.schemas import ACTION_TOPIC, CONTRACT_VERSION, DEAD_LETTER_TOPIC, EXTRACTED_EVENT, UNRESOLVED_FACULTY_ID
from paperloom.settings import DEFAULTS, Settings

INVALID_FACULTY = ("not_found", "inactive")


def lookup_key(sender: Column) -> Column:
    return F.split_part(sender, F.lit("@"), F.lit(1))


def directory_keys(users: DataFrame) -> DataFrame:
    """One row per lookup key: a user answers to its id, its e-mail address and the local part of that address.

    Three keyed rows per user replace an OR condition, which could only run as a nested loop. If several users share a
    key, an id match wins over an address and that over a local part, then the smaller user id.
    """
    keys = F.array(F.col("user_id"), F.col("email"), F.split_part(F.col("email"), F.lit("@"), F.lit(1)))
    person = F.struct(
        F.col("faculty_id").cast("string").alias("faculty_id"), F.col("name").alias("faculty_name"),
        F.col("email").alias("faculty_email"), "department_code",
        F.when(F.col("is_active"), "active").otherwise("inactive").alias("faculty_status"),
    )
    rows = users.select("user_id", person.alias("person"), F.posexplode(keys).alias("priority", "lookup_key"))
    return (
        rows.filter(F.col("lookup_key").isNotNull()).groupBy("lookup_key")
        .agg(F.min_by("person", F.struct("priority", "user_id")).alias("person")).select("lookup_key", "person.*")
    )


def enrich(df: DataFrame, users: DataFrame, key: str = "lookup_key") -> DataFrame:
    """Left join with the directory. Spark broadcasts the directory when its measured size allows, and shuffles otherwise."""
    people = directory_keys(users).withColumnRenamed("lookup_key", key)
    joined = df.join(people, key, "left")
    return joined.withColumn("faculty_id", F.coalesce("faculty_id", F.lit(UNRESOLVED_FACULTY_ID))).withColumn(
        "faculty_status", F.coalesce("faculty_status", F.lit("not_found"))
    )


def issue(code: str, message: Column | str, action: str) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.struct(F.lit(code).alias("code"), text.alias("message"), F.lit(action).alias("action"))


def issue_rules() -> Column:
    """Issues of an ingested event that has been enriched: array<struct<code, message, action>>."""
    security = F.col("security")
    result = F.coalesce(security["clamav_result"], F.lit(""))
    status = F.col("faculty_status")
    faculty = F.format_string("Faculty '%s' status='%s'", F.col("faculty_id"), status)
    found = [
        (F.coalesce(F.size("content.attachments"), F.lit(0)) <= 0, issue("NO_ATTACHMENTS", "Email has no file attachments to process", "REVIEW_REQUIRED")),
        (~F.coalesce(security["pii_redacted"], F.lit(False)), issue("PII_NOT_REDACTED", "Personal data is not redacted", "BLOCK")),
        (~F.coalesce(security["source_domain_verified"], F.lit(False)), issue("DOMAIN_NOT_VERIFIED", "Source domain is not verified", "BLOCK")),
        (result != "CLEAN", issue("MALWARE_FLAG", F.concat(F.lit("Scan result: "), result), "BLOCK")),
        (status.isin(*INVALID_FACULTY), issue("FACULTY_INVALID", faculty, "BLOCK")),
    ]
    return F.array_compact(F.array(*[F.when(condition, value) for condition, value in found]))


def _with_action(issues: Column, action: str) -> Column:
    return F.filter(issues, lambda i: i.action == action)


def route(
    df: DataFrame, threshold: float | None = None, settings: Settings = DEFAULTS, issues: str = "issues", confidence: str = "confidence"
) -> DataFrame:
    """Add `final_action`, `target_topic`, `reasons`, `applied_threshold`.

    A block hides the review reasons. A threshold of 0 means 0; only None takes the default.
    """
    limit = settings.routing_threshold if threshold is None else threshold
    score, status = F.col(confidence), F.col("faculty_status")
    blocking = F.transform(
        _with_action(F.col(issues), "BLOCK"),
        lambda i: F.concat(F.lit("validation_issue BLOCK: ["), i.code, F.lit("] "), i.message),
    )
    reviewing = F.transform(
        _with_action(F.col(issues), "REVIEW_REQUIRED"),
        lambda i: F.concat(F.lit("validation_issue REVIEW_REQUIRED: ["), i.code, F.lit("] "), i.message),
    )
    none = F.array().cast("array<string>")
    bad_faculty = F.when(
        status.isin(*INVALID_FACULTY),
        F.array(F.format_string("faculty_status='%s' for faculty_id='%s'", status, F.col("faculty_id"))),
    ).otherwise(none)
    low = F.when(
        score < limit, F.array(F.format_string("overall_confidence=%.4f < threshold=%.4f", score, F.lit(float(limit))))
    ).otherwise(none)
    clear = F.array(F.format_string(
        "all checks passed | confidence=%.4f >= threshold=%.4f | faculty_status=active", score, F.lit(float(limit))
    ))
    block_reasons, review_reasons = F.concat(bad_faculty, blocking), F.concat(low, reviewing)
    out = df.withColumn("__block", block_reasons).withColumn("__review", review_reasons)
    action = F.when(F.size("__block") > 0, "BLOCK").when(F.size("__review") > 0, "REVIEW_REQUIRED").otherwise("AUTO_SAVE")
    reasons = F.when(F.size("__block") > 0, F.col("__block")).when(F.size("__review") > 0, F.col("__review")).otherwise(clear)
    return (
        out.withColumn("final_action", action).withColumn("reasons", reasons)
        .withColumn("target_topic", lookup(ACTION_TOPIC, F.col("final_action")))
        .withColumn("applied_threshold", F.lit(float(limit))).drop("__block", "__review")
    )


def build_extracted(df: DataFrame, worker_id: str = "extract", carry: Sequence[str] = ()) -> DataFrame:
    """The nested `paper.extracted.v1` event next to its `target_topic` and the columns to `carry`.

    Expects ingested-event columns plus the outputs of `extract`, `enrich`, `issue_rules` and `route`. Ids and the trace
    header are derived from the event, so a retry produces the same message.
    """
    trace_hex = F.substring(sha256(F.concat(F.lit("trace:"), F.col("event_id"))), 1, 32)
    span_hex = F.substring(sha256(F.concat(F.lit("span:"), F.col("event_id"))), 1, 16)
    names = F.when(F.size("authors") > 0, F.col("authors")).otherwise(F.array(F.lit("Unknown Author")))
    people = F.transform(names, lambda n, i: F.struct(
        n.alias("name"), F.lit(None).cast("string").alias("affiliation"), (i + 1).alias("order")
    ))
    attachments = F.transform("content.attachments", lambda a: F.struct(
        a.filename.alias("filename"), storage_uri(a.s3_bucket, a.s3_key).alias("uri"), a.checksum_sha256.alias("checksum_sha256")
    ))
    nothing = F.lit(None)
    issues = F.transform("issues", lambda i: F.struct(
        i.code.alias("code"), nothing.cast("string").alias("severity"), i.action.alias("action"), F.lit("module3").alias("source"),
        i.message.alias("message"), nothing.cast("string").alias("json_path"), nothing.cast("string").alias("extracted_value"),
        nothing.cast("double").alias("confidence"), nothing.cast("double").alias("threshold"),
    ))
    metadata = F.struct(
        "title", people.alias("authors"), "venue", F.col("venue").alias("journal"), "year", "doi", "abstract",
        F.array().cast("array<string>").alias("keywords"), F.lit("unknown").alias("paper_type"),
    )
    scores = F.struct(
        F.col("confidence").alias("overall"), F.col("authors_score").alias("authors"), F.col("title_score").alias("title"),
        F.col("venue_year_score").alias("venue_year"), F.lit(FORMULA).alias("formula"),
    )
    pipeline_status = F.coalesce(
        F.col("forced_status") if "forced_status" in df.columns else F.lit(None),
        F.when(F.col("final_action") == "BLOCK", "blocked").otherwise("extracted"),
    )
    event = df.select(
        stable_id(F.lit("extraction"), F.col("event_id")).alias("extraction_id"),
        stable_id(F.lit("extracted"), F.col("event_id")).alias("event_id"),
        F.col("email.idempotency_key").alias("idempotency_key"),
        F.lit(CONTRACT_VERSION).alias("contract_version"),
        F.struct(
            pipeline_status.alias("pipeline_status"), "final_action", F.col("confidence").alias("overall_confidence"),
            "applied_threshold",
            F.struct(nothing.cast("string").alias("summary"), "reasons").alias("decision_rationale"),
        ).alias("routing_decision"),
        F.struct(
            metadata.alias("metadata"), scores.alias("confidence_scores"), F.col("extraction_tier").alias("extraction_source"),
            nothing.cast("array<float>").alias("embedding"),
        ).alias("extraction_result"),
        F.struct("faculty_id", "faculty_name", "faculty_email", "department_code", "faculty_status").alias("enriched_context"),
        F.struct(F.col("content.raw_text_hash").alias("raw_text_hash"), attachments.alias("attachments")).alias("content_reference"),
        issues.alias("validation_issues"),
        F.struct(
            F.concat(F.lit("00-"), trace_hex, F.lit("-"), span_hex, F.lit("-01")).alias("trace_id"), span_hex.alias("span_id"),
            F.create_map().cast("map<string,int>").alias("processing_times"),
        ).alias("audit_trail"),
        F.struct(
            nothing.cast(EXTRACTED_EVENT["processing"].dataType["attempts"].dataType).alias("attempts"),
            F.lit(worker_id).alias("worker_id"), F.col("event_id").alias("source_event_id"),
        ).alias("processing"),
        "target_topic", *carry,
    )
    return event


def failed_events(df: DataFrame, reason: str = "INTEGRITY_CHECK_FAILED", settings: Settings = DEFAULTS) -> DataFrame:
    """Ingested events that failed verification, shaped for `build_extracted`: zero confidence, blocked, dead-letter topic."""
    text = lambda: F.lit(None).cast("string")
    zero = F.lit(0.0)
    return (
        df.withColumn("title", text()).withColumn("venue", text()).withColumn("abstract", text()).withColumn("doi", text())
        .withColumn("year", F.lit(None).cast("int")).withColumn("authors", F.array().cast("array<string>"))
        .withColumn("authors_score", zero).withColumn("title_score", zero).withColumn("venue_year_score", zero)
        .withColumn("confidence", zero).withColumn("extraction_tier", F.lit("REGEX"))
        .withColumn("faculty_id", F.lit(UNRESOLVED_FACULTY_ID)).withColumn("faculty_name", text())
        .withColumn("faculty_email", text()).withColumn("department_code", text())
        .withColumn("faculty_status", F.lit("not_found"))
        .withColumn("issues", F.array(issue("INTEGRITY_CHECK_FAILED", reason, "BLOCK")))
        .withColumn("final_action", F.lit("BLOCK")).withColumn("reasons", F.array(F.lit(reason)))
        .withColumn("applied_threshold", F.lit(settings.routing_threshold))
        .withColumn("target_topic", F.lit(DEAD_LETTER_TOPIC)).withColumn("forced_status", F.lit("failed"))
    )


def dead_letters(
    rows: DataFrame, payload: Column, key: Column, reason: Column, failed_at: Column, original_topic: str | None = None,
) -> DataFrame:
    """Dead-letter envelopes with the whole payload, so that a rejected message can be replayed."""
    columns = [
        failed_at.alias("failed_at"), key.alias("idempotency_key"), reason.alias("reason"),
        payload.alias("original_payload"),
    ]
    if original_topic is not None:
        columns.append(F.lit(original_topic).alias("original_topic"))
    return rows.select(*columns)
