"""Table and event schemas, enumerations and lookup tables. Everything is read with these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Enumerations and mappings.
PAPER_TYPES = ("journal", "conference", "thesis", "book_chapter", "unknown")
PAPER_STATUSES = ("PUBLISHED", "DRAFT", "REJECTED", "PENDING_REVIEW")
FINALISED_OR_IN_REVIEW = ("PUBLISHED", "PENDING_REVIEW", "REJECTED")
OPEN_STATUSES = ("PENDING_REVIEW", "DRAFT")
SEVERITIES = ("error", "warning", "info")
ACTIONS = ("AUTO_SAVE", "REVIEW_REQUIRED", "BLOCK")
ACTION_STATUS = {"AUTO_SAVE": "PUBLISHED", "REVIEW_REQUIRED": "PENDING_REVIEW", "BLOCK": "REJECTED"}
ACTION_TOPIC = {"AUTO_SAVE": "papers.validated", "REVIEW_REQUIRED": "papers.review", "BLOCK": "papers.failed"}
INGEST_TOPIC = "ingest.raw"
DEAD_LETTER_TOPIC = "dlq.ingestion.failed"
REPORT_TYPES = ("NAAC_CRITERIA_III", "FACULTY_PROFILE")
REPORT_FORMATS = ("pdf", "xlsx")
REPORT_STATUSES = ("PENDING", "GENERATING", "COMPLETED", "FAILED")
CHECKSUM_EVENTS = ("GENERATED", "VERIFIED", "MISMATCH")
ACCESS_ROLES = ("faculty", "coordinator", "hod", "admin", "system")
REPORT_ROLES = ("coordinator", "hod", "admin")
UNRESOLVED_FACULTY_ID = "00000000-0000-0000-0000-000000000000"
CONTRACT_VERSION = "v1"
INGESTED_STATUS = "ingested"
ROLE_PERMISSIONS = {
    "faculty": ["paper.view.self", "paper.submit", "paper.reprocess.self", "search.dept"],
    "coordinator": [
        "paper.view.self", "paper.submit", "paper.reprocess.self", "paper.review", "paper.approve", "export.create",
        "search.dept",
    ],
    "hod": [
        "paper.view.self", "paper.submit", "paper.review", "paper.approve", "export.create", "user.manage", "audit.view",
        "metrics.view", "search.dept",
    ],
    "admin": [
        "paper.view.all", "paper.submit", "paper.review", "paper.approve", "export.create", "export.global", "user.manage",
        "user.delete", "audit.view", "metrics.view", "system.config", "search.global",
    ],
    "system_worker": ["queue.consume", "db.write.internal"],
}


_NAMED = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "float": T.FloatType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
}


def _type(t: str | T.DataType) -> T.DataType:
    return _NAMED[t] if isinstance(t, str) else t


def struct(**fields: str | T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, _type(t)) for name, t in fields.items()])


def array(t: str | T.DataType) -> T.ArrayType:
    return T.ArrayType(_type(t))


AUTHOR = struct(name="string", affiliation="string", order="int")
STORED_ATTACHMENT = struct(filename="string", uri="string", checksum_sha256="string")
ENTITY = struct(label="string", text="string")
STRINGS = array("string")

INGESTED_EVENT = struct(
    event_id="string", contract_version="string", pipeline_status="string", created_at="timestamp",
    email=struct(
        message_id="string", thread_id="string", subject="string", sender="string", recipients=STRINGS,
        received_at="timestamp", idempotency_key="string",
    ),
    content=struct(
        raw_text="string", raw_text_hash="string", language="string",
        attachments=array(struct(
            filename="string", content_type="string", size_bytes="bigint", checksum_sha256="string", s3_key="string",
            s3_bucket="string",
        )),
    ),
    processing=struct(attempts=STRINGS, worker_id="string", processed_at="timestamp"),
    security=struct(
        pii_redacted="boolean", source_domain_verified="boolean", clamav_scanned="boolean", clamav_result="string"
    ),
)

EXTRACTED_EVENT = struct(
    extraction_id="string", event_id="string", idempotency_key="string", contract_version="string",
    routing_decision=struct(
        pipeline_status="string", final_action="string", overall_confidence="double", applied_threshold="double",
        decision_rationale=struct(summary="string", reasons=STRINGS),
    ),
    extraction_result=struct(
        metadata=struct(
            title="string", authors=array(AUTHOR), venue="string", journal="string", year="int", doi="string",
            abstract="string", keywords=STRINGS, paper_type="string",
        ),
        confidence_scores=struct(overall="double", authors="double", title="double", venue_year="double", formula="string"),
        extraction_source="string", embedding=array("float"),
    ),
    enriched_context=struct(
        faculty_id="string", faculty_name="string", faculty_email="string", department_code="string", faculty_status="string"
    ),
    content_reference=struct(raw_text_hash="string", attachments=array(STORED_ATTACHMENT)),
    validation_issues=array(struct(
        code="string", severity="string", action="string", source="string", message="string", json_path="string",
        extracted_value="string", confidence="double", threshold="double",
    )),
    audit_trail=struct(
        trace_id="string", span_id="string", processing_times=T.MapType(T.StringType(), T.IntegerType())
    ),
    processing=struct(
        attempts=array(struct(attempt_number="int", timestamp="string", status="string", source="string")),
        worker_id="string", source_event_id="string",
    ),
)

PAPERS = struct(
    paper_id="string", ingestion_idempotency_key="string", extraction_id="string", title="string", authors=array(AUTHOR),
    venue="string", year="int", doi="string", paper_type="string", faculty_id="string", faculty_email="string",
    department_code="string", status="string", overall_confidence=T.DecimalType(3, 2), raw_text_hash="string",
    attachment_uris=array(STORED_ATTACHMENT), embedding=array("float"), created_at="timestamp", updated_at="timestamp",
)

ISSUES = struct(
    issue_id="string", paper_id="string", issue_code="string", severity="string", action="string", json_path="string",
    extracted_value="string", confidence=T.DecimalType(4, 3), threshold=T.DecimalType(4, 3), source="string",
    message="string", resolved_at="timestamp", resolved_by="string", created_at="timestamp",
)

VERSIONS = struct(
    version_id="string", paper_id="string", version_number="bigint", changed_by="string", changed_at="timestamp",
    change_reason="string", before_state="string", after_state="string",
)

AUDIT_LOG = struct(
    log_id="string", logged_at="timestamp", action="string", actor_type="string", actor_id="string", resource_type="string",
    resource_id="string", details="string", ip_address="string", trace_id="string",
)

REPORTS = struct(
    report_id="string", report_type="string", department_code="string", academic_year="string", output_format="string",
    faculty_id="string", status="string", s3_uri="string", checksum_sha256="string", total_papers="bigint",
    error_message="string", generated_by="string", requested_at="timestamp", generated_at="timestamp",
)

CHECKSUMS = struct(
    checksum_id="string", report_id="string", checksum_sha256="string", event_type="string", recorded_at="timestamp"
)

USERS = struct(
    user_id="string", faculty_id="string", email="string", name="string", role="string", department_code="string",
    is_active="boolean", mfa_enabled="boolean", last_login_at="timestamp", created_at="timestamp", updated_at="timestamp",
)

MAIL = struct(
    message_id="string", in_reply_to="string", references="string", subject="string", sender="string", to_header="string",
    cc_header="string", body_text="string",
    attachments=array(struct(filename="string", content_type="string", content="binary")), parse_error="string",
)

DATE_PARTS = struct(**{"date-parts": array(array("int"))})
REGISTRY_WORK = struct(**{
    "DOI": "string", "title": STRINGS, "author": array(struct(given="string", family="string")),
    "published-print": DATE_PARTS, "published-online": DATE_PARTS, "created": DATE_PARTS, "container-title": STRINGS,
    "publisher": "string", "abstract": "string",
})

MODEL_OUTPUT = struct(
    idempotency_key="string", title="string", authors=STRINGS, year="string", venue="string", abstract="string", doi="string"
)
