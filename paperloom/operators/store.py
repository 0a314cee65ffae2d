"""From extracted events to stored papers and issues; patches, resolutions and uniqueness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import blank_to_null, key_width_64, lookup, stable_id
from paperloom.functions.rules import HEX64, Rule, longer_than, off_unit_interval, outside, violations
from paperloom.operators.dedup import absent_from, first_per_key
from paperloom.schemas import ACTION_STATUS, ACTIONS, PAPER_STATUSES, PAPER_TYPES, SEVERITIES, UNRESOLVED_FACULTY_ID
from paperloom.settings import DEFAULTS, Settings

# Defaults for missing fields.
DEFAULT_TITLE = "Untitled Paper"
DEFAULT_YEAR = 2024
DEFAULT_AUTHOR = "Unknown Author"
DEFAULT_DEPARTMENT = "UNKNOWN"
DEFAULT_ACTION = "REVIEW_REQUIRED"
NO_HASH = "0" * 64
PATCHABLE = ("title", "venue", "year", "doi", "paper_type", "status", "overall_confidence")
REASON_LENGTH = (5, 500)


def status_of(action: Column) -> Column:
    return lookup(ACTION_STATUS, F.coalesce(action, F.lit(DEFAULT_ACTION)), "DRAFT")


def flatten_extracted(events: DataFrame, as_of: Column, settings: Settings = DEFAULTS, carry: Sequence[str] = ()) -> DataFrame:
    """Extracted events to paper rows. Missing or null fields take their defaults; keys are 64 wide on both sides of every
    later comparison."""
    meta, ctx = "extraction_result.metadata", "enriched_context"
    authors = F.transform(F.col(f"{meta}.authors"), lambda a, i: F.struct(
        F.coalesce(a["name"], F.lit("Unknown")).alias("name"), a.affiliation.alias("affiliation"),
        F.coalesce(a.order, i + 1).alias("order"),
    ))
    fallback = F.array(F.struct(
        F.lit(DEFAULT_AUTHOR).alias("name"), F.lit(None).cast("string").alias("affiliation"), F.lit(1).alias("order")
    ))
    attachments = F.transform(
        F.coalesce(F.col("content_reference.attachments"), F.array().cast("array<struct<filename:string,uri:string,checksum_sha256:string>>")),
        lambda a: F.struct(
            F.coalesce(a.filename, F.lit("unknown")).alias("filename"), F.coalesce(a.uri, F.lit("")).alias("uri"),
            F.coalesce(a.checksum_sha256, F.lit(NO_HASH)).alias("checksum_sha256"),
        ),
    )
    key = key_width_64(F.col("idempotency_key"))
    return events.select(
        stable_id(F.lit("paper"), key).alias("paper_id"),
        key.alias("ingestion_idempotency_key"),
        "extraction_id",
        F.coalesce(f"{meta}.title", F.lit(DEFAULT_TITLE)).alias("title"),
        F.when(F.coalesce(F.size(authors), F.lit(0)) > 0, authors).otherwise(fallback).alias("authors"),
        F.coalesce(blank_to_null(F.col(f"{meta}.venue")), F.col(f"{meta}.journal")).alias("venue"),
        F.coalesce(f"{meta}.year", F.lit(DEFAULT_YEAR)).alias("year"),
        F.col(f"{meta}.doi").alias("doi"),
        F.coalesce(f"{meta}.paper_type", F.lit("unknown")).alias("paper_type"),
        F.coalesce(f"{ctx}.faculty_id", F.lit(UNRESOLVED_FACULTY_ID)).alias("faculty_id"),
        F.coalesce(f"{ctx}.faculty_email", F.lit("unknown@" + settings.institution_domain)).alias("faculty_email"),
        F.coalesce(f"{ctx}.department_code", F.lit(DEFAULT_DEPARTMENT)).alias("department_code"),
        status_of(F.col("routing_decision.final_action")).alias("status"),
        F.coalesce("routing_decision.overall_confidence", F.lit(0.0)).cast("decimal(3,2)").alias("overall_confidence"),
        F.coalesce("content_reference.raw_text_hash", F.lit(NO_HASH)).alias("raw_text_hash"),
        attachments.alias("attachment_uris"),
        F.col("extraction_result.embedding").alias("embedding"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
        *carry,
    )


def paper_rules(as_of_year: Column, settings: Settings = DEFAULTS) -> list[Rule]:
    return [
        ("key_length", ~F.length("ingestion_idempotency_key").between(8, 64), "key must have 8 to 64 characters"),
        ("title_length", F.length("title") < 10, "title must have at least 10 characters"),
        ("authors", F.size("authors") < 1, "at least one author is required"),
        ("author_name", F.exists("authors", lambda a: ~F.length(a["name"]).between(1, 300)), "author names need 1 to 300 characters"),
        ("venue_length", longer_than(F.col("venue"), 500), "venue is longer than 500"),
        ("year_range", ~F.col("year").between(2000, as_of_year + 1), "year must lie between 2000 and next year"),
        ("doi_length", longer_than(F.col("doi"), 200), "doi is longer than 200"),
        ("paper_type", outside(F.col("paper_type"), PAPER_TYPES), "unknown paper type"),
        ("status", outside(F.col("status"), PAPER_STATUSES), "unknown status"),
        ("email_length", F.length("faculty_email") > 200, "e-mail is longer than 200"),
        ("department_length", F.length("department_code") > 20, "department is longer than 20"),
        ("confidence", ~F.col("overall_confidence").between(0, 1), "confidence must lie between 0 and 1"),
        ("text_hash", ~F.col("raw_text_hash").rlike(HEX64), "hash must be 64 lower-case hex digits"),
        ("attachment_hash", F.exists("attachment_uris", lambda a: ~a.checksum_sha256.rlike(HEX64)), "attachment hash is malformed"),
        ("embedding_dim", F.col("embedding").isNotNull() & (F.size("embedding") != settings.embedding_dim), "embedding has another dimension"),
    ]


def severity_of(action: Column) -> Column:
    """Severity for issues that come without one, so that a blocking issue also counts against a report."""
    return F.when(action == "BLOCK", "error").otherwise("warning")


def issue_rows(events: DataFrame, as_of: Column) -> DataFrame:
    """One row per validation issue of an extracted event, defaults applied."""
    action = F.coalesce("i.action", F.lit(DEFAULT_ACTION))
    rows = events.select(
        stable_id(F.lit("paper"), key_width_64(F.col("idempotency_key"))).alias("paper_id"),
        as_of.alias("created_at"), F.posexplode("validation_issues").alias("at", "i"),
    )
    return rows.select(
        stable_id(F.lit("issue"), F.col("paper_id"), F.col("at")).alias("issue_id"), "paper_id",
        F.coalesce("i.code", F.lit("UNKNOWN")).alias("issue_code"),
        F.coalesce(F.col("i.severity"), severity_of(action)).alias("severity"),
        action.alias("action"), F.col("i.json_path").alias("json_path"),
        F.coalesce("i.extracted_value", F.lit("")).alias("extracted_value"),
        F.col("i.confidence").cast("decimal(4,3)").alias("confidence"),
        F.col("i.threshold").cast("decimal(4,3)").alias("threshold"),
        F.coalesce("i.source", F.lit("module3")).alias("source"),
        F.coalesce("i.message", F.lit("")).alias("message"),
        F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(None).cast("string").alias("resolved_by"),
        "created_at",
    )


def stored_issue_rules() -> list[Rule]:
    return [
        ("issue_code", longer_than(F.col("issue_code"), 50), "code is longer than 50"),
        ("severity", outside(F.col("severity"), SEVERITIES), "unknown severity"),
        ("action", outside(F.col("action"), ACTIONS), "unknown action"),
        ("json_path", longer_than(F.col("json_path"), 200), "path is longer than 200"),
        ("confidence", off_unit_interval(F.col("confidence")), "confidence must lie between 0 and 1"),
        ("threshold", off_unit_interval(F.col("threshold")), "threshold must lie between 0 and 1"),
        ("source", longer_than(F.col("source"), 50), "source is longer than 50"),
    ]


def new_rows(candidates: DataFrame, existing: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Insert-if-absent: the first candidate of each key that is not stored yet."""
    return absent_from(first_per_key(candidates, [key], order), existing, [key])


def insert_if_absent(candidates: DataFrame, existing: DataFrame, key: str, order: list[str]) -> DataFrame:
    """All distinct candidate keys with `created`: true if this batch inserts it, false if it was stored before."""
    stored = existing.select(key, F.lit(False).alias("created"))
    return first_per_key(candidates, [key], order).join(stored, key, "left").withColumn(
        "created", F.coalesce("created", F.lit(True))
    )


def latest_patches(patches: DataFrame, key: str = "paper_id", ts: str = "changed_at", seq: str = "change_seq") -> DataFrame:
    """Per key, the newest non-null value of every patched column, in one partial aggregation."""
    order = F.struct(ts, seq)
    columns = [c for c in PATCHABLE if c in patches.columns]
    newest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"new_{c}") for c in columns]
    return patches.groupBy(key).agg(
        *newest, F.max(ts).alias("patched_at"), F.max_by("change_reason", order).alias("change_reason")
    )


def patch_rules() -> list[Rule]:
    low, high = REASON_LENGTH
    return [("change_reason", ~F.coalesce(F.length("change_reason").between(low, high), F.lit(False)), "a reason of 5 to 500 characters is required")]


def apply_patches(papers: DataFrame, patches: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers after valid patches: only present values overwrite, `updated_at` moves to the patch time."""
    valid = patches.filter(F.size(violations(patch_rules())) == 0)
    latest = latest_patches(valid, key)
    joined = papers.join(latest, key, "left")
    out = []
    for c in papers.columns:
        if f"new_{c}" in latest.columns:
            out.append(F.coalesce(F.col(f"new_{c}").cast(papers.schema[c].dataType), F.col(c)).alias(c))
        elif c == "updated_at":
            out.append(F.coalesce("patched_at", "updated_at").alias("updated_at"))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def resolve_issues(issues: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Set `resolved_at` and `resolved_by` from a table of resolutions; the latest one per issue wins."""
    latest = resolutions.groupBy("issue_id").agg(
        F.max_by(F.struct(F.col("resolved_at").alias("at"), F.col("resolved_by").alias("by")), F.struct("resolved_at", "resolved_by")).alias("r")
    )
    has_by = "resolved_by" in issues.columns
    joined = issues.join(latest, "issue_id", "left")
    return joined.withColumn("resolved_at", F.coalesce("r.at", "resolved_at")).withColumn(
        "resolved_by", F.coalesce("r.by", F.col("resolved_by") if has_by else F.lit(None).cast("string"))
    ).drop("r")


def duplicates_of(df: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """Key values that occur more than once: (rule, key_value, n). Null keys never conflict."""
    present = df.dropna(subset=keys)
    return (
        present.groupBy(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key_value"))
        .agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(F.lit(rule).alias("rule"), "key_value", "n")
    )


def uniqueness_audit(papers: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    found = duplicates_of(papers, "doi_department", ["doi", "department_code"]).unionByName(
        duplicates_of(papers, "idempotency_key", ["ingestion_idempotency_key"])
    )
    if versions is not None:
        found = found.unionByName(duplicates_of(versions, "paper_version", ["paper_id", "version_number"]))
    return found


def current_state(changes: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Latest row per key from an append-only log, by partial aggregation."""
    rest = [c for c in changes.columns if c != key]
    picked = changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, seq)).alias("row"))
    return picked.select(key, "row.*").select(*changes.columns)


def judge_email_claims(users: DataFrame, changes: DataFrame) -> DataFrame:
    """`changes` with `email_owner` and `rejected` (null or EMAIL_TAKEN): an e-mail address belongs to one user.

    A stored address belongs to its user (the smallest id, should several have it), any other to the first provision that asks for it by
    (changed_at, change_seq, user_id). Provisions of other users with it are rejected. Deactivation frees no address. Changes of other
    kinds and provisions without an address ask for none. Owners are found by partial aggregation, one row an address.
    """
    asks = (F.col("op") == "provision") & F.col("email").isNotNull()
    stored = users.filter(F.col("email").isNotNull()).groupBy("email").agg(F.min("user_id").alias("holder"))
    first = changes.filter(asks).groupBy("email").agg(F.min_by("user_id", F.struct("changed_at", "change_seq", "user_id")).alias("claimant"))
    owners = first.join(stored, "email", "left").select("email", F.coalesce("holder", "claimant").alias("email_owner"))
    none = F.lit(None).cast(users.schema["user_id"].dataType)
    others = changes.filter(~F.coalesce(asks, F.lit(False))).withColumn("email_owner", none).withColumn("rejected", F.lit(None).cast("string"))
    judged = changes.filter(asks).join(owners, "email").withColumn("rejected", F.when(~F.col("email_owner").eqNullSafe(F.col("user_id")), "EMAIL_TAKEN"))
    return judged.select(*others.columns).unionByName(others)


def apply_user_changes(users: DataFrame, changes: DataFrame) -> DataFrame:
    """Users after provisioning, role changes and deactivations.

    `changes`: user_id, op (`provision`, `role`, `deactivate`), email, name, role, department_code, changed_at, change_seq.
    Existing users keep what no change touches; a provision of an unknown id adds a user. Leave out what `judge_email_claims` rejects.
    """
    order = F.struct("changed_at", "change_seq")

    def newest(c: str, ops: tuple[str, ...]) -> Column:
        return F.max_by(F.col(c), F.when(F.col("op").isin(*ops) & F.col(c).isNotNull(), order)).alias(f"new_{c}")

    active = F.max_by(F.col("op") == "provision", F.when(F.col("op").isin("provision", "deactivate"), order))
    latest = changes.groupBy("user_id").agg(
        newest("email", ("provision",)), newest("name", ("provision",)), newest("role", ("provision", "role")),
        newest("department_code", ("provision", "role")), active.alias("new_is_active"),
        F.max_by("op", order).alias("last_op"), F.bool_or(F.col("op") == "provision").alias("provisioned"),
    )
    base = users.select("user_id", "email", "name", "role", "department_code", "is_active", F.lit(True).alias("known"))
    merged = base.join(latest, "user_id", "full_outer").filter(F.col("known") | F.col("provisioned"))
    fields = ("email", "name", "role", "department_code", "is_active")
    return merged.select("user_id", *[F.coalesce(f"new_{c}", c).alias(c) for c in fields])
