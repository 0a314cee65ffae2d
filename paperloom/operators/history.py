"""Version history, audit rows and sliding-window counts over change logs.

A plain window per key would put all changes of one busy key into one task. Here a key's time line is cut into chunks: the
windows run per (key, chunk), a small per-chunk table carries totals and last states across chunk borders, and both are
joined back. The result is the same for every chunk width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import stable_id, trace_uuid
from paperloom.schemas import AUDIT_LOG

# Texts written by version and audit rules.
FIRST_REASON = "Initial creation"
DEFAULT_REASON = "update"
SYSTEM_ACTOR = "system"
PAPER_AUDIT_ACTIONS = {"INSERT": "paper_created", "UPDATE": "paper_updated", "DELETE": "paper_deleted"}

DAY = 86_400


def _seconds(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def versioned(
    changes: DataFrame, key: str, ts: str, seq: str, state: list[str], existing_max: DataFrame | None = None,
    chunk_seconds: int = DAY,
) -> DataFrame:
    """Add `version_number` (1, 2, ... per key by time) and `before` (the state struct before the change; null at first).

    `existing_max` (key, version_number, optional `before`: the stored state) continues numbering after stored versions.
    Changes without a time count as the oldest of their key, those without a key as changes of one more key; none is lost.
    """
    state_struct = F.struct(*state)
    rows = changes.withColumn("__chunk", F.floor(_seconds(ts) / F.lit(chunk_seconds * 1_000_000)))
    inside = Window.partitionBy(key, "__chunk").orderBy(ts, seq)
    numbered = rows.withColumn("__n", F.row_number().over(inside)).withColumn("__prev", F.lag(state_struct).over(inside))
    chunks = rows.groupBy(key, "__chunk").agg(
        F.count("*").alias("rows"), F.max_by(state_struct, F.struct(ts, seq)).alias("last_state")
    )
    across = Window.partitionBy(key).orderBy("__chunk")
    carried = chunks.select(
        F.col(key).alias("__key"), F.col("__chunk").alias("__at"),
        F.coalesce(F.sum("rows").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"),
        F.lag("last_state").over(across).alias("__carried"),
    )
    out = numbered.join(carried, F.col(key).eqNullSafe(F.col("__key")) & F.col("__chunk").eqNullSafe(F.col("__at"))).drop("__key", "__at")
    number = F.col("__n") + F.col("__offset")
    before = F.when(F.col("__n") == 1, F.col("__carried")).otherwise(F.col("__prev"))
    if existing_max is not None:
        earlier = F.col("before") if "before" in existing_max.columns else F.lit(None).cast(rows.select(state_struct.alias("s")).schema["s"].dataType)
        stored = existing_max.select(F.col(key).alias("__key"), F.col("version_number").alias("__stored"), earlier.alias("__last"))
        out = out.join(stored, F.col(key).eqNullSafe(F.col("__key")), "left")
        number = number + F.coalesce("__stored", F.lit(0))
        before = F.coalesce(before, F.when(F.col("__n") + F.col("__offset") == 1, F.col("__last")))
    return out.withColumn("version_number", number.cast("bigint")).withColumn("before", before).drop(
        "__chunk", "__n", "__prev", "__offset", "__carried", "__key", "__stored", "__last"
    )


def version_rows(changes: DataFrame, key: str, ts: str, seq: str, state: list[str], **kwargs) -> DataFrame:
    """Rows of the versions table: before/after snapshots as JSON, actor and reason with their defaults."""
    def text(name: str) -> Column:
        return F.col(name) if name in changes.columns else F.lit(None).cast("string")

    numbered = versioned(changes, key, ts, seq, state, **kwargs)
    reason = F.when(F.col("version_number") == 1, FIRST_REASON).otherwise(F.coalesce(text("change_reason"), F.lit(DEFAULT_REASON)))
    return numbered.select(
        stable_id(F.lit("version"), F.col(key), F.col("version_number")).alias("version_id"),
        F.col(key).cast("string").alias("paper_id"), "version_number",
        F.coalesce(text("changed_by"), F.lit(SYSTEM_ACTOR)).alias("changed_by"),
        F.col(ts).cast("timestamp").alias("changed_at"), reason.alias("change_reason"),
        F.when(F.col("before").isNotNull(), F.to_json("before")).alias("before_state"),
        F.to_json(F.struct(*state)).alias("after_state"),
    )


def first_versions(papers: DataFrame, key: str, ts: str, state: list[str]) -> DataFrame:
    """Version rows of newly stored papers: number 1, nothing before. No window is needed, the papers are new."""
    number = F.lit(1).cast("bigint")
    return papers.select(
        stable_id(F.lit("version"), F.col(key), number).alias("version_id"), F.col(key).cast("string").alias("paper_id"), number.alias("version_number"),
        F.lit(SYSTEM_ACTOR).alias("changed_by"), F.col(ts).cast("timestamp").alias("changed_at"), F.lit(FIRST_REASON).alias("change_reason"),
        F.lit(None).cast("string").alias("before_state"), F.to_json(F.struct(*state)).alias("after_state"),
    )


def latest_versions(papers: DataFrame, versions: DataFrame) -> DataFrame:
    """Latest version number of every paper, 0 without any."""
    top = versions.groupBy("paper_id").agg(F.max("version_number").alias("latest"))
    return papers.select("paper_id").join(top, "paper_id", "left").withColumn("latest", F.coalesce("latest", F.lit(0)))


def version_history(versions: DataFrame) -> DataFrame:
    return versions.orderBy("paper_id", "version_number")


def issues_by_age(issues: DataFrame) -> DataFrame:
    return issues.orderBy("paper_id", "created_at", "issue_id")


def audit_rows(
    source: DataFrame, action: Column, resource_type: str, resource_id: Column, details: Column, logged_at: Column,
    actor_type: Column | None = None, actor_id: Column | None = None, ip_address: Column | None = None,
    trace: Column | None = None, row_key: Column | None = None,
) -> DataFrame:
    """Rows of the shared audit log. `row_key` tells rows apart that share action, resource and time, so that log ids are unique.
    A trace header that cannot be parsed gets an id derived from the row."""
    fallback = stable_id(F.lit("trace"), action, resource_id, logged_at)
    return source.select(
        stable_id(F.lit("audit"), action, F.lit(resource_type), resource_id, logged_at, *([] if row_key is None else [row_key])).alias("log_id"),
        logged_at.cast("timestamp").alias("logged_at"), action.alias("action"),
        F.coalesce(actor_type if actor_type is not None else F.lit(None), F.lit(SYSTEM_ACTOR)).alias("actor_type"),
        F.coalesce(actor_id.cast("string") if actor_id is not None else F.lit(None).cast("string"), F.lit(SYSTEM_ACTOR)).alias("actor_id"),
        F.lit(resource_type).alias("resource_type"), resource_id.cast("string").alias("resource_id"),
        F.to_json(details).alias("details"),
        (ip_address if ip_address is not None else F.lit(None).cast("string")).alias("ip_address"),
        F.coalesce(trace_uuid(trace) if trace is not None else F.lit(None).cast("string"), fallback).alias("trace_id"),
    )


def audit_log(*producers: DataFrame) -> DataFrame:
    """Union of several producers on the one audit schema."""
    names = AUDIT_LOG.fieldNames()
    out = None
    for part in producers:
        missing = [F.lit(None).cast(AUDIT_LOG[n].dataType).alias(n) for n in names if n not in part.columns]
        aligned = part.select("*", *missing).select(*names)
        out = aligned if out is None else out.unionByName(aligned)
    return out


def audit_tail(log: DataFrame, resource_type: str, resource_id: str, limit: int | None = 100) -> DataFrame:
    """Newest audit rows of one resource; all of them if `limit` is None."""
    if limit is not None and limit < 1:
        raise ValueError("the audit limit must be positive, or None for all rows")
    rows = log.filter((F.col("resource_type") == resource_type) & (F.col("resource_id") == resource_id))
    ordered = rows.orderBy(F.desc("logged_at"), F.asc("log_id"))
    return ordered if limit is None else ordered.limit(limit)


def attempts_in_window(df: DataFrame, keys: list[str], ts: str, window_seconds: int) -> DataFrame:
    """Add `attempts`: rows of the same key in (t - window, t], the current one included.

    Time is cut into window-sized buckets; every row also serves the next bucket as context. So a window only ever needs one
    (key, bucket), and a busy key spreads over as many tasks as it has buckets. Rows without a time are kept; their number is null.
    """
    width = window_seconds * 1_000_000
    micros = _seconds(ts)
    placed = df.withColumn("__us", micros).withColumn("__home", F.floor(F.col("__us") / F.lit(width)))
    buckets = F.when(F.col("__home").isNull(), F.array(F.col("__home"))).otherwise(F.array(F.col("__home"), F.col("__home") + 1))
    spread = placed.withColumn("__bucket", F.explode(buckets))
    sliding = Window.partitionBy(*keys, "__bucket").orderBy("__us").rangeBetween(-width + 1, 0)
    counted = spread.withColumn("attempts", F.when(F.col("__us").isNotNull(), F.count("*").over(sliding)))
    return counted.filter(F.col("__bucket").eqNullSafe(F.col("__home"))).drop("__us", "__home", "__bucket")


def rate_limited(df: DataFrame, keys: list[str], ts: str, limit: int = 5, window_seconds: int = 60) -> DataFrame:
    """Sliding-log rate limiter: denied attempts count too. An attempt without a time is neither allowed nor denied (null)."""
    counted = attempts_in_window(df, keys, ts, window_seconds)
    return counted.withColumn("allowed", F.col("attempts") <= limit).withColumn(
        "remaining", F.when(F.col("attempts").isNotNull(), F.greatest(F.lit(0), F.lit(limit) - F.col("attempts"))).cast("bigint")
    )
