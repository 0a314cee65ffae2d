"""The stream stages, run to the end of the available input, and their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators import extract as x
from paperloom.operators import intake
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import DOMAIN, sql, strip
from paperloom.plans.extract_queries import _REGISTRY, _TIER1
from paperloom.plans.intake_queries import _REFUSED, RATE_SQL, TTL_SQL
from paperloom.plans.store_queries import _FLAT, _NAMES, extracted_events
from paperloom.session import cut_lineage, scratch_path
from paperloom.settings import DEFAULTS
from paperloom.sources.events import file_stream
from paperloom.sources.sinks import event_records
from paperloom.streaming import gates, jobs


def event_stream(spark, sf):
    """The events table as a file stream with event time in microseconds."""
    gates.use_rocksdb(spark)
    schema = d.table(spark, sf, "events").schema
    stream = file_stream(spark, f"{sf}/event[s].parquet", schema=schema).select("event_id", "user_id", "event_type", "ts")
    return gates.event_time(stream, "ts")


def drained(spark, stream, label):
    path = scratch_path(spark, label)
    gates.run_to_files(stream, path, scratch_path(spark, f"{label}-checkpoint"))
    return spark.read.parquet(path)


@query("ttl_dedup_stream", TTL_SQL)
def ttl_dedup_stream(spark, sf):
    gated = gates.ttl_gate(event_stream(spark, sf), ["user_id", "event_type"], "ts", "event_id", DEFAULTS.dedup_ttl_seconds)
    return drained(spark, gated, "ttl").select("user_id", "event_type", d.shown_time(F.col("ts")).alias("accepted_at"))


@query("ttl_dedup_batches", TTL_SQL)
def ttl_dedup_batches(spark, sf):
    base = scratch_path(spark, "ttl-batches")
    jobs.run_ttl_gate(event_stream(spark, sf), ["user_id", "event_type"], "ts", "event_id", base, scratch_path(spark, "ttl-batches-checkpoint"))
    return jobs.read_output(spark, base, "accepted").select("user_id", "event_type", d.shown_time(F.col("ts")).alias("accepted_at"))


@query("rate_limit_stream", RATE_SQL)
def rate_limit_stream(spark, sf):
    gated = gates.rate_gate(event_stream(spark, sf), ["user_id"], "ts", "event_id", window_seconds=6 * 3600)
    return drained(spark, gated, "rate").drop("ts")


def ingest_messages(spark, sf):
    """Envelopes on the ingest topic: screened messages, some sent twice, some with a wrong contract, some no JSON at all."""
    screened = intake.screen(d.messages(spark, sf)).filter(F.col("refused").isNull())
    events = intake.ingested_events(screened, d.as_of()).withColumn("msg_seq", F.regexp_extract("email.subject", r"(\d+)", 1).cast("bigint"))
    i = F.col("msg_seq")
    copies = events.withColumn("copy", F.explode(F.when(i % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    changed = (
        copies.withColumn("event_id", F.concat("event_id", F.lit("-"), F.col("copy").cast("string")))
        .withColumn("contract_version", F.when(i % 17 == 0, "v2").otherwise(F.col("contract_version")))
        .withColumn("email", F.col("email").withField("idempotency_key", F.concat(F.lit("key-"), i.cast("string"))))
    )
    value = F.to_json(F.struct(*[c for c in events.columns if c != "msg_seq"]))
    return changed.select(
        F.col("email.idempotency_key").alias("key"), F.when(i % 53 == 0, F.concat(F.lit("broken "), i.cast("string"))).otherwise(value).alias("value"),
        F.lit("ingest.raw").alias("topic"), d.as_of().alias("timestamp"),
    )


def stored_files(spark, sf):
    """Hashes of stored attachment files; some files were changed, some are gone."""
    screened = intake.screen(d.messages(spark, sf)).select("msg_seq", "s3_bucket", "s3_prefix", F.explode("attachments").alias("a"))
    i = F.col("msg_seq")
    folder = F.when(i % 7 == 0, F.concat(F.lit("gone/"), i.cast("string"))).otherwise(F.col("s3_prefix"))
    rows = screened.select(
        "s3_bucket", F.concat(folder, F.col("a.filename")).alias("s3_key"), F.when(i % 19 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("a.checksum_sha256")).alias("file_hash")
    )
    return rows.groupBy("s3_bucket", "s3_key").agg(F.min("file_hash").alias("file_hash"))


def route_stage(spark, sf):
    users = d.users(spark, sf)
    registry = x.registry_metadata(d.registry_works(spark, sf))
    files = stored_files(spark, sf)

    def stage(batch, earlier):
        remembered = None if earlier is None else jobs.still_remembered(earlier, d.as_of())
        return jobs.extract_and_route(batch, users, registry, d.as_of(), remembered, file_hashes=files)

    return stage


def route_outcomes(outcomes):
    """(idempotency_key, destination) of every message."""
    failed = F.split_part("reason", F.lit(":"), F.lit(1))
    destination = F.when(F.col("kind") == "routed", F.col("topic")).when(F.col("kind") == "dead_letter", failed).otherwise(F.lit("skipped"))
    return outcomes.select(F.col("key").alias("idempotency_key"), destination.alias("destination"))


# Messages with the same (message id, file name) share one stored file; its smallest hash stands for it.
_SENT = f"""
    SELECT m.msg_seq, concat('key-', m.msg_seq) AS idempotency_key, {strip('r.redacted_text')} AS raw_text, m.filename IS NOT NULL AND m.size_bytes <= 52428800 AS has_file, m.checksum, m.address,
      concat(strftime(m.received_at, '%Y/%m/%d'), '/', m.message_id, '/', m.filename) AS file_key
    FROM messages m JOIN redacted r USING (msg_seq) JOIN refusal f USING (msg_seq) WHERE f.refused IS NULL"""
_FILES = """
    SELECT concat(strftime(received_at, '%Y/%m/%d'), '/', message_id, '/', filename) AS file_key, min(CASE WHEN msg_seq % 19 = 0 THEN sha256('other') ELSE checksum END) AS file_hash
    FROM messages WHERE filename IS NOT NULL AND size_bytes <= 52428800 AND msg_seq % 7 <> 0 GROUP BY ALL"""
_SOUND = """
    SELECT s.*, NOT has_file OR coalesce(f.file_hash = s.checksum, false) AS intact FROM sent s LEFT JOIN files f USING (file_key)"""
_ROUTED = """
    SELECT s.msg_seq, s.idempotency_key, CASE WHEN u.user_id IS NULL OR NOT u.is_active THEN 'papers.failed' WHEN NOT has_file THEN 'papers.review'
      WHEN round(CASE WHEN r.doi_key IS NULL THEN CASE WHEN t.title IS NOT NULL THEN 0.18 ELSE 0 END + CASE WHEN t.year IS NOT NULL THEN 0.18 ELSE 0 END
        ELSE CASE WHEN len(r.authors) > 0 THEN 0.4 ELSE 0 END + CASE WHEN coalesce(r.title, t.title) IS NOT NULL THEN 0.3 ELSE 0 END + CASE WHEN r.venue IS NOT NULL OR r.year IS NOT NULL OR t.year IS NOT NULL THEN 0.3 ELSE 0 END END, 4) < 0.75
      THEN 'papers.review' ELSE 'papers.validated' END AS topic
    FROM sound s JOIN tier1 t USING (msg_seq) LEFT JOIN registry r ON r.doi_key = lower(t.doi) LEFT JOIN users u ON split_part(u.email, '@', 1) = split_part(s.address, '@', 1)"""
_ROUTE_CTES = {
    "refusal": _REFUSED, "sent": _SENT, "files": _FILES, "sound": _SOUND, "tier1": _TIER1.replace("FROM messages", "FROM sound").replace("body_text", "raw_text"),
    "registry": _REGISTRY, "routed": _ROUTED,
}
_COPIES = "(VALUES (0), (1)) c(copy) ON c.copy = 0 OR s.msg_seq % 10 = 0"
ROUTE_SQL = sql(f"""
    SELECT idempotency_key, CASE WHEN msg_seq % 53 = 0 OR msg_seq % 17 = 0 THEN 'schema_validation_failed' WHEN copy = 1 THEN 'skipped' WHEN NOT intact THEN 'integrity_check_failed' ELSE topic END AS destination
    FROM sound s JOIN routed r USING (msg_seq, idempotency_key) JOIN {_COPIES}""", "redacted", "users", **_ROUTE_CTES)


@query("route_batch", ROUTE_SQL)
def route_batch(spark, sf):
    return route_outcomes(route_stage(spark, sf)(ingest_messages(spark, sf), None))


def replay(spark, messages, label, batches=3):
    """The messages as a file stream of a few micro-batches. All tasks write, and read, a batch; a key's messages are in one file."""
    path = scratch_path(spark, f"{label}-topic")
    each = -(-spark.sparkContext.defaultParallelism // batches)
    messages.repartition(batches * each, "key").write.parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return file_stream(spark, path, files_per_trigger=-(-files // batches))


@query("route_stream", ROUTE_SQL)
def route_stream(spark, sf):
    base = scratch_path(spark, "route")
    stream = replay(spark, ingest_messages(spark, sf), "route")
    jobs.run_stage(stream, route_stage(spark, sf), jobs.split_routed, base, scratch_path(spark, "route-checkpoint"), "processed")
    return route_outcomes(jobs.read_output(spark, base, "_outcomes"))


def extracted_messages(spark, sf):
    """Envelopes on the routed topics, some of them sent twice."""
    events = extracted_events(spark, sf)
    i = F.col("event_id").cast("bigint")
    copies = events.withColumn("copy", F.explode(F.when(i % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    topic = F.coalesce(F.when(F.col("routing_decision.final_action") == "BLOCK", "papers.failed").when(F.col("routing_decision.final_action") == "REVIEW_REQUIRED", "papers.review"), F.lit("papers.validated"))
    marked = copies.withColumn("event_id", F.concat("event_id", F.lit("-"), F.col("copy").cast("string"))).drop("copy").withColumn("target_topic", topic)
    return event_records(marked).withColumn("timestamp", d.as_of()).select("key", "value", "topic", "timestamp")


def store_stage(batch, earlier):
    return jobs.store_batch(batch, earlier, d.as_of(), F.lit(2024))


def store_outcomes(outputs):
    """Per message: its outcome, and how many issues, versions and audit rows its paper has."""
    stored = outputs["papers"].select("paper_id", F.col("ingestion_idempotency_key").alias("key"), F.col("status").alias("outcome"))
    for name, column in (("issues", "paper_id"), ("versions", "paper_id"), ("audit", "resource_id")):
        counts = outputs[name].groupBy(F.col(column).alias("paper_id")).agg(F.count("*").alias(name))
        stored = stored.join(counts, "paper_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))

    def without(name, outcome):
        zero = [F.lit(0).cast("bigint").alias(c) for c in ("issues", "versions", "audit")]
        return outputs[name].select("key", F.lit(outcome).alias("outcome"), *zero)

    return stored.drop("paper_id").unionByName(without("rejected", "rejected")).unionByName(without("skipped", "skipped"))


_STORE_BATCH = """
    SELECT ingestion_idempotency_key AS key, CASE WHEN copy = 1 THEN 'skipped' WHEN length(title) < 10 OR year NOT BETWEEN 2000 AND 2025 THEN 'rejected' ELSE status END AS outcome,
      CASE WHEN copy = 0 AND length(title) >= 10 AND event_no % 3 = 0 AND event_no % 7 <> 1 AND event_no % 2 = 0 THEN 1 ELSE 0 END AS issues,
      CASE WHEN copy = 0 AND length(title) >= 10 THEN 1 ELSE 0 END AS versions, CASE WHEN copy = 0 AND length(title) >= 10 THEN 1 ELSE 0 END AS audit
    FROM flat JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR event_no % 10 = 0"""


_STORE_SQL = sql(_STORE_BATCH, "papers", "authors_long", names=_NAMES, flat=_FLAT)


@query("store_batch", _STORE_SQL)
def store_batch(spark, sf):
    return store_outcomes(jobs.split_stored(cut_lineage(store_stage(extracted_messages(spark, sf), None))))


@query("store_stream", _STORE_SQL)
def store_stream(spark, sf):
    base = scratch_path(spark, "store")
    stream = replay(spark, extracted_messages(spark, sf), "store")
    jobs.run_stage(stream, store_stage, jobs.split_stored, base, scratch_path(spark, "store-checkpoint"), "papers", "ingestion_idempotency_key")
    return store_outcomes({n: jobs.read_output(spark, base, n) for n in ("papers", "issues", "versions", "audit", "rejected", "skipped")})
