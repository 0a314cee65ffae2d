"""The two stream stages. Each micro-batch is a batch job over the operators; outputs carry the batch id, so that a batch that
is replayed after a failure overwrites its own files and nothing is written twice."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.columns import key_width_64
from paperloom.functions.rules import split_by_rules, violations
from paperloom.operators import extract as x
from paperloom.operators import history, routing, store
from paperloom.operators.dedup import multi_key_accepted, ttl_accepted
from paperloom.operators.intake import contract_rules
from paperloom.schemas import DEAD_LETTER_TOPIC, ENTITY, EXTRACTED_EVENT, INGESTED_EVENT, array
from paperloom.session import cut_lineage
from paperloom.settings import DEFAULTS, Settings
from paperloom.sources.events import EXTRACTED_REQUIRED, INGESTED_REQUIRED, read_contract
from paperloom.sources.sinks import event_records
from paperloom.streaming import done_keys

PAYLOAD_REASON = "; "


def mark_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add `is_first`: true for the first row of each key. Only keys and ids are aggregated (copies collapse before the
    shuffle); the wide rows are joined with one id per key. `event_id` identifies a row."""
    firsts = df.groupBy(key).agg(F.min_by("event_id", F.struct(*order)).alias("first_event"))
    return df.join(firsts, key, "left").withColumn("is_first", F.col("event_id") == F.col("first_event")).drop("first_event")


def extract_and_route(
    batch: DataFrame, users: DataFrame, registry: DataFrame, as_of: Column, processed: DataFrame | None = None,
    model_output: DataFrame | None = None, file_hashes: DataFrame | None = None, entities: DataFrame | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One batch of ingested-event messages (`key`, `value`, ...) to one outcome row per message: (kind, topic, key, value,
    reason, at), kind being `routed`, `dead_letter` or `skipped`.

    `processed` holds keys done earlier; `file_hashes` (s3_bucket, s3_key, file_hash) are hashes of stored files; `entities`
    (idempotency_key, entities) are recognised names per message.
    """
    rows = read_contract(batch, INGESTED_EVENT, INGESTED_REQUIRED).select("key", "value", "reason", "event.*")
    rows = rows.withColumn("violations", violations(contract_rules(as_of, settings)))
    texts = F.concat(F.lit("schema_validation_failed: "), F.array_join(F.transform("violations", lambda v: v.message), PAYLOAD_REASON))
    reason = F.coalesce("reason", F.when(F.size("violations") > 0, texts))
    # Parsed once here: a filter on the checks would otherwise be pushed below the parse and repeat it per rule.
    rows = cut_lineage(rows.withColumn("reason", reason).withColumn("idempotency_key", F.col("email.idempotency_key")).drop("violations"))
    lawful, rejected = rows.filter(F.col("reason").isNull()), rows.filter(F.col("reason").isNotNull())
    marked = mark_first(lawful, "idempotency_key", ["created_at", "event_id"])
    if processed is None:
        marked = marked.withColumn("is_done", F.lit(False))
    else:
        done = processed.select("idempotency_key").distinct().withColumn("is_done", F.lit(True))
        marked = marked.join(done, "idempotency_key", "left").withColumn("is_done", F.coalesce("is_done", F.lit(False)))
    live = F.col("is_first") & ~F.col("is_done")
    skipped = marked.filter(~live)

    first = F.get("content.attachments", F.lit(0))
    verified = marked.filter(live).withColumn("s3_bucket", first["s3_bucket"]).withColumn("s3_key", first["s3_key"])
    if file_hashes is None:
        verified = verified.withColumn("file_hash", first["checksum_sha256"])
    else:
        # A message without a file joins nothing; its own id in place of the file's name keeps all those from meeting in one task.
        verified = verified.withColumn("s3_bucket", F.when(F.col("s3_key").isNotNull(), F.col("s3_bucket"))).withColumn("s3_key", F.coalesce("s3_key", "event_id"))
        # The texts are read behind this shuffle; a number of its own keeps it from being merged, by its bytes, into a few tasks.
        tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        verified = verified.repartition(tasks, "s3_bucket", "s3_key").join(file_hashes, ["s3_bucket", "s3_key"], "left")
    verified = verified.withColumn("check", x.integrity(
        F.col("content.raw_text"), F.col("content.raw_text_hash"), first.isNotNull(), F.col("file_hash"), first["checksum_sha256"]
    )).drop("s3_bucket", "s3_key", "file_hash")
    sound = verified.filter("check.passed").withColumn("raw_text", F.col("content.raw_text")).withColumn(
        "lookup_key", routing.lookup_key(F.col("email.sender"))
    )
    if entities is None:
        sound = sound.withColumn("entities", F.array().cast(array(ENTITY)))
    else:
        sound = sound.join(entities, "idempotency_key", "left")
    extracted = x.extract(sound, registry, model_output, settings=settings)
    enriched = routing.enrich(extracted, users).withColumn("issues", routing.issue_rules())
    routed = event_records(routing.build_extracted(routing.route(enriched, settings=settings)))
    damaged = verified.filter(~F.col("check.passed"))
    failed = event_records(routing.build_extracted(routing.failed_events(damaged, settings=settings), carry=["check"]), extra=["check"])

    def outcome(df: DataFrame, kind: str, topic: Column, key: Column, value: Column, reason: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), topic.alias("topic"), key.alias("key"), value.alias("value"), reason.alias("reason"), as_of.alias("at"))

    def dead(df: DataFrame, key: Column, reason: Column) -> DataFrame:
        return outcome(df, "dead_letter", F.lit(DEAD_LETTER_TOPIC), key, F.col("value"), reason)

    no_reason = F.lit(None).cast("string")
    return (
        outcome(routed, "routed", F.col("topic"), F.col("key"), F.col("value"), no_reason)
        .unionByName(outcome(skipped, "skipped", no_reason, F.col("idempotency_key"), no_reason, no_reason))
        .unionByName(dead(rejected, F.coalesce("idempotency_key", "key", F.lit("unknown")), F.col("reason")))
        .unionByName(dead(failed, F.col("key"), F.concat(F.lit("integrity_check_failed: "), F.col("check.failure_reason"))))
    )


def split_routed(outcomes: DataFrame) -> dict[str, DataFrame]:
    """Outputs of the extraction stage: routed records, dead-letter envelopes, skipped keys and keys now done."""
    def of(kind: str) -> DataFrame:
        return outcomes.filter(F.col("kind") == kind)

    letters = routing.dead_letters(of("dead_letter"), F.col("value"), F.col("key"), F.col("reason"), F.col("at"))
    return {
        "routed": of("routed").select("topic", "key", "value"), "dead_letters": letters, "skipped": of("skipped").select(F.col("key").alias("idempotency_key")),
        "processed": of("routed").select(F.col("key").alias("idempotency_key"), F.col("at").alias("processed_at")),
    }


def still_remembered(processed: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """Processed keys whose time-to-live is not over at `as_of`."""
    return processed.filter(F.timestamp_add("SECOND", F.lit(settings.dedup_ttl_seconds), F.col("processed_at")) > as_of)


def store_batch(
    batch: DataFrame, existing: DataFrame | Callable[[DataFrame], DataFrame] | None, as_of: Column, as_of_year: Column, settings: Settings = DEFAULTS,
    encoder: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One batch of extracted-event messages to one outcome row per message: (kind, key, reason, paper columns,
    validation_issues, trace), kind being `stored`, `rejected` or `skipped` (stored before, or a copy in the batch).

    `existing` are stored papers, or a function that gives the stored keys (`key`) for a frame of keys.
    A message's paper, issues, version and audit row all come from its one outcome row, so they appear together or not at all.
    """
    rows = cut_lineage(read_contract(batch, EXTRACTED_EVENT, EXTRACTED_REQUIRED))
    unreadable = rows.filter(F.col("reason").isNotNull())
    events = rows.filter(F.col("reason").isNull()).select("topic", "event.*").withColumn("paper_key", key_width_64(F.col("idempotency_key")))
    marked = mark_first(events, "paper_key", ["event_id"])
    if existing is None:
        marked = marked.withColumn("is_stored", F.lit(False))
    else:
        known = existing(marked.select(F.col("paper_key").alias("key"))) if callable(existing) else existing.select(F.col("ingestion_idempotency_key").alias("key"))
        stored = known.select(F.col("key").alias("paper_key")).distinct().withColumn("is_stored", F.lit(True))
        marked = marked.join(stored, "paper_key", "left").withColumn("is_stored", F.coalesce("is_stored", F.lit(False)))
    fresh = F.col("is_first") & ~F.col("is_stored")
    carry = ["validation_issues", "audit_trail", "idempotency_key", "is_first", "is_stored"]
    flat = store.flatten_extracted(marked, as_of, settings, carry)
    checked = flat.withColumn("violations", violations(store.paper_rules(as_of_year, settings)))
    texts = F.array_join(F.transform("violations", lambda v: v.message), PAYLOAD_REASON)
    kind = F.when(~fresh, "skipped").when(F.size("violations") > 0, "rejected").otherwise("stored")
    outcomes = checked.withColumn("kind", kind).withColumn("reason", F.when(F.col("kind") == "rejected", texts)).withColumn(
        "trace", F.col("audit_trail.trace_id")
    ).withColumn("key", F.col("ingestion_idempotency_key")).drop("violations", "audit_trail", "is_first", "is_stored")
    if encoder is not None:
        outcomes = encoder(outcomes)
    unread = unreadable.select(F.lit("rejected").alias("kind"), F.coalesce("key", F.lit("unknown")).alias("key"), "reason")
    return outcomes.unionByName(unread, allowMissingColumns=True)


def split_stored(outcomes: DataFrame) -> dict[str, DataFrame]:
    """Outputs of the storage stage: rows for papers, issues, versions and audit, plus rejected and skipped keys."""
    stored = outcomes.filter(F.col("kind") == "stored")
    columns = [c for c in outcomes.columns if c not in ("kind", "key", "reason", "trace", "validation_issues", "idempotency_key")]
    as_of = F.col("created_at")
    issues, bad_issues = split_by_rules(store.issue_rows(stored, as_of), store.stored_issue_rules())
    snapshot = [c for c in columns if c != "embedding"]
    first_version = history.first_versions(stored, "paper_id", "created_at", snapshot)
    audit = history.audit_rows(
        stored, F.lit(history.PAPER_AUDIT_ACTIONS["INSERT"]), "paper", F.col("paper_id"),
        F.struct("title", "status", "department_code", "overall_confidence"), as_of, trace=F.col("trace"),
    )
    texts = F.array_join(F.transform("violations", lambda v: v.message), PAYLOAD_REASON)
    return {
        "papers": stored.select(*columns), "issues": issues, "versions": first_version, "audit": audit,
        "rejected": outcomes.filter(F.col("kind") == "rejected").select("key", "reason"),
        "rejected_issues": bad_issues.select(F.col("issue_id").alias("key"), texts.alias("reason")),
        "skipped": outcomes.filter(F.col("kind") == "skipped").select("key"),
    }


def write_outputs(outputs: dict[str, DataFrame], base: str, batch_id: int) -> None:
    """Write each output under `batch_id=...`; a manifest row written last marks the batch complete for readers."""
    spark = next(iter(outputs.values())).sparkSession
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")
    spark.range(1).select(F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(f"{base}/_manifest/batch_id={batch_id}")


def read_output(spark: SparkSession, base: str, name: str, before: int | None = None) -> DataFrame:
    """Rows of completed batches only (those before batch `before`, if given); the manifest has one row per batch."""
    complete = spark.read.parquet(f"{base}/_manifest").select("batch_id")
    if before is not None:
        complete = complete.filter(F.col("batch_id") < before)
    return spark.read.parquet(f"{base}/{name}").join(complete, "batch_id", "left_semi").drop("batch_id")


def run_stage(
    stream: DataFrame, stage: Callable[[DataFrame, DataFrame | None], DataFrame], split: Callable[[DataFrame], dict[str, DataFrame]],
    base: str, checkpoint: str, keys_from: str, key: str | None = None,
) -> None:
    """Run a stage over everything available.

    A batch is computed once into `outcomes`; the outputs are plain reads of those files, so a lost executor never repeats the
    stage. `stage(batch, earlier)` gets the rows of output `keys_from` of earlier batches (None in the first), by which keys
    that are already done are recognised. With `key`, a column of that output, it gets a function instead, which reads the buckets of
    the keys it is asked for in the table of done keys; the batch's own keys are added to it before the batch is complete.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            earlier = None
        elif key is None:
            earlier = read_output(spark, base, keys_from, before=batch_id)
        else:
            earlier = partial(done_keys.seen, spark, f"{base}/_keys", batch_id)
        path = f"{base}/_outcomes/batch_id={batch_id}"
        outcomes = stage(batch, earlier)
        outcomes.write.mode("overwrite").parquet(path)
        outputs = split(spark.read.schema(outcomes.schema).parquet(path))
        if key is not None:
            done_keys.add(outputs[keys_from].select(F.col(key).alias("key")), f"{base}/_keys", batch_id)
        write_outputs(outputs, base, batch_id)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_ttl_gate(
    stream: DataFrame, keys: list[str], ts: str, row_id: str, base: str, checkpoint: str, settings: Settings = DEFAULTS
) -> None:
    """The TTL duplicate gate as micro-batches, for keys too hot for keyed state.

    Each batch walks acceptances like the batch form, so no key's rows meet in one task. What earlier batches accepted is read
    from their output; only acceptances younger than the TTL before the batch's first row still count. Output: `accepted`.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        remembered = None
        if batch_id > 0:
            horizon = batch.agg(F.timestamp_add("SECOND", F.lit(-settings.dedup_ttl_seconds), F.min(F.col(ts).cast("timestamp")))).first()[0]
            recent = read_output(spark, base, "accepted", before=batch_id).filter(F.col(ts) > F.lit(horizon))
            remembered = recent.groupBy(*keys).agg(F.max(ts).alias("last_accepted"))
        accepted = ttl_accepted(batch, keys, ts, row_id, settings.dedup_ttl_seconds, remembered)
        write_outputs({"accepted": accepted}, base, batch_id)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_multi_key_gate(stream: DataFrame, checked: str, marked: str, ts: str, row_id: str, base: str, checkpoint: str, settings: Settings = DEFAULTS) -> None:
    """The multi-key duplicate gate as micro-batches. Output: `accepted` (row_id, ts, key). Keys that earlier batches marked are read
    from their output, as far as they are younger than the TTL before the batch's first row."""
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        remembered = None
        if batch_id > 0:
            horizon = batch.agg(F.timestamp_add("SECOND", F.lit(-settings.dedup_ttl_seconds), F.min(F.col(ts).cast("timestamp")))).first()[0]
            recent = read_output(spark, base, "accepted", before=batch_id).filter((F.col(ts) > F.lit(horizon)) & F.col("key").isNotNull())
            remembered = recent.groupBy("key").agg(F.max(ts).alias("last_accepted"))
        write_outputs({"accepted": multi_key_accepted(batch, checked, marked, ts, row_id, settings.dedup_ttl_seconds, remembered)}, base, batch_id)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
